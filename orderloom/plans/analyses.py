"""Top lists over the finished demand-supply mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ITEM = ["prtnum", "item_name", "item_family", "abc_class"]


def _latest_week(mart: DataFrame, signal: str) -> DataFrame:
    newest = mart.agg(F.max("week_start")).scalar()
    return mart.filter((F.col("signal") == signal) & (F.col("week_start") == newest))


def missed_opportunity(mart: DataFrame) -> DataFrame:
    """Items wanted in the latest week while the warehouse could not ship them."""
    return (
        _latest_week(mart, "missed_opportunity")
        .orderBy(F.desc("cart_adds_while_oos"), F.desc("demand_events"), "prtnum")
        .select(
            *_ITEM,
            "week_start",
            "item_views",
            "cart_adds",
            "cart_adds_while_oos",
            "views_while_oos",
            "days_out_of_stock",
            "snapshot_days",
            "avg_shippable_qty",
            "inbound_qty_peak",
        )
    )


def missed_opportunity_4wk(mart: DataFrame) -> DataFrame:
    """The same over the last four complete weeks; the newest week may be partial."""
    weeks = (
        mart.select("week_start").distinct().orderBy(F.desc("week_start")).offset(1).limit(4)
    )
    return (
        mart.filter(F.col("signal") == "missed_opportunity")
        .join(weeks, "week_start", "left_semi")
        .groupBy(*_ITEM)
        .agg(
            F.count(F.lit(1)).alias("weeks_flagged"),
            F.sum("cart_adds_while_oos").alias("cart_adds_while_oos_total"),
            F.sum("views_while_oos").alias("views_while_oos_total"),
            F.sum("days_out_of_stock").alias("days_out_of_stock_total"),
            F.avg("avg_shippable_qty").alias("avg_shippable_qty"),
        )
        .orderBy(F.desc("weeks_flagged"), F.desc("cart_adds_while_oos_total"), "prtnum")
    )


def promote_candidates(mart: DataFrame) -> DataFrame:
    """Items with stock and next to no interest in the latest week, most stock first."""
    return (
        _latest_week(mart, "promote_candidate")
        .orderBy(F.desc("avg_on_hand_qty"), "prtnum")
        .select(
            *_ITEM,
            "velocity_zone",
            "week_start",
            "item_views",
            "cart_adds",
            "demand_events",
            "avg_shippable_qty",
            "avg_on_hand_qty",
            "shippable_eow",
        )
    )


def restock_risk(mart: DataFrame) -> DataFrame:
    """Items whose interest climbs while stock does not, strongest climb first."""
    ratio = F.round(
        F.col("item_views") / F.nullif(F.col("views_prior_4wk_avg"), F.lit(0.0)), 2
    )
    return (
        _latest_week(mart, "restock_risk")
        .select(
            *_ITEM,
            "week_start",
            "item_views",
            "views_prior_4wk_avg",
            ratio.alias("views_vs_baseline_ratio"),
            "shippable_eow",
            "shippable_eow_prior_4wk_avg",
            "inbound_qty_peak",
        )
        .orderBy(F.desc("views_vs_baseline_ratio"), "prtnum")
    )
