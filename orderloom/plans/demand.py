"""Item demand, and demand against supply per item and week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import list_part, trimmed_or_null, whole_number
from orderloom.params import Params

# What an item number looks like, and the label of this demand source.
ITEM_NUMBER = r"^[0-9]{3,8}$"
SOURCE_SYSTEM = "event_log"


# What demand is computed from, besides the event's key.
DEMAND_COLUMNS = [
    "entity_id", "event_at_utc", "expected_payload_format", "response", "feature_name",
    "is_add", "is_remove", "is_qty_change", "customer_key", "actor_type",
]


def is_demand(params: Params) -> Column:
    """Cart edits and item views within plausible times."""
    at = F.col("event_at_utc")
    viewed = F.col("feature_name").isin("item_detail", "image_enlarge")
    return (
        (at >= F.lit(params.go_live))
        & (at <= params.now())
        & (classify.is_cart_edit() | viewed)
    )


def demand_events(enriched: DataFrame, params: Params) -> DataFrame:
    """Cart edits and item views with a well-formed item number, within plausible times."""
    at = F.col("event_at_utc")
    layout = F.col("expected_payload_format")
    sku = F.when(layout == "positional", list_part("response", 1)).when(
        layout == "sku", trimmed_or_null("response")
    )
    quantity = F.when(
        (layout == "positional") & F.col("is_add"),
        whole_number(list_part("response", 2), "int"),
    )
    return (
        enriched.filter(is_demand(params))
        .select(
            clock.day(at).alias("activity_date"),
            sku.alias("sku"),
            quantity.alias("add_qty"),
            "customer_key",
            "actor_type",
            "feature_name",
            "is_add",
            "is_remove",
            "is_qty_change",
        )
        .filter(F.col("sku").rlike(ITEM_NUMBER))
    )


def demand_measures() -> list[Column]:
    return [
        F.count_if(F.col("feature_name") == "item_detail").alias("item_detail_views"),
        F.count_if(F.col("feature_name") == "image_enlarge").alias("image_enlarge_views"),
        F.count_if("is_add").alias("cart_adds"),
        F.count_if("is_remove").alias("cart_removes"),
        F.count_if("is_qty_change").alias("cart_qty_changes"),
        F.sum(F.when(F.col("is_add"), F.col("add_qty")).otherwise(0)).alias("cart_add_qty"),
    ]


def demand_by_day(events: DataFrame) -> DataFrame:
    """Measures per day and item.

    Customers are reduced first, then counted: exact distinct counts without expanding the
    rows, and a popular item is spread over its customers.
    """
    measures = [
        "item_detail_views",
        "image_enlarge_views",
        "cart_adds",
        "cart_removes",
        "cart_qty_changes",
        "cart_add_qty",
    ]
    per_customer = events.groupBy("sku", "activity_date", "customer_key").agg(
        *demand_measures(),
        F.max(F.col("actor_type") == "customer").alias("_self"),
    )
    return per_customer.groupBy("sku", "activity_date").agg(
        *[F.sum(m).alias(m) for m in measures],
        F.count("customer_key").alias("distinct_customers"),
        F.count(F.when(F.col("_self"), F.col("customer_key"))).alias("distinct_self_customers"),
    )


def item_demand_daily(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    by_day = demand_by_day(demand_events(enriched, params))
    return by_day.select(
        "activity_date",
        "sku",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        *[c for c in by_day.columns if c not in ("activity_date", "sku")],
    )


def _stock_by_day(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("prtnum", "snapshot_date").agg(
        *[F.sum(q).alias(q) for q in ("shippable_qty", "on_hand_qty", "planned_qty", "pnd_rcvqty")]
    )


def supply_eow(inventory: DataFrame) -> DataFrame:
    """Shippable stock at the last snapshot of each item week."""
    return (
        _stock_by_day(inventory)
        .groupBy("prtnum", clock.week_start("snapshot_date").alias("week_start"))
        .agg(F.max_by("shippable_qty", "snapshot_date").alias("shippable_eow"))
    )


def _demand_and_stock_by_day(demand_daily: DataFrame, inventory: DataFrame) -> DataFrame:
    """Demand and stock of the same item and day side by side; either may be missing.

    Both are rows of one aggregation. A join would hold the aggregates and the sorted rows of
    both sides in one task.
    """
    sums = ["item_views", "cart_adds", "cart_removes", "cart_add_qty"]
    stocks = ["shippable_qty", "on_hand_qty", "planned_qty", "pnd_rcvqty"]
    demand = demand_daily.withColumn(
        "item_views", F.col("item_detail_views") + F.col("image_enlarge_views")
    ).select(
        F.col("sku").alias("prtnum"),
        F.col("activity_date").alias("day"),
        *sums,
        F.col("distinct_customers").alias("customers"),
        F.lit(True).alias("has_demand"),
    )
    stock = inventory.select(
        "prtnum", F.col("snapshot_date").alias("day"), *stocks, F.lit(True).alias("has_stock")
    )
    return (
        demand.unionByName(stock, allowMissingColumns=True)
        .groupBy("prtnum", "day")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.max("customers").alias("customers"),
            F.max("has_demand").alias("has_demand"),
            *[F.sum(c).alias(c) for c in stocks],
            F.max("has_stock").alias("has_stock"),
        )
        .withColumn("inbound_qty", F.col("planned_qty") + F.col("pnd_rcvqty"))
        .drop("planned_qty", "pnd_rcvqty")
    )


def _dated_item() -> Column:
    """Demand and stock without an item or a day are not of the same one."""
    return F.col("prtnum").isNotNull() & F.col("day").isNotNull()


def oos_overlap(demand_daily: DataFrame, inventory: DataFrame) -> DataFrame:
    """Demand of each item week that fell on a day without shippable stock."""
    both = _demand_and_stock_by_day(demand_daily, inventory).filter(
        F.col("has_demand") & F.col("has_stock") & _dated_item()
    )
    return both.groupBy("prtnum", clock.week_start("day").alias("week_start")).agg(
        *_oos_measures()
    )


def _oos_measures() -> list[Column]:
    empty = (F.col("shippable_qty") <= 0) & _dated_item()
    return [
        F.sum(F.when(empty, F.coalesce(F.col(source), F.lit(0))).otherwise(0)).alias(out)
        for source, out in (("cart_adds", "cart_adds_while_oos"), ("item_views", "views_while_oos"))
    ]


def demand_supply_weekly(demand_daily: DataFrame, inventory: DataFrame) -> DataFrame:
    """Demand, supply, end-of-week stock and their same-day overlap per item week.

    Demand and stock meet once, by day, and everything weekly comes out of one aggregation of
    these days.
    """
    days = _demand_and_stock_by_day(demand_daily, inventory)
    zero = F.lit(0).cast("bigint")
    weekly = days.groupBy("prtnum", clock.week_start("day").alias("week_start")).agg(
        *[
            F.coalesce(F.sum(c), zero).alias(c)
            for c in ("item_views", "cart_adds", "cart_removes", "cart_add_qty")
        ],
        F.coalesce(F.max("customers"), zero).alias("peak_daily_customers"),
        F.count("has_demand").alias("demand_active_days"),
        F.avg("shippable_qty").alias("avg_shippable_qty"),
        F.min("shippable_qty").alias("min_shippable_qty"),
        F.avg("on_hand_qty").alias("avg_on_hand_qty"),
        F.count_if(F.col("shippable_qty") <= 0).alias("days_out_of_stock"),
        F.count("has_stock").alias("snapshot_days"),
        F.max("inbound_qty").alias("inbound_qty_peak"),
        F.max_by("shippable_qty", F.when(F.col("has_stock"), F.col("day"))).alias("shippable_eow"),
        *_oos_measures(),
    )
    return weekly


def item_demand_supply(
    enriched: DataFrame, inventory: DataFrame, item_master: DataFrame, params: Params = Params()
) -> DataFrame:
    """Demand against supply per item and week, with the trend and the signal.

    Weeks before the first demand week are dropped before the trailing averages are taken, so
    that missing history is not read as no interest. An item's window holds its weeks only.
    """
    events = demand_events(enriched, params)
    first_week = events.agg(F.min("activity_date").alias("first")).select(
        clock.week_start("first")
    )
    weekly = demand_supply_weekly(demand_by_day(events), inventory)
    before = Window.partitionBy("prtnum").orderBy("week_start").rowsBetween(-4, -1)
    trended = (
        weekly.filter(F.col("week_start") >= first_week.scalar())
        .withColumn("demand_events", F.col("item_views") + F.col("cart_adds"))
        .withColumn("views_prior_4wk_avg", F.avg("item_views").over(before))
        .withColumn("shippable_eow_prior_4wk_avg", F.avg("shippable_eow").over(before))
    )
    base = F.col("views_prior_4wk_avg")
    trending = (base >= params.trend_min_base_views) & (
        F.col("item_views") >= params.trend_ratio * base
    )
    dry = (F.col("days_out_of_stock") >= params.oos_min_days) | (F.col("cart_adds_while_oos") > 0)
    signal = (
        F.when((F.col("demand_events") >= params.min_demand_events) & dry, "missed_opportunity")
        .when(
            trending & (F.col("shippable_eow") <= F.col("shippable_eow_prior_4wk_avg")),
            "restock_risk",
        )
        .when(
            (F.col("demand_events") <= params.promote_max_events)
            & (F.col("avg_shippable_qty") > 0),
            "promote_candidate",
        )
        .otherwise("healthy")
    )
    named = item_master.select(
        "prtnum",
        "item_name",
        "item_family",
        "abc_class",
        "abc_class_description",
        "velocity_zone",
    )
    return trended.join(named, "prtnum").select(
        "prtnum",
        "week_start",
        *named.columns[1:],
        "item_views",
        "cart_adds",
        "cart_removes",
        "cart_add_qty",
        "peak_daily_customers",
        "demand_active_days",
        "demand_events",
        "views_prior_4wk_avg",
        "avg_shippable_qty",
        "min_shippable_qty",
        "avg_on_hand_qty",
        "shippable_eow",
        "shippable_eow_prior_4wk_avg",
        "days_out_of_stock",
        "snapshot_days",
        "inbound_qty_peak",
        "cart_adds_while_oos",
        "views_while_oos",
        trending.alias("is_trending_interest"),
        signal.alias("signal"),
    )
