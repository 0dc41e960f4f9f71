"""Weekly scorecards: customers, feature pairs and representatives."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.params import Params


def customer_weekly(
    enriched: DataFrame, cycles: DataFrame, orders: DataFrame, params: Params = Params()
) -> DataFrame:
    """Behaviour, service mode, friction and churn signal per customer and ISO week."""
    key = ["customer_key", "week_start"]
    features = ("search", "filter", "icon_click", "catalog_view", "item_detail", "oos_check")
    sections = ("promo", "backorder", "history", "suggest")
    behaviour = (
        enriched.filter(F.col("customer_key").isNotNull() & F.col("event_at_utc").isNotNull())
        .groupBy("customer_key", clock.week_start("event_at_utc").alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("actor_type") == "customer").alias("self_events"),
            F.count_if(F.col("actor_type") == "sales").alias("rep_events"),
            F.count_if("is_add").alias("add_count"),
            F.count_if("is_remove").alias("remove_count"),
            F.count_if("is_qty_change").alias("qty_change_count"),
            *[F.count_if(F.col("feature_name") == f).alias(f"{f}_count") for f in features],
            *[F.count_if(F.col("page_context") == s).alias(f"{s}_count") for s in sections],
            *[
                F.count_if(F.col("l1_code") == code).alias(f"{name}_count")
                for name, code in classify.FRICTION_FAMILIES.items()
            ],
        )
    )
    cycle_weeks = cycles.groupBy(
        "customer_key", clock.week_start("started_at_utc").alias("week_start")
    ).agg(
        F.count(F.lit(1)).alias("cycles"),
        F.count_if("is_submitted").alias("cycles_submitted"),
    )
    order_weeks = (
        orders.filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key", clock.week_start("submitted_at").alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("orders_submitted"),
            F.sum("grand_total").alias("order_value_total"),
        )
    )
    friction = [f"{name}_count" for name in classify.FRICTION_FAMILIES] + ["oos_check_count"]
    churning = (F.col("remove_count") > F.col("add_count")).cast("int")
    trailing = (
        Window.partitionBy("customer_key")
        .orderBy("week_start")
        .rowsBetween(1 - params.churn_consecutive_weeks, 0)
    )
    return (
        behaviour.join(cycle_weeks, key, "left")
        .join(order_weeks, key, "left")
        .fillna(0, ["cycles", "cycles_submitted", "orders_submitted", "order_value_total"])
        .withColumn("remove_gt_add", churning)
        .select(
            *key,
            "event_count",
            "self_events",
            "rep_events",
            "cycles",
            "cycles_submitted",
            "orders_submitted",
            "order_value_total",
            "add_count",
            "remove_count",
            "qty_change_count",
            (F.col("add_count") - F.col("remove_count")).alias("net_item_events"),
            *[f"{f}_count" for f in features],
            *[f"{s}_count" for s in sections],
            *[f"{name}_count" for name in classify.FRICTION_FAMILIES],
            sum(F.col(c) for c in friction).alias("friction_total"),
            classify.service_mode(F.col("self_events"), F.col("event_count")).alias(
                "service_mode"
            ),
            "remove_gt_add",
            (F.col("remove_gt_add") == 1).alias("remove_gt_add_flag"),
            (
                F.sum("remove_gt_add").over(trailing) == params.churn_consecutive_weeks
            ).alias("churn_signal"),
        )
    )


def feature_pairing(enriched: DataFrame) -> DataFrame:
    """Feature pairs used by a customer on the same day, per week, with the weekly change.

    There are few features, so a customer's day is one bit per feature and a pair is two bits
    set. Days and customers are then plain sums: no pair rows are built before the result.
    """
    features = classify.FEATURES
    bit = F.lit(0)
    for position, feature in enumerate(features):
        bit = F.when(F.col("feature_name") == feature, 1 << position).otherwise(bit)
    days = (
        enriched.filter(
            F.col("feature_name").isNotNull()
            & F.col("customer_key").isNotNull()
            & F.col("event_at_utc").isNotNull()
        )
        .groupBy("customer_key", clock.day("event_at_utc").alias("day"))
        .agg(F.bit_or(bit).alias("used"))
    )
    pairs = list(combinations_with_replacement(range(len(features)), 2))

    def both(a: int, b: int):
        mask = (1 << a) | (1 << b)
        return F.col("used").bitwiseAND(F.lit(mask)) == mask

    customers = days.groupBy("customer_key", clock.week_start("day").alias("week_start")).agg(
        *[F.count_if(both(a, b)).alias(f"d{a}_{b}") for a, b in pairs]
    )
    weeks = customers.groupBy("week_start").agg(
        *[F.sum(f"d{a}_{b}").alias(f"d{a}_{b}") for a, b in pairs],
        *[F.count_if(F.col(f"d{a}_{b}") > 0).alias(f"c{a}_{b}") for a, b in pairs],
    )
    rows = weeks.select(
        "week_start",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(features[a]).alias("feature_a"),
                        F.lit(features[b]).alias("feature_b"),
                        F.col(f"d{a}_{b}").alias("co_occurrence_days"),
                        F.col(f"c{a}_{b}").alias("customers_count"),
                        F.col(f"d{a}_{a}").alias("days_with_a"),
                    )
                    for a, b in pairs
                ]
            )
        ),
    ).filter("co_occurrence_days > 0")
    by_pair = Window.partitionBy("feature_a", "feature_b").orderBy("week_start")
    return rows.select(
        "week_start",
        "feature_a",
        "feature_b",
        "co_occurrence_days",
        "customers_count",
        (F.col("co_occurrence_days").cast("double") / F.col("days_with_a")).alias(
            "pct_of_a_days_with_b"
        ),
        (F.col("co_occurrence_days") - F.lag("co_occurrence_days").over(by_pair)).alias(
            "wow_change"
        ),
    )


def rep_weekly(cycles: DataFrame, orders: DataFrame, admin_users: DataFrame) -> DataFrame:
    """Workload and feature use per sales code and ISO week."""
    key = ["sales_code", "week_start"]
    touched = (
        "search",
        "filter",
        "icon_click",
        "catalog_view",
        "promo",
        "backorder",
        "history",
        "suggest",
    )
    averages = {
        "avg_adds_per_cycle": "add_count",
        "avg_removes_per_cycle": "remove_count",
        "avg_net_item_events": "net_item_events",
        "avg_active_minutes": "active_minutes",
        "avg_days_to_close": "days_to_close",
    }
    uses = {f"avg_{t}_per_cycle": f"{t}_count" for t in touched}
    worked = (
        cycles.filter(F.col("is_sales_assisted") & F.col("sales_code").isNotNull())
        .groupBy("sales_code", clock.week_start("started_at_utc").alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("cycles_worked"),
            F.count_if("is_submitted").alias("cycles_submitted"),
            *[F.avg(c).alias(name) for name, c in averages.items()],
            *[
                F.avg((F.col(f"{t}_count") > 0).cast("double")).alias(f"pct_cycles_{t}")
                for t in touched
            ],
            *[F.avg(c).alias(name) for name, c in uses.items()],
        )
    )
    ordered = (
        orders.filter(F.col("sales_code").isNotNull())
        .groupBy("sales_code", clock.week_start("submitted_at").alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("orders_submitted"),
            F.sum("grand_total").alias("order_value_total"),
        )
    )
    # One display name per sales code, so that the join cannot multiply rows.
    names = (
        admin_users.filter(F.col("salesperson_code").isNotNull())
        .groupBy(F.col("salesperson_code").alias("sales_code"))
        .agg(F.max(F.concat("first_name", F.lit(" "), "last_name")).alias("rep_name"))
    )
    return (
        worked.join(ordered, key, "full")
        .join(names, "sales_code", "left")
        .fillna(0, ["orders_submitted", "order_value_total", "cycles_worked", "cycles_submitted"])
        .select(
            "sales_code",
            "rep_name",
            "week_start",
            "orders_submitted",
            "order_value_total",
            "cycles_worked",
            "cycles_submitted",
            *averages,
            *[f"pct_cycles_{t}" for t in touched],
            *uses,
        )
    )
