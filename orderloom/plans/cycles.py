"""Shopping cycles: a customer's behavioural events cut into bursts and order cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import kv_value, list_part
from orderloom.operators import tables
from orderloom.operators.slices import SLICE, across_slices, slice_of, up_to_here, within_slice
from orderloom.params import Params
from orderloom.session import shared_dir

_KEYS = ["customer_key"]


def cycle_events(enriched: DataFrame, params: Params) -> DataFrame:
    """Cart edits, feature use and submits of known customers, narrowed to what cycles need."""
    submit = classify.is_submit()
    edit = classify.is_cart_edit()
    behaviour = edit | F.col("feature_name").isNotNull() | submit
    return enriched.filter(
        F.col("customer_key").isNotNull() & F.col("event_at_utc").isNotNull() & behaviour
    ).select(
        "entity_id",
        "customer_key",
        "actor_type",
        "sales_code",
        "username",
        "app_name",
        "source_code",
        "event_at_utc",
        "is_add",
        "is_remove",
        "is_qty_change",
        "feature_name",
        "page_context",
        submit.alias("is_submit"),
        F.when(classify.has_order_payload(), kv_value("response", "increment_id")).alias(
            "submit_increment_id"
        ),
        F.when(edit, list_part("response", 1)).alias("cart_sku"),
        slice_of("event_at_utc", params.slice_minutes).alias(SLICE),
    )


def _starts(previous_at: Column, previous_submit: Column, at: Column, p: Params) -> dict:
    """Whether an event opens a new burst or cycle, given the customer's event before it."""
    first = previous_at.isNull()
    gap = clock.minutes_between(previous_at, at)
    burst = first | (gap >= p.cycle_gap_minutes)
    cycle = first | previous_submit | (gap >= p.cycle_abandon_days * 24 * 60)
    return {
        "starts_burst": F.coalesce(burst, F.lit(False)),
        "starts_cycle": F.coalesce(cycle, F.lit(False)),
    }


def number_cycles(events: DataFrame, params: Params) -> DataFrame:
    """Events with `cycle_seq`, `burst_seq`, the start flags and the time of the event before.

    Every time slice of a customer is numbered on its own, as if its first event started
    nothing. One summary row per slice then tells whether that first event starts a burst or a
    cycle and how many came before, and is joined back on the slice.
    """
    window = within_slice(_KEYS, "event_at_utc", "entity_id")
    lagged = events.withColumns(
        {
            "_local_at": F.lag("event_at_utc").over(window),
            "_local_submit": F.lag("is_submit").over(window),
        }
    )
    head = F.col("_local_at").isNull()
    inner = _starts(F.col("_local_at"), F.col("_local_submit"), F.col("event_at_utc"), params)
    flagged = lagged.withColumns({f"_{k}": ~head & v for k, v in inner.items()})
    running = up_to_here(window)
    local = flagged.withColumns(
        {
            "_local_bursts": F.sum(F.col("_starts_burst").cast("bigint")).over(running),
            "_local_cycles": F.sum(F.col("_starts_cycle").cast("bigint")).over(running),
        }
    )

    slices = local.groupBy(*_KEYS, SLICE).agg(
        F.min("event_at_utc").alias("first_at"),
        F.max("event_at_utc").alias("last_at"),
        F.max_by("is_submit", F.struct("event_at_utc", "entity_id")).alias("last_submit"),
        F.max("_local_bursts").alias("bursts"),
        F.max("_local_cycles").alias("cycles"),
    )
    order = across_slices(_KEYS)
    heads = slices.withColumns(
        {
            "_carried_at": F.lag("last_at").over(order),
            "_carried_submit": F.lag("last_submit").over(order),
        }
    )
    outer = _starts(F.col("_carried_at"), F.col("_carried_submit"), F.col("first_at"), params)
    heads = heads.withColumns({f"_head_{k}": v for k, v in outer.items()})
    total = up_to_here(order)
    carried = heads.select(
        F.col("customer_key").alias("_c_customer"),
        F.col(SLICE).alias("_c_slice"),
        "_carried_at",
        "_head_starts_burst",
        "_head_starts_cycle",
        # Starts up to and including the slice's first event.
        *[
            (
                F.sum(F.col(many) + F.col(f"_head_starts_{one}").cast("bigint")).over(total)
                - F.col(many)
            ).alias(f"_base_{many}")
            for one, many in (("burst", "bursts"), ("cycle", "cycles"))
        ],
    )
    joined = local.join(
        carried,
        (F.col("customer_key") == F.col("_c_customer")) & (F.col(SLICE) == F.col("_c_slice")),
    )
    return joined.select(
        *[c for c in events.columns if c != SLICE],
        F.coalesce("_local_at", "_carried_at").alias("previous_at"),
        *[
            F.when(head, F.col(f"_head_{flag}")).otherwise(F.col(f"_{flag}")).alias(flag)
            for flag in ("starts_burst", "starts_cycle")
        ],
        (F.col("_base_cycles") + F.col("_local_cycles")).alias("cycle_seq"),
        (F.col("_base_bursts") + F.col("_local_bursts")).alias("burst_seq"),
    )


def cycle_bursts(numbered: DataFrame) -> DataFrame:
    """Bursts of each cycle with their length in minutes."""
    return numbered.groupBy("customer_key", "cycle_seq", "burst_seq").agg(
        clock.minutes_between(F.min("event_at_utc"), F.max("event_at_utc")).alias("burst_minutes")
    )


def _first_app(events: str) -> Column:
    """The application with the most events; ties go to the first name, then the first code."""
    return F.min(F.struct((-F.col(events)).alias("rank"), "app_name", "source_code"))


def cycle_dominant_app(numbered: DataFrame) -> DataFrame:
    """Application with the most events of each cycle, from counts per application.

    Counts are plain sums, which stay right when an aggregate falls back to sorting; `mode` over
    a struct does not.
    """
    apps = numbered.groupBy("customer_key", "cycle_seq", "app_name", "source_code").agg(
        F.count(F.lit(1)).alias("_events")
    )
    return (
        apps.groupBy("customer_key", "cycle_seq")
        .agg(_first_app("_events").alias("_app"))
        .select("customer_key", "cycle_seq", "_app.app_name", "_app.source_code")
    )


def fct_order_cycles(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per shopping cycle, from one chain of aggregations of the numbered events.

    Bursts, active minutes and active days are sums over steps between neighbouring events. All
    measures are first reduced to one row per cycle, application and cart item, which map tasks
    do before anything is shuffled; these rows are dealt by cycle once, and give the counts per
    application, the distinct items and the totals.
    """
    return with_status(cycle_facts(cycle_events(enriched, params), params), params)


def cycle_facts(events: DataFrame, params: Params) -> DataFrame:
    """Cycles of narrowed events, without the status, which depends on the clock."""
    numbered = number_cycles(events, params)
    opens_cycle = F.col("starts_cycle")
    opens_burst = F.col("starts_burst") | opens_cycle
    opens_day = opens_cycle | (clock.day("event_at_utc") != clock.day("previous_at"))
    step = clock.minutes_between("previous_at", "event_at_utc")
    by_rep = F.col("actor_type") == "sales"
    summed = {
        "burst_count": F.count_if(opens_burst),
        "active_minutes": F.sum(F.when(opens_burst, 0).otherwise(step)),
        "days_active": F.count_if(opens_day),
        "event_count": F.count(F.lit(1)),
        "add_count": F.count_if("is_add"),
        "remove_count": F.count_if("is_remove"),
        "qty_change_count": F.count_if("is_qty_change"),
        **{f"_{f}": F.count_if(F.col("feature_name") == f) for f in classify.FEATURES},
        **{f"{s}_count": F.count_if(F.col("page_context") == s) for s in classify.PAGE_CONTEXTS},
    }
    greatest = {
        "ended_at_utc": F.col("event_at_utc"),
        "is_sales_assisted": by_rep,
        "sales_code": F.when(by_rep, F.col("sales_code")),
        "rep_username": F.when(by_rep, F.col("username")),
        "is_submitted": F.col("is_submit"),
        "submit_increment_id": F.col("submit_increment_id"),
        "submitted_at_utc": F.when(F.col("is_submit"), F.col("event_at_utc")),
    }
    parts = numbered.groupBy(
        "customer_key", "cycle_seq", "app_name", "source_code", "cart_sku"
    ).agg(
        F.min("event_at_utc").alias("started_at_utc"),
        *[F.max(value).alias(name) for name, value in greatest.items()],
        *[value.alias(name) for name, value in summed.items()],
    )
    app = Window.partitionBy("customer_key", "cycle_seq", "app_name", "source_code")
    dealt = parts.repartition("customer_key", "cycle_seq").withColumn(
        "_app_events", F.sum("event_count").over(app)
    )
    totals = dealt.groupBy("customer_key", "cycle_seq").agg(
        F.min("started_at_utc").alias("started_at_utc"),
        *[F.max(name).alias(name) for name in greatest],
        *[F.sum(name).alias(name) for name in summed],
        F.count_distinct("cart_sku").alias("distinct_skus"),
        _first_app("_app_events").alias("_app"),
    )
    features_used = sum((F.col(f"_{f}") > 0).cast("bigint") for f in classify.FEATURES)
    submitted = F.col("is_submitted")
    return totals.select(
        F.concat_ws("-", "customer_key", F.col("cycle_seq").cast("string")).alias("cycle_id"),
        "customer_key",
        "cycle_seq",
        "is_sales_assisted",
        "sales_code",
        "rep_username",
        "_app.app_name",
        "_app.source_code",
        "started_at_utc",
        "ended_at_utc",
        clock.day("started_at_utc").alias("started_date"),
        "burst_count",
        "active_minutes",
        "days_active",
        "event_count",
        "add_count",
        "remove_count",
        "qty_change_count",
        (F.col("add_count") - F.col("remove_count")).alias("net_item_events"),
        "distinct_skus",
        *[
            F.col(f"_{f}").alias(f"{f}_count")
            for f in ("search", "filter", "icon_click", "catalog_view", "item_detail", "oos_check")
        ],
        *[f"{s}_count" for s in ("promo", "backorder", "history", "suggest")],
        features_used.alias("features_used_count"),
        "is_submitted",
        "submit_increment_id",
        "submitted_at_utc",
        F.when(submitted, clock.days_between("started_at_utc", "submitted_at_utc")).alias(
            "days_to_close"
        ),
        classify.cycle_segment(
            F.col("add_count"),
            F.col("remove_count"),
            submitted,
            features_used,
            F.col("active_minutes"),
        ).alias("segment_name"),
    )


def with_status(facts: DataFrame, params: Params) -> DataFrame:
    status = classify.cycle_status(
        F.col("is_submitted"),
        clock.days_between("ended_at_utc", params.now()),
        params.cycle_abandon_days,
    )
    return facts.select(
        *[c for c in facts.columns if c != "segment_name"], status.alias("cycle_status"), "segment_name"
    )


# ---- incremental -------------------------------------------------------------------------------


def refresh_order_cycles(
    enriched: DataFrame, path: str, params: Params = Params(), day: str | None = None
) -> None:
    """Redo the cycles that the trailing window of events can have changed, and no others.

    A new event at a time t leaves alone all cycles of its customer that began before the one t
    falls into. So each customer of the window is redone from the beginning of that cycle, or
    from t if no stored cycle is near enough. The stored cycles are in blocks of the week they
    begin in; blocks whose last event is further back than a cycle can reach are not read: the
    manifest knows their times. `carry` beside the table holds each customer's last number, for
    customers with no cycle in the blocks that are read.

    `day` names the column that the events are partitioned by, if any. The status of a cycle
    depends on the clock and is added on reading, by `stored_order_cycles`.
    """
    spark = enriched.sparkSession
    events = cycle_events(enriched, params)
    table, carry = f"{path}/cycles", f"{path}/carry"
    before = tables.manifest(spark, table)
    week = F.floor(F.unix_seconds("started_at_utc") / (7 * 86_400)).cast("int")
    scratch: list[str] = []

    def written(df: DataFrame, label: str) -> DataFrame:
        scratch.append(shared_dir(spark, label))
        df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    try:
        touched, kept = [], None
        if before is None:
            facts = cycle_facts(events, params)
        else:
            newest = tables.high_water(spark, table, "ended_at_utc")
            late = tables.since(enriched, newest, "event_at_utc", params.late_window_days, day)
            first = written(
                cycle_events(late, params).groupBy("customer_key").agg(F.min("event_at_utc").alias("t")),
                "late-customers",
            )
            earliest = first.agg(F.min(F.unix_micros("t"))).first()[0]
            if earliest is None:
                return
            reach = earliest - params.cycle_abandon_days * 86_400_000_000
            near = [f for f in before["folders"] if f["high"]["ended_at_utc"] >= reach]
            stored = tables.read_table(spark, table, near)
            known = stored.join(first, "customer_key").groupBy("customer_key", "t").agg(
                F.max(F.when(F.col("started_at_utc") <= F.col("t"), F.struct("cycle_seq", "started_at_utc")))
                .alias("in_cycle"),
                F.min("cycle_seq").alias("next_seq"),
            ).drop("t")
            last = tables.read_table(spark, carry).select("customer_key", "last_seq")
            redo = written(
                first.join(known, "customer_key", "left").join(last, "customer_key", "left").select(
                    "customer_key",
                    F.coalesce("in_cycle.started_at_utc", "t").alias("redo_from"),
                    F.coalesce(
                        F.col("in_cycle.cycle_seq") - 1, F.col("next_seq") - 1, "last_seq", F.lit(0)
                    ).alias("done"),
                ),
                "redo",
            )
            oldest = redo.agg(F.min(F.unix_micros("redo_from"))).first()[0]
            again = cycle_events(tables.since(enriched, oldest, "event_at_utc", 0, day), params)
            again = again.join(redo, "customer_key").where("event_at_utc >= redo_from")
            made = cycle_facts(again.drop("redo_from", "done"), params)
            number = F.col("cycle_seq") + F.col("done")
            facts = made.join(redo, "customer_key").withColumns(
                {
                    "cycle_seq": number,
                    "cycle_id": F.concat_ws("-", "customer_key", number.cast("string")),
                }
            ).select(*made.columns)
            kept = (
                stored.join(redo, "customer_key", "left")
                .where("done IS NULL OR cycle_seq <= done")
                .select(*stored.columns)
            )
            touched = near
        facts = written(facts, "cycles")
        every = facts if kept is None else kept.unionByName(facts)
        tables.replace_blocks(spark, table, before, touched, every.withColumn(tables.BLOCK, week))
        numbers = facts.groupBy("customer_key").agg(F.max("cycle_seq").alias("last_seq"))
        bucket = F.pmod(F.xxhash64("customer_key"), F.lit(64)).cast("int")
        tables.upsert_table(numbers, carry, "customer_key", [F.desc("last_seq")], bucket)
    finally:
        for folder in scratch:
            tables.discard(spark, folder)


def stored_order_cycles(spark: SparkSession, path: str, params: Params = Params()) -> DataFrame:
    return with_status(tables.read_table(spark, f"{path}/cycles"), params)
