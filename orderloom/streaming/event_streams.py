"""Streaming forms of the late-data operators.

The batch models reprocess a trailing window and upsert by key. As a stream the same ends are
met by state: a stateful deduplication by event id in the query's state store, and stored
aggregates that every micro-batch is merged into. Bursts are stored as sessions, demand as cells
of a day and item whose customers are bitmaps; both can be merged, so no event is read twice.

A batch's merge is published in one version together with the batch's number. A batch that runs
again after a failure finds its number and changes nothing; a stream that stops anywhere and
starts again ends at the batch result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions import clock
from orderloom.operators.tables import (
    BLOCK,
    already_done,
    append_rows,
    discard,
    id_block,
    manifest,
    read_table,
    replace_blocks,
    table_exists,
    upsert_table,
)
from orderloom.params import Params
from orderloom.plans.cycles import cycle_events
from orderloom.plans.demand import (
    DEMAND_COLUMNS,
    SOURCE_SYSTEM,
    demand_events,
    demand_measures,
    is_demand,
)
from orderloom.plans.staging import stage_events
from orderloom.session import shared_dir


def read_event_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Raw events from a folder that parquet files are added to."""
    schema = spark.read.parquet(folder).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_event_upsert(raw: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keeps a table with the latest version of every event, in whatever order they arrive.

    A micro-batch that runs again after a failure writes the same rows, so the table is right
    without any state in the query.
    """

    def merge(batch: DataFrame, n: int) -> None:
        # Several source rows of an event may share a batch; staging keeps the latest.
        staged = stage_events(batch)
        newest = [F.col("updated_at").desc_nulls_last(), F.col("created_at").desc_nulls_last()]
        upsert_table(
            staged,
            target,
            "entity_id",
            newest,
            id_block("entity_id"),
            keep_latest=True,
            batch_id=(checkpoint, n),
        )

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_event_once(events: DataFrame, late: str | None) -> DataFrame:
    """Drops events whose id was seen before, by state.

    Without a limit every id is kept, one narrow row an event, and an event may be any age. With
    `late` (such as "3 days") ids are forgotten and events dropped once the newest event is that
    much ahead, which bounds the state.
    """
    if late is None:
        return events.dropDuplicates(["entity_id"])
    return events.withWatermark("event_at_utc", late).dropDuplicatesWithinWatermark(["entity_id"])


def _seen_before(events: DataFrame, stored: dict | None, batch_id: tuple[str, int]) -> bool:
    """Whether a batch is merged already. It is run even so: the query's state moves on by it."""
    if not already_done(stored, batch_id):
        return False
    events.write.format("noop").mode("overwrite").save()
    return True


def _merging(
    events: DataFrame, merge: Callable[[DataFrame, tuple[str, int]], None], checkpoint: str
) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(lambda batch, n: merge(batch, (checkpoint, n)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def session_bursts(events: DataFrame, params: Params = Params()) -> DataFrame:
    """Bursts of behavioural events per customer, as event-time sessions.

    Sessions close after an elapsed gap, whereas the cycle model counts minute boundaries; the
    two differ only for gaps within a minute of the limit.
    """
    gap = F.session_window("event_at_utc", f"{params.cycle_gap_minutes} minutes")
    return (
        events.groupBy("customer_key", gap.alias("burst"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min("event_at_utc").alias("started_at_utc"),
            F.max("event_at_utc").alias("ended_at_utc"),
        )
        .select(
            "customer_key",
            "started_at_utc",
            "ended_at_utc",
            "event_count",
            clock.minutes_between("started_at_utc", "ended_at_utc").alias("burst_minutes"),
        )
    )


def _week(seconds: Column) -> Column:
    return F.floor(seconds / (7 * 86_400)).cast("int")


def merge_sessions(
    events: DataFrame, target: str, gap_minutes: int, batch_id: tuple[str, int]
) -> None:
    """Merge new events into the stored sessions, whose block is the week they start in.

    Only blocks with a session that could touch a new one are read and rewritten: their range of
    times in the manifest tells. A new event may join two stored sessions into one. Per customer
    and week there are at most as many sessions as gaps fit into it.
    """
    spark = events.sparkSession
    before = manifest(spark, target)
    if _seen_before(events, before, batch_id):
        return
    window = F.session_window("event_at_utc", f"{gap_minutes} minutes")
    folder = shared_dir(spark, "sessions")
    week = _week(F.unix_seconds("started_at_utc"))
    try:
        events.groupBy("customer_key", window.alias("burst")).agg(
            F.min("event_at_utc").alias("started_at_utc"),
            F.max("event_at_utc").alias("ended_at_utc"),
            F.count(F.lit(1)).alias("event_count"),
        ).drop("burst").write.parquet(folder)
        fresh = spark.read.parquet(folder)
        gap = gap_minutes * 60_000_000
        ranges = fresh.groupBy(week.alias("block")).agg(
            F.min(F.unix_micros("started_at_utc")), F.max(F.unix_micros("ended_at_utc"))
        ).collect()
        if not ranges:
            return
        weeks = {r[0] for r in ranges}

        def near(f: dict) -> bool:
            low, high = f["low"]["started_at_utc"], f["high"]["ended_at_utc"]
            return f["block"] in weeks or any(
                low <= r[2] + gap and high >= r[1] - gap for r in ranges
            )

        touched = [f for f in before["folders"] if near(f)] if before else []
        every = fresh
        if touched:
            every = read_table(spark, target, touched).unionByName(fresh)
        by_start = Window.partitionBy("customer_key").orderBy("started_at_utc", "ended_at_utc")
        earlier = by_start.rowsBetween(Window.unboundedPreceding, -1)
        last = F.max(F.unix_micros("ended_at_utc")).over(earlier)
        opens = F.coalesce(F.unix_micros("started_at_utc") - last > gap, F.lit(True))
        merged = (
            every.withColumn("_opens", opens.cast("int"))
            .withColumn("_session", F.sum("_opens").over(by_start))
            .groupBy("customer_key", "_session")
            .agg(
                F.min("started_at_utc").alias("started_at_utc"),
                F.max("ended_at_utc").alias("ended_at_utc"),
                F.sum("event_count").alias("event_count"),
            )
            .drop("_session")
        )
        replace_blocks(spark, target, before, touched, merged.withColumn(BLOCK, week), batch_id)
    finally:
        discard(spark, folder)


def stream_bursts(
    enriched: DataFrame,
    target: str,
    checkpoint: str,
    params: Params = Params(),
    late: str | None = None,
) -> StreamingQuery:
    """Keeps the table of bursts up to date, open ones included: after each micro-batch
    `current_bursts` has what the events so far give. Work is in proportion to the batch and the
    weeks that it falls into."""
    events = cycle_events(enriched, params).select("entity_id", "customer_key", "event_at_utc")
    return _merging(
        each_event_once(events, late),
        lambda batch, n: merge_sessions(batch, target, params.cycle_gap_minutes, n),
        checkpoint,
    )


def current_bursts(spark: SparkSession, target: str, params: Params = Params()) -> DataFrame:
    return read_table(spark, target).select(
        "customer_key",
        "started_at_utc",
        "ended_at_utc",
        "event_count",
        clock.minutes_between("started_at_utc", "ended_at_utc").alias("burst_minutes"),
    )


# Customers are numbered in so many hash buckets, each on its own.
CODE_BUCKETS = 64
_MEASURES = [
    "item_detail_views",
    "image_enlarge_views",
    "cart_adds",
    "cart_removes",
    "cart_qty_changes",
    "cart_add_qty",
]


def code_customers(customers: DataFrame, path: str) -> DataFrame:
    """(customer_key, code) of all customers known; the new ones among `customers` are added.

    Codes are dense within each bucket and interleaved, so bitmaps are filled evenly. A customer
    never changes its code; a run that is repeated finds the codes it added.
    """
    spark = customers.sparkSession
    bucket = F.pmod(F.xxhash64("customer_key"), F.lit(CODE_BUCKETS)).cast("int")
    new = customers.where("customer_key IS NOT NULL").distinct()
    if table_exists(spark, path):
        known = read_table(spark, path)
        used = known.groupBy(bucket.alias(BLOCK)).agg(F.max("place").alias("used"))
        new = new.join(known.select("customer_key"), "customer_key", "left_anti")
    else:
        used = spark.createDataFrame([], f"{BLOCK} int, used long")
    order = Window.partitionBy(BLOCK).orderBy("customer_key")
    place = F.row_number().over(order) + F.coalesce("used", F.lit(0))
    numbered = (
        new.withColumn(BLOCK, bucket)
        .join(used, BLOCK, "left")
        .withColumn("place", place.cast("long"))
        .select("customer_key", "place", (F.col("place") * CODE_BUCKETS + F.col(BLOCK)).alias("code"), BLOCK)
    )
    folder = shared_dir(spark, "codes")
    try:
        numbered.write.parquet(folder)
        added = spark.read.schema(numbered.schema).parquet(folder)
        if not added.isEmpty():
            append_rows(spark, path, added)
        elif not table_exists(spark, path):
            return spark.createDataFrame([], "customer_key string, code long")
    finally:
        discard(spark, folder)
    return read_table(spark, path).select("customer_key", "code")


def demand_cells(events: DataFrame, codes: DataFrame) -> DataFrame:
    """Measures and customers of each day, item and bucket of customers.

    `customers` and `self_customers` are bitmaps over a bucket of 32,768 codes. Cells of one key
    can be added: measures by sum, bitmaps by or.
    """
    by_self = F.col("actor_type") == "customer"
    position = F.bitmap_bit_position("code")
    return (
        events.join(codes, "customer_key", "left")
        .groupBy("activity_date", "sku", F.bitmap_bucket_number("code").alias("bucket"))
        .agg(
            *demand_measures(),
            F.bitmap_construct_agg(position).alias("customers"),
            F.bitmap_construct_agg(F.when(by_self, position)).alias("self_customers"),
        )
    )


def merge_demand(
    events: DataFrame, target: str, params: Params, batch_id: tuple[str, int]
) -> None:
    """Add new events to the stored cells; only the weeks they fall into are read and rewritten."""
    spark = events.sparkSession
    days = f"{target}/days"
    before = manifest(spark, days)
    if _seen_before(events, before, batch_id):
        return
    folder, batch = shared_dir(spark, "cells"), shared_dir(spark, "demand-batch")
    week = _week(F.unix_date("activity_date") * F.lit(86_400).cast("long"))
    try:
        # a stateful batch is run once: what is read twice is written first
        demand_events(events, params).write.parquet(batch)
        found = spark.read.parquet(batch)
        codes = code_customers(found.select("customer_key"), f"{target}/customers")
        demand_cells(found, codes).withColumn(BLOCK, week).write.parquet(folder)
        fresh = spark.read.parquet(folder)
        weeks = {r[0] for r in fresh.select(BLOCK).distinct().collect()}
        if not weeks:
            return
        touched = [f for f in before["folders"] if f["block"] in weeks] if before else []
        every = fresh.drop(BLOCK)
        if touched:
            every = read_table(spark, days, touched).unionByName(every)
        merged = every.groupBy("activity_date", "sku", "bucket").agg(
            *[F.sum(m).alias(m) for m in _MEASURES],
            *[F.bitmap_or_agg(c).alias(c) for c in ("customers", "self_customers")],
        )
        replace_blocks(spark, days, before, touched, merged.withColumn(BLOCK, week), batch_id)
    finally:
        discard(spark, folder)
        discard(spark, batch)


def stream_daily_demand(
    enriched: DataFrame,
    target: str,
    checkpoint: str,
    params: Params = Params(),
    late: str | None = None,
) -> StreamingQuery:
    """Keeps daily demand up to date without rereading events; customers stay exact."""
    events = enriched.filter(is_demand(params)).select(*DEMAND_COLUMNS)
    return _merging(
        each_event_once(events, late),
        lambda batch, n: merge_demand(batch, target, params, n),
        checkpoint,
    )


def current_demand(spark: SparkSession, target: str, params: Params = Params()) -> DataFrame:
    """Demand per day and item with exact numbers of customers, from the stored cells."""
    cells = read_table(spark, f"{target}/days")
    return cells.groupBy("activity_date", "sku").agg(
        F.first(F.lit(SOURCE_SYSTEM)).alias("source_system"),
        *[F.sum(m).alias(m) for m in _MEASURES],
        *[
            F.sum(F.bitmap_count(c)).alias(f"distinct_{c}")
            for c in ("customers", "self_customers")
        ],
    )
