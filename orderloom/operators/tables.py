"""Materialised tables: full rebuilds, keyed upserts and the trailing reprocess window."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from orderloom.operators.dedupe import latest_per_key
from orderloom.session import shared_dir

BLOCK = "_block"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Versions of a table that readers may still be at work on.
KEPT_VERSIONS = 3
_MANIFESTS = "_versions"
_EPOCH = "1900-01-01"


class ConcurrentWrite(RuntimeError):
    """Another writer has published a version since this one began."""


# ---- versions ----------------------------------------------------------------------------------
#
# A table is a folder of immutable data folders and of manifests, one JSON file per version. A
# manifest lists the folders that make up the version, each with its block, its rows and the
# least and greatest value of its time columns. A writer first writes its data, then publishes
# the next manifest by a rename; until then every reader sees the version before, whole.


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _files(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _read_manifest(spark: SparkSession, path: str, version: int) -> dict:
    fs, file = _files(spark, f"{path}/{_MANIFESTS}/{version:012d}.json")
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest published version of a table; None if there is none."""
    versions = _versions(spark, path)
    return _read_manifest(spark, path, versions[-1]) if versions else None


def publish(spark: SparkSession, path: str, new: dict, keep: int = KEPT_VERSIONS) -> None:
    """Make a version the newest, all or nothing, and drop what only older versions need.

    `new["version"]` is one more than the version that its writer started from. If another
    writer has published in between, this raises and the table is the other one's.
    """
    name = f"{new['version']:012d}.json"
    fs, draft = _files(spark, f"{path}/{_MANIFESTS}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps(new).encode()))
    stream.close()
    _, final = _files(spark, f"{path}/{_MANIFESTS}/{name}")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentWrite(f"version {new['version']} of {path} exists")
    versions = _versions(spark, path)
    stale, kept = versions[:-keep], versions[-keep:]
    needed = {f["folder"] for v in kept for f in _read_manifest(spark, path, v)["folders"]}
    for version in stale:
        for folder in _read_manifest(spark, path, version)["folders"]:
            if folder["folder"] not in needed:
                discard(spark, f"{path}/{folder['folder']}")
        discard(spark, f"{path}/{_MANIFESTS}/{version:012d}.json")


def _times(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, TimestampType)]


def _described(df: DataFrame, folder: str, by_block: bool) -> list[dict]:
    """Manifest entries of a data folder just written: rows and ranges of times, per block."""
    times = _times(df.schema)
    measured = [F.count(F.lit(1)).alias("_rows")] + [
        f(F.unix_micros(c)).alias(f"_{n}_{c}") for c in times for n, f in (("low", F.min), ("high", F.max))
    ]
    groups = df.groupBy(BLOCK).agg(*measured) if by_block else df.agg(*measured)
    return [
        {
            "block": r[BLOCK] if by_block else None,
            "folder": f"{folder}/{BLOCK}={r[BLOCK]}" if by_block else folder,
            "rows": r["_rows"],
            "low": {c: r[f"_low_{c}"] for c in times},
            "high": {c: r[f"_high_{c}"] for c in times},
        }
        for r in groups.collect()
    ]


def high_water(spark: SparkSession, path: str, column: str) -> int | None:
    """The greatest time in a column of a stored table, in microseconds since 1970, from its
    manifest: nothing is scanned."""
    stored = manifest(spark, path)
    known = [f["high"].get(column) for f in stored["folders"]] if stored else []
    return max((x for x in known if x is not None), default=None)


def counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of the conditions that were counted while the table was written."""
    return (manifest(spark, path) or {}).get("counts", {})


def read_table(spark: SparkSession, path: str, folders: list[dict] | None = None) -> DataFrame:
    """The newest version of a stored table, or some of its folders."""
    stored = manifest(spark, path)
    if stored is None:
        raise FileNotFoundError(f"no published table in {path}")
    schema = StructType.fromJson(stored["schema"])
    listed = [f"{path}/{f['folder']}" for f in (stored["folders"] if folders is None else folders)]
    if not listed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*listed)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run within leave no shuffle files: each drops its own as it ends.
    Otherwise they fill the executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def rebuild(
    df: DataFrame | list[DataFrame],
    path: str,
    partition_by: str | None = None,
    counted: dict[str, Column] | None = None,
) -> DataFrame:
    """Replace a table as a whole and read it back; its readers see the old one or the new one.

    Several DataFrames of one schema are written in turn, so that the disk holds the shuffles of
    one at a time; the table shows all of them or none.

    With a partition column the rows are rebalanced by it first: a large partition is split
    over tasks, small ones share a task, and neither leaves a file per task and partition.

    `counted` names conditions whose rows are counted by the tasks that write the table; the
    counts go into the manifest, see `counts`.
    """
    parts = df if isinstance(df, list) else [df]
    spark = parts[0].sparkSession
    before = manifest(spark, path)
    folder = f"data/{uuid.uuid4().hex}"
    known = dict.fromkeys(counted or {}, 0)
    try:
        for part in parts:
            seen = Observation()
            spread = part.hint("rebalance", F.col(partition_by)) if partition_by else part
            if counted:
                spread = spread.observe(seen, *[F.count_if(c).alias(n) for n, c in counted.items()])
            writer = spread.write.partitionBy(partition_by) if partition_by else spread.write
            with dropped_shuffles(spark):
                writer.mode("append").parquet(f"{path}/{folder}")
            if counted:
                known = {n: known[n] + count for n, count in seen.get.items()}
        written = spark.read.schema(parts[0].schema).parquet(f"{path}/{folder}")
        with dropped_shuffles(spark):
            folders = _described(written, folder, False)
        publish(
            spark,
            path,
            {
                "version": before["version"] + 1 if before else 1,
                "schema": written.schema.jsonValue(),
                "folders": folders,
                "batches": {},
                "counts": known,
            },
        )
    except BaseException:
        discard(spark, f"{path}/{folder}")
        raise
    return read_table(spark, path)


def materialise(df: DataFrame | list[DataFrame], label: str) -> DataFrame:
    """Compute once, read many: a written copy in the shared folder, pruned and filtered by
    its readers as any parquet table, and safe against lost executors.

    Several DataFrames of one schema are computed in turn and read back as one.
    """
    parts = df if isinstance(df, list) else [df]
    spark = parts[0].sparkSession
    path = shared_dir(spark, label)
    for part in parts:
        with dropped_shuffles(spark):
            part.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def trailing_window(
    source: DataFrame,
    target: DataFrame,
    source_ts: str,
    target_ts: str,
    days: int = 3,
    source_day: str | None = None,
) -> DataFrame:
    """Source rows no older than `days` before the newest target row; all for an empty target.

    The anchor is a scalar subquery: one row, reduced on the executors. If the source is
    partitioned by the day of its timestamp, naming that column skips the older partitions.
    """
    newest = F.coalesce(F.max(target_ts), F.lit(_EPOCH).cast("timestamp"))
    anchor = target.agg(F.timestamp_add("DAY", F.lit(-days), newest)).scalar()
    recent = source.filter(F.col(source_ts) >= anchor)
    return recent.filter(F.col(source_day) >= anchor.cast("date")) if source_day else recent


def since(
    source: DataFrame,
    newest: int | None,
    source_ts: str,
    days: int = 3,
    source_day: str | None = None,
) -> DataFrame:
    """`trailing_window` for a known newest time: the anchor is a constant of the scan's filter."""
    if newest is None:
        return source
    anchor = F.timestamp_micros(F.lit(newest - days * 86_400_000_000))
    recent = source.filter(F.col(source_ts) >= anchor)
    return recent.filter(F.col(source_day) >= anchor.cast("date")) if source_day else recent


def merge_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target with the batch's rows replacing those of the same key.

    Columns new in either side are kept and are NULL where the other side lacks them.
    """
    untouched = target.join(batch.select(key), key, "left_anti")
    return untouched.unionByName(batch, allowMissingColumns=True)


def id_block(key: str, rows: int = 10_000_000) -> Column:
    """Block of a growing numeric id: recent rows share few blocks."""
    return F.floor(F.col(key) / rows).cast("int")


def number_block(key: str, rows: int = 1_000_000) -> Column:
    """Block of a text key by the range of the number in it: late keys share few blocks."""
    digits = F.regexp_extract(key, "([0-9]{1,18})", 1).try_cast("bigint")
    return F.coalesce(F.floor(digits / rows), F.lit(-1)).cast("int")


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table from whatever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_blocks(
    spark: SparkSession,
    path: str,
    before: dict | None,
    replaced: list[dict],
    rows: DataFrame,
    batch: tuple[str, int] | None = None,
) -> None:
    """Publish a version in which `rows`, with their block, stand for the replaced folders.

    The other folders stay as they are, unread. Columns that are new in `rows` join the schema
    and are NULL in older folders. `batch` marks a stream's batch as done, in the same version.
    """
    folder = f"data/{uuid.uuid4().hex}"
    gone = {f["folder"] for f in replaced}
    try:
        # Files by block; a rebalance splits a large block over tasks and joins small ones.
        spread = rows.hint("rebalance", F.col(BLOCK))
        spread.write.partitionBy(BLOCK).parquet(f"{path}/{folder}")
        written = spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
        schema = rows.drop(BLOCK).schema
        if before:
            known = {f.name for f in schema.fields}
            older = StructType.fromJson(before["schema"]).fields
            schema = StructType(schema.fields + [f for f in older if f.name not in known])
        entries = _described(written, folder, True)
        publish(
            spark,
            path,
            {
                "version": before["version"] + 1 if before else 1,
                "schema": schema.jsonValue(),
                "folders": [f for f in (before or {"folders": []})["folders"] if f["folder"] not in gone]
                + entries,
                "batches": {**(before or {"batches": {}})["batches"], **(dict([batch]) if batch else {})},
            },
        )
    except BaseException:
        discard(spark, f"{path}/{folder}")
        raise


def append_rows(spark: SparkSession, path: str, rows: DataFrame, most: int = 16) -> None:
    """Add rows, with their block, in folders of their own; blocks of many folders become one."""
    before = manifest(spark, path)
    held: dict[int, list[dict]] = {}
    for f in before["folders"] if before else []:
        held.setdefault(f["block"], []).append(f)
    crowded = {b: folders for b, folders in held.items() if len(folders) >= most}
    for block, folders in crowded.items():
        older = read_table(spark, path, folders).withColumn(BLOCK, F.lit(block))
        rows = rows.unionByName(older, allowMissingColumns=True)
    replace_blocks(spark, path, before, [f for x in crowded.values() for f in x], rows)


def already_done(stored: dict | None, batch: tuple[str, int] | None) -> bool:
    """Whether a stream's batch is in the table: it ran before and failed after publishing."""
    return bool(stored and batch and stored["batches"].get(batch[0], -1) >= batch[1])


def upsert_table(
    batch: DataFrame,
    path: str,
    key: str,
    order: list[Column],
    block: Column,
    keep_latest: bool = False,
    batch_id: tuple[str, int] | None = None,
) -> None:
    """Insert new keys and replace known ones, rewriting only the blocks the batch touches.

    The table is partitioned by a function of its key that is never NULL, so an update never
    moves a row to another block. The batch is written to the shared folder first, since it is
    read twice; the folders of its blocks are merged with it into new folders, once, and the
    version is published last. Running the same batch again gives the same table, and a write
    that fails leaves the table as it was. The scratch copy is deleted whatever happens.

    With `keep_latest` the order also decides between a batch row and the stored row, for
    batches that may bring older versions.
    """
    spark = batch.sparkSession
    before = manifest(spark, path)
    if already_done(before, batch_id):
        return
    scratch = shared_dir(spark, "upsert-batch")
    try:
        latest = latest_per_key(batch, [key], order, batch.columns)
        latest.withColumn(BLOCK, block).write.parquet(scratch)
        fresh = spark.read.parquet(scratch)
        touched = {r[0] for r in fresh.select(BLOCK).distinct().collect()}
        folders = [f for f in before["folders"] if f["block"] in touched] if before else []
        merged = fresh.drop(BLOCK)
        if folders:
            stored = read_table(spark, path, folders)
            if keep_latest:
                both = stored.unionByName(merged, allowMissingColumns=True)
                merged = latest_per_key(both, [key], order, both.columns)
            else:
                merged = merge_by_key(stored, merged, key)
        replace_blocks(spark, path, before, folders, merged.withColumn(BLOCK, block), batch_id)
    finally:
        discard(spark, scratch)
