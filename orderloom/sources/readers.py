"""Readers and writers for the event API export, parquet sources and reference CSVs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.operators.dedupe import latest_per_key
from orderloom.operators.tables import materialise
from orderloom.sources.schemas import ENVELOPE, RAW_EVENT, SEEDS

EVENT_COLUMNS = RAW_EVENT.fieldNames()


def unnest_envelopes(envelopes: DataFrame) -> DataFrame:
    """One row per event from rows shaped like the API envelope."""
    return envelopes.select(F.explode("data.data").alias("event")).select(
        *[F.col(f"event.{name}").alias(name) for name in EVENT_COLUMNS]
    )


def read_event_envelope(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events of the paged API export; folders are read with everything below them.

    An envelope is one document per file, so the parallelism is the number of files. The
    schema is given, which saves the inference pass over the data.
    """
    reader = spark.read.schema(ENVELOPE).option("multiLine", True)
    return unnest_envelopes(reader.option("recursiveFileLookup", True).json(path))


_OPEN = "{"
_FRAGMENTS = "file string, block long, part int, body string"
WHOLE, HEAD, TAIL = 0, 1, 2


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins what lies between two beginnings of events, within each split of a file.

    What comes before a split's first beginning, and its last event, may belong together with
    other splits: they leave as fragments.
    """
    # a quote inside a text is escaped, so this can only stand where an object begins
    begins = rf'^\s*"(?:{"|".join(EVENT_COLUMNS)})"\s*:'
    at, started, held = None, False, []

    def fragment() -> list[tuple]:
        if not held:
            return []
        return [(*at, TAIL if started else HEAD, _OPEN.join(held))]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        names = ["file", "block", "part", "body"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        piece = batch.column("value")
        opens = np.asarray(pc.match_substring_regex(piece, begins).cast(pa.uint8())).astype(bool)
        files = np.asarray(batch.column("file").dictionary_encode().indices)
        blocks = np.asarray(batch.column("block"))
        new = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        out: list[tuple] = []
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(piece)]):
            here = (batch.column("file")[lo].as_py(), int(blocks[lo])) if hi > lo else at
            if here != at:
                out += fragment()
                at, started, held = here, False, []
            texts = piece.slice(lo, hi - lo).to_pylist()
            edges = np.flatnonzero(opens[lo:hi]).tolist()
            held += texts[: edges[0] if edges else hi - lo]
            for a, b in zip(edges, [*edges[1:], hi - lo]):
                out += [(*at, WHOLE, _OPEN.join(held))] if started else fragment()
                started, held = True, texts[a:b]
        yield made(out)
    yield made(fragment())


def read_large_envelope(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events of envelopes of any size: a file is read by as many tasks as it has splits.

    Spark's text reader cuts the files, by splits, at every opening brace. Tasks join the pieces
    between two beginnings of events; only the first and last piece of each split travel, to be
    joined by file. An event begins where an object's first key is a column of the event; events
    are flat, as the export has them. Several envelopes in one file are read too.
    """
    pieces = (
        spark.read.option("lineSep", _OPEN)
        .option("recursiveFileLookup", True)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    parts = pieces.mapInArrow(_assemble, _FRAGMENTS)
    whole = parts.where(F.col("part") == WHOLE).select("body")
    edges = parts.where(F.col("part") != WHOLE)
    # two rows per split: the tail of one goes on with the heads after it
    order = Window.partitionBy("file").orderBy("block", "part")
    joined = (
        edges.withColumn("_event", F.sum((F.col("part") == TAIL).cast("int")).over(order))
        .groupBy("file", "_event")
        .agg(F.sort_array(F.collect_list(F.struct("block", "part", "body"))).alias("parts"))
        .where("_event > 0")
        .select(F.array_join(F.col("parts.body"), _OPEN).alias("body"))
    )
    event = F.from_json(F.concat(F.lit(_OPEN), "body"), RAW_EVENT)
    return whole.unionByName(joined).select(event.alias("event")).select("event.*")


def read_flat_events(source: DataFrame) -> DataFrame:
    """Events that already come one per row."""
    return source.select(*EVENT_COLUMNS)


def read_parquet_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A reference CSV with its fixed column types; quoted fields may hold commas and quotes."""
    return (
        spark.read.schema(SEEDS[name])
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(f"{folder}/seed_{name}.csv")
    )


_DAMAGED = "_damaged"


def read_seed_checked(
    spark: SparkSession, folder: str, name: str, schema: StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """A reference CSV and its damaged rows: (rows, rejects with file and record).

    Damaged are records with a value that is not of its column's type, or with too few or too
    many fields. A header that differs from the schema raises.
    """
    schema = schema or SEEDS[name]
    read = (
        spark.read.schema(StructType([*schema.fields, StructField(_DAMAGED, StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _DAMAGED)
        .csv(f"{folder}/seed_{name}.csv")
        .select("*", F.col("_metadata.file_name").alias("_file"))
    )
    # parsed once: what is damaged depends on the columns that a query of the file asks for
    read = materialise(read, f"seed-{name}")
    sound = F.col(_DAMAGED).isNull()
    rejects = read.where(~sound).select(
        F.col("_file").alias("file"), F.col(_DAMAGED).alias("record"), *schema.fieldNames()
    )
    return read.where(sound).select(*schema.fieldNames()), rejects


def flatten_to_parquet(
    spark: SparkSession, source: str | list[str], target: str, large: bool = False
) -> None:
    """Unnest an export, keep the latest version of each event, write parquet. Rerunnable.

    `large` reads files by splits, for exports of few large files.
    """
    events = (read_large_envelope if large else read_event_envelope)(spark, source)
    stamp = F.col("updated_at").cast("timestamp").desc_nulls_last()
    latest_per_key(events, ["entity_id"], [stamp], events.columns).write.mode("overwrite").parquet(target)
