"""A corpus pipeline over `documents`, from the operators of `orderloom.llm`.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and is written as
Parquet to the shared folder and read again as the next one's docs. All but the last return the
columns of `documents`; the last one returns tokens in place of the text. Rows with nulls in any
column pass through the stages as the operators' docstrings say; empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import entropy_mix, language_mix, ngram_join, pii_crf, piece_scan
from orderloom.llm.common import counted, finished, finished_counted, small, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# The share that the language of a document must have in it.
MAIN_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with one main language and sets `lang` to it.

    Rejected: texts without a letter, and texts of which no language has half.
    """
    found = language_mix.identify(docs.select(*COLUMNS))
    kept = found.where(
        (F.col("lang_pred") != language_mix.UNKNOWN) & (F.col("score") >= MAIN_SHARE)
    )
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates.

    Rows that repeat a doc_id with different texts are documents of their own, the smallest by a
    hash of the text; of those with one text the first by lang, source and n_chars stays. Rows
    without a doc_id are in no group and stay.
    """
    docs = docs.select(*COLUMNS)
    repeated, repeats = counted(
        docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"),
        "repeated",
    )
    ids = small(repeated.select(F.col("doc_id").alias("_id")), repeats)
    again = F.col("_id").isNotNull()
    key = F.when(again, F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id"))
    keyed = docs.join(ids, F.col("doc_id") == F.col("_id"), "left").select(
        *COLUMNS, again.alias("_again"), key.alias("_key")
    )


    def copies_to_drop() -> DataFrame:
        groups = ngram_join.jaccard_components(keyed.select(F.col("_key").alias("doc_id"), "text"))
        found = groups.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_key"), "component_id")
        if repeats == 0:
            # keys are doc_ids, and components are named by the smallest
            return found.where("_key <> component_id").select("_key").distinct()
        names = small(*counted(keyed.where("_again").select("_key", "doc_id").distinct(), "names"))
        named = found.join(names, "_key", "left").withColumn(
            "doc_id", F.coalesce("doc_id", "_key")
        )
        # components are named by their smallest key, which is not of the smallest doc_id in these
        least = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("least"))
        moved = counted(
            least.select("component_id", F.col("least._key").alias("_first"))
            .where("_first <> component_id"),
            "moved",
        )
        return (
            found.join(small(*moved), "component_id", "left")
            .where("_key <> coalesce(_first, component_id)").select("_key").distinct()
        )

    dropped = finished_counted(spark, "dropped", copies_to_drop)
    kept = keyed.join(small(*dropped), "_key", "left_anti")
    first = F.min(F.struct("lang", "source", "n_chars")).alias("_row")
    copies = kept.where("_again").groupBy("doc_id", "text").agg(first)
    return (
        kept.where("NOT _again").select(*COLUMNS)
        .unionByName(copies.select("doc_id", "text", "_row.*"))
    )


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by the name of its kind."""
    found = pii_crf.find(docs.select(*COLUMNS), mask=True)
    changed = F.when(F.col("spans") != "", F.char_length("text").cast("long"))
    return found.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the words of each source meet its target."""
    dealt = entropy_mix.mix(docs.select(*COLUMNS), keep=("text", "lang", "n_chars"))
    repeats = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return dealt.where("copies > 0").select(*COLUMNS, repeats.alias("_copy")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every text, and the digest of what they decode to."""
    return piece_scan.encode(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

# Expectation maximisation, trained fields and segmentation by score are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = finished(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
