"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and pairs of words are hashed into `BUCKETS` counters, counted over all raw documents and
over the target documents. A document's log weight is the sum over its n-grams of the log ratio
of their probabilities under the two models. The k documents with the largest log weight plus
Gumbel noise are a sample without replacement in proportion to the weights. The noise is a
function of the row's doc_id and the seed, so reruns agree.

The target is all labelled good documents, or a sample of `TARGET_ROWS` of them by hash if there
are more; this bound is a parameter. Both models are tables of fixed size. The k-th largest key
is found by counting keys in bins and refining the bin it falls into, so neither the documents
nor their keys are sorted or gathered.

`mean` weights divide the sum by the number of n-grams and multiply it by `scale`: the plain sum
grows with the length of a text, so a few very long texts would decide the sample.

Defined results: a null or blank text has log weight 0 and the key of its noise. A null doc_id
never is a target and has noise of its own seed. Rows that repeat a doc_id have the same noise;
rows with equal keys at the limit are taken by doc_id, then by a fixed order. k above the number
of rows takes all. Without target documents all weights are 0. Extra columns are ignored; an
empty table gives an empty sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import (
    _mix,
    bounded_batches,
    row_slices,
    scratch,
    shingles,
    ship,
    table,
    word_hashes,
)

ship(__name__)

BUCKETS = 1 << 16
SMOOTHING = 1.0
TARGET_ROWS = 20_000
SCALE = 100.0
SEED = 11
BINS = 4096
TIES = 10_000  # rows of the last bin that are ranked together


def _grams(words: np.ndarray) -> np.ndarray:
    """Buckets of the words and pairs of words of one text."""
    if len(words) == 0:
        return np.zeros(0, np.int64)
    both = np.concatenate([_mix(words), shingles(words, 2) if len(words) > 1 else words[:0]])
    return (both >> np.uint64(48)).astype(np.int64)


def _texts(batch):
    column = batch.column("text")
    for lo, hi in row_slices(column):
        hashes, at = word_hashes(column.slice(lo, hi - lo))
        for i in range(hi - lo):
            yield lo + i, _grams(hashes[at[i] : at[i + 1]])


def fit(docs: DataFrame, target_ids: np.ndarray) -> np.ndarray:
    """Log ratio of target to raw probability of each bucket."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(np.sort(target_ids))

    def count(batches):
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).min)
            target = np.isin(np.asarray(ids), shared.value)
            for i, grams in _texts(batch):
                held = np.bincount(grams, minlength=BUCKETS)
                raw += held
                if target[i]:
                    good += held
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(raw[some]), pa.array(good[some])],
            names=["bucket", "raw", "good"],
        )

    got = (
        docs.select("doc_id", "text")
        .mapInArrow(count, "bucket long, raw long, good long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .toArrow()
    )
    raw, good = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[np.asarray(got.column("bucket"))] += np.asarray(got.column("raw"))
    good[np.asarray(got.column("bucket"))] += np.asarray(got.column("good"))
    if len(target_ids) == 0:
        return np.zeros(BUCKETS)
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def score(docs: DataFrame, ratio: np.ndarray, mean: bool = True, scale: float = SCALE) -> DataFrame:
    """(doc_id, log_weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, grams in _texts(batch):
                total = shared.value[grams].sum()
                out[i] = total * scale / len(grams) if mean and len(grams) else total
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out)], names=["doc_id", "log_weight"]
            )

    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, log_weight double")


def gumbel(seed: int) -> F.Column:
    """Standard Gumbel noise from the hash of doc_id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def top_keys(keyed: DataFrame, k: int) -> DataFrame:
    """The k rows with the largest (key, -doc_id) of a written table (doc_id, key)."""
    n, low, high = keyed.agg(F.count("*"), F.min("key"), F.max("key")).first()
    if k >= n or n == 0:
        return keyed
    if k <= 0:
        return keyed.limit(0)
    above = 0  # rows known to be above the open range [low, high]
    while True:
        inside = keyed.where((F.col("key") >= low) & (F.col("key") <= high))
        width = (high - low) / BINS
        if width <= 0:
            break
        at = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1))
        bins = (
            inside.groupBy(at.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
            .collect()
        )
        for row in sorted(bins, key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high = row["lo"], row["hi"]
        if row["n"] <= TIES or low == high:
            break
    ranked = inside.where((F.col("key") >= low) & (F.col("key") <= high))
    if low == high:
        # equal keys: ranked by salted groups of doc_id, so a tie of any size is split
        return keyed.where(F.col("key") > high).unionByName(_first(ranked, k - above))
    rank = F.row_number().over(Window.orderBy(F.desc("key"), "doc_id"))
    chosen = ranked.withColumn("_rank", rank).where(F.col("_rank") <= k - above).drop("_rank")
    return keyed.where(F.col("key") > high).unionByName(chosen)


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The k rows with the smallest hash of their doc_id."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(1024)))
    counts = salted.groupBy("_salt").agg(F.count("*").alias("n"))
    before = Window.orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_salt").orderBy("doc_id"))
    return (
        salted.withColumn("_rank", rank)
        .join(offset, "_salt")
        .where(F.col("_before") + F.col("_rank") <= k)
        .drop("_salt", "_rank", "_before")
    )


def target_sample(labels: DataFrame, bound: int = TARGET_ROWS) -> tuple[np.ndarray, float]:
    """doc_ids of at most `bound` good documents, and the share of good among all labels."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = known.where("quality = 1").select("doc_id").distinct()
    ids = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).toArrow().column("doc_id")
    share = known.agg(F.avg(F.when(F.col("quality") == 1, 1.0).otherwise(0.0))).first()[0]
    return np.asarray(ids, dtype=np.int64), 1.0 if share is None else share


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, key) of the sampled rows.

    Without k, the sample is as large as the share of good documents among the labels says.
    """
    bounded_batches(docs.sparkSession)
    ids, share = target_sample(labels)
    ratio = fit(docs, ids)
    keyed = scratch(
        score(docs, ratio).withColumn("key", F.col("log_weight") + gumbel(seed)), "weights"
    )
    if k is None:
        k = round(keyed.count() * share)
    return top_keys(keyed, k)


def op2_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
