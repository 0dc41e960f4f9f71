"""Approximate nearest neighbours by several shifted Hilbert curves.

Every curve orders the distinct vectors by the Hilbert index of a few randomly rotated, shifted
coordinates, and is cut into `blocks` ranges of about equal size. A query meets the vectors of
its own range and of `window` ranges to either side, on each curve; the best of every window
merge and are reranked by their exact cosine. Queries are copied to the neighbouring ranges, not
vectors, so an index row goes out once per curve. Ranges that hold many rows are dealt to salted
sub-blocks, and so are their queries, so no task grows with the table.

Range borders and quantile maps come from a bounded sample (`SAMPLE` vectors); every vector is
indexed. Equal vectors are indexed once with their k + 1 smallest ids, which is all that a
result of k can need, so large groups of copies cost one row.

On vectors without structure a window must cover a share of the table, not a fixed count, for
recall to hold at every size; 16 curves with 3 of 32 ranges each reach about 0.98 there.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take
no part, nor do rows with a null id; vectors of another length are no candidates of each other.
Rows that repeat an id and vector count once. With fewer candidates than k, all are returned; a
query without any returns no row. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import scratch, ship, table

ship(__name__)

CURVES = 16
AXES = 3
BITS = 8
BLOCKS = 32
WINDOW = 1
SAMPLE = 4096
GROUP_ROWS = 16_384


def hilbert_index(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points, by the known Gray-code transform."""
    x = grid.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(axes):
            high = (x[:, i] >> level) & 1 == 1
            x[high, 0] ^= low
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[:, i] >> bit) & 1)
    return key


class Curves:
    """Rotations, quantile maps, shifts and range borders for vectors of one length."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, blocks: int, seed: int):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.axes = min(axes, dim)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.turns, self.maps, self.shifts, self.borders = [], [], [], []
        per_turn, turn = dim // self.axes, None
        for c in range(curves):
            if c % per_turn == 0:
                turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
            at = c % per_turn * self.axes
            self.turns.append(turn[:, at : at + self.axes])
            self.maps.append(np.sort(unit @ self.turns[-1], axis=0))
            self.shifts.append(rng.random(self.axes) * 0.2)
            keys = np.sort(self._keys(unit, c))
            at = np.arange(1, blocks) * len(keys) // blocks
            self.borders.append(keys[at])

    def _keys(self, unit: np.ndarray, c: int) -> np.ndarray:
        y, ranks = unit @ self.turns[c], self.maps[c]
        places = np.stack(
            [np.searchsorted(ranks[:, i], y[:, i]) for i in range(self.axes)], axis=1
        ) / len(ranks)
        grid = ((places * 0.8 + self.shifts[c]) * ((1 << BITS) - 1)).astype(np.int64)
        return hilbert_index(grid, BITS)

    def ranges(self, vectors: np.ndarray) -> np.ndarray:
        """The range of each vector on each curve: [rows, curves]."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        out = [
            np.searchsorted(b, self._keys(unit, c), side="right")
            for c, b in enumerate(self.borders)
        ]
        return np.stack(out, axis=1)


def usable(vector: str) -> F.Column:
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) > 0) & finite & F.exists(v, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids, asked): each vector once, its k + 1 smallest ids, and whether a query has it."""
    near = Window.partitionBy("v").orderBy("id")
    # repeated (id, v) rows are one; the group limit cuts copies before the shuffle
    ids = (
        rows.select("v", "id")
        .withColumn("_rank", F.dense_rank().over(near))
        .where(F.col("_rank") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    asked = rows.where("asked").select("v", F.lit(True).alias("asked")).distinct()
    return ids.join(asked, "v", "left").select(
        F.xxhash64("v").alias("key"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")
    )


def search(
    vectors: DataFrame,
    vec_id: str,
    vector: str,
    is_query: F.Column,
    k: int = 5,
    curves: int = CURVES,
    axes: int = AXES,
    blocks: int = BLOCKS,
    window: int = WINDOW,
    seed: int = 17,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("id"),
        F.col(vector).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    held = scratch(distinct_vectors(rows, k), "vectors")
    kinds = dict(held.dtypes)  # ids and components keep the types that they come in
    sizes = {r[0]: (r[1], r[2]) for r in held.groupBy(F.size("v")).agg(
        F.count("*"), F.count_if("asked")).collect()}
    fitted = {}
    for dim in sizes:
        sample = held.where(F.size("v") == dim).orderBy(F.hash("key"), "key").limit(SAMPLE)
        x = np.array([r[0] for r in sample.select("v").collect()], np.float64)
        fitted[dim] = Curves(x, curves, axes, blocks, seed)
    # sub-blocks of rows and of queries in one range of one curve
    subs = {
        dim: (math.ceil(n / blocks / GROUP_ROWS), math.ceil(q * (2 * window + 1) / blocks / 4096))
        for dim, (n, q) in sizes.items()
    }

    def place(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            out = np.zeros((len(dims), curves), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                flat = batch.column("v").take(pa.array(at)).flatten()
                x = np.asarray(flat).astype(np.float64).reshape(len(at), dim)
                out[at] = fitted[dim].ranges(x)
            placed = pa.ListArray.from_arrays(
                np.arange(0, out.size + 1, curves, dtype=np.int32), pa.array(out.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                batch.columns + [placed], names=batch.schema.names + ["ranges"]
            )

    placed = held.withColumn("dim", F.size("v")).mapInArrow(
        place, f"key long, v {kinds['v']}, ids {kinds['ids']}, asked boolean, dim int, "
        "ranges array<int>"
    )
    n_sub = F.element_at(F.create_map(*[F.lit(x) for d in subs for x in (d, subs[d][0])]), F.col("dim")) if subs else F.lit(1)
    q_sub = F.element_at(F.create_map(*[F.lit(x) for d in subs for x in (d, max(1, subs[d][1]))]), F.col("dim")) if subs else F.lit(1)
    on_curve = placed.select("*", F.posexplode("ranges").alias("curve", "block"))
    salt = F.shiftrightunsigned("key", 20)
    rows_in = on_curve.select(
        "dim", "curve", "block",
        F.pmod(salt, n_sub).cast("int").alias("sub"),
        F.explode(F.sequence(F.lit(0), q_sub - 1)).alias("qsub"),
        F.lit(False).alias("asks"), "key", "v", "ids",
    )
    asking = (
        on_curve.where("asked")
        .withColumn("qsub", F.pmod(salt, q_sub).cast("int"))
        .select(
            "dim", "curve", "qsub", "key", "v", "ids",
            F.explode(F.sequence(F.greatest(F.col("block") - window, F.lit(0)),
                                 F.least(F.col("block") + window, F.lit(blocks - 1)))).alias("block"),
        )
        .select(
            "dim", "curve", "block", F.explode(F.sequence(F.lit(0), n_sub - 1)).alias("sub"),
            "qsub", F.lit(True).alias("asks"), "key", "v", "ids",
        )
    )
    most = k + 1

    def best(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = np.asarray(group.column("asks"))
        keys = np.asarray(group.column("key"))
        dim = group.column("dim")[0].as_py()
        flat = np.asarray(group.column("v").combine_chunks().flatten())
        x = flat.astype(np.float64).reshape(-1, dim)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        from_q, from_c = [], []
        if len(q) and len(c):
            norms = np.sqrt((x * x).sum(1))
            y = (x[c] / norms[c][:, None]).T
            for lo in range(0, len(q), 256):
                part = q[lo : lo + 256]
                s = (x[part] / norms[part][:, None]) @ y
                n = min(most, len(c))
                floor = -np.partition(-s, n - 1, axis=1)[:, n - 1] - 1e-12
                i, j = np.nonzero(s >= floor[:, None])
                from_q.append(part[i])
                from_c.append(c[j])
        a = np.concatenate(from_q) if from_q else np.zeros(0, np.int64)
        b = np.concatenate(from_c) if from_c else np.zeros(0, np.int64)
        score = (x[a] * x[b]).sum(1) / (norms[a] * norms[b]) if len(a) else np.zeros(0)
        first = np.asarray(group.column("ids").combine_chunks().flatten())[
            np.asarray(group.column("ids").combine_chunks().offsets)[:-1]
        ]
        order = np.lexsort((first[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        start = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
        keep = rank < most
        a, b, score = a[keep], b[keep], score[keep]
        return pa.table(
            {"qkey": keys[a], "ckey": keys[b], "score": score,
             "ids": group.column("ids").take(pa.array(b))}
        )

    hits = (
        rows_in.unionByName(asking)
        .groupBy("dim", "curve", "block", "sub", "qsub")
        .applyInArrow(best, f"qkey long, ckey long, score double, ids {kinds['ids']}")
    )
    merged = hits.groupBy("qkey", "ckey").agg(
        F.max("score").alias("score"), F.min("ids").alias("ids")
    )
    nearest = Window.partitionBy("qkey").orderBy(F.desc("score"), "id")
    listed = (
        merged.select("qkey", "score", F.explode("ids").alias("id"))
        .withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") <= most)
        .groupBy("qkey")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "id", "score"))).alias("near"))
    )
    queries = rows.where("asked").select("id", F.xxhash64("v").alias("qkey")).distinct()
    found = queries.join(listed, "qkey").select(
        F.col("id").alias("query_id"),
        F.posexplode(
            F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
        ).alias("at", "hit"),
    )
    return found.select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("hit.id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )


def op8_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
