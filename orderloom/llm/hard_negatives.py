"""Hard negatives by angular triangle filtering.

Vectors are scaled to integers. Every row stores its angles to a few reference directions. By the
triangle inequality two such angles give an interval of the angle between an anchor and a row,
hence of its cosine; times both norms it bounds the score. Rows are ordered by (label, nearest
reference, angle to it) and cut into windows; an anchor meets a window only where the bounds
over the window's angles and norms overlap the scores it still looks for. Only these windows get
exact integer scores.

An anchor looks for scores in bands: its positives in one open band over rows of its label, then
for each positive the band of `low` to `high` hundredths of the positive's score over rows of
other labels. A row has a level by its hash, sixteen times as many rows in each as in the one
before. Levels are worked through in turn, and the best found so far raise the lower ends of the
bands, so that the hits which leave the tasks stay in proportion to the anchors. All levels
together are all rows: the result is exact.

Rows go into blocks of at most `BLOCK` rows, anchors into chunks of about `CHUNK`. Each pair of a
block and a chunk is one unit of work of bounded size, however many rows share a label: the
stated query set against all rows, in blocks. On vectors without structure the bounds exclude
little and the work is anchors times rows.

Defined results: rows whose id, label or vector is null, or whose vector holds a null or
non-finite component, take no part, nor do those whose integer vector is 2^28 long or longer,
since their scores need not fit a long. Rows that repeat id, label and vector are one; rows with
one id and different vectors are rows of their own, but not each other's candidates. Vectors of
different lengths are not compared. A zero or empty vector scores 0. Ties go to the smaller id.
Fewer candidates than asked for are all returned; an anchor without a positive, or a positive
without a negative in its band, gives no row. Extra columns are ignored; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import bounded_batches, scratch, ship, table

ship(__name__)

REFERENCES = 16
SAMPLE = 2048
BLOCK = 1024
CHUNK = 256
WINDOW = 64
# Rows of the first level, about; each level after it has GROWTH times as many.
FIRST_LEVEL = 1024
GROWTH = 16
LONGEST = float(1 << 28)
# Stored angles are 32-bit floats of an arccosine taken in doubles.
ANGLE_SLACK = 4e-6
LEAST, MOST = -(1 << 62), 1 << 62


def usable(vector: str) -> Column:
    v = F.transform(vector, lambda x: x.cast("double"))
    return F.col(vector).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )


def scaled(vector: str, scale: int) -> Column:
    """Integer components floor(scale * x); null where the vector is too long."""
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    real = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    squares = F.aggregate(real, F.lit(0.0), lambda a, x: a + x * x)
    return F.when(squares < LONGEST * LONGEST, parts.cast("array<int>"))


def references(sample: list[list[int]], most: int) -> dict[int, np.ndarray]:
    """Unit reference directions by vector length: the sample's rows that are farthest apart."""
    by_length: dict[int, list] = {}
    for row in sample:
        if any(row):
            by_length.setdefault(len(row), []).append(row)
    out = {}
    for dim, rows in by_length.items():
        x = np.array(rows, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        chosen, nearest = [0], x @ x[0]
        while len(chosen) < min(most, len(x)):
            chosen.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


def angles_to(x: np.ndarray, refs: dict[int, np.ndarray], most: int) -> np.ndarray:
    """Angles of integer vectors to the references, [rows, most]; zeros for zero vectors.

    Lengths without a sampled row use fixed random directions, fewer references repeat the last.
    """
    n, dim = x.shape
    if dim == 0 or n == 0:
        return np.zeros((n, most), np.float32)
    r = refs.get(dim)
    if r is None:
        r = np.random.default_rng(dim).normal(size=(most, dim))
        r /= np.linalg.norm(r, axis=1, keepdims=True)
    norms = np.linalg.norm(x, axis=1)
    cosines = (x @ r.T) / np.where(norms > 0, norms, 1)[:, None]
    found = np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0)
    return np.pad(found, ((0, 0), (0, most - found.shape[1])), mode="edge").astype(np.float32)


def window_edges(labels: np.ndarray, homes: np.ndarray, most: int) -> np.ndarray:
    """Borders of windows: at each change of label or nearest reference, and every `most` rows."""
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (homes[1:] != homes[:-1])
    starts = np.flatnonzero(new)
    place = np.arange(len(labels)) - starts[np.cumsum(new) - 1]
    return np.append(np.flatnonzero(place % most == 0), len(labels))


def bounds(block: dict, anchors: dict, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each anchor with the rows of each window."""
    at = edges[:-1]
    low, high = (f.reduceat(block["angles"], at, axis=0) for f in (np.minimum, np.maximum))
    short, long = (f.reduceat(block["norms"], at) for f in (np.minimum, np.maximum))
    near = np.zeros((len(anchors["norms"]), len(at)))
    far = np.full_like(near, np.pi)
    for r in range(low.shape[1]):
        a = anchors["angles"][:, r : r + 1].astype(np.float64)
        lo, hi = low[None, :, r].astype(np.float64), high[None, :, r].astype(np.float64)
        np.maximum(near, np.maximum(a - hi, lo - a), out=near)
        np.minimum(far, np.minimum(a + hi, 2 * np.pi - a - lo), out=far)
    top = np.cos(np.clip(near - ANGLE_SLACK, 0, np.pi))
    low_cos = np.cos(np.clip(far + ANGLE_SLACK, 0, np.pi))
    norm = anchors["norms"][:, None]
    most = norm * np.where(top >= 0, long, short) * top
    least = norm * np.where(low_cos >= 0, short, long) * low_cos
    slack = 1e-9 * norm * long + 1e-6
    return least - slack, most + slack


def integer_scores(a: np.ndarray, b: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products: in doubles while every partial sum is below 2^53."""
    if size < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def best_of(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group, by score, then by the smaller id."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    start = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0))
    return order[rank < k]


def block_hits(block: dict, anchors: dict, same: bool, k: int) -> tuple[dict, int]:
    """The best k rows of a block for each band of each anchor, and how many pairs were scored.

    `anchors` has low and high as [anchors, bands]; a band that is not used has low > high.
    """
    edges = window_edges(block["labels"], np.argmin(block["angles"], axis=1), WINDOW)
    least, most = bounds(block, anchors, edges)
    alike = anchors["labels"][:, None] == block["labels"][edges[:-1]][None, :]
    overlap = (most[:, :, None] >= anchors["low"][:, None, :]) & (
        least[:, :, None] <= anchors["high"][:, None, :]
    )
    used = (anchors["low"] <= anchors["high"])[:, None, :]
    meets = (overlap & used).any(axis=2) & (alike if same else ~alike)
    found, scored = [], 0
    size = float(anchors["norms"].max(initial=0) * block["norms"].max(initial=0))
    for w in np.flatnonzero(meets.any(axis=0)):
        rows = np.arange(edges[w], edges[w + 1])
        asking = np.flatnonzero(meets[:, w])
        scores = integer_scores(anchors["vectors"][asking], block["vectors"][rows], size)
        scored += scores.size
        own = anchors["ids"][asking][:, None] == block["ids"][rows][None, :]
        for band in range(anchors["low"].shape[1]):
            fits = (scores >= anchors["low"][asking, band][:, None]) & ~own
            fits &= scores <= anchors["high"][asking, band][:, None]
            if fits.any():
                held = np.where(fits, scores, LEAST)
                n = min(k, len(rows))
                # ties with the n-th best stay until ids decide
                floor = np.partition(held, len(rows) - n, axis=1)[:, len(rows) - n]
                i, j = np.nonzero(fits & (held >= floor[:, None]))
                found.append((asking[i], np.full(len(i), band), rows[j], scores[i, j]))
    if not found:
        none = np.zeros(0, np.int64)
        return {"anchor": none, "band": none, "row": none, "score": none}, scored
    anchor, band, row, score = (np.concatenate(x) for x in zip(*found))
    group = anchor * anchors["low"].shape[1] + band
    keep = best_of(group, score, block["ids"][row], k)
    hits = {"anchor": anchor[keep], "band": band[keep], "row": row[keep], "score": score[keep]}
    return hits, scored


ROW = "level int, dim int, id long, label long, q array<int>, norm double, angles array<float>"
PACKED = (
    "level int, dim int, ids array<long>, labels array<long>, qs array<int>, norms array<double>, "
    "angles array<float>"
)


def measured(rows: DataFrame, refs: dict[int, np.ndarray], most: int) -> DataFrame:
    """Rows with their norm and their angles to the references."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            norms = np.zeros(len(dims))
            angles = np.zeros((len(dims), most), np.float32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                flat = batch.column("q").take(pa.array(at)).flatten()
                x = np.asarray(flat).astype(np.float64).reshape(len(at), dim)
                norms[at] = np.linalg.norm(x, axis=1)
                angles[at] = angles_to(x, refs, most)
            offsets = pa.array(np.arange(0, angles.size + 1, most, dtype=np.int32))
            listed = pa.ListArray.from_arrays(offsets, pa.array(angles.ravel()))
            columns = [batch.column(c) for c in ("level", "dim", "id", "label", "q")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(norms), listed], schema=_arrow_schema(batch)
            )

    def _arrow_schema(batch: pa.RecordBatch) -> pa.Schema:
        held = [batch.schema.field(c) for c in ("level", "dim", "id", "label", "q")]
        return pa.schema(
            [*held, pa.field("norm", pa.float64()), pa.field("angles", pa.list_(pa.float32()))]
        )

    return rows.select("level", "dim", "id", "label", "q").mapInArrow(measure, ROW)


def packed(rows: DataFrame, most: int = BLOCK) -> DataFrame:
    """Blocks of neighbouring rows: one record holds up to `most` rows of one level and length."""
    home = F.array_position("angles", F.array_min("angles"))
    order = ["level", "dim", "label", "_home", "_near", "id"]
    dealt = rows.withColumns({"_home": home, "_near": F.array_min("angles")})
    ordered = dealt.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, dim = (np.asarray(batch.column(c)) for c in ("level", "dim"))
            new = np.flatnonzero((level[1:] != level[:-1]) | (dim[1:] != dim[:-1])) + 1
            edges = [0, *new.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                for lo in range(a, b, most):
                    part = batch.slice(lo, min(most, b - lo))
                    lists = [pa.array([np.asarray(part.column(c))]) for c in ("id", "label", "norm")]
                    flat = {c: np.asarray(part.column(c).flatten()) for c in ("q", "angles")}
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("level").slice(0, 1),
                            part.column("dim").slice(0, 1),
                            lists[0],
                            lists[1],
                            pa.array([flat["q"]], pa.list_(pa.int32())),
                            lists[2],
                            pa.array([flat["angles"]], pa.list_(pa.float32())),
                        ],
                        names=["level", "dim", "ids", "labels", "qs", "norms", "angles"],
                    )

    return ordered.select("level", "dim", "id", "label", "q", "norm", "angles").mapInArrow(
        pack, PACKED
    )


def chunked(anchors: DataFrame, count: int) -> tuple[DataFrame, int]:
    """Anchors with their bands (low, high arrays) in chunks of about CHUNK, of one length each."""
    chunks = max(1, -(-count // CHUNK))
    fields = ["id", "key", "label", "q", "norm", "angles", "low", "high"]
    listed = anchors.groupBy(
        F.pmod(F.xxhash64("id", "key"), F.lit(chunks)).cast("int").alias("chunk"), "dim"
    ).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("asks"))
    flat = {f: F.col(f"asks.{f}") for f in ("id", "key", "label", "norm")}
    nested = {f: F.flatten(F.col(f"asks.{f}")) for f in ("q", "angles", "low", "high")}
    made = listed.select(
        "chunk", F.col("dim").alias("a_dim"),
        *[c.alias(f"a_{f}") for f, c in {**flat, **nested}.items()],
    )
    return made, chunks


def level_hits(blocks: DataFrame, anchors: DataFrame, count: int, same: bool, k: int) -> DataFrame:
    """(id, key, band, hit, score): the best k of each block for each anchor and band."""
    asks, chunks = chunked(anchors, count)
    each = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    pairs = blocks.withColumn("chunk", each).join(
        asks.withColumnRenamed("a_dim", "dim"), ["chunk", "dim"]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: np.asarray(batch.column(c)[i].values)  # noqa: E731, B023
                dim = batch.column("dim")[i].as_py()
                block = {"ids": get("ids"), "labels": get("labels"), "norms": get("norms")}
                n = len(block["ids"])
                block["vectors"] = get("qs").reshape(n, dim)
                block["angles"] = get("angles").reshape(n, -1)
                ask = {"ids": get("a_id"), "labels": get("a_label"), "norms": get("a_norm")}
                m, keys = len(ask["ids"]), get("a_key")
                ask["vectors"] = get("a_q").reshape(m, dim)
                ask["angles"] = get("a_angles").reshape(m, -1)
                ask["low"] = get("a_low").reshape(m, -1)
                ask["high"] = get("a_high").reshape(m, -1)
                hits, _ = block_hits(block, ask, same, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ask["ids"][hits["anchor"]]),
                        pa.array(keys[hits["anchor"]]),
                        pa.array(hits["band"].astype(np.int32)),
                        pa.array(block["ids"][hits["row"]]),
                        pa.array(hits["score"]),
                    ],
                    names=["id", "key", "band", "hit", "score"],
                )

    return pairs.mapInArrow(score, "id long, key long, band int, hit long, score long")


def best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id", "key", "band").orderBy(F.desc("score"), "hit")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def look(blocks: DataFrame, levels: int, anchors: DataFrame, count: int, same: bool, k: int) -> DataFrame:
    """(id, key, band, hit, score, rank) over all levels; `anchors` have their bands.

    After each level an anchor's k-th best of a band, where it has k, becomes the band's low end.
    """
    found = None
    for level in range(levels):
        asking = anchors
        if found is not None:
            reached = F.map_from_entries(F.collect_list(F.struct("band", "score")))
            floors = found.where(F.col("rank") == k).groupBy("id", "key").agg(reached.alias("_floor"))
            raised = F.transform(
                "low", lambda x, i: F.greatest(x, F.coalesce(F.col("_floor")[i], F.lit(LEAST)))
            )
            asking = anchors.join(floors, ["id", "key"], "left").withColumn("low", raised)
        hits = level_hits(blocks.where(F.col("level") == level), asking, count, same, k)
        if found is not None:
            hits = hits.unionByName(found.drop("rank"))
        found = scratch(best(hits, k), "hits")
    return found


def mine(
    vectors: DataFrame,
    vec_id: str,
    vector: str,
    label: str | Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    most_references: int = REFERENCES,
    first_level: int = FIRST_LEVEL,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    label = F.col(label) if isinstance(label, str) else label
    rows = (
        vectors.where(usable(vector) & F.col(vec_id).isNotNull() & label.isNotNull())
        .select(
            F.col(vec_id).cast("long").alias("id"),
            label.cast("long").alias("label"),
            scaled(vector, scale).alias("q"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        )
        .where("q IS NOT NULL")
        .distinct()
        .withColumn("key", F.xxhash64("label", "q"))
        .withColumn("dim", F.size("q"))
    )
    held = scratch(rows, "vectors")
    count, asked = held.agg(F.count("*"), F.count_if("asks")).first()
    levels = 1
    while count > first_level * GROWTH ** (levels - 1):
        levels += 1
    # row i of 16^j has the last digit that is not zero at place j: level by trailing zeros
    spot = F.pmod(F.xxhash64("key", "id"), F.lit(GROWTH ** (levels - 1)))
    level = F.lit(levels - 1)
    for below in range(1, levels):
        level = F.when(spot % GROWTH**below == 0, levels - 1 - below).otherwise(level)
    sample = held.select("q").orderBy(F.hash("key", "id"), "id").limit(SAMPLE)
    refs = references([r[0] for r in sample.collect()], most_references)
    marked = measured(held.withColumn("level", level.cast("int")), refs, most_references)
    blocks = scratch(packed(marked), "blocks")
    asking = scratch(
        measured(held.where("asks").withColumn("level", F.lit(0)), refs, most_references)
        .withColumn("key", F.xxhash64("label", "q")).drop("level"),
        "anchors",
    )
    anyone = asking.withColumns(
        {
            "low": F.array(F.lit(LEAST).cast("long")),
            "high": F.array(F.lit(MOST).cast("long")),
        }
    )
    near = look(blocks, levels, anyone, asked, True, positives)
    # 100 * negative >= low * positive and <= high * positive, in whole numbers
    up, down = F.col("score") * low + 99, F.col("score") * high
    ends = near.select(
        "id", "key", "rank", "score",
        ((up - F.pmod(up, F.lit(100))) / 100).cast("long").alias("from"),
        ((down - F.pmod(down, F.lit(100))) / 100).cast("long").alias("to"),
    )
    listed = F.collect_list(F.struct("rank", "from", "to"))
    bands = ends.groupBy("id", "key").agg(F.map_from_entries(
        F.transform(listed, lambda x: F.struct(x["rank"], x))).alias("bands"))
    places = F.sequence(F.lit(1), F.lit(positives))
    end = lambda name, none: F.transform(
        places, lambda i: F.coalesce(F.col("bands")[i][name], F.lit(none).cast("long"))
    )
    with_bands = asking.join(bands, ["id", "key"]).select(
        "*", end("from", MOST).alias("low"), end("to", LEAST).alias("high")
    ).drop("bands")
    far = look(blocks, levels, with_bands, asked, False, negatives)
    return far.join(
        near.select(
            "id", "key", (F.col("rank") - 1).alias("band"),
            F.col("hit").alias("positive_id"), F.col("score").alias("positive_score"),
        ),
        ["id", "key", "band"],
    ).select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("hit").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, "vec_id", "embedding", label, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id
    ORDER BY negative_score DESC, negative_id)::INTEGER AS rank,
  negative_id, positive_score, negative_score
FROM n QUALIFY rank <= 3
"""
