"""N-gram Jaccard self-join: a blocked sparse product of document by n-gram incidence.

Rows of the incidence matrix are documents, columns are hashed n-grams, and the product of the
matrix with its transpose counts the n-grams two documents share. Columns are dealt to blocks;
each block multiplies its columns and gives partial counts, which are summed. Bounds that follow
from the set sizes keep the product small, and lose nothing:

* Two sets with a Jaccard index of at least t share one of their first n - ceil(t n) + 1 columns
  in any common order of columns. Only those are multiplied. The order puts columns that many
  documents hold last; how many is counted over all documents in a fixed-size table of hashed
  counters (any order is correct, this one is fast).
* Sizes must be within a factor t; a shared column must leave room for the overlap needed; and a
  summed count must reach the overlap needed less what the other columns can hold.

Documents with equal sets are one row of the matrix. The product is taken in three rounds. In the
first, each document meets the smallest one of its columns, and in the second one of the largest
component of its columns; both are checked exactly and link most copies. In the third all pairs
of a column not yet in one component are counted. So a large group of near copies costs about its
size, while no link between components is lost. Candidates are decided on their whole sets of
64-bit hashes.

Defined results: a null or blank text has an empty set and links with nothing. A text of fewer
words than `width` is one n-gram. Rows that repeat a doc_id are one document that links through
any of its texts; each row gets its own n_shingles. A null doc_id takes no part: its
component_id is null. Extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from orderloom.llm.common import (
    BROADCAST_ROWS,
    bounded_batches,
    counted,
    finished,
    finished_counted,
    row_slices,
    scratch,
    ship,
    shingles,
    small,
    table,
    word_hashes,
    _mix,
)
from orderloom.llm.components import components

ship(__name__)

WIDTH = 5
PERCENT = 75
# Counters of the column order (a power of two, one byte each in the tasks). With fewer columns
# to a counter the order tells rare columns better from common ones; any number is correct.
COUNTERS = 1 << 24
# Rows of the incidence matrix that a task multiplies at a time; one column may hold more.
GROUP_ROWS = 100_000
# N-grams of a block of whole sets, about: a bound on bytes, since sets differ in size.
BLOCK_GRAMS = 1_500_000


def text_sets(texts: pa.Array, width: int):
    """The sorted set of n-gram hashes of each text."""
    for lo, hi in row_slices(texts):
        hashes, at = word_hashes(texts.slice(lo, hi - lo))
        for i in range(hi - lo):
            yield np.unique(shingles(hashes[at[i] : at[i + 1]], width))


def column_ranks(texts: DataFrame, width: int, counters: int) -> np.ndarray:
    """A rank of 0 to 255 for each counter, by how many documents hold one of its columns.

    Every document counts. A task sends its counters packed in chunks, so that what is shuffled
    depends on the number of tasks and not on the number of columns.
    """
    shift, chunk = np.uint64(64 - counters.bit_length() + 1), min(counters, 1 << 16)

    def count(batches):
        held = np.zeros(counters, np.uint32)
        for batch in batches:
            for s in text_sets(batch.column("text"), width):
                np.add.at(held, (s >> shift).astype(np.int64), 1)
        packer = zstandard.ZstdCompressor(level=1)
        for lo in range(0, counters, chunk):
            part = held[lo : lo + chunk]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lo]), pa.array([packer.compress(part.tobytes())], pa.binary())],
                    names=["lo", "held"],
                )

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.uint64)
        for packed in group.column("held"):
            raw = zstandard.ZstdDecompressor().decompress(packed.as_py())
            total += np.frombuffer(raw, np.uint32)
        ranks = np.minimum(255, 8 * np.log2(total + 1.0)).astype(np.uint8)
        sent = zstandard.ZstdCompressor(level=1).compress(ranks.tobytes())
        return pa.table({"lo": group.column("lo")[:1], "ranks": pa.array([sent], pa.binary())})

    out = np.zeros(counters, np.uint8)
    packed = texts.mapInArrow(count, "lo long, held binary")
    for row in packed.groupBy("lo").applyInArrow(add, "lo long, ranks binary").toArrow().to_pylist():
        raw = zstandard.ZstdDecompressor().decompress(row["ranks"])
        out[row["lo"] : row["lo"] + chunk] = np.frombuffer(raw, np.uint8)
    return out


def incidence(texts: DataFrame, width: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """(doc_id, n, k1, k2, last, prefix): set size, two hashes of the set, its first columns.

    `last` is the rank of the last column of the prefix in the common order.
    """
    shared = texts.sparkSession.sparkContext.broadcast(ranks)
    shift = np.uint64(64 - len(ranks).bit_length() + 1)

    def build(batches):
        for batch in batches:
            sizes, k1, k2, last, prefixes = [], [], [], [], []
            for s in text_sets(batch.column("text"), width):
                n = len(s)
                sizes.append(n)
                k1.append(np.bitwise_xor.reduce(_mix(s)) if n else 0)
                k2.append(np.add.reduce(s) if n else 0)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                classes = shared.value[(s >> shift).astype(np.int64)]
                # sets are sorted, so a stable sort by rank orders by rank, then hash
                order = np.argsort(classes, kind="stable")[:keep]
                prefixes.append(s[order].view(np.int64))
                end = order[-1] if n else 0
                last.append((int(classes[end]) << 55) + (int(s[end]) >> 9) if n else 0)
            at = np.r_[0, np.cumsum([len(x) for x in prefixes])].astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array(last, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                ],
                names=["doc_id", "n", "k1", "k2", "last", "prefix"],
            )

    return texts.mapInArrow(
        build, "doc_id long, n long, k1 long, k2 long, last long, prefix array<long>"
    )


def whole_groups(batches, key: str):
    """Batches sorted by key, joined to larger ones and recut so that no key is split."""
    held, waiting = None, []
    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in waiting) < GROUP_ROWS:
            continue
        held = pa.concat_tables(waiting if held is None else [held, *waiting])
        waiting = []
        keys = np.asarray(held.column(key))
        cut = np.searchsorted(keys, keys[-1]) if keys[0] != keys[-1] else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if waiting:
        held = pa.concat_tables(waiting if held is None else [held, *waiting])
    if held is not None and held.num_rows:
        yield held


def _runs(cols: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Where runs begin in rows sorted by column and set size: rows of one column whose sizes
    follow each other within the size bound. Sets of two runs never link through the column."""
    return np.r_[True, (cols[1:] != cols[:-1]) | (100 * n[:-1] < percent * n[1:])]


def shared_columns(entries: DataFrame, percent: int) -> DataFrame:
    """(col, doc_id, n, at, first, first_n, first_at): columns of at least two documents whose
    sizes allow a link.

    `first` is the smallest set of the column's run of sizes.
    """

    def keep(batches):
        for t in whole_groups(batches, "col"):
            cols = np.asarray(t.column("col"))
            start = _runs(cols, np.asarray(t.column("n")), percent)
            head = np.maximum.accumulate(np.where(start, np.arange(len(cols)), 0))
            size = np.diff(np.r_[np.flatnonzero(start), len(cols)])
            several = np.repeat(size, size) > 1
            t = t.append_column("first", t.column("doc_id").take(pa.array(head)))
            t = t.append_column("first_n", t.column("n").take(pa.array(head)))
            t = t.append_column("first_at", t.column("at").take(pa.array(head)))
            yield from t.filter(pa.array(several)).combine_chunks().to_batches()

    dealt = entries.repartition("col").sortWithinPartitions("col", "n", "doc_id")
    return dealt.mapInArrow(
        keep, "col long, doc_id long, n long, at int, first long, first_n long, first_at int"
    )


def needed(a: str, b: str, percent: int) -> F.Column:
    """The smallest overlap with which two sets of these sizes reach the threshold."""
    return F.ceil((F.col(a) + F.col(b)) * percent / F.lit(100 + percent) - 1e-9)


def placed_sets(docs: DataFrame, places: DataFrame, held: int, width: int) -> DataFrame:
    """(place, doc_id, cols): the whole sets of documents at each of their places.

    `places`: (doc_id, places), a written table of `held` rows. Sets are made from the texts
    where these lie if the places can be broadcast, and shuffled once, to their places.
    """
    texts = docs.select("doc_id", "text")
    if held <= BROADCAST_ROWS // 8:
        placed = texts.join(F.broadcast(places), "doc_id")
    else:
        ids = small(places.select("doc_id"), held)
        placed = texts.join(ids, "doc_id", "left_semi").join(places, "doc_id")

    def sets(batches):
        for batch in batches:
            done = 0
            for lo, hi in row_slices(batch.column("text")):
                part = list(text_sets(batch.column("text").slice(lo, hi - lo), width))
                at = np.r_[0, np.cumsum([len(x) for x in part])].astype(np.int32)
                flat = np.concatenate(part).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, hi - lo),
                        batch.column("places").slice(done, hi - lo),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                    ],
                    names=["doc_id", "places", "cols"],
                )
                done += hi - lo

    placed = placed.select("doc_id", "text", "places")
    schema = StructType([f for f in placed.schema if f.name != "text"]).add(
        "cols", ArrayType(LongType())
    )
    return placed.mapInArrow(sets, schema).select(F.explode("places").alias("place"), "doc_id", "cols")


def exact_links(
    candidates: DataFrame,
    members: DataFrame | None,
    sizes: DataFrame,
    docs: DataFrame,
    width: int,
    percent: int,
) -> DataFrame:
    """(a, b): a link of each candidate (doc_id, group) to one document of the group, if any.

    `candidates`: distinct rows. `members`: (group, doc_id); without them each group is one
    document, which names it. The documents of a group are linked already, so one link is
    enough. Groups are cut into blocks by the n-grams they hold and the candidates of a group
    into blocks too; the whole sets of a pair of blocks are multiplied in one task, which returns
    links only. `sizes`: (doc_id, grams), a written table.
    """
    asking = Observation()
    candidates = candidates.select("doc_id", "group").observe(asking, F.count(F.lit(1)).alias("n"))
    candidates = scratch(candidates, "candidates")
    if asking.get["n"] == 0:
        return candidates.toDF("a", "b")
    if members is None:
        members = candidates.select("group", F.col("group").alias("doc_id")).distinct()
    blocks = F.ceil(F.sum("grams") / BLOCK_GRAMS).cast("int")
    sized = (
        candidates.join(sizes, "doc_id").groupBy("group").agg(blocks.alias("xs"))
        .join(members.join(sizes, "doc_id").groupBy("group").agg(blocks.alias("ys")), "group")
    )
    sized, groups = counted(sized, "group-sizes")
    asked = members.join(small(sized, groups), "group")
    salt = F.xxhash64("doc_id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = (
        candidates.join(small(sized, groups), "group")
        .select("group", "doc_id", F.pmod(salt, "xs").cast("int").alias("x"), "ys", F.lit(True).alias("asks"))
        .withColumn("y", every("ys")).drop("ys")
    ).unionByName(
        asked.select("group", "doc_id", F.pmod(salt, "ys").cast("int").alias("y"), "xs", F.lit(False).alias("asks"))
        .withColumn("x", every("xs")).drop("xs")
    )

    def multiply(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks, docs_ = np.asarray(group.column("asks")), np.asarray(group.column("doc_id"))
        lists = group.column("cols").combine_chunks()
        at, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        y = np.flatnonzero(~asks)
        size = np.diff(at)
        cols = np.concatenate([flat[at[i] : at[i + 1]] for i in y])
        owner = np.repeat(np.arange(len(y)), size[y])
        order = np.argsort(cols, kind="stable")
        cols, owner = cols[order], owner[order]
        a, b = [], []
        for i in np.flatnonzero(asks):
            mine = flat[at[i] : at[i + 1]]
            lo = np.searchsorted(cols, mine, side="left")
            many = np.searchsorted(cols, mine, side="right") - lo
            # positions of all equal columns, run after run
            where = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
            shared = np.bincount(owner[where], minlength=len(y))
            linked = 100 * shared >= percent * (size[i] + size[y] - shared)
            linked &= docs_[y] != docs_[i]
            if linked.any():
                a.append(docs_[i])
                b.append(docs_[y[linked.argmax()]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    place = F.struct("group", "x", "y", "asks")
    places = rows.groupBy("doc_id").agg(F.collect_list(place).alias("places"))
    sets = placed_sets(docs, *counted(places, "places"), width).select("place.*", "doc_id", "cols")
    return sets.groupBy("group", "x", "y").applyInArrow(multiply, "a long, b long")


# `shared` of a document with several sets, to which no bound but that of sizes applies.
UNBOUNDED = 1 << 40


def first_pairs(columns: DataFrame, ends: DataFrame, percent: int) -> DataFrame:
    """(doc_id, group): each document with the `first` it shares most columns with, of those
    that it can link with by the columns that either shares with any document.

    `ends`: (doc_id, last, sets), a written table.
    """
    room = F.least(
        F.col("n") - F.col("at"), F.col("first_n") - F.col("first_at")
    ) >= needed("n", "first_n", percent)
    votes = (
        columns.where((F.col("doc_id") != F.col("first")) & (100 * F.col("first_n") >= percent * F.col("n")) & room)
        .groupBy("doc_id", "first")
        .agg(F.count("*").alias("votes"), F.max("n").alias("n"), F.max("first_n").alias("first_n"))
    )
    held = columns.groupBy("doc_id").agg(F.count("*").alias("_n"))
    bounds = ends.join(held, "doc_id").select(
        "doc_id", "last", F.when(F.col("sets") > 1, F.lit(UNBOUNDED)).otherwise(F.col("_n")).alias("shared")
    )
    other_bounds = bounds.toDF("first", "first_last", "first_shared")
    rest, first_rest = (F.ceil(F.col(c) * percent / 100 - 1e-9) - 1 for c in ("n", "first_n"))
    outside = (
        F.when(F.greatest("shared", "first_shared") >= UNBOUNDED, F.greatest(rest, first_rest))
        .when(F.col("first_last") < F.col("last"), first_rest)
        .otherwise(rest)
    )
    able = F.least("shared", "first_shared") + outside >= needed("n", "first_n", percent)
    found = votes.join(bounds, "doc_id").join(other_bounds, "first").where(able)
    return found.groupBy("doc_id").agg(
        F.max(F.struct("votes", (-F.col("first")).alias("f"))).alias("best")
    ).select("doc_id", (-F.col("best.f")).alias("group"))


def _outside(rest, last, shared, x, y):
    """How many columns the pairs (x, y) can share outside the multiplied ones."""
    first = np.where(last[y] < last[x], rest[y], rest[x])
    loose = np.maximum(shared[x], shared[y]) >= UNBOUNDED
    return np.where(loose, np.maximum(rest[x], rest[y]), first)


def _able(n, rest, last, shared, x, y, percent: int):
    """Whether the pairs (x, y) can link, how many columns they can share outside the
    multiplied ones, and the overlap they need."""
    other = _outside(rest, last, shared, x, y)
    need = -(-percent * (n[x] + n[y]) // (100 + percent))
    fits = np.minimum(n[x], n[y]) * 100 >= percent * np.maximum(n[x], n[y])
    return fits & (np.minimum(shared[y], shared[x]) + other >= need), other, need


def cross_columns(
    columns: DataFrame, documents: DataFrame, total: int, percent: int
) -> DataFrame:
    """Columns that documents of several components hold, with each document's component, if
    their sizes allow a link.

    `total`: the number of documents. `shared` of a document is the number of its columns that
    are left.
    """
    labelled = columns.select("col", "doc_id", "n").join(documents, "doc_id")

    def mixed(batches):
        for t in whole_groups(batches, "col"):
            cols, n, root = (np.asarray(t.column(c)) for c in ("col", "n", "root"))
            start = np.flatnonzero(_runs(cols, n, percent))
            several = np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start)
            keep = np.repeat(several, np.diff(np.r_[start, len(cols)]))
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    dealt = labelled.repartition("col").sortWithinPartitions("col", "n")
    held = scratch(dealt.mapInArrow(mixed, labelled.schema), "cross")
    shared = held.groupBy("doc_id").agg(F.count("*").alias("_n"))
    return held.join(small(shared, at_most=total), "doc_id").withColumn(
        "shared", F.when(F.col("sets") > 1, F.lit(UNBOUNDED)).otherwise(F.col("_n"))
    )


def largest_neighbours(cross: DataFrame, percent: int) -> DataFrame:
    """(doc_id, group): each document with the one it meets most often as the first of the
    largest component of a column, other than its own; the group is that document alone.

    Only documents that it can link with count, so few of the texts that share some common
    words become candidates.
    """

    def vote(batches):
        for t in whole_groups(batches, "col"):
            cols, docs, root, members, n, last, shared = (
                np.asarray(t.column(c))
                for c in ("col", "doc_id", "root", "members", "n", "last", "shared")
            )
            # the largest component of each column first, the smallest root of equal ones
            order = np.lexsort((docs, root, -members, cols))
            cols, docs, root, n, last, shared = (
                v[order] for v in (cols, docs, root, n, last, shared)
            )
            start = np.r_[True, cols[1:] != cols[:-1]]
            head = np.maximum.accumulate(np.where(start, np.arange(len(cols)), 0))
            x = np.flatnonzero(root[head] != root)
            rest = -(-percent * n // 100) - 1
            x = x[_able(n, rest, last, shared, x, head[x], percent)[0]]
            docs, head = docs[x], docs[head[x]]
            order = np.lexsort((head, docs))
            docs, head = docs[order], head[order]
            at = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (head[1:] != head[:-1])])
            if len(docs):
                votes = np.diff(np.r_[at, len(docs)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[at]), pa.array(head[at]), pa.array(votes)],
                    names=["doc_id", "group", "votes"],
                )

    dealt = cross.repartition("col").sortWithinPartitions("col")
    votes = dealt.mapInArrow(vote, "doc_id long, group long, votes long")
    summed = votes.groupBy("doc_id", "group").agg(F.sum("votes").alias("votes"))
    best = summed.groupBy("doc_id").agg(
        F.max(F.struct("votes", (-F.col("group")).alias("g"))).alias("best")
    )
    return best.select("doc_id", (-F.col("best.g")).alias("group"))


def cross_candidates(cross: DataFrame, percent: int) -> DataFrame:
    """(doc_id, group): documents that could link with a document of the component `group`.

    The component of a pair with more documents is the group, so a large group of near copies
    is named once for each document outside it. Counts are summed over all columns of a
    document and a group, and dropped if they cannot reach the threshold: of two documents,
    take the one whose prefix ends first; what they share is among the multiplied columns, or
    among its other ones.
    """

    def multiply(batches):
        for t in whole_groups(batches, "col"):
            cols, docs, n, root, last, shared, size = (
                np.asarray(t.column(c))
                for c in ("col", "doc_id", "n", "root", "last", "shared", "members")
            )
            rest = -(-percent * n // 100) - 1
            start = np.flatnonzero(np.r_[True, cols[1:] != cols[:-1]])
            ends = np.r_[start[1:], len(cols)]
            found, held = [], 0
            for lo, hi in zip(start, ends):
                # all pairs but those inside the commonest component of the column
                names, counts = np.unique(root[lo:hi], return_counts=True)
                lone = root[lo:hi] != names[counts.argmax()]
                for x in lo + np.flatnonzero(lone):
                    # n is sorted: only sets within the size bound are met
                    first = np.searchsorted(n[lo:hi], -(-percent * n[x] // 100))
                    end = np.searchsorted(n[lo:hi], 100 * n[x] // percent, side="right")
                    y = np.arange(lo + first, lo + end)
                    y = y[(root[y] != root[x]) & (~lone[y - lo] | (y > x))]
                    able, other, need = _able(n, rest, last, shared, x, y, percent)
                    y, other, need = y[able], other[able], need[able]
                    if len(y) == 0:
                        continue
                    to_y = (size[y] > size[x]) | ((size[y] == size[x]) & (root[y] < root[x]))
                    found.append(
                        np.stack([
                            np.where(to_y, docs[x], docs[y]),
                            np.where(to_y, root[y], root[x]),
                            np.full(len(y), lo), other, need,
                        ])
                    )
                    held += len(y)
                    if held > 200_000:
                        yield _summed(found)
                        found, held = [], 0
            if held:
                yield _summed(found)

    dealt = cross.repartition("col").sortWithinPartitions("col", "n", "doc_id")
    partial = dealt.mapInArrow(
        multiply, "doc_id long, group long, held long, other long, need long"
    )
    total = partial.groupBy("doc_id", "group").agg(
        F.sum("held").alias("held"), F.max("other").alias("other"), F.min("need").alias("need")
    )
    return total.where("held + other >= need").select("doc_id", "group")


def _summed(found: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each document and group: in how many columns they meet, and its bounds."""
    doc, group, col, other, need = np.concatenate(found, axis=1)
    order = np.lexsort((col, group, doc))
    doc, group, col, other, need = (v[order] for v in (doc, group, col, other, need))
    pair = np.r_[True, (doc[1:] != doc[:-1]) | (group[1:] != group[:-1])]
    start = np.flatnonzero(pair)
    new_col = pair | np.r_[True, col[1:] != col[:-1]]
    values = (
        doc[start],
        group[start],
        np.add.reduceat(new_col.astype(np.int64), start),
        np.maximum.reduceat(other, start),
        np.minimum.reduceat(need, start),
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int64()) for v in values],
        names=["doc_id", "group", "held", "other", "need"],
    )


def _follow(rows: DataFrame, column: str, roots: tuple[DataFrame, int]) -> DataFrame:
    """Replaces a node by its root, where it has one. `roots`: (node, root) and their number."""
    found, number = roots
    step = small(found.select(F.col("node").alias("_node"), F.col("root").alias("_root")), number)
    return (
        rows.join(step, F.col(column) == F.col("_node"), "left")
        .withColumn(column, F.coalesce("_root", column))
        .drop("_node", "_root")
    )


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, counters: int = COUNTERS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs(doc_id, text), a written table."""
    spark = docs.sparkSession
    bounded_batches(spark)
    return finished(spark, "components", lambda: _components(docs, width, percent, counters))


def _components(docs: DataFrame, width: int, percent: int, counters: int) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = column_ranks(texts.select("text"), width, counters)
    matrix = scratch(incidence(texts, width, percent, ranks), "incidence")
    linkable = matrix.where("n > 0 AND doc_id IS NOT NULL")
    # equal sets are one row: the class is named by its smallest doc_id
    classes = linkable.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    keyed = linkable.select("doc_id", "n", "k1", "k2").join(classes, ["n", "k1", "k2"])
    copies, copied = counted(
        keyed.where("doc_id <> rep").select("doc_id", "k1", "k2", "rep").distinct(), "copies"
    )
    reps = linkable.join(
        small(copies.select("doc_id", "k1", "k2"), copied), ["doc_id", "k1", "k2"], "left_anti"
    )
    entries = reps.select("doc_id", "n", F.posexplode("prefix").alias("at", "col"))
    columns = scratch(
        shared_columns(entries.select("col", "doc_id", "n", "at"), percent), "columns"
    )
    rep_texts = texts.where("doc_id IS NOT NULL")
    held, total = counted(
        reps.groupBy("doc_id").agg(
            F.max("last").alias("last"), F.count("*").alias("sets"), F.sum("n").alias("grams")
        ),
        "prefix-ends",
    )
    ends, sizes = held.select("doc_id", "last", "sets"), held.select("doc_id", "grams")

    def links_to_one(pairs: DataFrame) -> DataFrame:
        """Links of candidates to a group of one document, which names it."""
        return exact_links(pairs, None, sizes, rep_texts, width, percent)

    near = finished(spark, "near", lambda: links_to_one(first_pairs(columns, ends, percent)))

    def labelled(links: DataFrame, columns: DataFrame):
        """Roots of the linked documents, members of all components, columns across them."""
        roots = finished_counted(spark, "roots", lambda: components(links))
        found = _follow(ends.withColumn("root", F.col("doc_id")), "root", roots)
        large = found.groupBy("root").agg(F.count("*").alias("members")).where("members > 1")
        large = small(*counted(large, "sizes"))
        found = scratch(
            found.join(large, "root", "left").withColumn(
                "members", F.coalesce("members", F.lit(1))
            ),
            "documents",
        )
        members = found.select(F.col("root").alias("group"), "doc_id")
        return roots, members, cross_columns(columns, found, total, percent)

    # second round: a document of the largest component around each document
    _, members, cross = labelled(near, columns)
    more = finished(spark, "near", lambda: links_to_one(largest_neighbours(cross, percent)))
    # columns within one component stay so
    roots, members, cross = labelled(near.union(more), cross)
    rest = finished(
        spark,
        "rest",
        lambda: exact_links(
            cross_candidates(cross, percent), members, sizes, rep_texts, width, percent
        ),
    )
    # links between components of the first round, and between the sets of a repeated doc_id
    sets = keyed.select("doc_id", "rep").distinct()
    least = sets.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
    repeated = sets.join(least.where("a <> z"), "doc_id").select("a", F.col("rep").alias("b"))
    between = _follow(_follow(rest.union(repeated), "a", roots), "b", roots)
    last_roots = finished_counted(spark, "roots", lambda: components(between))
    named = matrix.select("doc_id", F.col("n").alias("n_shingles")).join(
        copies.groupBy("doc_id").agg(F.min("rep").alias("rep")), "doc_id", "left"
    )
    named = named.withColumn("component_id", F.coalesce("rep", "doc_id")).drop("rep")
    return _follow(_follow(named, "component_id", roots), "component_id", last_roots)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach AS r JOIN links AS l ON l.a = r.node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents AS d LEFT JOIN sizes AS s USING (doc_id)
JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) AS r ON r.node = d.doc_id
"""
