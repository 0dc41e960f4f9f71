"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Texts are lower-cased (A-Z) and cut into words, runs of letters, digits and all beyond ASCII. The
windows of `width` words of every benchmark item, or the whole of a shorter item, are hashed and
broadcast; the windows of every document are hashed in place, probe the set map-side, and each
hit is verified by its words. What leaves a task is one row per document and one per verified
hit, so no text and no window is shuffled. Hits of a document become merged word spans, by which
`decontaminate` drops spans or whole documents.

The set is broadcast in blocks of at most `BLOCK_BYTES`, counted before; a larger benchmark means
more passes over the documents, not a larger broadcast. Window lengths are read off the
benchmark, at most `width` different ones. Items with equal windows are listed once per set of
items, so that a window which many items share adds one short id to a hit.

Defined results: a null, empty or wordless text has no words and no hits; a null, empty or
wordless item has no window. Rows that repeat a document each get its result. A null doc_id is a
document like others. An item without an item_id marks words, but is not counted or listed;
rows with one item_id are one item. Texts of any length are read whole. Either table empty: no
hits. Extra columns are ignored by `contamination` and kept by `decontaminate`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import scratch, table

WIDTH = 10
# Bytes of n-grams, words and keys, that one broadcast may hold.
BLOCK_BYTES = 48 << 20
# Copies of one document that a task writes out by itself.
COPIES = 4096
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words and what is between them, in turn; A-Z are letters before lower-casing.
PIECES = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; splitting between words costs a sixth of extracting each of them."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    found = F.array_remove(F.split(lower, BETWEEN), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once; Catalyst would inline a column into lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hashes(w: Column, lengths: list[int], body) -> Column:
    """`body` of one array per length: at place i the hash of the run of words from i.

    Runs of 2, 4, 8... words are hashed from two halves, others from such parts. A run that goes
    over the end has the hash of what there is; verification drops it.
    """

    def pair(x: Column, y: Column) -> Column:
        return F.xxhash64(x, y)

    def compose(levels: dict[int, Column], length: int) -> Column:
        parts = [p for p in sorted(levels, reverse=True) if length & p]
        if len(parts) == 1:
            return levels[parts[0]]

        def run(x: Column, i: Column) -> Column:
            at = parts[0]
            for p in parts[1:]:
                x = pair(x, F.get(levels[p], i + at))
                at += p
            return x

        return F.transform(levels[parts[0]], run)

    def climb(levels: dict[int, Column], size: int) -> Column:
        if 2 * size > max(lengths):
            return body([compose(levels, n) for n in lengths])
        held = levels[size]
        longer = F.transform(held, lambda x, i: pair(x, F.get(held, i + size)))
        return _let(longer, lambda v: climb({**levels, 2 * size: v}, 2 * size))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), lambda v: climb({1: v}, 1))


def _gram(run: Column) -> Column:
    return F.array_join(run, " ")


def item_grams(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """(h, gram, n, bytes, items): each distinct window and the sorted ids of its items."""
    held = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w"))
    sized = held.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(width)))
    every = list(range(1, width + 1))
    hashed = _hashes(F.col("w"), every, lambda found: F.element_at(F.array(*found), F.col("n")))
    # the windows end where the words do
    whole = F.slice(hashed, 1, F.size("w") - F.col("n") + 1)
    runs = sized.select("item", "n", "w", F.posexplode(whole).alias("at", "h"))
    run = F.slice("w", F.col("at") + 1, F.col("n"))
    return (
        runs.select("item", "n", _gram(run).alias("gram"), "h")
        .groupBy("h", "gram", "n")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("set_id", F.md5(F.to_json("items")))
        .withColumn("bytes", F.octet_length("gram") + 80)
    )


def _probe(held: DataFrame, grams: DataFrame, lengths: list[int], marked: bool) -> DataFrame:
    """A row per verified hit, and with `marked` one more per document, of place -1."""
    marker = F.array(F.lit(None).cast("bigint"))
    listed = _hashes(F.col("w"), lengths, lambda found: F.concat(marker, *found))
    # computed in a step of its own, so that exploding and probing stay in generated code
    hashed = held.withColumn("listed", listed)
    rows = hashed.select("id", "digest", "w", F.posexplode_outer("listed").alias("j", "wh"))
    # one array per length follows the marker, each as long as the words
    start = F.col("j") - 1 if len(lengths) == 1 else F.pmod(F.col("j") - 1, F.size("w"))
    same = _gram(F.slice("w", start + 1, F.col("n"))) == F.col("gram")
    kind = "left" if marked else "inner"
    hits = rows.join(F.broadcast(grams), (F.col("wh") == F.col("h")) & same, kind)
    return hits.where(F.col("n").isNotNull() | (F.col("j") == 0)).select(
        "id",
        "digest",
        (F.col("j") == 0).alias("marker"),
        F.when(F.col("j") == 0, F.size("w")).alias("n_words"),
        F.when(F.col("n").isNotNull(), F.struct(start.alias("at"), "n")).alias("hit"),
        "set_id",
    )


def _merged(hits: Column) -> Column:
    """Word spans [start, end) that the hits cover, merged where they meet."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    last = lambda a: F.element_at(a, -1)

    def add(spans: Column, hit: Column) -> Column:
        end = hit["at"] + hit["n"]
        one = F.array(F.struct(hit["at"].alias("start"), end.alias("end")))
        longer = F.array(
            F.struct(last(spans)["start"].alias("start"), F.greatest(last(spans)["end"], end).alias("end"))
        )
        meets = (F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["end"] >= hit["at"])
        return F.when(
            meets, F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), longer)
        ).otherwise(F.concat(spans, one))

    return F.aggregate(F.sort_array(hits), empty, add)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, digest, n_words, spans, items, copies) of every distinct (doc_id, text), written.

    `digest` is the MD5 of the text, `spans` are merged word ranges [start, end), `items` the
    sorted ids with an occurring window, and `copies` the number of rows.
    """
    grams = scratch(item_grams(items, item_id, item_text, width), "test-grams")
    total = grams.agg(F.sum("bytes"), F.sort_array(F.collect_set("n"))).first()
    lengths = total[1] or [width]
    blocks = max(1, -(-(total[0] or 0) // block_bytes))
    held = docs.select(
        F.col(doc_id).alias("id"), F.md5(F.col(text)).alias("digest"), words(F.col(text)).alias("w")
    )
    of = F.pmod(F.col("h"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    narrow = grams.select("h", "gram", "n", "set_id")
    parts = [
        _probe(held, narrow.where(of == b) if blocks > 1 else narrow, lengths, b == 0)
        for b in range(blocks)
    ]
    found = reduce(DataFrame.unionByName, parts).groupBy("id", "digest").agg(
        F.count_if("marker").alias("copies"),
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_set("hit").alias("hits"),
        F.collect_set("set_id").alias("sets"),
    )
    sets = grams.groupBy("set_id").agg(F.first("items").alias("members"))
    listed = found.select("*", F.explode_outer("sets").alias("set_id")).join(sets, "set_id", "left")
    done = (
        listed.groupBy("id", "digest")
        .agg(
            *[F.first(c).alias(c) for c in ("copies", "n_words", "hits")],
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("items"),
        )
        .select(
            F.col("id").alias(doc_id),
            "digest",
            "n_words",
            _merged(F.col("hits")).alias("spans"),
            "items",
            "copies",
        )
    )
    return scratch(done, "contamination")


def covered(spans: Column) -> Column:
    """Number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))


def each_row(found: DataFrame) -> DataFrame:
    """One row per copy; those of a document with very many copies are dealt over tasks."""
    few = found.where(F.col("copies") <= COPIES).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    many = found.where(F.col("copies") > COPIES).withColumn("_part", part)
    left = F.least(F.lit(COPIES), F.col("copies") - F.col("_part") * COPIES).cast("int")
    dealt = many.hint("rebalance").withColumn("_copy", F.explode(F.sequence(F.lit(1), left)))
    return few.unionByName(dealt.drop("_part")).drop("_copy")


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands between these words."""

    def cut(pieces: Column) -> Column:
        first = F.when(F.size(words(F.element_at(pieces, 1))) > 0, 0).otherwise(1)
        # word i is piece 2 i + first, counted from 0
        begin = lambda s: 2 * s["start"] + first
        end = lambda s: 2 * s["end"] - 1 + first
        gap = lambda lo, hi: F.array_join(F.slice(pieces, lo + 1, hi - lo), "")
        inner = F.transform(
            spans,
            lambda s, i: gap(
                F.when(i == 0, 0).otherwise(end(F.element_at(spans, F.greatest(i, F.lit(1))))), begin(s)
            ),
        )
        rest = gap(end(F.element_at(spans, -1)), F.size(pieces))
        return F.concat(F.array_join(inner, ""), rest)

    return _let(F.regexp_extract_all(text, F.lit(PIECES)), cut)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "spans",
    doc_id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """`docs` without contaminated documents, or without the spans that are in the benchmark.

    Only contaminated documents are joined back, by id and digest; Spark joins them by a
    broadcast or a shuffle as their size says.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove spans or documents, not {remove!r}")
    found = contamination(docs, items, doc_id, text, **options).where(F.size("spans") > 0)
    dirty = scratch(
        found.select(F.col(doc_id).alias("_id"), F.col("digest").alias("_digest"), "spans"), "dirty"
    ).withColumnRenamed("spans", "_spans")
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.md5(F.col(text)) == F.col("_digest"))
    if remove == "documents":
        return docs.join(dirty, same, "left_anti")
    cleaned = F.when(
        F.col("_spans").isNotNull(), without_spans(F.col(text), F.col("_spans"))
    ).otherwise(F.col(text))
    return docs.join(dirty, same, "left").withColumn(text, cleaned).select(*docs.columns)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = each_row(contamination(docs, items))
    return found.select(
        "doc_id",
        "n_words",
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP13_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_at AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM item WHERE len(w) > 0),
gram AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM item_at),
size_of AS (SELECT DISTINCT n FROM gram),
doc_at AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size_of WHERE len(w) >= n),
win AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM doc_at),
hit AS (SELECT DISTINCT win.r, win.n, win.i, gram.item_id FROM win JOIN gram USING (n, g)),
word AS (SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""
