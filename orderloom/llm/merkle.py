"""Document fingerprints: a Merkle tree over sections, paragraphs and sentence pieces.

A text is split into sections at blank lines, sections into paragraphs at line ends, and
paragraphs into leaves: pieces of at most `LEAF` characters that end at a sentence end at the
latest. A leaf's hash is of its characters, a paragraph's of its leaves, a section's of its
paragraphs, and the root's of its sections, so equal roots mean equal texts, and two trees that
differ are walked from the root along differing branches only to the leaves that were edited
(`locate_edits`). The fingerprint is the root and a sketch: the smallest of the numbers that the
leaf hashes give, whose share of common values estimates how much of two texts is the same.

Everything is built from SQL functions. Neighbours by descending doc_id are found within ranges
of `RANGE` ids; the first text of each range is also handed to the range before it, so no window
holds more than one range.

Defined results: a null or empty text is one section with one empty paragraph and has an empty
sketch; two empty sketches are alike (1), an empty and a full one are not (0). A document that is
alone is its own next document. Rows without a doc_id come after all others, as one range, in
the order of their texts. Rows that repeat a doc_id follow each other in the order of their texts.
Very long texts are single rows, as they are in the table. Extra columns are kept by `tree`; an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import scratch, table

LEAF = 24
SKETCH = 64
RANGE = 512
_PIECES = rf"(?s)[^.!?]{{0,{LEAF - 1}}}[.!?]|[^.!?]{{1,{LEAF}}}"


def _digest(level: str, parts: Column) -> Column:
    """Hash of a node from its children's hashes; the level and the number of children count."""
    return F.sha2(F.concat_ws(",", F.lit(level), F.size(parts).cast("string"), parts), 256)


def leaves(paragraph: Column) -> Column:
    """Hashes of the pieces of a paragraph, which joined give the paragraph."""
    return F.transform(
        F.regexp_extract_all(paragraph, F.lit(_PIECES), F.lit(0)), lambda x: F.md5(x)
    )


def tree(text: Column) -> Column:
    """Sections of paragraphs of leaf hashes, with the digest of every paragraph and section."""
    paragraph = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n", -1),
        lambda section: F.transform(
            F.transform(F.split(section, "\n", -1), leaves),
            lambda held: F.struct(_digest("paragraph", held).alias("hash"), held.alias("leaves")),
        ),
    )
    return F.transform(
        paragraph,
        lambda ps: F.struct(
            _digest("section", F.transform(ps, lambda p: p["hash"])).alias("hash"),
            ps.alias("paragraphs"),
        ),
    )


def root(tree_column: Column) -> Column:
    return _digest("root", F.transform(tree_column, lambda s: s["hash"]))


def sketch(tree_column: Column) -> Column:
    """The smallest distinct numbers that leaf hashes give, in order."""
    found = F.flatten(
        F.transform(
            tree_column, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"]))
        )
    )
    numbers = F.transform(found, lambda x: F.xxhash64(x))
    return F.slice(F.array_sort(F.array_distinct(numbers)), 1, SKETCH)


def likeness(a: Column, b: Column) -> Column:
    """Share of common values among the smallest of the union of two sketches."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(both / F.size(least))


def as_text(root_column: Column, sketch_column: Column) -> Column:
    return F.concat_ws(
        ":",
        root_column,
        F.concat_ws("", F.transform(sketch_column, lambda x: F.lpad(F.hex(x), 16, "0"))),
    )


def locate_edits(a: Column, b: Column) -> Column:
    """(section, paragraph, leaves) places, from 0, whose digests differ between two trees.

    Only sections that differ are looked into, and of these only paragraphs that differ.
    """
    none = F.array().cast("array<string>")

    def pieces(x: Column, y: Column) -> Column:
        x, y = F.coalesce(x["leaves"], none), F.coalesce(y["leaves"], none)
        most = F.greatest(F.size(x), F.size(y))
        places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda k: ~F.get(x, k).eqNullSafe(F.get(y, k)))

    sections = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)

    def inside(i: Column) -> Column:
        x, y = F.get(a, i)["paragraphs"], F.get(b, i)["paragraphs"]
        places = F.sequence(
            F.lit(0), F.greatest(F.coalesce(F.size(x), F.lit(0)), F.coalesce(F.size(y), F.lit(0))) - 1
        )
        changed = F.filter(
            places, lambda j: ~F.get(x, j)["hash"].eqNullSafe(F.get(y, j)["hash"])
        )
        return F.transform(
            changed,
            lambda j: F.struct(
                i.alias("section"),
                j.alias("paragraph"),
                pieces(F.get(x, j), F.get(y, j)).alias("leaves"),
            ),
        )

    differ = F.filter(sections, lambda i: ~F.get(a, i)["hash"].eqNullSafe(F.get(b, i)["hash"]))
    return F.flatten(F.transform(differ, inside))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds next_<column> of the next row by descending doc_id; the first follows the last.

    Ranges of ids are windows of their own; what follows the last row of a range is the first
    row of the next range that has rows, copied there as a guest.
    """
    ranged = docs.withColumn("_range", F.floor(F.col("doc_id") / RANGE))
    tie = F.xxhash64("text")
    held = F.struct(*[F.col(c) for c in columns])
    heads = ranged.groupBy("_range").agg(
        F.max_by(held, F.struct(F.col("doc_id"), (-(tie / 2)).alias("t"))).alias("_held")
    )
    heads = scratch(heads, "heads")
    # one short row per range: the order of ranges, closed to a ring
    order = Window.orderBy(F.col("_range").desc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hosts = heads.select(
        F.col("_range").alias("_of"),
        F.when(F.row_number().over(order) == 1, F.last("_range").over(whole))
        .otherwise(F.lag("_range").over(order))
        .alias("_range"),
    )
    guests = hosts.join(heads.withColumnRenamed("_range", "_of2"),
                        F.col("_of").eqNullSafe(F.col("_of2"))).select("_range", "_held.*")
    rows = ranged.select("_range", F.lit(0).alias("_guest"), *docs.columns).unionByName(
        guests.withColumn("_guest", F.lit(1)), allowMissingColumns=True
    )
    near = Window.partitionBy("_range").orderBy(
        "_guest", F.col("doc_id").desc_nulls_last(), (-(tie / 2)).desc()
    )
    return (
        rows.withColumns({f"next_{c}": F.lead(c).over(near) for c in columns})
        .where("_guest = 0")
        .drop("_guest", "_range")
    )


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    near = with_next(docs, ["doc_id", "text"])
    n = F.char_length("text").cast("long")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (n - cut).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), cut),
    )
    trees = near.select(
        "doc_id",
        n.alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        *[
            F.transform(F.array(tree(t)), lambda x: F.struct(root(x).alias("r"), sketch(x).alias("s")))[0].alias(name)
            for name, t in (("f", F.col("text")), ("e", edited), ("x", F.col("next_text")))
        ],
    )
    return trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("f.r"), F.col("f.s")).alias("fingerprint"),
        as_text(F.col("e.r"), F.col("e.s")).alias("edited_fingerprint"),
        likeness(F.col("f.s"), F.col("e.s")).alias("near_edited"),
        likeness(F.col("f.s"), F.col("x.s")).alias("near_next"),
    )
