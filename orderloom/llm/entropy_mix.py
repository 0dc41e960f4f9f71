"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, an exponential tilt of one by its size, `min(cap, exp(lambda *
size / mean size of the source))`. These rates are the closest to one in relative entropy among
all that meet the token constraint of each source under the cap. The dual is convex with one
variable per source; each Newton step is one aggregation over (source, size) cells, which hold
the counts of documents and are far fewer than documents. A bracket kept beside the iterate
guards the steps. Rates are rounded into whole copies so that the words taken of a source come
as near to its target as whole documents allow: cells are rounded in descending size with the
error carried on, then what is left is settled with the largest documents that fit into it.

Which documents of a cell get the extra copy is decided by a rank of their hash, counted through
1024 salted groups, so a cell of any size is split over tasks. Rows without a doc_id, which may
be copies of one text, are dealt to 64 further groups of their salt.

Defined results: a null text has size zero; documents of size zero are never copied. A null
source is a source of its own, last in order. A null doc_id is a document like others; each such
row is one of its own, by the hash of its text and its place in the written table. Rows that
repeat a document count separately but get the same number of copies where ties of their hash
allow, by a fixed order. An empty table gives an empty one. Extra columns are ignored unless
`keep` names them: these go with their row through the dealing, so that each row has its own
copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, finished, scratch, small, table

CAP = 3
SALTS = 1024
NULL_PARTS = 64
NEWTON_STEPS = 40
SETTLE_STEPS = 12
TOLERANCE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source, words, target) from (source, words): shares by weight, at most cap times the size.

    Targets are fixed at their bound in rising order of bound over weight: with the sources in
    that order, those before the first whose bound exceeds its share of the rest are capped.
    Sources count in the hundreds or thousands, so their windows run over one small partition.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights)) + 1)
    weighted = sources.withColumn("weight", weight.cast("double"))
    whole = Window.partitionBy(F.lit(0))
    by_bound = Window.partitionBy(F.lit(0)).orderBy(
        F.col("words") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    bound = cap * F.col("words")
    total = F.sum("words").over(whole)
    left = total - F.coalesce(F.sum(bound).over(before), F.lit(0))
    fits = weighted.select(
        "*", (left / F.sum("weight").over(onward)).alias("_per_weight")
    ).withColumn("_open", bound >= F.col("_per_weight") * F.col("weight"))
    # the first source that fits sets the price per weight of all that follow
    price = F.first(F.when(F.col("_open"), F.col("_per_weight")), ignorenulls=True).over(
        by_bound.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return fits.select(
        "source",
        "words",
        F.when(
            F.col("words") > 0,
            F.least(bound.cast("double"), F.coalesce(price * F.col("weight"), bound.cast("double"))),
        )
        .otherwise(0.0)
        .alias("target"),
    )


def _rate(tilt: Column, cap: int) -> Column:
    return F.when(F.exp(tilt) >= cap, F.lit(float(cap))).otherwise(F.exp(tilt))


def newton(cells: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """(source, tilt): the dual variable of each source, over sizes in units of their mean."""
    keyed = cells.where("size > 0").join(
        goals.select(F.col("source").alias("_s"), "mean", "target"),
        F.col("source").eqNullSafe(F.col("_s")),
    )
    data = scratch(
        keyed.select("source", (F.col("size") / F.col("mean")).alias("z"),
                     (F.col("n") * F.col("size")).alias("mass"),
                     (F.col("n").cast("double")).alias("n"), "mean", "target"),
        "mix-cells",
    )
    state = goals.select(
        "source", "target", "words",
        F.when(F.col("target") >= cap * F.col("words"), F.lit(1e6)).otherwise(0.0).alias("tilt"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (F.col("target") >= cap * F.col("words")).alias("done"),
    )
    for _ in range(NEWTON_STEPS):
        rate = _rate(F.col("tilt") * F.col("z"), cap)
        inside = F.exp(F.col("tilt") * F.col("z")) < cap
        sums = (
            data.select("source", "z", "mass")
            .join(state.select(F.col("source").alias("_s"), "tilt"),
                  F.col("source").eqNullSafe(F.col("_s")))
            .groupBy("source")
            .agg(F.sum(rate * F.col("mass")).alias("got"),
                 F.sum(F.when(inside, rate * F.col("mass") * F.col("z")).otherwise(0.0))
                 .alias("slope"))
        )
        over = F.col("got") > F.col("target")
        low = F.when(~over, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
        state = (
            state.join(sums.withColumnRenamed("source", "_s"),
                       F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", "target", "words", "tilt", "done", low.alias("low"),
                    high.alias("high"),
                    (F.col("tilt") - F.try_divide(F.col("got") - F.col("target"), F.col("slope")))
                    .alias("next"),
                    (F.abs(F.col("got") - F.col("target"))
                     <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))).alias("near"))
            .select("source", "target", "words", "low", "high",
                    (F.col("done") | F.coalesce("near", F.lit(True))).alias("done"),
                    F.when(F.col("done") | F.coalesce("near", F.lit(True)), F.col("tilt"))
                    .when((F.col("next") > F.col("low")) & (F.col("next") < F.col("high")),
                          F.greatest(F.least(F.col("next"), F.col("tilt") + 4), F.col("tilt") - 4))
                    .otherwise((F.greatest(F.col("low"), F.col("tilt") - 4)
                                + F.least(F.col("high"), F.col("tilt") + 4)) / 2).alias("tilt"))
        )
        # each step is written: the state is read twice by the next one
        state = scratch(state, "mix-state")
        if state.where("NOT done").isEmpty():
            break
    return state.select("source", "tilt")


def round_cells(cells: DataFrame, goals: DataFrame, tilts: DataFrame, cap: int) -> DataFrame:
    """(source, size, n, copies): whole copies of each cell, `copies` in all."""
    info = goals.select("source", "mean", "target").join(
        tilts.withColumnRenamed("source", "_t"), F.col("source").eqNullSafe(F.col("_t"))
    )
    rated = (
        cells.join(info.drop("_t").withColumnRenamed("source", "_s"),
                   F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("want", F.when(F.col("size") > 0, F.col("n") * _rate(
            F.col("tilt") * F.col("size") / F.col("mean"), cap)).otherwise(0.0))
    )
    down = (
        Window.partitionBy("source")
        .orderBy(F.desc("size"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.round(F.sum("want").over(down)).cast("long")
    carried = rated.withColumn("_upto", upto)
    step = Window.partitionBy("source").orderBy(F.desc("size"))
    copies = F.col("_upto") - F.coalesce(F.lag("_upto").over(step), F.lit(0))
    held = carried.withColumn(
        "copies", F.greatest(F.lit(0), F.least(copies, F.col("n") * cap)).cast("long")
    ).select("source", "size", "n", "target", "copies")
    whole = Window.partitionBy("source")
    for _ in range(SETTLE_STEPS):
        # settle what is left with the largest size that fits and has copies to give or take
        left = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(whole)
        held = held.withColumn("_left", left)
        room = F.when(F.col("_left") > 0, F.col("n") * cap - F.col("copies")).otherwise(
            F.col("copies")
        )
        fit = F.floor(F.try_divide(F.abs("_left"), F.col("size")))
        able = (F.col("size") > 0) & (room > 0) & (fit >= 1)
        held = held.withColumn("_pick", F.max(F.when(able, F.col("size"))).over(whole))
        moved = F.when(
            F.col("size") == F.col("_pick"),
            (F.signum("_left") * F.least(room, fit)).cast("long"),
        ).otherwise(0)
        held = held.withColumn("copies", (F.col("copies") + moved).cast("long")).drop(
            "_left", "_pick"
        )
    return held.drop("target")


def deal(sized: DataFrame, cells: DataFrame) -> DataFrame:
    """Gives each document of a cell the floor of its share, and the first by hash one more.

    From narrow rows, the last document of each cell that gets one more is found, through salted
    groups. It is the only thing the rows themselves are compared with, so they are joined with
    their cells where they lie, and no text is shuffled; cells beyond the counted bound of a
    broadcast are joined by shuffle.
    """
    salt = F.pmod(F.shiftrightunsigned("_hash", 12), F.lit(SALTS)) * (NULL_PARTS + 1)
    part = F.when(F.col("doc_id").isNull(), 1 + F.pmod("_row", F.lit(NULL_PARTS))).otherwise(0)
    place = (salt + part).alias("_salt")
    keyed = sized.select("source", "size", "_hash", "_row", place)
    counts = keyed.groupBy("source", "size", "_salt").agg(F.count("*").alias("_k"))
    before = (
        Window.partitionBy("source", "size")
        .orderBy("_salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = F.col("_s").eqNullSafe(F.col("source")) & (F.col("_z") == F.col("size"))
    named = cells.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "n", "copies")
    offsets = counts.select(
        "source", "size", "_salt", "_k", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before")
    ).join(named, here).select(
        "_s", "_z", F.col("_salt").alias("_p"),
        (F.expr("copies % n") - F.col("_before")).alias("_wanted"), "_k",
    )
    # the group in which a cell's last extra copy falls, and that document's rank in it
    groups = scratch(offsets.where("_wanted BETWEEN 1 AND _k"), "mix-groups")
    inside = keyed.join(small(groups), here & (F.col("_p") == F.col("_salt")))
    rank = F.row_number().over(
        Window.partitionBy("source", "size").orderBy("_hash", "_row")
    )
    last = (
        inside.withColumn("_rank", rank)
        .where("_rank = _wanted")
        .select(F.col("source").alias("_ls"), F.col("size").alias("_lz"), F.col("_salt").alias("_lp"),
                F.col("_hash").alias("_lh"), F.col("_row").alias("_lr"))
    )
    shares = scratch(
        named.join(
            last, F.col("_s").eqNullSafe(F.col("_ls")) & (F.col("_z") == F.col("_lz")), "left"
        ).select("_s", "_z", F.expr("copies div n").alias("_base"), "_lp", "_lh", "_lr"),
        "mix-shares",
    )
    own, limit = F.struct(place, "_hash", "_row"), F.struct("_lp", "_lh", "_lr")
    more = F.when(F.col("_lr").isNotNull() & (own <= limit), 1).otherwise(0)
    return (
        sized.join(small(shares), here)
        .withColumn("copies", F.col("_base") + more)
        .drop("_s", "_z", "_base", "_lp", "_lh", "_lr")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = CAP,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row of docs.

    The columns that `keep` names follow, each row's own.
    """
    # the place is written with the row, so all later reads agree on it
    placed = docs.withColumn("_row", F.monotonically_increasing_id())
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(29), "doc_id")).otherwise(
        F.xxhash64(F.lit(29), "text")
    )
    size = word_count(F.col("text")).alias("size")
    sized = scratch(
        placed.select("doc_id", "source", size, key.alias("_hash"), "_row", *keep), "mix-sizes"
    )
    cells = scratch(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    per_source = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("words"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"),
    )
    means = per_source.select(
        F.col("source").alias("_m"),
        F.coalesce(F.col("words") / F.col("docs"), F.lit(1.0)).alias("mean"),
    )
    goals = scratch(
        targets(per_source.select("source", "words"), weights, cap)
        .join(means, F.col("source").eqNullSafe(F.col("_m")))
        .drop("_m"),
        "mix-goals",
    )
    rounded = finished(
        docs.sparkSession,
        "mix-rounded",
        lambda: round_cells(cells, goals, newton(cells, goals, cap), cap),
    )
    dealt = deal(sized, rounded)
    return dealt.join(
        goals.select(F.col("source").alias("_g"), F.col("words").alias("source_size"), "target"),
        F.col("source").eqNullSafe(F.col("_g")),
    ).select("doc_id", "source", "size", "source_size", "target", "copies", *keep)


def op9_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
