"""Representative journeys: from opening an order to sending it, and what happened between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import kv_value, list_part, trimmed_or_null
from orderloom.operators.slices import (
    SLICE,
    across_slices,
    before_here,
    latest_before,
    slice_of,
    up_to_here,
    within_slice,
)
from orderloom.params import Params

# Dictionary categories, code exceptions and the order number format.
OPEN_CATEGORY = "Create Order"
CLOSE_CATEGORY = "Send Order"
NOT_OPENING = ("09060000", "09070000")
SUBMIT_SUCCESS = "01"
SUBMIT_FAILURE = "02"
ORDER_NUMBER = r"([A-Z][0-9]{9})"
CART = "Order Operations"
ICONS = "Activity (Customer Interactions)"
ICON_CODES = {
    "backorder": "02",
    "history": "03",
    "suggest": "04",
    "new": "05",
    "promo": "06",
    "new_promo": "07",
    "all_product": "08",
    "categories": "09",
}
NAVIGATION = {
    "filter_events": "Filtering & Sorting",
    "search_events": "Search",
    "icon_clicks": ICONS,
    "catalog_views": "Catalog View Analytics",
}

CYCLE_COLUMNS = [
    "username",
    "order_customer_no",
    "local_id",
    "increment_id",
    "sales_code",
    "source_code",
    "app_version",
    "opened_at",
    "submitted_at",
    "days_to_close",
]


def _opens(enriched: DataFrame) -> DataFrame:
    """First time each local order was opened, with the first opening of its number."""
    created = (
        enriched.filter(
            (F.col("l1_category_name") == OPEN_CATEGORY)
            & ~F.col("description_code").isin(*NOT_OPENING)
            & (F.col("actor_type") == "sales")
        )
        .select(
            "username",
            list_part("response", 1).alias("order_customer_no"),
            list_part("response", 2).alias("local_id"),
            "sales_code",
            "source_code",
            "app_version",
            "event_at_utc",
        )
        # An open without a rep, customer or number can match no close.
        .dropna(subset=["username", "order_customer_no", "local_id"])
    )
    number = ["username", "order_customer_no", "local_id"]
    opened = created.groupBy(*number, "sales_code", "source_code", "app_version").agg(
        F.min("event_at_utc").alias("opened_at")
    )
    return opened.withColumn(
        "first_opened_at", F.min("opened_at").over(Window.partitionBy(*number))
    )


def _closes(enriched: DataFrame) -> DataFrame:
    """First successful submit of each order number."""
    number = F.when(
        F.col("expected_payload_format") == "kv", kv_value("response", "increment_id")
    ).otherwise(trimmed_or_null(F.regexp_extract("response", ORDER_NUMBER, 1)))
    return (
        enriched.filter(
            (F.col("l1_category_name") == CLOSE_CATEGORY) & (F.col("l3_code") == SUBMIT_SUCCESS)
        )
        .select("username", "customer_key", number.alias("increment_id"), "event_at_utc")
        .filter(F.col("increment_id").isNotNull())
        .groupBy("username", F.col("customer_key").alias("order_customer_no"), "increment_id")
        .agg(F.min("event_at_utc").alias("submitted_at"))
    )


_OPEN_FIELDS = [
    "local_id",
    "sales_code",
    "source_code",
    "app_version",
    "opened_at",
    "first_opened_at",
]


def rep_order_cycle(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """Each submit with the nearest earlier open of the same rep and customer, one to one.

    A pair survives when the open is the last one before the submit and the submit is the first
    one after the order number was first opened. Both are facts about neighbours in time, so
    opens and closes are laid out in one sequence per rep and customer and each close looks
    back once; no pair that does not survive is ever built. Pairs that lose are not re-paired.
    Of all submits without any open only the earliest is kept.
    """
    # At equal times a submit sorts before an open, since an open must be strictly earlier; of
    # opens at one time the one with the largest number sorts last and is taken.
    opens = _opens(enriched).select(
        "username",
        "order_customer_no",
        F.col("opened_at").alias("at"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("increment_id"),
        F.struct(*_OPEN_FIELDS).alias("open"),
    )
    closes = _closes(enriched).select(
        "username",
        "order_customer_no",
        F.col("submitted_at").alias("at"),
        F.lit(0).alias("kind"),
        "increment_id",
        F.lit(None).cast(opens.schema["open"].dataType).alias("open"),
    )
    marks = opens.unionByName(closes).withColumn(SLICE, slice_of("at", params.slice_minutes))
    looked_back = latest_before(
        marks,
        ["username", "order_customer_no"],
        ["at", "kind", "increment_id", "open"],
        {
            "last_open": F.col("open"),
            "last_close_at": F.when(F.col("kind") == 0, F.col("at")),
        },
    ).filter(F.col("kind") == 0)
    unmatched = F.col("last_open").isNull()
    first_after_open = F.col("last_close_at").isNull() | (
        F.col("last_close_at") <= F.col("last_open.first_opened_at")
    )
    pairs = looked_back.filter(unmatched | first_after_open).select(
        "username",
        "order_customer_no",
        "increment_id",
        F.col("at").alias("submitted_at"),
        *[F.col(f"last_open.{f}").alias(f) for f in _OPEN_FIELDS[:-1]],
        unmatched.alias("_unmatched"),
    )
    # Matched pairs are unique already; the rank leaves one row of the unmatched ones. Its group
    # limit runs before the shuffle, so that group is never gathered.
    rank = F.row_number().over(
        Window.partitionBy(
            "_unmatched",
            *[
                F.when(~F.col("_unmatched"), F.col(c)).alias(f"_{c}")
                for c in ("username", "order_customer_no", "local_id")
            ],
        ).orderBy("submitted_at", "increment_id", F.col("username").asc_nulls_last())
    )
    return (
        pairs.withColumn("_rank", rank)
        .filter("_rank = 1")
        .withColumn("days_to_close", clock.days_between("opened_at", "submitted_at"))
        .select(*CYCLE_COLUMNS)
    )


def _journey_counters() -> dict[str, Column]:
    category, l2 = F.col("l1_category_name"), F.col("l2_code")
    icons = category == ICONS
    return {
        "events": F.lit(True),
        "add_count": (category == CART) & (l2 == "05"),
        "remove_count": (category == CART) & (l2 == "04"),
        "oos_check_count": (category == CART) & (l2 == "13"),
        **{f"click_{name}_count": icons & (l2 == code) for name, code in ICON_CODES.items()},
        **{name: category == label for name, label in NAVIGATION.items()},
        "submit_attempts": category == CLOSE_CATEGORY,
        "submit_fail_count": (category == CLOSE_CATEGORY)
        & (F.col("l3_code") == SUBMIT_FAILURE),
    }


def rep_order_journey(
    events: DataFrame, cycles: DataFrame, params: Params = Params()
) -> DataFrame:
    """What a rep did between opening and sending each order.

    Every output is a count over an interval of the rep's events, and a count over an interval
    is the difference of two running counts. So events and interval ends go through one ordered
    pass per rep, cut into time slices, instead of a range join: no event is copied once per
    open order, and the work is linear however many orders a rep has open at a time.
    """
    counters = _journey_counters()
    rep_events = events.filter(
        (F.col("actor_type") == "sales") & F.col("username").isNotNull()
    ).select(
        "username",
        F.col("event_at_utc").alias("at"),
        slice_of("event_at_utc", params.slice_minutes).alias(SLICE),
        *[F.coalesce(c, F.lit(False)).cast("bigint").alias(n) for n, c in counters.items()],
    )
    ends = cycles.filter(F.col("username").isNotNull() & F.col("opened_at").isNotNull()).select(
        F.col("username"),
        F.struct(*[c for c in CYCLE_COLUMNS if c != "username"]).alias("cycle"),
        F.explode(
            F.array(
                F.struct(F.col("opened_at").alias("at"), F.lit(-1).alias("side")),
                F.struct(
                    F.coalesce("submitted_at", params.now()).alias("at"), F.lit(1).alias("side")
                ),
            )
        ).alias("end"),
    )
    marks = ends.select(
        "username", F.col("end.at").alias("at"), F.col("end.side").alias("side"), "cycle"
    ).withColumn(SLICE, slice_of("at", params.slice_minutes))
    sequence = rep_events.withColumn("side", F.lit(0)).unionByName(
        marks, allowMissingColumns=True
    )
    # Both ends are inclusive: an opening sorts before the events of its instant, an end after.
    running = up_to_here(within_slice(["username"], "at", "side"))
    seen = sequence.select(
        "username", SLICE, "side", "cycle", *[F.sum(n).over(running).alias(n) for n in counters]
    ).filter("side <> 0")

    earlier = before_here(across_slices(["username"]))
    slices = sequence.groupBy("username", SLICE).agg(*[F.sum(n).alias(n) for n in counters])
    before = slices.select(
        F.col("username").alias("_c_username"),
        F.col(SLICE).alias("_c_slice"),
        *[F.sum(n).over(earlier).alias(f"_c_{n}") for n in counters],
    )
    zero = F.lit(0).cast("bigint")
    at_ends = seen.join(
        before,
        (F.col("username") == F.col("_c_username")) & (F.col(SLICE) == F.col("_c_slice")),
    )
    totals = (
        at_ends.groupBy("username", "cycle")
        .agg(
            *[
                F.sum(
                    F.col("side") * (F.coalesce(n, zero) + F.coalesce(f"_c_{n}", zero))
                ).alias(n)
                for n in counters
            ]
        )
        .filter("events > 0")
        .select("username", "cycle.*", *[n for n in counters if n != "events"])
    )

    ratio = F.col("remove_count") / F.nullif(F.col("add_count"), zero)
    used = {
        "filter": "filter_events",
        "search": "search_events",
        "icons": "icon_clicks",
        "catalog_view": "catalog_views",
        **{name: f"click_{name}_count" for name in ICON_CODES},
    }
    clicks = ("backorder", "history", "suggest", "new", "promo", "new_promo")
    return totals.select(
        *CYCLE_COLUMNS,
        classify.days_bucket(F.col("days_to_close")).alias("cycle_bucket"),
        "add_count",
        "remove_count",
        "oos_check_count",
        ratio.alias("churn_ratio"),
        *[f"click_{name}_count" for name in clicks],
        *NAVIGATION,
        *[(F.col(c) > 0).cast("int").alias(f"used_{name}") for name, c in used.items()],
        (F.col("submit_attempts") > 0).cast("int").alias("had_submit_attempt"),
        "submit_fail_count",
        classify.journey_segment(ratio, F.col("days_to_close")).alias("behavior_segment"),
    )
