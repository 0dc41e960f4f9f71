"""The event spine: decoded and enriched events, and the published event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import blank_to_null, decimal_number, list_part

FACT_COLUMNS = [
    "entity_id",
    "event_at_utc",
    "customer_key",
    "actor_type",
    "source_code",
    "app_name",
    "app_platform",
    "app_user_type",
    "sales_code",
    "username",
    "description_code",
    "l1_code",
    "l2_code",
    "l3_code",
    "l4_code",
    "function_name",
    "l1_category_name",
    "outcome",
    "feature_name",
    "feature_group",
    "page_context",
    "is_add",
    "is_remove",
    "is_qty_change",
    "latitude",
    "longitude",
    "response",
]


def decode_events(staged: DataFrame, app_sources: DataFrame) -> DataFrame:
    """Events of registered applications with codes, times, place and customer decoded.

    The reference tables joined here and below are small; none is hinted, so Catalyst
    broadcasts a side only after checking its size and falls back to a shuffle join otherwise.
    """
    known = app_sources.select(F.col("source_code").alias("source"))
    offset = F.coalesce(clock.offset_hours("timezone"), F.lit(0))
    return staged.join(known, "source", "left_semi").select(
        "entity_id",
        blank_to_null("sales_code").alias("sales_code"),
        blank_to_null("username").alias("username"),
        blank_to_null("ust_customer_no").alias("ust_customer_no"),
        blank_to_null("device_name").alias("device_name"),
        F.col("source").alias("source_code"),
        blank_to_null("version").alias("app_version"),
        "description_code",
        *[
            F.substring("description_code", 2 * level - 1, 2).alias(f"l{level}_code")
            for level in (1, 2, 3, 4)
        ],
        # The device offset applies to every format of the event time, epochs included.
        clock.add_hours(clock.event_time("event_time"), -offset).alias("event_at_utc"),
        F.col("timezone").alias("device_timezone"),
        clock.add_hours("created_at", clock.SERVER_OFFSET_HOURS).alias("created_at_utc"),
        clock.add_hours("updated_at", clock.SERVER_OFFSET_HOURS).alias("updated_at_utc"),
        clock.epoch_millis("event_id").alias("event_id_at_utc"),
        decimal_number(list_part("location", 1)).alias("latitude"),
        decimal_number(list_part("location", 2)).alias("longitude"),
        classify.actor_type("source").alias("actor_type"),
        classify.customer_key("source", "ust_customer_no", "username", "response").alias(
            "customer_key"
        ),
        "response",
    )


def enrich_events(
    decoded: DataFrame,
    dictionary: DataFrame,
    app_sources: DataFrame,
    system_accounts: DataFrame,
) -> DataFrame:
    """Decoded events with dictionary and application columns and their classification.

    Leaves out the placeholder sales code, events without a sales code, system accounts and
    events without a usable time.
    """
    kept = decoded.filter(
        (F.col("sales_code") != classify.EXCLUDED_SALES_CODE)
        & F.col("event_at_utc").isNotNull()
    ).join(system_accounts.select("username"), "username", "left_anti")
    codes = dictionary.select(
        F.col("description_code").alias("_code"),
        "function_name",
        "l1_category_name",
        F.col("payload_format").alias("expected_payload_format"),
        F.col("has_geo").alias("expects_geo"),
        "is_system_event",
        "event_type",
        "log_level",
    )
    apps = app_sources.select(
        F.col("source_code"),
        "app_name",
        F.col("user_type").alias("app_user_type"),
        F.col("platform").alias("app_platform"),
    )
    joined = kept.join(codes, F.col("description_code") == F.col("_code"), "left").join(
        apps, "source_code", "left"
    )
    flags = classify.event_flags(
        "description_code", "l1_code", "function_name", F.col("_code").isNotNull()
    )
    return joined.select(
        *decoded.columns,
        *[c for c in codes.columns if c != "_code"],
        "app_name",
        "app_user_type",
        "app_platform",
        *[column.alias(name) for name, column in flags.items()],
    )


def fct_events(enriched: DataFrame) -> DataFrame:
    """The event-grain fact: no payload-derived columns."""
    return enriched.select(*FACT_COLUMNS)
