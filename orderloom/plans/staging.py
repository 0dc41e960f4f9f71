"""Staging: typing, trimming and one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import trimmed, trimmed_or_null, whole_number
from orderloom.operators.dedupe import latest_per_key
from orderloom.sources.schemas import WMS

_TRIMMED_EVENT_TEXT = (
    "sales_code",
    "username",
    "ust_customer_no",
    "location",
    "timezone",
    "event_time",
    "source",
    "version",
    "description_code",
)


def stage_events(raw: DataFrame) -> DataFrame:
    """Typed events, latest version of each. The payload keeps its spaces."""
    typed = raw.select(
        F.col("entity_id").cast("bigint").alias("entity_id"),
        *[trimmed(c).alias(c) for c in _TRIMMED_EVENT_TEXT],
        F.col("response").cast("string").alias("response"),
        trimmed("device_name").alias("device_name"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        trimmed("event_id").alias("event_id"),
    )
    newest = [F.col("updated_at").desc_nulls_last(), F.col("created_at").desc_nulls_last()]
    # versions of one event with equal times have no order of their own
    return latest_per_key(typed, ["entity_id"], newest, typed.columns)


def _text(**names: str) -> list[Column]:
    return [trimmed_or_null(source).alias(out) for out, source in names.items()]


def _count(**names: str) -> list[Column]:
    return [whole_number(trimmed_or_null(source)).alias(out) for out, source in names.items()]


def _time(**names: str) -> list[Column]:
    return [trimmed_or_null(source).cast("timestamp").alias(out) for out, source in names.items()]


def stage_admin_users(raw: DataFrame) -> DataFrame:
    flags = (
        "is_active",
        "is_salesperson",
        "convert_quotes",
        "receive_quote_emails",
        "lognum",
    )
    return raw.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        *_text(
            username="username",
            first_name="firstname",
            last_name="lastname",
            email="email",
            salesperson_code="salesperson_code",
            role_name="role_name",
            interface_locale="interface_locale",
        ),
        *_count(**{c: c for c in flags}),
        *_time(logdate="logdate", created_at="created", updated_at="modified"),
    )


def stage_category(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("category_id").cast("bigint").alias("entity_id"),
        trimmed_or_null("parent_id").cast("bigint").alias("parent_id"),
        *_text(category_name="name", is_active="is_active"),
        *_count(position="position", category_level="level", product_count="product_count"),
        *_text(
            meta_title="meta_title",
            meta_keywords="meta_keywords",
            meta_description="meta_description",
        ),
        *_time(created_at="create_at", updated_at="updated_at"),
    )


def stage_wms(table: str, raw: DataFrame) -> DataFrame:
    """Any warehouse table as landed: every column kept, padded join keys trimmed, no dedupe.

    The columns that keys, parents, checks and freshness need must be there; a source that has
    dropped one is refused.
    """
    padded = WMS[table].trimmed
    missing = set(WMS[table].columns) - set(raw.columns)
    if missing:
        raise ValueError(f"{table} lacks the columns {sorted(missing)}")
    return raw.select(*[F.trim(c).alias(c) if c in padded else F.col(c) for c in raw.columns])
