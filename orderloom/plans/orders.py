"""Submitted orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import decimal_number, kv_value, whole_number
from orderloom.operators.dedupe import latest_per_key


def fct_orders(enriched: DataFrame) -> DataFrame:
    """One row per submitted order; the latest submit of a number wins."""
    submits = enriched.filter(classify.has_order_payload()).select(
        kv_value("response", "increment_id").alias("increment_id"),
        "customer_key",
        "actor_type",
        "source_code",
        "app_name",
        "sales_code",
        "username",
        F.col("event_at_utc").alias("submitted_at"),
        F.upper(kv_value("response", "order_source")).alias("order_channel"),
        decimal_number(kv_value("response", "grand_total")).alias("grand_total"),
        decimal_number(kv_value("response", "subtotal")).alias("subtotal"),
        whole_number(kv_value("response", "total_item_count"), "int").alias("total_item_count"),
        "entity_id",
    )
    latest = latest_per_key(
        submits.filter(F.col("increment_id").isNotNull()),
        ["increment_id"],
        [F.col("submitted_at").desc(), F.col("entity_id").desc()],
    )
    return latest.select(
        "increment_id",
        "customer_key",
        "actor_type",
        "source_code",
        "app_name",
        "sales_code",
        "username",
        "submitted_at",
        clock.day("submitted_at").alias("submitted_date"),
        "order_channel",
        "grand_total",
        "subtotal",
        (F.col("grand_total") - F.col("subtotal")).alias("freight_and_adj"),
        "total_item_count",
    )
