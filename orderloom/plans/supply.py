"""Warehouse side: item master and daily stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.functions.text import trimmed_or_null
from orderloom.operators.dedupe import latest_per_key, preferred_first

# The warehouse's template, description key and locale.
WAREHOUSE_TEMPLATE = "CABOT"
ITEM_DESCRIPTION_KEY = "%prtnum|prt_client_id|wh_id_tmpl"
LOCALE = "US_ENGLISH"
ABC_DOMAIN = "abccod"


def inventory_daily(inv_snap: DataFrame) -> DataFrame:
    """Last stock snapshot per item, client, warehouse and day."""
    snaps = inv_snap.filter(F.col("gendte").isNotNull() & F.col("prtnum").isNotNull()).select(
        "prtnum",
        "prt_client_id",
        "wh_id",
        clock.day("gendte").alias("snapshot_date"),
        F.col("gendte").alias("snapshot_at"),
        "shippable_qty",
        "on_hand_qty",
        "ordered_qty",
        "planned_qty",
        "pnd_rcvqty",
        "rcvqty",
        "shpqty",
        "adjqty",
        "inv_snap_id",
    )
    return latest_per_key(
        snaps,
        ["prtnum", "prt_client_id", "wh_id", "snapshot_date"],
        [F.col("snapshot_at").desc(), F.col("inv_snap_id").desc_nulls_last()],
    ).drop("inv_snap_id")


def items(prtmst: DataFrame, prtdsc: DataFrame, code_descriptions: DataFrame) -> DataFrame:
    """Item master with English names and the decoded ABC class, one row per item and client.

    Items and descriptions share their shuffle keys with the ranking, so the joins move nothing
    again. Description keys are ranked untrimmed, as padded variants count as separate entries.
    """
    master = latest_per_key(
        prtmst,
        ["prtnum", "prt_client_id"],
        [preferred_first("wh_id_tmpl", WAREHOUSE_TEMPLATE), F.col("wh_id_tmpl").asc_nulls_last()],
    )
    key = [F.split_part("colval", F.lit("|"), F.lit(i)) for i in (1, 2, 3)]
    described = latest_per_key(
        prtdsc.filter(
            F.col("colnam").like(ITEM_DESCRIPTION_KEY) & (F.col("locale_id") == LOCALE)
        ).select(
            key[0].alias("_item"),
            key[1].alias("_client"),
            key[2].alias("_template"),
            "lngdsc",
            "short_dsc",
        ),
        ["_item", "_client"],
        [preferred_first("_template", WAREHOUSE_TEMPLATE), F.col("_template").asc_nulls_last()],
        # a key may occur with and without a byte order mark
        ["lngdsc", "short_dsc"],
    ).select(
        trimmed_or_null("_item").alias("prtnum"),
        trimmed_or_null("_client").alias("prt_client_id"),
        "lngdsc",
        "short_dsc",
    )
    abc = code_descriptions.filter(F.col("code_domain") == ABC_DOMAIN).select(
        F.col("code_value").alias("abccod"), F.col("long_description").alias("_abc")
    )
    return (
        master.join(described, ["prtnum", "prt_client_id"], "left")
        .join(abc, "abccod", "left")
        .select(
            "prtnum",
            "prt_client_id",
            "dsp_prtnum",
            F.col("lngdsc").alias("item_name"),
            F.col("short_dsc").alias("item_short_name"),
            F.col("prtfam").alias("item_family"),
            F.col("abccod").alias("abc_class"),
            F.col("_abc").alias("abc_class_description"),
            F.col("velzon").alias("velocity_zone"),
            F.col("stkuom").alias("stock_uom"),
            F.col("dspuom").alias("display_uom"),
            F.col("rcvsts").alias("receive_status"),
        )
    )
