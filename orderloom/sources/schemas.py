"""Schemas, keys and grains of the inputs.

Fixed values: column names, keys, grains and age limits must equal those of the sources.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The raw event as the API delivers it. Times stay text here; staging types them.
RAW_EVENT = T.StructType(
    [T.StructField("entity_id", T.LongType())]
    + _strings(
        "sales_code",
        "username",
        "ust_customer_no",
        "location",
        "timezone",
        "event_time",
        "source",
        "version",
        "description_code",
        "response",
        "device_name",
        "created_at",
        "updated_at",
        "event_id",
    )
)

ENVELOPE = T.StructType(
    [
        T.StructField("code", T.LongType()),
        T.StructField("msg", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("current_page", T.LongType()),
                    T.StructField("data", T.ArrayType(RAW_EVENT)),
                    T.StructField("per_page", T.LongType()),
                    T.StructField("total", T.LongType()),
                ]
            ),
        ),
    ]
)

# Reference CSVs. Codes are text, so that leading zeros survive.
SEEDS: dict[str, T.StructType] = {
    "event_codes": T.StructType(
        _strings("description_code", "function_name", "l1_category_name", "payload_format")
        + [T.StructField("has_geo", T.BooleanType())]
        + [T.StructField("is_system_event", T.BooleanType())]
        + _strings("event_type", "log_level", "platforms")
    ),
    "app_sources": T.StructType(
        _strings("source_code", "app_name", "app_full_name", "user_type", "platform")
    ),
    "system_accounts": T.StructType(_strings("username", "account_type", "note")),
    "categories": T.StructType(_strings("category_id", "category_name")),
    "app_category_codes": T.StructType(
        _strings(
            "app_category_code",
            "app_id",
            "ust_category_id",
            "category_name",
            "icon",
            "code_type",
            "notes",
        )
    ),
    "category_name_aliases": T.StructType(
        _strings("raw_name", "category_id", "alias_type", "dev_definition")
    ),
    "warn_event_codes": T.StructType(_strings("description_code", "log_level", "notes")),
    "layout_codes": T.StructType(_strings("layout_code", "layout_name", "notes")),
    "jdawms_code_descriptions": T.StructType(
        _strings("code_domain", "code_value", "long_description", "short_description")
    ),
}


@dataclass(frozen=True)
class WmsTable:
    """What differs between the warehouse tables: padded keys, grain, parent and age limit."""

    grain: tuple[str, ...]
    trimmed: tuple[str, ...] = ()
    parent: tuple[str, str, str] | None = None  # (column, parent table, parent column)
    warn_hours: int = 168
    required: tuple[str, ...] = ()  # never NULL, besides a single-column grain

    @property
    def columns(self) -> tuple[str, ...]:
        """What every landing of the table must have."""
        parent = self.parent[:1] if self.parent else ()
        return tuple(
            dict.fromkeys((*self.grain, *self.trimmed, *parent, *self.required, "loaddate"))
        )


_ITEM = ("prtnum", "prt_client_id")

WMS: dict[str, WmsTable] = {
    "dlytrn": WmsTable(("dlytrn_id",), _ITEM, warn_hours=48),
    "inv_snap": WmsTable(("inv_snap_id",), _ITEM, warn_hours=48),
    "invdtl": WmsTable(("dtlnum",), _ITEM, ("subnum", "invsub", "subnum")),
    "invlod": WmsTable(("lodnum",)),
    "invsub": WmsTable(("subnum",), (), ("lodnum", "invlod", "lodnum")),
    "invsum": WmsTable(
        ("wh_id", "stoloc", "prtnum", "prt_client_id", "invsts"), _ITEM, required=("stoloc", "prtnum")
    ),
    "locmst": WmsTable(("wh_id", "stoloc"), required=("stoloc",)),
    "pckwrk_dtl": WmsTable(
        ("wrkref_dtl",), (*_ITEM, "stcust"), ("wrkref", "pckwrk_hdr", "wrkref")
    ),
    "pckwrk_hdr": WmsTable(("wrkref",), _ITEM),
    "prtdsc": WmsTable(("colnam", "colval", "locale_id")),
    "prtftp": WmsTable(
        ("prtnum", "ftpcod", "prt_client_id", "wh_id"), _ITEM, required=("prtnum",)
    ),
    "prtftp_dtl": WmsTable(
        ("prtnum", "ftpcod", "prt_client_id", "wh_id", "uomcod", "uomlvl"), _ITEM
    ),
    "prtmst": WmsTable(
        ("prtnum", "prt_client_id", "wh_id_tmpl"), (*_ITEM, "dsp_prtnum"), required=("prtnum",)
    ),
    "rplcfg": WmsTable(("rplnum",), _ITEM),
    "shipment": WmsTable(("ship_id",), warn_hours=48),
    "shipment_line": WmsTable(
        ("ship_line_id",), _ITEM, ("ship_id", "shipment", "ship_id"), warn_hours=48
    ),
}


@dataclass(frozen=True)
class FreshnessRule:
    loaded_at: str
    warn_after: timedelta
    error_after: timedelta | None = None


FRESHNESS: dict[str, FreshnessRule] = {
    "system_event_log": FreshnessRule("created_at", timedelta(hours=24), timedelta(hours=72)),
    **{
        name: FreshnessRule("loaddate", timedelta(hours=table.warn_hours))
        for name, table in WMS.items()
    },
}
