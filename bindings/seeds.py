"""Reference tables of the trial data.

Fixed values: registered applications, warn codes, application category codes
and ABC classes must equal those of the source system for right results. The event dictionary
is the trial's own subset; of the system accounts only `itadmin` occurs in the trial data, the
other names are invented.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

APP_SOURCES = [
    ("PDA-A", "PDA", "PDA — Handheld Sales Device", "Sales", "Android"),
    ("CatalogFC-A", "CatalogFC", "Catalog For Customer (Android)", "Customer", "Android"),
    ("CatalogFC-I", "CatalogFC", "Catalog For Customer (iOS)", "Customer", "iOS"),
    ("CatalogFS-I", "CatalogFS", "Catalog For Sales (iOS)", "Sales", "iOS"),
    ("CatalogFS-A", "CatalogFS", "Catalog For Sales (Android)", "Sales", "Android"),
    ("Vegas-I", "Vegas", "Vegas — Customer App (iOS)", "Customer", "iOS"),
    ("Vegas-A", "Vegas", "Vegas — Customer App (Android)", "Customer", "Android"),
    ("CatalogSE", "CatalogSE", "Special Edition", "Customer", "iOS"),
    ("Web", "Web", "Website (Latest Version)", "Customer", "Web"),
    ("CatalogFC", "CatalogFC", "Catalog For Customer (iOS)", "Customer", "iOS"),
    ("Vegas", "Vegas", "Vegas — Customer App (iOS)", "Customer", "iOS"),
]

SYSTEM_ACCOUNTS = [
    ("cndev", "dev"),
    ("Cndev", "dev"),
    ("cndev2", "dev"),
    ("devone", "dev"),
    ("itadmin", "it"),
    ("devtwo", "dev"),
    ("devthree", "dev"),
    ("Unlogged", "system"),
    ("SME001", "test"),
]

# code, function name, L1 category, payload format
EVENT_CODES = [
    ("04010100", "Order List: Customer - Success", "Send Order", "kv"),
    ("04010200", "Order List: Customer - Fail", "Send Order", "kv"),
    ("04050100", "submit_quote_cart_page - Success", "Send Order", "bare_value"),
    ("05010100", "Request Review: Order List - Success", "Request Review", "positional_order"),
    ("07010100", "Restore: Order Detail - Success", "Restore Order", "bare_value"),
    ("09010000", "Create Order", "Create Order", "positional"),
    ("10040100", "Delete Item: Order Detail", "Order Operations", "sku"),
    ("10040800", "remove_item_promo_page", "Order Operations", "sku"),
    ("10050100", "add_item_list_page", "Order Operations", "positional"),
    ("10050300", "add_item_promo_page", "Order Operations", "positional"),
    ("10130100", "OOS Check: List", "Order Operations", "sku"),
    ("10150200", "change_qty_item_suggest_page", "Order Operations", "positional"),
    ("11010100", "Filter By Category: New & Promo", "Filtering & Sorting", "bare_value"),
    ("12011600", "Search: Back Order", "Search", "bare_value"),
    ("14030000", "Item Detail: Purchase History", "Item Detail Navigation", "sku"),
    ("15010000", "Item Enlarge: Product Detail", "Item Image Enlarge", "sku"),
    ("18020000", "click_backorder_icon", "Activity (Customer Interactions)", "title"),
    ("18030000", "click_history_icon", "Activity (Customer Interactions)", "title"),
    ("19010000", "Catalog View", "Catalog View Analytics", "kv"),
]

WARN_CODES = [
    "02010200", "02020200", "02030102", "02030202", "03010200", "03020200", "03050200",
    "03060200", "03070200", "03080200", "03100200", "03110300", "04010200", "04020200",
    "04030200", "04040200", "04050200", "05010200", "05020200", "06010200", "06020200",
    "06030200", "07010200", "07020200", "13010200", "13020200", "17040102", "17040202",
    "17040302", "17040402", "17040502", "20010200", "20020402",
]

# app code, app id, website category id, name, kind
APP_CATEGORY_CODES = [
    ("100", "6", "6", "Rice & Noodles", "real_category"),
    ("300", "19", "19", "Canned Goods & Vegetables", "real_category"),
    ("500", "20", "20", "Seafood & Meat", "real_category"),
    ("600", "43", "43", "Sauces & Seasonings", "real_category"),
    ("800", "21", "21", "Baking & Mixes", "real_category"),
    ("900", "24", "24", "Desserts & Sweets", "real_category"),
    ("1200", "25", "25", "Snacks", "real_category"),
    ("1300", "26", "26", "Beverages", "real_category"),
    ("1600", "27", "27", "Fresh & Frozen", "real_category"),
    ("1700", "28", "28", "Household", "real_category"),
    ("1111", "-2", None, "New", "virtual_slot"),
    ("8888", "-3", None, "Promo", "virtual_slot"),
    ("9990", None, None, "New Recommendation", "virtual_slot"),
    ("9991", "-6", None, "Recommend by Service", "virtual_slot"),
    ("4444", None, None, "Back Order", "virtual_slot"),
    ("5555", None, None, "Purchase History", "virtual_slot"),
    ("7777", None, None, "HOT", "virtual_slot"),
    ("9999", None, None, "Recommend", "virtual_slot"),
]

CODE_DESCRIPTIONS = [
    ("abccod", "A", "A Items - EXPENSIVE", "A Items"),
    ("abccod", "B", "B Items", "B Items"),
    ("abccod", "C", "C Items", "C Items"),
    ("abccod", "D", "D item for ABCD analysis", None),
    ("uomcod", "EA", "Each", "Each"),
    ("uomcod", "CS", "Case", "Case"),
]

_TABLES: dict[str, tuple[list[str], list[tuple]]] = {
    "app_sources": (
        ["source_code", "app_name", "app_full_name", "user_type", "platform"],
        APP_SOURCES,
    ),
    "system_accounts": (["username", "account_type"], SYSTEM_ACCOUNTS),
    "event_codes": (
        [
            "description_code",
            "function_name",
            "l1_category_name",
            "payload_format",
            "has_geo",
            "is_system_event",
            "event_type",
            "log_level",
        ],
        [
            (*row, row[0][:2] in ("04", "09"), False, "ACTION", "INFO")
            if row[0] not in WARN_CODES
            else (*row, True, False, "ACTION", "WARN")
            for row in EVENT_CODES
        ],
    ),
    "warn_event_codes": (
        ["description_code", "log_level"],
        [(code, "WARN") for code in WARN_CODES],
    ),
    "app_category_codes": (
        ["app_category_code", "app_id", "ust_category_id", "category_name", "code_type"],
        APP_CATEGORY_CODES,
    ),
    "layout_codes": (
        ["layout_code", "layout_name", "notes"],
        [
            ("0", "Standard Layout", None),
            ("1", "Builder Layout", None),
            ("2", "New Layout", "used by most"),
        ],
    ),
    "jdawms_code_descriptions": (
        ["code_domain", "code_value", "long_description", "short_description"],
        CODE_DESCRIPTIONS,
    ),
}


_built: dict[tuple[str, str], DataFrame] = {}


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A reference table as a local relation, whose size Catalyst knows."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _built:
        columns, rows = _TABLES[name]
        _built[key] = spark.createDataFrame(
            pa.table({c: [r[i] for r in rows] for i, c in enumerate(columns)})
        )
    return _built[key]


def seed_values(name: str) -> str:
    """The same table as a VALUES clause for the comparison SQL."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        return "'" + value.replace("'", "''") + "'"

    columns, rows = _TABLES[name]
    body = ",\n    ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES\n    {body}) AS v({', '.join(columns)})"
