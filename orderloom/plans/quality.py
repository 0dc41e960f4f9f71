"""Audit views and the checks declared over the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import classify, clock
from orderloom.functions.text import blank_to_null, whole_number
from orderloom.operators.checks import (
    Check,
    accepted_values,
    not_null_check,
    relationships_check,
    row_check,
    unique_check,
    unique_combination_check,
)
from orderloom.sources.schemas import WMS

# Codes confirmed as legacy and kept out of the dictionary.
LEGACY_CODES = ("00000000", "03110400", "10051500", "10691200", "11124000")


def quarantine_invalid_source(staged: DataFrame, app_sources: DataFrame) -> DataFrame:
    """Events whose application is missing or not registered: the spine's complement."""
    known = app_sources.select(F.col("source_code").alias("source"))
    return staged.join(known, "source", "left_anti").select(
        "entity_id",
        "source",
        "username",
        "ust_customer_no",
        "location",
        "event_time",
        "description_code",
        "response",
        "device_name",
        "created_at",
        "updated_at",
    )


def unparsed_event_times(staged: DataFrame, app_sources: DataFrame) -> DataFrame:
    """Events of registered applications that leave the spine because their time, though not
    blank, is no timestamp."""
    known = app_sources.select(F.col("source_code").alias("source"))
    lost = (F.col("event_time") != "") & clock.event_time("event_time").isNull()
    return staged.join(known, "source", "left_semi").filter(lost).select(
        "entity_id", "source", "username", "event_time", "description_code", "created_at"
    )


def unmapped_event_codes(decoded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Codes of genuine events that the dictionary lacks, most frequent first."""
    code = F.col("description_code")
    well_formed = (F.length(code) == 8) & whole_number(code).isNotNull()
    return (
        decoded.join(dictionary.select("description_code"), "description_code", "left_anti")
        .groupBy("description_code")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("source_code").alias("distinct_sources"),
            F.min("source_code").alias("example_source"),
            F.min("created_at_utc").alias("first_seen_utc"),
            F.max("created_at_utc").alias("last_seen_utc"),
        )
        .select(
            "description_code",
            well_formed.alias("is_well_formed_code"),
            code.isin(*LEGACY_CODES).alias("is_known_legacy"),
            F.substring(code, 1, 2).alias("l1_code"),
            "event_count",
            "distinct_sources",
            "example_source",
            "first_seen_utc",
            "last_seen_utc",
        )
        .orderBy(F.desc("event_count"), "description_code")
    )


def unmatched_demand_skus(demand_daily: DataFrame, item_master: DataFrame) -> DataFrame:
    """Lifetime demand of item numbers the warehouse does not know, most demand first."""
    views = F.col("item_detail_views") + F.col("image_enlarge_views")
    return (
        demand_daily.groupBy("sku")
        .agg(
            F.min("activity_date").alias("first_seen"),
            F.max("activity_date").alias("last_seen"),
            F.sum(views).alias("item_views"),
            F.sum("cart_adds").alias("cart_adds"),
            F.sum("cart_add_qty").alias("cart_add_qty"),
        )
        .join(item_master.select(F.col("prtnum").alias("sku")), "sku", "left_anti")
        .withColumn("demand_events", F.col("item_views") + F.col("cart_adds"))
        .orderBy(F.desc("demand_events"), "sku")
    )


def without_sales_code() -> Column:
    blank = blank_to_null(F.trim("sales_code")).isNull()
    return classify.is_sales_app("source_code") & blank


def sales_code_check(decoded: DataFrame) -> Check:
    """Sales-application events that carry no sales code; only a warning."""
    return row_check(
        "sales_code_present",
        decoded,
        without_sales_code(),
        "warn",
        ["entity_id", "source_code", "username", "sales_code", "created_at_utc"],
    )


# Declared checks. Keys, accepted values and severities of the models.
UNIQUE = {
    "stg_event_log": ["entity_id"],
    "stg_admin_users": ["user_id"],
    "stg_category": ["entity_id"],
    "events_decoded": ["entity_id"],
    "events_enriched": ["entity_id"],
    "fct_events": ["entity_id"],
    "fct_orders": ["increment_id"],
    "fct_order_cycles": ["cycle_id"],
    "quarantine_invalid_source": ["entity_id"],
    "unmapped_event_codes": ["description_code"],
    "unmatched_demand_skus": ["sku"],
    "event_codes": ["description_code"],
    "app_sources": ["source_code"],
    "system_accounts": ["username"],
    "categories": ["category_id"],
    "app_category_codes": ["app_category_code"],
    "category_name_aliases": ["raw_name"],
    "warn_event_codes": ["description_code"],
    "layout_codes": ["layout_code"],
}
NOT_NULL = {
    "stg_event_log": ["entity_id", "source", "description_code"],
    "stg_admin_users": ["user_id"],
    "stg_category": ["entity_id"],
    "events_decoded": ["entity_id", "source_code", "description_code", "created_at_utc"],
    "events_enriched": ["entity_id"],
    "item_demand_daily": ["activity_date", "sku"],
    "inventory_daily": ["prtnum", "snapshot_date"],
    "items": ["prtnum"],
    "fct_events": ["entity_id"],
    "fct_orders": ["increment_id", "submitted_at"],
    "fct_order_cycles": ["cycle_id", "customer_key"],
    "customer_weekly": ["customer_key", "week_start"],
    "rep_weekly": ["sales_code", "week_start"],
    "feature_pairing": ["week_start", "feature_a", "feature_b"],
    "item_demand_supply": ["prtnum", "week_start"],
    "quarantine_invalid_source": ["entity_id"],
    "unmapped_event_codes": ["description_code"],
    "unmatched_demand_skus": ["sku"],
    "event_codes": ["description_code", "function_name"],
    "app_sources": ["source_code"],
    "system_accounts": ["username"],
    "categories": ["category_id", "category_name"],
    "app_category_codes": ["app_category_code", "category_name"],
    "category_name_aliases": ["raw_name", "alias_type"],
    "warn_event_codes": ["description_code", "log_level"],
    "layout_codes": ["layout_code", "layout_name"],
    "jdawms_code_descriptions": ["code_domain", "code_value", "long_description"],
}
COMBINATION = {
    "item_demand_daily": ["sku", "activity_date", "source_system"],
    "inventory_daily": ["prtnum", "prt_client_id", "wh_id", "snapshot_date"],
    "items": ["prtnum", "prt_client_id"],
    "item_demand_supply": ["prtnum", "week_start"],
    "jdawms_code_descriptions": ["code_domain", "code_value"],
}
ACCEPTED = {
    ("events_decoded", "source_code"): [
        "PDA-A",
        "CatalogFC-A",
        "CatalogFC-I",
        "CatalogFS-I",
        "CatalogFS-A",
        "Vegas-I",
        "Vegas-A",
        "CatalogSE",
        "Web",
        "CatalogFC",
        "Vegas",
    ],
    ("events_decoded", "actor_type"): ["sales", "customer"],
    ("events_enriched", "outcome"): ["success", "fail"],
    ("events_enriched", "feature_name"): list(classify.FEATURES),
    ("events_enriched", "page_context"): list(classify.PAGE_CONTEXTS),
    ("fct_order_cycles", "cycle_status"): ["submitted", "abandoned", "open"],
    ("fct_order_cycles", "segment_name"): ["churner", "quick_reorder", "browser", "mixed"],
    ("customer_weekly", "service_mode"): ["self_service", "sales_assisted", "mixed"],
    ("item_demand_supply", "signal"): [
        "missed_opportunity",
        "restock_risk",
        "promote_candidate",
        "healthy",
    ],
    ("event_codes", "payload_format"): [
        "none",
        "kv",
        "positional_order",
        "positional",
        "duration",
        "sku",
        "title",
        "bare_value",
        "fail_marker",
    ],
    ("app_sources", "user_type"): ["Sales", "Customer"],
    ("app_sources", "platform"): ["iOS", "Android", "Web"],
    ("app_category_codes", "code_type"): ["real_category", "virtual_slot"],
    ("category_name_aliases", "alias_type"): [
        "aggregate_view_all",
        "category_match",
        "ui_label",
        "search_query",
        "brand_keyword",
        "error_payload",
    ],
}
RELATIONSHIPS = {
    ("events_decoded", "description_code"): ("event_codes", "description_code", "warn"),
    ("item_demand_supply", "prtnum"): ("items", "prtnum", "error"),
    ("category_name_aliases", "category_id"): ("categories", "category_id", "warn"),
}


def row_conditions(model: str) -> dict[str, Column]:
    """The conditions of a model's row checks by the check's name, to be counted as it is written."""
    found = {f"not_null_{model}_{c}": F.col(c).isNull() for c in NOT_NULL.get(model, [])}
    if model == "events_decoded":
        found["sales_code_present"] = without_sales_code()
    return found


def declared_checks(models: dict[str, DataFrame]) -> list[Check]:
    """The declared checks of whichever models are given.

    Warehouse tables are named `wms_<table>`; their uniqueness and parent checks only warn.
    """
    out: list[Check] = []
    for name, df in models.items():
        for column in UNIQUE.get(name, []):
            out.append(unique_check(f"unique_{name}_{column}", df, column))
        for column in NOT_NULL.get(name, []):
            out.append(not_null_check(f"not_null_{name}_{column}", df, column))
        if name in COMBINATION:
            out.append(
                unique_combination_check(f"unique_combination_{name}", df, COMBINATION[name])
            )
    for (name, column), values in ACCEPTED.items():
        if name in models:
            bad = accepted_values(models[name], column, values)
            out.append(Check(f"accepted_values_{name}_{column}", bad))
    for (name, column), (parent, field, severity) in RELATIONSHIPS.items():
        if name in models and parent in models:
            label = f"relationships_{name}_{column}"
            out.append(
                relationships_check(label, models[name], column, models[parent], field, severity)
            )
    for table, spec in WMS.items():
        name = f"wms_{table}"
        if name not in models:
            continue
        grain = list(spec.grain)
        if len(grain) == 1:
            label = f"unique_{name}_{grain[0]}"
            out.append(unique_check(label, models[name], grain[0], "warn"))
            out.append(not_null_check(f"not_null_{name}_{grain[0]}", models[name], grain[0]))
        else:
            label = f"unique_combination_{name}"
            out.append(unique_combination_check(label, models[name], grain, "warn"))
        for column in spec.required:
            out.append(not_null_check(f"not_null_{name}_{column}", models[name], column))
        if spec.parent and f"wms_{spec.parent[1]}" in models:
            column, parent, field = spec.parent
            label = f"relationships_{name}_{column}"
            of = models[f"wms_{parent}"]
            out.append(relationships_check(label, models[name], column, of, field, "warn"))
    if "events_decoded" in models:
        out.append(sales_code_check(models["events_decoded"]))
    return out
