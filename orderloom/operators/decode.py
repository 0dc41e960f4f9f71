"""Lookups of coded values in the reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.dedupe import latest_per_key

# Column names whose code domain has another name.
_DOMAIN_BY_COLUMN = {"fr_arecod": "arecod", "to_arecod": "arecod"}
_UNIT_SUFFIX, _UNIT_DOMAIN = "uom", "uomcod"


def drop_warn_codes(events: DataFrame, warn_codes: DataFrame) -> DataFrame:
    """Events without the network-error codes; events without a code stay."""
    return events.join(warn_codes.select("description_code"), "description_code", "left_anti")


def code_domain(column: str) -> str:
    if column in _DOMAIN_BY_COLUMN:
        return _DOMAIN_BY_COLUMN[column]
    return _UNIT_DOMAIN if column.endswith(_UNIT_SUFFIX) else column


def decode_wms_code(
    df: DataFrame, column: str, descriptions: DataFrame, domain: str | None = None
) -> DataFrame:
    """Adds the long and short description of a warehouse code column."""
    names = descriptions.filter(F.col("code_domain") == (domain or code_domain(column))).select(
        F.col("code_value").alias(column),
        F.col("long_description").alias(f"{column}_description"),
        F.col("short_description").alias(f"{column}_short_description"),
    )
    return df.join(names, column, "left").select(*df.columns, *names.columns[1:])


def decode_app_category(
    df: DataFrame, column: str, app_codes: DataFrame, categories: DataFrame
) -> DataFrame:
    """Decodes a payload's category code.

    The code may be an application code or an application id; either names a real category or
    a virtual slot, which is no product category. Codes unknown to the application are looked
    up among the website's own category ids.
    """
    real = F.col("code_type") == "real_category"
    described = [
        "code_type",
        F.when(real, F.col("ust_category_id")).alias("_id"),
        F.col("category_name").alias("_name"),
    ]

    def keyed(code: str, priority: int) -> DataFrame:
        return app_codes.select(
            F.col(code).alias("_key"), F.lit(priority).alias("_by"), *described
        )

    either = (
        keyed("app_category_code", 0)
        .unionByName(keyed("app_id", 1))
        .filter(F.col("_key").isNotNull())
    )
    lookup = latest_per_key(either, ["_key"], [F.col("_by").asc()], ["_id", "_name"]).drop("_by")
    website = categories.select(
        F.col("category_id").alias("_cat"), F.col("category_name").alias("_cat_name")
    )
    by_app = df.join(lookup, F.col(column) == F.col("_key"), "left")
    known = F.col("_key").isNotNull()
    wanted = F.when(known, F.col("_id")).otherwise(F.col(column))
    return by_app.join(website, wanted == F.col("_cat"), "left").select(
        *df.columns,
        F.when(known, "app_code")
        .when(F.col("_cat").isNotNull(), "category")
        .otherwise("unknown")
        .alias("decoded_by"),
        "code_type",
        F.when(known, F.col("_id")).otherwise(F.col("_cat")).alias("category_id"),
        F.coalesce("_cat_name", "_name").alias("category_name"),
        F.coalesce(F.when(known, real), F.col("_cat").isNotNull()).alias("is_product_category"),
    )


def classify_category_name(
    df: DataFrame, column: str, aliases: DataFrame, categories: DataFrame
) -> DataFrame:
    """Adds alias type and category id of a raw category name; every row is kept.

    The alias table is matched on the exact text first, then the category names.
    """
    alias = aliases.select(
        F.col("raw_name").alias("_raw"), "alias_type", F.col("category_id").alias("_alias_id")
    )
    # Category names may repeat; the smallest id stands for the name.
    website = categories.groupBy(F.col("category_name").alias("_name")).agg(
        F.min("category_id").alias("_website_id")
    )
    # Only rows without an alias meet the names: as NULL keys of one join the others would all
    # hash to one partition.
    by_alias = df.join(alias, F.col(column) == F.col("_raw"), "left")
    aliased = by_alias.filter(F.col("_raw").isNotNull()).select(
        *df.columns, "alias_type", F.col("_alias_id").alias("category_id")
    )
    rest = df.join(alias.select("_raw"), F.col(column) == F.col("_raw"), "left_anti")
    named = rest.join(website, F.col(column) == F.col("_name"), "left").select(
        *df.columns,
        F.lit(None).cast("string").alias("alias_type"),
        F.col("_website_id").alias("category_id"),
    )
    return aliased.unionByName(named)
