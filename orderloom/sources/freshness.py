"""Age of each source against its limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.tables import high_water
from orderloom.params import Params
from orderloom.sources.schemas import FRESHNESS, FreshnessRule


def source_freshness(
    sources: dict[str, DataFrame],
    params: Params,
    rules: dict[str, FreshnessRule] = FRESHNESS,
) -> DataFrame:
    """One row per source: newest load, age in hours and pass / warn / error.

    Only the load column of each source is read, and reduced before it is shuffled.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        rule = rules[name]
        newest = df.agg(F.max(F.col(rule.loaded_at).cast("timestamp")).alias("max_loaded_at"))
        return _aged(name, newest, rule, params)

    return reduce(DataFrame.unionByName, (one(n, df) for n, df in sources.items()))


def stored_freshness(
    spark: SparkSession,
    paths: dict[str, str],
    params: Params,
    rules: dict[str, FreshnessRule] = FRESHNESS,
) -> DataFrame:
    """The same of stored tables, from the greatest load times in their manifests: no scan.

    The load column of a rule must be a timestamp in the stored table.
    """

    def one(name: str, path: str) -> DataFrame:
        newest = high_water(spark, path, rules[name].loaded_at)
        row = spark.range(1).select(F.timestamp_micros(F.lit(newest)).alias("max_loaded_at"))
        return _aged(name, row, rules[name], params)

    return reduce(DataFrame.unionByName, (one(n, p) for n, p in paths.items()))


def _aged(name: str, newest: DataFrame, rule: FreshnessRule, params: Params) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), params.now())
    status = F.when(F.col("max_loaded_at").isNull(), "error")
    if rule.error_after is not None:
        status = status.when(age > int(rule.error_after.total_seconds()), "error")
    status = status.when(age > int(rule.warn_after.total_seconds()), "warn")
    return newest.select(
        F.lit(name).alias("source_name"),
        "max_loaded_at",
        F.floor(age / 3600).alias("age_hours"),
        status.otherwise("pass").alias("status"),
    )
