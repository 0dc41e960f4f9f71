"""The whole pipeline: first build, second build over late data, checks."""

from pyspark.sql import functions as F

from bindings.frames import TRIAL
from orderloom.operators import tables
from orderloom.plans import build as pipeline
from orderloom.plans import events, orders
from orderloom.session import shared_dir


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_builds_in_two_steps_equal_one(spark, models):
    def sources(event_log):
        return pipeline.Sources(
            event_log=event_log,
            admin_users=models.source("admin_users"),
            inv_snap=models.source("inv_snap"),
            prtmst=models.source("prtmst"),
            prtdsc=models.source("prtdsc"),
            seeds=models.seed,
        )

    raw = models.source("raw_events")
    warehouse = shared_dir(spark, "warehouse")
    early = raw.filter(F.col("created_at") < F.lit("2024-01-20"))
    first = pipeline.build(spark, sources(early), warehouse, TRIAL)
    assert first["fct_events"].count() == first["events_enriched"].count()

    built = pipeline.build(spark, sources(raw), warehouse, TRIAL)
    fact = events.fct_events(models.spine())
    assert rows(built["fct_events"].select(fact.columns)) == rows(fact)
    submitted = orders.fct_orders(models.spine())
    assert rows(built["fct_orders"].select(submitted.columns)) == rows(submitted)
    assert rows(built["fct_order_cycles"]) == rows(models.order_cycles())
    assert rows(built["item_demand_supply"].select("prtnum", "week_start", "signal")) == rows(
        models.mart(TRIAL).select("prtnum", "week_start", "signal")
    )

    summary = {r.check_name: r for r in pipeline.run_checks(built, warehouse).collect()}
    failed = {n for n, r in summary.items() if r.status == "error"}
    assert failed == {"not_null_stg_event_log_source"}
    stored = tables.read_table(spark, f"{warehouse}/test_failures")
    stored = stored.where("check_name = 'not_null_stg_event_log_source'")
    assert stored.count() == summary["not_null_stg_event_log_source"].failures > 0
    assert summary["relationships_events_decoded_description_code"].status == "warn"


def test_refresh_skips_old_partitions(spark, models):
    from orderloom.functions import clock

    path = shared_dir(spark, "by-day")
    by_day = tables.rebuild(
        models.spine().withColumn("event_date", clock.day("event_at_utc")), path, "event_date"
    )
    late = tables.trailing_window(
        by_day, by_day, "event_at_utc", "event_at_utc", 3, source_day="event_date"
    )
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "subquery" in plan.lower()
    assert rows(late.select("entity_id")) == rows(
        tables.trailing_window(
            models.spine(), models.spine(), "event_at_utc", "event_at_utc", 3
        ).select("entity_id")
    )
