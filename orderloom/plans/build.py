"""The whole pipeline over a warehouse folder: views, rebuilt tables, incremental facts, checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import clock
from orderloom.operators import tables
from orderloom.operators.checks import check_summary, store_failures
from orderloom.params import Params
from orderloom.plans import (
    cycles,
    demand,
    events,
    orders,
    quality,
    reps,
    scorecards,
    staging,
    supply,
)
from orderloom.session import prepare

EVENT_DAY = "event_date"


@dataclass(frozen=True)
class Sources:
    """Inputs of a build: source tables as landed, and the reference tables by name."""

    event_log: DataFrame
    admin_users: DataFrame
    inv_snap: DataFrame
    prtmst: DataFrame
    prtdsc: DataFrame
    seeds: dict[str, DataFrame]
    category: DataFrame | None = None
    wms: dict[str, DataFrame] = field(default_factory=dict)  # the other warehouse tables


def refresh_fct_events(enriched: DataFrame, path: str, params: Params) -> None:
    """Upserts the trailing window of events into the event fact."""
    batch = events.fct_events(_late(enriched, path, "event_at_utc", params))
    newest = [F.col("event_at_utc").desc()]
    tables.upsert_table(batch, path, "entity_id", newest, tables.id_block("entity_id"))


def refresh_fct_orders(enriched: DataFrame, path: str, params: Params) -> None:
    """Upserts the orders submitted in the trailing window; a resubmit replaces the order."""
    batch = orders.fct_orders(_late(enriched, path, "submitted_at", params))
    newest = [F.col("submitted_at").desc()]
    tables.upsert_table(batch, path, "increment_id", newest, tables.number_block("increment_id"))


def _late(enriched: DataFrame, path: str, target_ts: str, params: Params) -> DataFrame:
    return tables.since(
        enriched,
        tables.high_water(enriched.sparkSession, path, target_ts),
        "event_at_utc",
        params.late_window_days,
        EVENT_DAY if EVENT_DAY in enriched.columns else None,
    )


def build(
    spark: SparkSession, sources: Sources, warehouse: str, params: Params = Params()
) -> dict[str, DataFrame]:
    """Builds every model and returns them by name.

    What several models read is written once; the rest stays a view. Order cycles, journeys and
    scorecards are rebuilt as a whole, since late events move their boundaries. The two event
    facts are refreshed incrementally.
    """
    prepare(spark)
    seed = sources.seeds

    def table(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        counted = quality.row_conditions(name)
        return tables.rebuild(df, f"{warehouse}/{name}", partition_by, counted)

    # written once: the decode, the quarantine, the audits and the checks read it
    staged = table("stg_event_log", staging.stage_events(sources.event_log))
    users = staging.stage_admin_users(sources.admin_users)
    inventory = supply.inventory_daily(staging.stage_wms("inv_snap", sources.inv_snap))
    items = supply.items(
        staging.stage_wms("prtmst", sources.prtmst),
        staging.stage_wms("prtdsc", sources.prtdsc),
        seed["jdawms_code_descriptions"],
    )
    decoded = table("events_decoded", events.decode_events(staged, seed["app_sources"]))
    enriched = table(
        "events_enriched",
        events.enrich_events(
            decoded, seed["event_codes"], seed["app_sources"], seed["system_accounts"]
        ).withColumn(EVENT_DAY, clock.day("event_at_utc")),
        EVENT_DAY,
    )

    facts = {name: f"{warehouse}/{name}" for name in ("fct_events", "fct_orders")}
    refresh_fct_events(enriched, facts["fct_events"], params)
    refresh_fct_orders(enriched, facts["fct_orders"], params)
    fct_events, fct_orders = (tables.read_upserted(spark, path) for path in facts.values())

    order_cycles = table("fct_order_cycles", cycles.fct_order_cycles(enriched, params))
    rep_cycles = table("rep_order_cycle", reps.rep_order_cycle(enriched, params))
    demand_daily = demand.item_demand_daily(enriched, params)
    return {
        "stg_event_log": staged,
        "stg_admin_users": users,
        "events_decoded": decoded,
        "events_enriched": enriched,
        "item_demand_daily": demand_daily,
        "inventory_daily": inventory,
        "items": items,
        "fct_events": fct_events,
        "fct_orders": fct_orders,
        "fct_order_cycles": order_cycles,
        "rep_order_cycle": rep_cycles,
        "customer_weekly": table(
            "customer_weekly",
            scorecards.customer_weekly(enriched, order_cycles, fct_orders, params),
        ),
        "feature_pairing": table("feature_pairing", scorecards.feature_pairing(enriched)),
        "item_demand_supply": table(
            "item_demand_supply", demand.item_demand_supply(enriched, inventory, items, params)
        ),
        "rep_weekly": table(
            "rep_weekly", scorecards.rep_weekly(order_cycles, fct_orders, users)
        ),
        "rep_order_journey": table(
            "rep_order_journey", reps.rep_order_journey(fct_events, rep_cycles, params)
        ),
        "quarantine_invalid_source": quality.quarantine_invalid_source(
            staged, seed["app_sources"]
        ),
        "unparsed_event_times": quality.unparsed_event_times(staged, seed["app_sources"]),
        "unmapped_event_codes": quality.unmapped_event_codes(decoded, seed["event_codes"]),
        "unmatched_demand_skus": quality.unmatched_demand_skus(demand_daily, items),
        "wms_inv_snap": staging.stage_wms("inv_snap", sources.inv_snap),
        "wms_prtmst": staging.stage_wms("prtmst", sources.prtmst),
        "wms_prtdsc": staging.stage_wms("prtdsc", sources.prtdsc),
        **{f"wms_{n}": staging.stage_wms(n, df) for n, df in sources.wms.items()},
        **(
            {"stg_category": staging.stage_category(sources.category)}
            if sources.category is not None
            else {}
        ),
        **seed,
    }


def run_checks(models: dict[str, DataFrame], warehouse: str) -> DataFrame:
    """Runs every declared check, keeps the rows that failed, returns the summary.

    Row checks of tables that `build` wrote were counted as they were written.
    """
    declared = quality.declared_checks(models)
    spark = next(iter(models.values())).sparkSession
    known = {n: k for m in models for n, k in tables.counts(spark, f"{warehouse}/{m}").items()}
    counted = check_summary(declared, known, in_turn=True)
    summary = tables.rebuild(counted, f"{warehouse}/check_summary")
    failed = {r.check_name for r in summary.filter("status <> 'pass'").collect()}
    if failed:
        store_failures([c for c in declared if c.name in failed], f"{warehouse}/test_failures")
    return summary


__all__ = ["Sources", "build", "refresh_fct_events", "refresh_fct_orders", "run_checks"]
