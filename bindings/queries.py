"""The registered queries: every plan over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import frames
from bindings.frames import TRIAL, TUNED
from orderloom.functions import clock, text
from orderloom.operators import checks, decode, tables
from orderloom.params import Params
from orderloom.plans import (
    analyses,
    build,
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
from orderloom.session import shared_dir
from orderloom.sources import freshness, readers
from orderloom.sources.freshness import source_freshness
from orderloom.sources.schemas import ENVELOPE, WMS
from orderloom.streaming import event_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Written tables, one per session, input folder and name: the decoded events, the enriched spine
# and finished models that others read. Like any table they are built once and read often.
_written: dict[tuple[str, str, str], DataFrame] = {}

SOURCES = {
    "raw_events": frames.raw_events,
    "inv_snap": frames.wms_inv_snap,
    "prtmst": frames.wms_prtmst,
    "prtdsc": frames.wms_prtdsc,
    "admin_users": frames.admin_users,
    "category": frames.category,
    "category_aliases": frames.category_aliases,
}


OTHER_WMS = [name for name in WMS if name not in SOURCES]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


class Inputs:
    """The models of one input folder, each built from the ones before it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.seed = frames.seeds(spark)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            _written[key] = tables.materialise(build(), name)
        return _written[key]

    def source(self, name: str) -> DataFrame:
        """A source table derived from the given tables, lazily."""
        if name in OTHER_WMS:
            return frames.wms_table(self.spark, self.sf_dir, name)
        return SOURCES[name](self.spark, self.sf_dir)

    def landed(self, name: str) -> DataFrame:
        """The same as files, which a stream reads."""
        return self._once(name, lambda: self.source(name))

    def wms(self, name: str) -> DataFrame:
        return staging.stage_wms(name, self.source(name))

    def staged(self) -> DataFrame:
        return staging.stage_events(readers.read_flat_events(self.source("raw_events")))

    def decoded(self) -> DataFrame:
        return events.decode_events(self.staged(), self.seed["app_sources"])

    def enriched(self) -> DataFrame:
        return events.enrich_events(
            self.decoded_table(),
            self.seed["event_codes"],
            self.seed["app_sources"],
            self.seed["system_accounts"],
        )

    def spine(self) -> DataFrame:
        return self._once("spine", self.enriched)

    def inventory(self) -> DataFrame:
        return supply.inventory_daily(self.wms("inv_snap"))

    def items(self) -> DataFrame:
        return supply.items(
            self.wms("prtmst"), self.wms("prtdsc"), self.seed["jdawms_code_descriptions"]
        )

    def admin_users(self) -> DataFrame:
        return staging.stage_admin_users(self.source("admin_users"))

    def categories(self) -> DataFrame:
        staged = staging.stage_category(self.source("category"))
        return staged.select(
            F.col("entity_id").cast("string").alias("category_id"), "category_name"
        )

    def demand_daily(self) -> DataFrame:
        return demand.item_demand_daily(self.spine(), TRIAL)

    def mart(self, params: Params = TUNED, inventory: DataFrame | None = None) -> DataFrame:
        stock = self.inventory() if inventory is None else inventory
        return demand.item_demand_supply(self.spine(), stock, self.items(), params)

    def order_cycles(self, params: Params = TRIAL) -> DataFrame:
        return cycles.fct_order_cycles(self.spine(), params)

    def numbered(self, params: Params = TRIAL) -> DataFrame:
        return cycles.number_cycles(cycles.cycle_events(self.spine(), params), params)

    def rep_cycles(self) -> DataFrame:
        return reps.rep_order_cycle(self.spine(), TRIAL)

    def customer_weekly(self) -> DataFrame:
        spine = self.spine()
        return scorecards.customer_weekly(
            spine, self.order_cycles_table(), orders.fct_orders(spine), TRIAL
        )

    def rep_weekly(self) -> DataFrame:
        return scorecards.rep_weekly(
            self.order_cycles_table(), orders.fct_orders(self.spine()), self.admin_users()
        )

    # Finished tables, for the models that read them.

    def decoded_table(self) -> DataFrame:
        return self._once("events_decoded", self.decoded)

    def inventory_table(self) -> DataFrame:
        return self._once("inventory_daily", self.inventory)

    def mart_table(self, inventory: DataFrame | None = None) -> DataFrame:
        return self._once("item_demand_supply", lambda: self.mart(inventory=inventory))

    def order_cycles_table(self) -> DataFrame:
        return self._once("fct_order_cycles", self.order_cycles)

    def demand_daily_table(self) -> DataFrame:
        return self._once("item_demand_daily", self.demand_daily)

    def customer_weekly_table(self) -> DataFrame:
        return self._once("customer_weekly", self.customer_weekly)

    def rep_cycles_table(self) -> DataFrame:
        return self._once("rep_order_cycle", self.rep_cycles)


# --- sources, staging and the spine -------------------------------------------------------------


@query
def flatten_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events packed into pages of the API's JSON and unnested again."""
    raw = Inputs(spark, sf_dir).source("raw_events")
    page = F.floor(F.col("entity_id") / 100)
    event = F.struct(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
            if c in ("created_at", "updated_at")
            else F.col(c)
            for c in readers.EVENT_COLUMNS
        ]
    )
    pages = raw.groupBy(page.alias("page")).agg(F.collect_list(event).alias("data"))
    body = F.struct(
        F.lit(200).alias("code"),
        F.lit("ok").alias("msg"),
        F.struct(F.col("page").alias("current_page"), "data").alias("data"),
    )
    parsed = pages.select(F.from_json(F.to_json(body), ENVELOPE).alias("page")).select("page.*")
    return readers.unnest_envelopes(parsed).select(
        *[
            F.col(c).cast("timestamp").alias(c) if c in ("created_at", "updated_at") else c
            for c in readers.EVENT_COLUMNS
        ]
    )


@query
def read_large_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as text of envelopes, read back by splits of 64 KB."""
    raw = Inputs(spark, sf_dir).source("raw_events")
    event = F.struct(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
            if c in ("created_at", "updated_at")
            else F.col(c)
            for c in readers.EVENT_COLUMNS
        ]
    )
    pages = raw.groupBy(F.floor(F.col("entity_id") / 1000).alias("current_page")).agg(
        F.collect_list(event).alias("data")
    )
    body = F.struct(
        F.lit(200).alias("code"), F.lit("ok").alias("msg"), F.struct("current_page", "data").alias("data")
    )
    folder = shared_dir(spark, "envelopes")
    pages.select(F.to_json(body)).write.text(folder)
    read = readers.read_large_envelope(spark, folder)
    return read.select(
        *[
            F.col(c).cast("timestamp").alias(c) if c in ("created_at", "updated_at") else c
            for c in readers.EVENT_COLUMNS
        ]
    )


@query
def flatten_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as pages of the export, landed as the latest version of each event."""
    raw = Inputs(spark, sf_dir).source("raw_events")
    event = F.struct(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
            if c in ("created_at", "updated_at")
            else F.col(c)
            for c in readers.EVENT_COLUMNS
        ]
    )
    pages = raw.groupBy(F.floor(F.col("entity_id") / 100).alias("current_page")).agg(
        F.collect_list(event).alias("data")
    )
    body = F.struct(F.lit(200).alias("code"), F.struct("current_page", "data").alias("data"))
    folder, target = shared_dir(spark, "pages"), shared_dir(spark, "flat")
    pages.select(F.to_json(body)).write.text(folder)
    readers.flatten_to_parquet(spark, folder, target, large=True)
    return spark.read.parquet(target).select(
        "entity_id", "description_code", "response", F.col("updated_at").cast("timestamp").alias("updated_at")
    )


@query
def seed_rows_and_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a reference CSV with quotes, commas and line breaks, every tenth one damaged."""
    part = frames.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    listed = part.select(
        F.when(key % 10 == 0, F.concat(F.lit("no "), key.cast("string"))).otherwise(key.cast("string")).alias("id"),
        F.concat(F.lit('"'), "p_name", F.lit('", '), key.cast("string"), F.lit("\nof "), "p_brand").alias("name"),
    )
    folder = shared_dir(spark, "seeds")
    listed.write.option("header", True).option("escape", '"').csv(f"{folder}/seed_parts.csv")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    rows, rejects = readers.read_seed_checked(spark, folder, "parts", schema)
    rejected = rejects.select(
        F.lit("reject").alias("kind"),
        F.regexp_extract("record", "no ([0-9]+)", 1).cast("long").alias("id"),
        F.lit(None).cast("string").alias("name"),
    )
    return rows.select(F.lit("row").alias("kind"), "id", "name").unionByName(rejected)


@query
def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact, written twice as a whole: only the second version is read."""
    inputs, path = Inputs(spark, sf_dir), shared_dir(spark, "rebuilt")
    fact = orders.fct_orders(inputs.spine())
    tables.rebuild(fact.where("increment_id < 'M5'"), path)
    return tables.rebuild(fact, path)


@query
def stg_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).staged()


@query
def stg_admin_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).admin_users()


@query
def stg_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_category(Inputs(spark, sf_dir).source("category"))


@query
def stg_wms_inv_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).wms("inv_snap")


@query
def stg_wms_prtmst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).wms("prtmst")


@query
def stg_wms_prtdsc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).wms("prtdsc")


def _stage_other(name: str) -> Query:
    return lambda spark, sf_dir: Inputs(spark, sf_dir).wms(name)


QUERIES.update({f"stg_wms_{name}": _stage_other(name) for name in OTHER_WMS})


@query
def parse_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsing functions over every raw event, one column each."""
    return Inputs(spark, sf_dir).source("raw_events").select(
        "entity_id",
        "updated_at",
        text.kv_value("response", "increment_id").alias("kv_increment_id"),
        text.kv_value("response", "category").alias("kv_category"),
        text.list_part("response", 2).alias("second_part"),
        clock.add_hours("created_at", -3).alias("three_hours_earlier"),
        clock.offset_hours("timezone").alias("offset_hours"),
        clock.epoch_millis("event_id").alias("event_id_time"),
        clock.event_time("event_time").alias("device_time"),
        text.decimal_number(text.kv_value("response", "grand_total")).alias("grand_total"),
        clock.week_start("created_at").alias("week_start"),
        clock.days_between("created_at", F.lit(TRIAL.as_of)).alias("days_to_as_of"),
        clock.minutes_between("created_at", "updated_at").alias("minutes_to_update"),
    )


@query
def events_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).decoded()


@query
def events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).enriched()


# --- facts --------------------------------------------------------------------------------------


@query
def fct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.fct_events(Inputs(spark, sf_dir).spine())


@query
def fct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.fct_orders(Inputs(spark, sf_dir).spine())


@query
def fct_order_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).order_cycles()


@query
def fct_order_cycles_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).order_cycles(TUNED)


@query
def cycle_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycle_bursts(Inputs(spark, sf_dir).numbered(TUNED))


@query
def cycle_dominant_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycle_dominant_app(Inputs(spark, sf_dir).numbered(TUNED))


@query
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event fact after a first load and a second batch of updated events."""
    inputs = Inputs(spark, sf_dir)
    raw = inputs.source("raw_events")
    revised = F.col("updated_at") > F.col("created_at")

    def fact(part: DataFrame) -> DataFrame:
        seed = inputs.seed
        decoded = events.decode_events(staging.stage_events(part), seed["app_sources"])
        return decoded.select("entity_id", "event_at_utc", "description_code", "updated_at_utc")

    return tables.merge_by_key(fact(raw.filter(~revised)), fact(raw.filter(revised)), "entity_id")


def _stored(inputs: Inputs, refresh: Callable[[DataFrame, str, Params], None], name: str):
    """A fact after a first load that lacks every seventh event, and a refresh with all events."""
    path = shared_dir(inputs.spark, name)
    spine = inputs.spine()
    refresh(spine.filter(F.col("entity_id") % 7 != 0), path, TRIAL)
    refresh(spine, path, TRIAL)
    return tables.read_upserted(inputs.spark, path)


@query
def refresh_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored event fact after a late batch: only the trailing window is caught up."""
    return _stored(Inputs(spark, sf_dir), build.refresh_fct_events, "fct-events")


@query
def refresh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored order fact after resubmits within the trailing window."""
    return _stored(Inputs(spark, sf_dir), build.refresh_fct_orders, "fct-orders")


@query
def refresh_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cycles after a load that lacks late events, and a refresh with all of them."""
    spine, path = Inputs(spark, sf_dir).spine(), shared_dir(spark, "cycles")
    late = F.col("event_at_utc") >= spine.agg(
        F.timestamp_add("DAY", F.lit(-TRIAL.late_window_days), F.max("event_at_utc"))
    ).scalar()
    missing = F.coalesce(late, F.lit(False)) & (F.col("entity_id") % 3 == 0)
    cycles.refresh_order_cycles(spine.where(~missing), path, TRIAL)
    cycles.refresh_order_cycles(spine, path, TRIAL)
    return cycles.stored_order_cycles(spark, path, TRIAL)


@query
def trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events an incremental refresh of the event fact would reprocess."""
    inputs = Inputs(spark, sf_dir)
    spine = inputs.spine()
    fact = events.fct_events(spine)
    return tables.trailing_window(
        fact, fact, "event_at_utc", "event_at_utc", TRIAL.late_window_days
    ).select("entity_id", "event_at_utc", "customer_key", "description_code")


# --- demand and supply --------------------------------------------------------------------------


@query
def inventory_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).inventory()


@query
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).items()


@query
def item_demand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).demand_daily()


@query
def supply_eow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.supply_eow(Inputs(spark, sf_dir).inventory())


@query
def oos_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return demand.oos_overlap(inputs.demand_daily(), inputs.inventory())


@query
def item_demand_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).mart(TRIAL)


@query
def item_demand_supply_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).mart(TUNED)


@query
def missed_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.missed_opportunity(Inputs(spark, sf_dir).mart_table())


@query
def missed_opportunity_4wk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.missed_opportunity_4wk(Inputs(spark, sf_dir).mart_table())


@query
def promote_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.promote_candidates(Inputs(spark, sf_dir).mart_table())


@query
def restock_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.restock_risk(Inputs(spark, sf_dir).mart_table())


# --- scorecards and journeys --------------------------------------------------------------------


@query
def customer_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).customer_weekly()


@query
def feature_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecards.feature_pairing(Inputs(spark, sf_dir).spine())


@query
def rep_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).rep_weekly()


@query
def rep_order_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).rep_cycles()


@query
def rep_order_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return reps.rep_order_journey(
        events.fct_events(inputs.spine()), inputs.rep_cycles_table(), TRIAL
    )


# --- quality ------------------------------------------------------------------------------------


@query
def quarantine_invalid_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return quality.quarantine_invalid_source(inputs.staged(), inputs.seed["app_sources"])


@query
def unparsed_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return quality.unparsed_event_times(inputs.staged(), inputs.seed["app_sources"])


@query
def unmapped_event_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return quality.unmapped_event_codes(inputs.decoded_table(), inputs.seed["event_codes"])


@query
def unmatched_demand_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return quality.unmatched_demand_skus(inputs.demand_daily(), inputs.items())


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events before staging hold some ids twice."""
    return checks.unique(Inputs(spark, sf_dir).source("raw_events"), "entity_id")


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = Inputs(spark, sf_dir).staged()
    return checks.not_null(staged, "source").select("entity_id", "source", "username")


@query
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = quality.ACCEPTED["events_decoded", "source_code"]
    return checks.accepted_values(Inputs(spark, sf_dir).source("raw_events"), "source", accepted)


@query
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return checks.relationships(
        inputs.decoded_table(),
        "description_code",
        inputs.seed["event_codes"],
        "description_code",
    )


@query
def check_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock snapshots before the daily dedupe repeat their item, warehouse and day."""
    staged = Inputs(spark, sf_dir).wms("inv_snap")
    days = staged.withColumn("snapshot_date", clock.day("gendte"))
    return checks.unique_combination(days, ["prtnum", "prt_client_id", "wh_id", "snapshot_date"])


@query
def check_sales_code_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sales_code_check(Inputs(spark, sf_dir).decoded_table()).violations


def _base_models(inputs: Inputs) -> dict[str, DataFrame]:
    spine = inputs.spine()
    return {
        "stg_event_log": inputs.staged(),
        "events_decoded": inputs.decoded_table(),
        "events_enriched": spine,
        "fct_orders": orders.fct_orders(spine),
        "inventory_daily": inputs.inventory(),
        "items": inputs.items(),
        **{f"wms_{name}": inputs.wms(name) for name in WMS},
        "event_codes": inputs.seed["event_codes"],
    }


@query
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared checks of the event spine, orders, stock, items and the warehouse."""
    declared = quality.declared_checks(_base_models(Inputs(spark, sf_dir)))
    return checks.check_summary(declared, in_turn=True)


@query
def stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the stored violations of each failed check stand for."""
    declared = quality.declared_checks(_base_models(Inputs(spark, sf_dir)))
    stored = checks.store_failures(declared, shared_dir(spark, "test-failures"))
    return stored.groupBy("check_name", "severity").agg(F.sum("n").alias("failures"))


@query
def stored_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the landed events, from the manifest of their table."""
    path = shared_dir(spark, "landed-events")
    tables.rebuild(Inputs(spark, sf_dir).source("raw_events"), path)
    return freshness.stored_freshness(spark, {"system_event_log": path}, TRIAL)


@query
def check_summary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared check of every model and seed."""
    inputs = Inputs(spark, sf_dir)
    spine, demand_daily = inputs.spine(), inputs.demand_daily_table()
    # written, as the mart and two checks read it: the shuffle of its dedupe is gone before theirs
    inventory = inputs.inventory_table()
    models = {
        **_base_models(inputs),
        "inventory_daily": inventory,
        **inputs.seed,
        "stg_admin_users": inputs.admin_users(),
        "stg_category": staging.stage_category(inputs.source("category")),
        "fct_events": events.fct_events(spine),
        "fct_order_cycles": inputs.order_cycles_table(),
        "item_demand_daily": demand_daily,
        "item_demand_supply": inputs.mart_table(inventory),
        "customer_weekly": inputs.customer_weekly_table(),
        "rep_weekly": inputs.rep_weekly(),
        "feature_pairing": scorecards.feature_pairing(spine),
        "quarantine_invalid_source": quality.quarantine_invalid_source(
            inputs.staged(), inputs.seed["app_sources"]
        ),
        "unmapped_event_codes": quality.unmapped_event_codes(
            inputs.decoded_table(), inputs.seed["event_codes"]
        ),
        "unmatched_demand_skus": quality.unmatched_demand_skus(demand_daily, inputs.items()),
        "categories": inputs.categories(),
        "category_name_aliases": inputs.source("category_aliases"),
    }
    return checks.check_summary(quality.declared_checks(models), in_turn=True)


@query
def source_freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    sources = {
        "system_event_log": inputs.source("raw_events"),
        **{name: inputs.source(name) for name in WMS},
    }
    return source_freshness(sources, TRIAL)


# --- decodes ------------------------------------------------------------------------------------


@query
def decode_app_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category codes of the catalog views."""
    inputs = Inputs(spark, sf_dir)
    views = (
        inputs.spine()
        .filter(F.col("description_code") == "19010000")
        .select("entity_id", text.kv_value("response", "category").alias("category_code"))
    )
    return decode.decode_app_category(
        views, "category_code", inputs.seed["app_category_codes"], inputs.categories()
    )


@query
def classify_category_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names as tracked: order lines name their item's category in three ways."""
    inputs = Inputs(spark, sf_dir)
    part = frames.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name"
    )
    line = F.col("l_linenumber") % 3
    number = F.col("l_partkey").cast("string")
    named = (
        frames.table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey")
        .join(part, "l_partkey")
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.when(line == 0, F.concat(F.lit("All "), "p_name", F.lit(" "), number))
            .when(
                line == 1,
                F.concat(
                    "p_name", F.lit(" "), (F.col("l_partkey") % 100).cast("string")
                ),
            )
            .otherwise(F.concat(F.lit("Search:"), "p_name"))
            .alias("raw_name"),
        )
    )
    aliases = inputs.source("category_aliases")
    return decode.classify_category_name(named, "raw_name", aliases, inputs.categories())


@query
def drop_warn_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return decode.drop_warn_codes(inputs.decoded_table(), inputs.seed["warn_event_codes"]).select(
        "entity_id", "description_code", "created_at_utc"
    )


@query
def decode_wms_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item master with its ABC class and units of measure spelled out."""
    inputs = Inputs(spark, sf_dir)
    codes = inputs.seed["jdawms_code_descriptions"]
    master = inputs.wms("prtmst").select(
        "prtnum", "wh_id_tmpl", "abccod", "stkuom", "dspuom"
    )
    for column in ("abccod", "stkuom", "dspuom"):
        master = decode.decode_wms_code(master, column, codes)
    return master


# --- streams: each reads the landed files as a stream, runs to their end and shows its table ----


def _stream(written: DataFrame) -> DataFrame:
    folder = written.inputFiles()[0].rsplit("/", 1)[0]
    return event_streams.read_event_stream(written.sparkSession, folder)


@query
def stream_event_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Inputs(spark, sf_dir).landed("raw_events")
    target, state = shared_dir(spark, "stream-events"), shared_dir(spark, "stream-state")
    event_streams.stream_event_upsert(_stream(raw), target, state).awaitTermination()
    return tables.read_upserted(spark, target)


@query
def stream_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = Inputs(spark, sf_dir).spine()
    target, state = shared_dir(spark, "stream-bursts"), shared_dir(spark, "stream-state")
    event_streams.stream_bursts(_stream(spine), target, state, TRIAL).awaitTermination()
    return event_streams.current_bursts(spark, target, TRIAL)


@query
def stream_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = Inputs(spark, sf_dir).spine()
    target, state = shared_dir(spark, "stream-demand"), shared_dir(spark, "stream-state")
    event_streams.stream_daily_demand(_stream(spine), target, state, TRIAL).awaitTermination()
    return event_streams.current_demand(spark, target, TRIAL)
