"""Rules that are easy to get wrong, on small hand-written frames."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from bindings.seeds import seed
from orderloom.params import Params
from orderloom.plans import cycles, demand, events, orders, reps, scorecards, staging, supply

T0 = datetime(2024, 1, 1, 9)
P = Params(go_live=datetime(2024, 1, 1), as_of=datetime(2024, 3, 1), slice_minutes=30)

_SPINE = (
    "entity_id long, customer_key string, actor_type string, sales_code string, username string, "
    "app_name string, source_code string, app_version string, event_at_utc timestamp, "
    "description_code string, l1_code string, l2_code string, l3_code string, response string, "
    "l1_category_name string, expected_payload_format string, feature_name string, "
    "page_context string, is_add boolean, is_remove boolean, is_qty_change boolean"
)
_DEFAULTS = dict(
    customer_key="C1",
    actor_type="customer",
    sales_code="900",
    username="C1",
    app_name="Web",
    source_code="Web",
    app_version="1.0",
    description_code="10050100",
    response="",
    l1_category_name=None,
    expected_payload_format=None,
    feature_name=None,
    page_context=None,
    is_add=False,
    is_remove=False,
    is_qty_change=False,
)


def spine(spark, rows):
    fields = [f.split()[0] for f in _SPINE.split(", ")]
    full = []
    for i, row in enumerate(rows):
        r = {**_DEFAULTS, "entity_id": i, **row}
        code = r["description_code"]
        r.update(l1_code=code[:2], l2_code=code[2:4], l3_code=code[4:6])
        full.append(tuple(r[f] for f in fields))
    return spark.createDataFrame(full, _SPINE)


def submit(minutes, number="M000000001", **more):
    return dict(
        event_at_utc=T0 + timedelta(minutes=minutes),
        description_code="04010100",
        response=f"increment_id:{number}, grand_total:10.5, subtotal:9, total_item_count:2",
        l1_category_name="Send Order",
        expected_payload_format="kv",
        **more,
    )


def add(minutes, sku="10001", **more):
    return dict(
        event_at_utc=T0 + timedelta(minutes=minutes),
        is_add=True,
        response=f"{sku},2,CAT",
        l1_category_name="Order Operations",
        expected_payload_format="positional",
        **more,
    )


def create(minutes, local, customer="C1", rep="rep1", **more):
    return dict(
        event_at_utc=T0 + timedelta(minutes=minutes),
        description_code="09010000",
        response=f"{customer},{local}",
        l1_category_name="Create Order",
        expected_payload_format="positional",
        actor_type="sales",
        username=rep,
        **more,
    )


def sent(minutes, number, customer="C1", rep="rep1", **more):
    return submit(minutes, number, customer_key=customer, actor_type="sales", username=rep, **more)


# --- spine ----------------------------------------------------------------------------------------


def test_events_without_sales_code_leave_the_spine(models):
    decoded, enriched = models.decoded(), models.enriched()
    assert decoded.filter("sales_code is null").count() > 0
    assert enriched.filter("sales_code is null or sales_code = '000'").count() == 0
    assert enriched.filter("username = 'itadmin'").count() == 0


def test_spine_and_quarantine_share_all_staged_events(models):
    from orderloom.plans.quality import quarantine_invalid_source

    staged = models.staged().count()
    apart = quarantine_invalid_source(models.staged(), models.seed["app_sources"]).count()
    assert models.decoded().count() + apart == staged


def test_payload_keeps_its_spaces(spark):
    raw = spark.createDataFrame(
        [(1, " x ", " p ", "2024-01-01", "2024-01-01")],
        "entity_id long, username string, response string, created_at string, updated_at string",
    )
    for column in ("sales_code ust_customer_no location timezone event_time source version "
                   "description_code device_name event_id").split():
        raw = raw.withColumn(column, F.lit(" "))
    row = staging.stage_events(raw).first()
    assert (row.username, row.response, row.source) == ("x", " p ", "")


def test_equal_versions_leave_one_row(spark, models):
    raw = models.source("raw_events")
    doubled = raw.unionAll(raw)
    assert staging.stage_events(doubled).count() == staging.stage_events(raw).count()


def test_unmapped_codes_have_no_labels(models):
    unmapped = models.enriched().filter("function_name is null")
    assert unmapped.count() > 0
    labels = ["outcome", "feature_name", "feature_group", "page_context"]
    assert unmapped.filter(" or ".join(f"{c} is not null" for c in labels)).count() == 0
    assert unmapped.filter("is_add or is_remove or is_qty_change").count() == 0


# --- orders ---------------------------------------------------------------------------------------


def test_latest_submit_of_an_order_wins(spark):
    out = orders.fct_orders(spine(spark, [submit(0), submit(5, sales_code="001"), submit(3)]))
    assert [(r.increment_id, r.sales_code, r.freight_and_adj) for r in out.collect()] == [
        ("M000000001", "001", 1.5)
    ]


def test_submit_pattern_treats_underscore_as_any_character(spark):
    row = {**submit(0), "response": "incrementXid:M1, increment_id :M2"}
    assert [r.increment_id for r in orders.fct_orders(spine(spark, [row])).collect()] == ["M2"]


# --- cycles ---------------------------------------------------------------------------------------


def brute_force_cycles(rows, p):
    """(customer, entity) -> (cycle, burst), event by event."""
    out, by_customer = {}, defaultdict(list)
    for i, r in enumerate(rows):
        by_customer[r["customer_key"]].append((r["event_at_utc"], i, r))
    for key, events_ in by_customer.items():
        cycle = burst = 0
        before = None
        for at, i, r in sorted(events_, key=lambda e: e[:2]):
            gap = None
            if before is not None:
                gap = int(at.timestamp() // 60) - int(before[0].timestamp() // 60)
            burst += gap is None or gap >= p.cycle_gap_minutes
            cycle += gap is None or before[1] or gap >= p.cycle_abandon_days * 1440
            out[key, i] = (cycle, burst)
            before = (at, "increment_id" in r["response"])
    return out


@pytest.mark.parametrize("slice_minutes", [1, 60, 1440, 600_000])
def test_numbering_does_not_depend_on_slices(spark, slice_minutes):
    random = Random(7)
    rows = []
    for _ in range(400):
        # Half of the events belong to one customer.
        customer = "C1" if random.random() < 0.5 else f"C{random.randint(2, 6)}"
        minute = random.randint(0, 60 * 24 * 30)
        make = submit if random.random() < 0.2 else add
        rows.append({**make(minute), "customer_key": customer})
    params = Params(cycle_gap_minutes=60, cycle_abandon_days=2, slice_minutes=slice_minutes)
    numbered = cycles.number_cycles(cycles.cycle_events(spine(spark, rows), params), params)
    got = {(r.customer_key, r.entity_id): (r.cycle_seq, r.burst_seq) for r in numbered.collect()}
    assert got == brute_force_cycles(rows, params)


def test_submit_closes_its_cycle_and_gap_opens_a_burst(spark):
    rows = [add(0), add(60), submit(61), submit(62), add(63)]
    out = cycles.fct_order_cycles(spine(spark, rows), P).orderBy("cycle_seq").collect()
    assert [(r.event_count, r.is_submitted, r.burst_count, r.active_minutes) for r in out] == [
        (3, True, 2, 1),
        (1, True, 1, 0),
        (1, False, 1, 0),
    ]


def test_gap_counts_minute_boundaries(spark):
    rows = [add(0), add(59)]
    rows[0]["event_at_utc"] += timedelta(seconds=59)
    rows[1]["event_at_utc"] += timedelta(seconds=59)
    late = [rows[0], {**rows[1], "event_at_utc": rows[1]["event_at_utc"] + timedelta(seconds=1)}]
    count = lambda r: cycles.fct_order_cycles(spine(spark, r), P).first().burst_count
    assert (count(rows), count(late)) == (1, 2)


def test_dominant_application_ties_go_to_the_first_name(spark):
    rows = [
        add(0, app_name="Web", source_code="Web"),
        add(1, app_name="Vegas", source_code="Vegas-I"),
        add(2, app_name="Vegas", source_code="Vegas-A"),
    ]
    out = cycles.fct_order_cycles(spine(spark, rows), P).first()
    assert (out.app_name, out.source_code) == ("Vegas", "Vegas-A")


def test_refreshed_cycles_equal_a_full_rebuild(spark, tmp_path):
    from orderloom.operators import tables

    rng = Random(7)
    rows, path = [], str(tmp_path)
    for i in range(400):
        kind = submit if rng.random() < 0.15 else add
        who = f"K{rng.randint(0, 11)}"
        rows.append(kind(rng.randint(0, 60 * 24 * 60), customer_key=who, username=who))
    events = spine(spark, rows).withColumn("n", F.col("entity_id")).orderBy("event_at_utc")
    all_ = events.collect()
    schema = events.schema
    done, window = [], timedelta(days=P.late_window_days)
    for step in range(0, 400, 80):
        fresh = all_[step : step + 80]
        held = [r for r in fresh if rng.random() < 0.3 and r.event_at_utc > fresh[-1].event_at_utc - window]
        for batch in ([r for r in fresh if r not in held], held):
            done += batch
            now = spark.createDataFrame(done, schema).drop("n")
            cycles.refresh_order_cycles(now, path, P)
            got = cycles.stored_order_cycles(spark, path, P)
            full = cycles.fct_order_cycles(now, P)
            assert got.columns == full.columns
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    before = {f["folder"] for f in tables.manifest(spark, f"{path}/cycles")["folders"]}
    cycles.refresh_order_cycles(now, path, P)
    after = {f["folder"] for f in tables.manifest(spark, f"{path}/cycles")["folders"]}
    assert before & after and after - before  # old weeks stay unread


def test_dominant_application_holds_with_many_cycles_in_a_partition(spark):
    # 300 cycles in few partitions: more groups than an object aggregate keeps before it sorts
    rows = []
    for i in range(300):
        of = dict(customer_key=f"K{i}", username=f"K{i}")
        rows += [
            add(3 * i, app_name="Vegas", source_code="Vegas-I", **of),
            add(3 * i + 1, app_name="Web", source_code="Web", **of),
            add(3 * i + 2, app_name="Web", source_code="Web", **of),
        ]
    events = spine(spark, rows).coalesce(1)
    numbered = cycles.number_cycles(cycles.cycle_events(events, P), P)
    for out in (cycles.cycle_dominant_app(numbered), cycles.fct_order_cycles(events, P)):
        assert {(r.app_name, r.source_code) for r in out.collect()} == {("Web", "Web")}
        assert out.count() == 300
    plan = cycles.fct_order_cycles(events, P)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan


def test_status_of_an_unsubmitted_cycle_depends_on_as_of(spark):
    rows = [add(0)]
    status = lambda day: (
        cycles.fct_order_cycles(spine(spark, rows), Params(as_of=day)).first().cycle_status
    )
    assert status(datetime(2024, 1, 7)) == "open"
    assert status(datetime(2024, 1, 8)) == "abandoned"


# --- representatives ------------------------------------------------------------------------------


def pairs(spark, rows):
    out = reps.rep_order_cycle(spine(spark, rows), P).collect()
    return sorted((r.increment_id, r.local_id) for r in out)


def test_losing_opens_and_closes_are_not_paired_again(spark):
    two_closes = [create(0, "L1"), sent(10, "M1"), sent(20, "M2")]
    assert pairs(spark, two_closes) == [("M1", "L1")]
    two_opens = [create(0, "L1"), create(5, "L2"), sent(10, "M1"), sent(20, "M2")]
    assert pairs(spark, two_opens) == [("M1", "L2")]


def test_only_the_earliest_unmatched_close_is_kept(spark):
    rows = [sent(30, "M3", customer="C9"), sent(10, "M1", rep="rep7"), sent(20, "M2")]
    assert pairs(spark, rows) == [("M1", None)]


def test_open_must_be_strictly_earlier(spark):
    assert pairs(spark, [create(10, "L1"), sent(10, "M1")]) == [("M1", None)]


def test_reused_local_number_pairs_with_the_first_close_only(spark):
    rows = [
        create(0, "L1", sales_code="001"),
        sent(10, "M1"),
        create(20, "L1", sales_code="002"),
        sent(30, "M2"),
    ]
    assert pairs(spark, rows) == [("M1", "L1")]


def brute_force_pairs(rows):
    opens, closes = {}, {}
    for r in rows:
        if r["l1_category_name"] == "Create Order":
            customer, local = r["response"].split(",")
            key = (r["username"], customer, local)
            opens[key] = min(opens.get(key, r["event_at_utc"]), r["event_at_utc"])
        else:
            number = r["response"].split(":")[1].split(",")[0]
            key = (r["username"], r["customer_key"], number)
            closes[key] = min(closes.get(key, r["event_at_utc"]), r["event_at_utc"])
    candidates = [
        (c, o)
        for c in closes
        for o in opens
        if c[:2] == o[:2] and opens[o] < closes[c]
    ]
    nearest, first = {}, {}
    for c, o in candidates:
        if c not in nearest or (opens[o], o) > (opens[nearest[c]], nearest[c]):
            nearest[c] = o
        if o not in first or (closes[c], c[2]) < (closes[first[o]], first[o][2]):
            first[o] = c
    kept = [(c[2], o[2]) for c, o in nearest.items() if first[o] == c]
    unmatched = sorted((closes[c], c[2]) for c in closes if c not in nearest)
    return sorted([*kept, *[(n, None) for _, n in unmatched[:1]]], key=str)


@pytest.mark.parametrize("seed_", range(3))
def test_pairs_equal_brute_force(spark, seed_):
    random = Random(seed_)
    rows = []
    for i in range(200):
        # One rep and customer hold about a third of the rows.
        rep, customer = ("rep1", "C1")
        if random.random() > 0.35:
            rep, customer = f"rep{random.randint(1, 3)}", f"C{random.randint(1, 4)}"
        minute = random.randint(0, 3000)
        if random.random() < 0.5:
            rows.append(create(minute, f"L{i:04d}", customer, rep))
        else:
            rows.append(sent(minute, f"M{i:09d}", customer, rep))
    got = reps.rep_order_cycle(spine(spark, rows), P).collect()
    assert sorted(((r.increment_id, r.local_id) for r in got), key=str) == brute_force_pairs(rows)


def test_journey_counts_equal_brute_force(spark):
    random = Random(3)
    rows = []
    for i in range(60):
        rep, customer = random.choice(["rep1", "rep1", "rep2"]), f"C{random.randint(1, 4)}"
        minute = random.randint(0, 3000)
        rows.append(create(minute, f"L{i:04d}", customer, rep))
        rows.append(sent(minute + random.randint(0, 400), f"M{i:09d}", customer, rep))
    for _ in range(300):
        rep = random.choice(["rep1", "rep1", "rep2"])
        rows.append(add(random.randint(0, 3400), actor_type="sales", username=rep))
    frame = spine(spark, rows)
    found = reps.rep_order_cycle(frame, P).filter("opened_at is not null").collect()
    journeys = reps.rep_order_journey(frame, reps.rep_order_cycle(frame, P), P).collect()
    expected = Counter(
        {
            (c.increment_id, c.local_id): sum(
                r["is_add"] and r["username"] == c.username
                and c.opened_at <= r["event_at_utc"] <= c.submitted_at
                for r in ({**_DEFAULTS, **x} for x in rows)
            )
            for c in found
        }
    )
    # Adds use code 10050100, whose second part is the add family.
    assert {(j.increment_id, j.local_id): j.add_count for j in journeys} == dict(expected)


# --- demand and scorecards ------------------------------------------------------------------------


def test_sku_is_read_by_payload_format(spark):
    rows = [
        add(0, "54309"),
        dict(
            event_at_utc=T0,
            is_remove=True,
            description_code="10040100",
            response=" 54309 ",
            expected_payload_format="sku",
        ),
        add(1, "junk"),
        add(2, "123456789"),
        dict(
            event_at_utc=T0,
            is_add=True,
            response="54309,1",
            expected_payload_format="title",
        ),
    ]
    out = demand.item_demand_daily(spine(spark, rows), P).collect()
    assert [(r.sku, r.cart_adds, r.cart_removes, r.cart_add_qty) for r in out] == [
        ("54309", 1, 1, 2)
    ]


def test_demand_is_clamped_to_go_live_and_now(spark):
    rows = [add(-60 * 24), add(0), add(60 * 24 * 365)]
    out = demand.item_demand_daily(spine(spark, rows), P).collect()
    assert sum(r.cart_adds for r in out) == 1


def test_customers_are_counted_exactly(spark):
    rows = [add(i, customer_key=f"C{i % 3}", actor_type=("sales", "customer")[i % 2]) for i in range(5)]
    rows.append(add(6, customer_key=None))
    row = demand.item_demand_daily(spine(spark, rows), P).first()
    assert (row.distinct_customers, row.distinct_self_customers) == (3, 2)


def inventory(spark, rows):
    columns = "prtnum string, prt_client_id string, wh_id string, gendte timestamp, inv_snap_id string"
    frame = spark.createDataFrame([(r[0], "----", "CABOT", r[1], str(i)) for i, r in enumerate(rows)], columns)
    stock = F.create_map(*[F.lit(v) for i, r in enumerate(rows) for v in (str(i), r[2])])
    frame = frame.withColumn("shippable_qty", stock[F.col("inv_snap_id")].cast("bigint"))
    for q in "on_hand_qty ordered_qty planned_qty pnd_rcvqty rcvqty shpqty adjqty".split():
        frame = frame.withColumn(q, F.lit(1).cast("bigint"))
    return supply.inventory_daily(frame)


def master(spark, *numbers):
    return spark.createDataFrame(
        [(n, "----", "n", "f", "A", "a", "v") for n in numbers],
        "prtnum string, prt_client_id string, item_name string, item_family string, "
        "abc_class string, abc_class_description string, velocity_zone string",
    )


def test_weeks_before_the_first_demand_do_not_dilute_the_baseline(spark):
    week = 60 * 24 * 7
    stock = [("10001", T0 + timedelta(minutes=w * week + h), 5) for w in range(-3, 3) for h in (0, 60)]
    rows = [add(0), add(week), add(week + 1)]
    out = (
        demand.item_demand_supply(
            spine(spark, rows), inventory(spark, stock), master(spark, "10001"), P
        )
        .orderBy("week_start")
        .collect()
    )
    assert [(r.cart_adds, r.snapshot_days, r.views_prior_4wk_avg) for r in out] == [
        (1, 1, None),
        (2, 1, 0.0),
        (0, 1, 0.0),
    ]
    assert [r.is_trending_interest for r in out] == [None, False, False]
    assert out[2].signal == "promote_candidate"


def test_demand_on_an_empty_shelf_is_a_missed_opportunity(spark):
    rows = [add(i) for i in range(10)]
    stock = [("10001", T0, 0), ("10001", T0 + timedelta(days=1), 9)]
    row = demand.item_demand_supply(
        spine(spark, rows), inventory(spark, stock), master(spark, "10001"), P
    ).first()
    assert (row.cart_adds_while_oos, row.days_out_of_stock, row.shippable_eow, row.signal) == (
        10,
        1,
        9,
        "missed_opportunity",
    )


def test_feature_pairs_need_the_same_day(spark):
    use = lambda m, f, c="C1": dict(event_at_utc=T0 + timedelta(minutes=m), feature_name=f, customer_key=c)
    rows = [
        use(0, "search"),
        use(1, "filter"),
        use(60 * 24, "search"),
        use(0, "filter", "C2"),
        use(2, "search", "C2"),
        use(2, "icon_click", "C3"),
        use(60 * 24 * 7, "search"),
    ]
    out = scorecards.feature_pairing(spine(spark, rows)).collect()
    got = {
        (str(r.week_start), r.feature_a, r.feature_b): (
            r.co_occurrence_days,
            r.customers_count,
            r.wow_change,
        )
        for r in out
    }
    assert got == {
        ("2024-01-01", "filter", "search"): (2, 2, None),
        ("2024-01-01", "filter", "filter"): (2, 2, None),
        ("2024-01-01", "search", "search"): (3, 2, None),
        ("2024-01-01", "icon_click", "icon_click"): (1, 1, None),
        ("2024-01-08", "search", "search"): (1, 1, -2),
    }


def test_churn_needs_three_observed_weeks(spark):
    week = 60 * 24 * 7
    gone = lambda w: dict(
        event_at_utc=T0 + timedelta(minutes=w * week), is_remove=True, description_code="10040100"
    )
    frame = spine(spark, [gone(0), gone(2), gone(5)])
    out = scorecards.customer_weekly(
        frame, cycles.fct_order_cycles(frame, P), orders.fct_orders(frame), P
    ).orderBy("week_start")
    assert [r.churn_signal for r in out.collect()] == [False, False, True]


def test_items_prefer_the_warehouse_template(spark):
    prtmst = spark.createDataFrame(
        [("1", "c", "----", "A"), ("1", "c", "CABOT", "B"), ("2", "c", "----", "Z")],
        "prtnum string, prt_client_id string, wh_id_tmpl string, abccod string",
    )
    for column in "dsp_prtnum prtfam velzon stkuom dspuom rcvsts".split():
        prtmst = prtmst.withColumn(column, F.lit("x"))
    key = "prtnum|prt_client_id|wh_id_tmpl"
    prtdsc = spark.createDataFrame(
        [
            (key, "1|c|----", "US_ENGLISH", "plain", "p"),
            ("﻿" + key, "1 |c|CABOT", "US_ENGLISH", "padded", "q"),
            (key, "2|c|----", "SPANISH", "dos", "d"),
        ],
        "colnam string, colval string, locale_id string, lngdsc string, short_dsc string",
    )
    codes = seed(spark, "jdawms_code_descriptions")
    out = supply.items(prtmst, prtdsc, codes).collect()
    got = sorted((r.prtnum, r.abc_class, r.item_name, r.abc_class_description) for r in out if r.prtnum == "2")
    assert got == [("2", "Z", None, None)]
    # Padded key variants are ranked apart, so both names of item 1 come through.
    assert sorted(r.item_name for r in out if r.prtnum == "1") == ["padded", "plain"]


# --- plans ----------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_before_the_shuffle(models):
    plan = plan_of(models.staged())
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_cross_products_in_any_model(models):
    frames = [models.order_cycles(), models.rep_cycles(), models.mart(), models.enriched()]
    for frame in frames:
        assert "CartesianProduct" not in plan_of(frame)
        assert "BroadcastNestedLoopJoin" not in plan_of(frame)


def test_scan_reads_only_what_is_needed(models):
    plan = plan_of(events.fct_events(models.spine()).select("entity_id").filter("is_add"))
    assert "ReadSchema: struct<entity_id:bigint,is_add:boolean>" in plan
    assert "PushedFilters: [IsNotNull(is_add), EqualTo(is_add,true)]" in plan


def test_demand_and_stock_meet_in_one_aggregation(spark):
    d1, d2 = T0.date(), T0.date() + timedelta(days=1)
    daily = spark.createDataFrame(
        [("10", d1, 2, 1, 1, 0, 3, 2), ("10", d1, 1, 0, 1, 0, 1, 1), ("11", d1, 4, 0, 0, 0, 0, 1),
         (None, d1, 5, 0, 1, 0, 1, 1)],
        "sku string, activity_date date, item_detail_views long, image_enlarge_views long, "
        "cart_adds long, cart_removes long, cart_add_qty long, distinct_customers long",
    )
    stock = spark.createDataFrame(
        [("10", d1, 0, 1, 1, 2), ("10", d2, 6, 7, 1, None), ("12", d1, 3, 3, 0, 0), (None, d1, 0, 0, 0, 0)],
        "prtnum string, snapshot_date date, shippable_qty long, on_hand_qty long, "
        "planned_qty long, pnd_rcvqty long",
    )
    weekly = demand.demand_supply_weekly(daily, stock)
    assert "Join" not in weekly._jdf.queryExecution().optimizedPlan().toString()
    found = {
        r.prtnum: (r.item_views, r.cart_adds, r.peak_daily_customers, r.demand_active_days,
                   r.avg_shippable_qty, r.snapshot_days, r.inbound_qty_peak, r.shippable_eow,
                   r.cart_adds_while_oos, r.views_while_oos)
        for r in weekly.collect()
    }
    assert found == {
        "10": (4, 2, 2, 1, 3.0, 2, 3, 6, 2, 4),
        "11": (4, 0, 1, 1, None, 0, None, None, 0, 0),
        "12": (0, 0, 0, 0, 3.0, 1, 0, 3, 0, 0),
        # demand and stock without an item are not of the same one
        None: (5, 1, 1, 1, 0.0, 1, 0, 0, 0, 0),
    }
    overlap = demand.oos_overlap(daily, stock).collect()
    assert [(r.prtnum, r.cart_adds_while_oos, r.views_while_oos) for r in overlap] == [("10", 2, 4)]
