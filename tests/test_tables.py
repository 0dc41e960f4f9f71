import json
import os
import time
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bindings import frames
from orderloom.operators import checks, decode, tables
from orderloom.params import Params
from orderloom.plans import cycles, demand, events, quality, staging
from orderloom.session import shared_dir
from orderloom.sources import readers
from orderloom.sources.freshness import source_freshness, stored_freshness
from orderloom.streaming import event_streams


def newest():
    return [F.col("version").desc()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, *values):
    return spark.createDataFrame(values, "id long, version int, name string")


def upsert(spark, path, *values, **more):
    tables.upsert_table(
        batch(spark, *values), path, "id", newest(), tables.id_block("id", 10), **more
    )


def read(spark, path):
    return rows(tables.read_upserted(spark, path).select("id", "version", "name"))


def test_upsert_is_idempotent_and_splits_freely(spark):
    first, second = [(1, 1, "a"), (12, 1, "b")], [(1, 2, "c"), (13, 1, "d"), (1, 3, "e")]
    split, once = shared_dir(spark, "split"), shared_dir(spark, "once")
    upsert(spark, split, *first)
    upsert(spark, split, *second)
    expected = [(1, 3, "e"), (12, 1, "b"), (13, 1, "d")]
    assert read(spark, split) == expected
    upsert(spark, split, *second)
    assert read(spark, split) == expected
    upsert(spark, once, *first, *second)
    assert read(spark, once) == expected


def test_upsert_replaces_even_by_an_older_version_unless_told_otherwise(spark):
    for keep, expected in ((False, [(1, 1, "old")]), (True, [(1, 2, "new")])):
        path = shared_dir(spark, "keep")
        upsert(spark, path, (1, 2, "new"))
        upsert(spark, path, (1, 1, "old"), keep_latest=keep)
        assert read(spark, path) == expected


def test_upsert_leaves_other_blocks_alone(spark):
    path = shared_dir(spark, "blocks")
    upsert(spark, path, (1, 1, "a"), (99, 1, "z"))

    def files():
        return set(tables.read_upserted(spark, path).inputFiles())

    before = {f for f in files() if "_block=9" in f}
    upsert(spark, path, (2, 1, "b"))
    assert before and before <= files()


def test_upsert_appends_new_columns(spark):
    path = shared_dir(spark, "columns")
    upsert(spark, path, (1, 1, "a"), (50, 1, "x"))
    wider = batch(spark, (2, 1, "b")).withColumn("extra", F.lit("new"))
    tables.upsert_table(wider, path, "id", newest(), tables.id_block("id", 10))
    out = tables.read_upserted(spark, path)
    assert rows(out.select("id", "extra").fillna("-")) == [(1, "-"), (2, "new"), (50, "-")]


def test_trailing_window_and_empty_target(spark):
    day = lambda n: datetime(2024, 1, n)
    source = spark.createDataFrame([(day(n),) for n in range(1, 11)], "at timestamp")
    target = source.filter(F.col("at") <= F.lit(day(8)))
    got = tables.trailing_window(source, target, "at", "at", 3)
    assert rows(got) == [(day(n),) for n in range(5, 11)]
    assert tables.trailing_window(source, target.limit(0), "at", "at").count() == 10


def test_incremental_refresh_equals_full_rebuild(spark, models):
    fact = events.fct_events(models.spine())
    latest = [F.col("event_at_utc").desc()]
    block = tables.id_block("entity_id", 100)
    path = shared_dir(spark, "fct-events")
    half = fact.filter("entity_id < 500")
    tables.upsert_table(half, path, "entity_id", latest, block)
    late = tables.trailing_window(
        fact, tables.read_upserted(spark, path), "event_at_utc", "event_at_utc"
    )
    tables.upsert_table(late, path, "entity_id", latest, block)
    got = tables.read_upserted(spark, path)
    assert rows(got.select("entity_id")) == rows(fact.select("entity_id"))


def test_envelope_files_are_unnested_and_flattened(spark, tmp_path):
    event = {c: "" for c in readers.EVENT_COLUMNS}
    old = {**event, "entity_id": 1, "response": "old", "updated_at": "2024-01-01 00:00:00"}
    new = {**old, "response": "a:1, b", "updated_at": "2024-01-02 00:00:00"}
    other = {**old, "entity_id": 2, "response": None}
    folder = tmp_path / "api" / "page"
    folder.mkdir(parents=True)
    for i, page in enumerate(([old, other], [new], [])):
        body = {"code": 200, "msg": "ok", "data": {"current_page": i, "data": page, "total": 3}}
        (folder / f"{i}.json").write_text(json.dumps(body, indent=1))
    read_back = readers.read_event_envelope(spark, str(tmp_path / "api"))
    assert read_back.columns == readers.EVENT_COLUMNS and read_back.count() == 3
    for _ in range(2):
        readers.flatten_to_parquet(spark, str(tmp_path / "api"), str(tmp_path / "flat"))
    flat = spark.read.parquet(str(tmp_path / "flat"))
    assert rows(flat.select("entity_id", F.coalesce("response", F.lit("-")))) == [
        (1, "a:1, b"),
        (2, "-"),
    ]


def test_seed_keeps_zeros_quotes_and_commas(spark, tmp_path):
    (tmp_path / "seed_warn_event_codes.csv").write_text(
        'description_code,log_level,notes\n02010200,WARN,"a ""b"", c"\n'
    )
    row = readers.read_seed(spark, str(tmp_path), "warn_event_codes").first()
    assert tuple(row) == ("02010200", "WARN", 'a "b", c')


def test_freshness_limits(spark):
    now = datetime(2024, 1, 10)
    loaded = lambda hours: spark.createDataFrame(
        [(now - timedelta(hours=hours),)], "created_at timestamp"
    )
    status = lambda hours: source_freshness(
        {"system_event_log": loaded(hours)}, Params(as_of=now)
    ).first()["status"]
    assert [status(h) for h in (24, 25, 72, 73)] == ["pass", "warn", "warn", "error"]
    none = source_freshness({"system_event_log": loaded(1).limit(0)}, Params(as_of=now))
    assert none.first()["status"] == "error"


def test_checks_treat_nulls_as_declared(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, "z")], "k int, v string")
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert rows(checks.unique_combination(df, ["k", "v"])) == [(None, "a", 2)]
    assert checks.not_null(df, "k").count() == 2
    assert rows(checks.accepted_values(df, "v", ["a"])) == [("z", 1)]
    parent = spark.createDataFrame([("a",)], "p string")
    assert rows(checks.relationships(df, "v", parent, "p")) == [("z", 1)]


def test_failures_are_stored_per_check(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    found = [checks.Check("unique_k", checks.unique(df, "k"), "warn")]
    stored = checks.store_failures(found, str(tmp_path / "failures"))
    assert rows(stored.where("check_name = 'unique_k'").select("n")) == [(1,)]
    assert rows(checks.check_summary(found)) == [("unique_k", "warn", 1, "warn")]


def test_models_hold_their_declared_checks(models):
    outputs = {
        "fct_order_cycles": models.order_cycles(),
        "item_demand_daily": models.demand_daily(),
        "item_demand_supply": models.mart(),
        "items": models.items(),
    }
    summary = checks.check_summary(quality.declared_checks(outputs)).collect()
    assert len(summary) > 10 and {r.status for r in summary} == {"pass"}


def _shuffle_files(spark):
    """Shuffle files on the disk of a local session; they are dropped a moment after their query."""
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.name for d in store.localDirsString() for f in Path(d).rglob("shuffle_*")}


def _left(spark, before):
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def _keyed_checks(spark, tmp_path):
    found = []
    for name in ("a", "b", "c"):
        path = str(tmp_path / name)
        spark.range(40).select((F.col("id") % 30).alias("k"), F.lit(name).alias("v")).write.parquet(path)
        found.append(checks.unique_check(f"unique_{name}", spark.read.parquet(path), "k"))
    return found


def _writes(folder):
    """The jobs that wrote a folder's files: part-00000-<job>-c000.snappy.parquet."""
    return {f.name.split("-", 2)[2][:36] for f in Path(folder).rglob("part-*.parquet")}


def test_checks_in_turn_hold_the_keys_of_one_table_at_a_time(spark, tmp_path):
    found = _keyed_checks(spark, tmp_path)
    before = _shuffle_files(spark)
    summary = checks.check_summary(found, in_turn=True)
    assert _left(spark, before) == set()
    written = summary.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert len(_writes(written)) == 3
    assert rows(summary) == rows(checks.check_summary(found))


def test_failures_are_stored_in_turn_and_leave_no_shuffle_files(spark, tmp_path):
    found = _keyed_checks(spark, tmp_path)
    before, setting = _shuffle_files(spark), spark.conf.get(tables._DROP_SHUFFLES, None)
    stored = checks.store_failures(found, str(tmp_path / "failures"))
    assert _left(spark, before) == set()
    assert spark.conf.get(tables._DROP_SHUFFLES, None) == setting
    assert len(_writes(tmp_path / "failures")) == 3
    assert rows(stored.select(*checks.failures(found).columns)) == rows(checks.failures(found))
    assert stored.groupBy("check_name").count().count() == 3


def test_a_table_of_several_parts_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (None,)], "k int")
    conditions = {"no_k": F.col("k").isNull()}
    written = tables.rebuild([df, df, df.where("k = 7")], path, counted=conditions)
    assert Counter(r.k for r in written.collect()) == {1: 2, None: 2}
    assert tables.counts(spark, path) == {"no_k": 2}
    broken = df.select(F.raise_error(F.lit("broken")).cast("int").alias("k"))
    with pytest.raises(Exception, match="broken"):
        tables.rebuild([df, broken], path)
    assert tables.read_table(spark, path).count() == 4
    assert len([f for f in (Path(path) / "data").iterdir() if not f.name.startswith(".")]) == 1


def test_parent_checks_of_warehouse_tables(spark):
    lines = spark.createDataFrame([("l1", "s1"), ("l2", "s9")], "ship_line_id string, ship_id string")
    ships = spark.createDataFrame([("s1",)], "ship_id string")
    found = quality.declared_checks({"wms_shipment_line": lines, "wms_shipment": ships})
    failed = {r.check_name: (r.failures, r.status) for r in checks.check_summary(found).collect()}
    assert failed["relationships_wms_shipment_line_ship_id"] == (1, "warn")
    assert failed["unique_wms_shipment_line_ship_line_id"] == (0, "pass")


def test_checks_of_keys_rows_and_parents_share_passes(spark, tmp_path):
    def table(name, schema, values):
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    parents = table("parents", "p string, v int", [("a", 1), ("a", None), ("b", 1), (None, 1), (None, 1)])
    lines = [("a", 1), ("x", 1), ("x", None), (None, 2), (None, 2)]
    children = table("children", "c string, k int", lines)
    numbers = table("numbers", "n long", [(1,), (1,), (7,)])
    shared = [
        checks.unique_check("unique_p", parents, "p"),
        checks.not_null_check("not_null_p", parents, "p"),
        checks.not_null_check("not_null_v", parents, "v"),
        checks.relationships_check("parent_c", children, "c", parents, "p", "warn"),
        checks.unique_combination_check("unique_ck", children, ["c", "k"]),
        checks.not_null_check("not_null_k", children, "k"),
        checks.unique_check("unique_n", numbers, "n"),
        # of another type than the parent's key
        checks.relationships_check("parent_n", numbers, "n", children, "k"),
    ]
    alone = [
        checks.Check(c.name, c.violations, c.severity, per_value=c.per_value) for c in shared
    ]
    summary = checks.check_summary(shared)
    assert rows(summary) == rows(checks.check_summary(alone))
    assert {(r.check_name, r.failures) for r in summary.collect()} == {
        ("unique_p", 1), ("not_null_p", 2), ("not_null_v", 1), ("parent_c", 2), ("unique_ck", 1),
        ("not_null_k", 1), ("unique_n", 1), ("parent_n", 1),
    }
    assert rows(checks.failures(shared)) == rows(checks.failures(alone))

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan")

    # parents once; children for their key, parent_c and parent_n; numbers for their key and parent_n
    assert scans(checks.check_summary(shared)) == 6
    assert scans(checks.failures([shared[0], shared[3]])) == 2
    none = checks.check_summary([checks.unique_check("u", parents.where("false"), "p")])
    assert rows(none) == [("u", "error", 0, "pass")]


def test_every_warehouse_table_is_staged_as_landed(spark):
    from orderloom.sources.schemas import WMS

    for table, spec in WMS.items():
        columns = [*spec.columns, "another"]
        raw = spark.createDataFrame([tuple(" x " for _ in columns)], [*columns])
        row = staging.stage_wms(table, raw).first()
        assert list(row.asDict()) == columns
        assert all(row[c] == ("x" if c in spec.trimmed else " x ") for c in columns)
        with pytest.raises(ValueError):
            staging.stage_wms(table, raw.drop(spec.grain[0]))


def test_category_codes_follow_their_order_of_lookup(spark):
    codes = frames.seeds(spark)["app_category_codes"]
    sites = spark.createDataFrame(
        [("6", "Six"), ("100", "Site hundred"), ("45", "Noodles")],
        "category_id string, category_name string",
    )
    views = spark.createDataFrame([(c,) for c in ("100", "-3", "45", "?", None)], "c string")
    out = decode.decode_app_category(views, "c", codes, sites)
    assert {r.c: (r.decoded_by, r.category_id, r.category_name, r.is_product_category) for r in out.collect()} == {
        "100": ("app_code", "6", "Six", True),
        "-3": ("app_code", None, "Promo", False),
        "45": ("category", "45", "Noodles", True),
        "?": ("unknown", None, None, False),
        None: ("unknown", None, None, False),
    }


def test_code_domains():
    names = ("fr_arecod", "to_arecod", "stkuom", "pck_uom", "abccod")
    assert [decode.code_domain(n) for n in names] == ["arecod", "arecod", "uomcod", "uomcod", "abccod"]


# --- streams --------------------------------------------------------------------------------------


def raw_folder(spark, models, files=4):
    path = shared_dir(spark, "raw-stream")
    models.source("raw_events").repartition(files).write.parquet(path)
    return path


def test_streamed_upsert_equals_batch_staging(spark, models):
    stream = event_streams.read_event_stream(spark, raw_folder(spark, models), files_per_batch=1)
    target = shared_dir(spark, "events")
    event_streams.stream_event_upsert(stream, target, shared_dir(spark, "cp")).awaitTermination()
    columns = ["entity_id", "updated_at", "username"]
    got = tables.read_upserted(spark, target).select(*columns)
    assert rows(got) == rows(models.staged().select(*columns))


def test_streamed_bursts_equal_batch_sessions(spark, models):
    path = shared_dir(spark, "spine-stream")
    models.spine().repartition(3).write.parquet(path)
    stream = event_streams.read_event_stream(spark, path)
    target = shared_dir(spark, "bursts")
    params = frames.TRIAL
    event_streams.stream_bursts(stream, target, shared_dir(spark, "cp"), params).awaitTermination()
    batch_ = event_streams.session_bursts(cycles.cycle_events(models.spine(), params), params)
    got = event_streams.current_bursts(spark, target, params)
    assert rows(got) == rows(batch_) and got.count() > 0


def test_sessions_are_the_bursts_of_the_cycle_model(models):
    """Sessions and bursts differ only where a gap is within a minute of the limit."""
    params = frames.TRIAL
    numbered = cycles.number_cycles(cycles.cycle_events(models.spine(), params), params)
    elapsed = F.unix_micros("event_at_utc") - F.unix_micros("previous_at")
    gap = params.cycle_gap_minutes * 60_000_000
    borderline = numbered.filter((elapsed > gap - 60_000_000) & (elapsed < gap)).filter(
        F.col("starts_burst")
    )
    bursts = numbered.filter("starts_burst").count()
    behaviour = cycles.cycle_events(models.spine(), params)
    assert event_streams.session_bursts(behaviour, params).count() == (
        bursts - borderline.count()
    )


def test_streamed_demand_equals_batch_demand(spark, models):
    path = shared_dir(spark, "spine-stream")
    models.spine().repartitionByRange(3, "event_at_utc").sortWithinPartitions(
        "event_at_utc"
    ).write.parquet(path)
    stream = event_streams.read_event_stream(spark, path)
    target = shared_dir(spark, "demand")
    params = frames.TRIAL
    event_streams.stream_daily_demand(
        stream, target, shared_dir(spark, "cp"), params
    ).awaitTermination()
    batch_ = demand.item_demand_daily(models.spine(), params)
    assert rows(event_streams.current_demand(spark, target, params)) == rows(batch_)


def test_an_upsert_reads_and_rewrites_only_touched_blocks(spark, tmp_path, monkeypatch):
    key = F.col("id")
    load = spark.range(1000).withColumn("v", F.lit(0)).withColumn("at", F.current_timestamp())
    path = str(tmp_path / "table")
    block = F.floor(key / 100).cast("int")
    tables.upsert_table(load, path, "id", [F.col("at").desc()], block)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("part-*.parquet")}
    batch = load.filter("id = 250").withColumn("v", F.lit(1))
    folders, asked = [], []
    made, read_ = tables.shared_dir, tables.read_table
    monkeypatch.setattr(
        tables, "shared_dir", lambda *a: folders.append(made(*a)) or folders[-1]
    )
    monkeypatch.setattr(tables, "read_table", lambda *a: asked.append(a[2:]) or read_(*a))
    tables.upsert_table(batch, path, "id", [F.col("at").desc()], block)
    monkeypatch.undo()
    assert [[f["block"] for f in x[0]] for x in asked] == [[2]]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("part-*.parquet")}
    assert before.items() <= after.items()
    new = after.keys() - before.keys()
    assert new and all(f"{tables.BLOCK}=2/" in str(p) for p in new)
    now = tables.read_upserted(spark, path)
    assert now.count() == 1000 and [r.id for r in now.filter("v = 1").collect()] == [250]
    assert len(folders) == 1 and not any(os.path.exists(f) for f in folders)


# --- versions -------------------------------------------------------------------------------------


def test_a_write_that_fails_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(spark, path, (1, 1, "a"), (12, 1, "b"))
    kept = read(spark, path)
    data = lambda: sorted(os.listdir(tmp_path / "t" / "data"))
    before = data()
    publish = tables.publish

    def broken(*_, **__):
        raise OSError("the last step fails")

    monkeypatch.setattr(tables, "publish", broken)
    with pytest.raises(OSError):
        upsert(spark, path, (1, 2, "new"), (30, 1, "c"))
    with pytest.raises(OSError):
        tables.rebuild(batch(spark, (7, 7, "x")), path)
    assert read(spark, path) == kept and data() == before
    monkeypatch.setattr(tables, "publish", publish)
    upsert(spark, path, (1, 2, "new"))
    assert read(spark, path) == [(1, 2, "new"), (12, 1, "b")]


def test_a_task_that_fails_leaves_the_table_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, (1, 1, "a"), (12, 1, "b"))
    bad = batch(spark, (2, 1, "c")).withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    for write in (
        lambda: tables.rebuild(bad, path),
        lambda: tables.upsert_table(bad, path, "id", newest(), tables.id_block("id", 10)),
    ):
        with pytest.raises(Exception, match="no"):
            write()
        assert read(spark, path) == [(1, 1, "a"), (12, 1, "b")]


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    opened = tables.rebuild(batch(spark, (1, 1, "a")), path)
    tables.rebuild(batch(spark, (2, 1, "b"), (3, 1, "c")), path)
    upsert(spark, path, (4, 1, "d"))
    assert rows(opened) == [(1, 1, "a")]
    assert read(spark, path) == [(2, 1, "b"), (3, 1, "c"), (4, 1, "d")]


def test_old_versions_and_their_folders_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(tables.KEPT_VERSIONS + 3):
        upsert(spark, path, (1, i, "a"))
    assert len(tables._versions(spark, path)) == tables.KEPT_VERSIONS
    folders = list((tmp_path / "t" / "data").glob(f"*/{tables.BLOCK}=*"))
    assert len(folders) == tables.KEPT_VERSIONS


def test_of_two_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, (1, 1, "a"))
    begun = tables.manifest(spark, path)
    upsert(spark, path, (2, 1, "b"))
    late = batch(spark, (3, 1, "c")).withColumn(tables.BLOCK, F.lit(0))
    with pytest.raises(tables.ConcurrentWrite):
        tables.replace_blocks(spark, path, begun, [], late)
    assert read(spark, path) == [(1, 1, "a"), (2, 1, "b")]


def test_high_water_comes_from_the_manifest(spark, tmp_path):
    day = lambda n: datetime(2024, 1, n, 12)
    at = spark.createDataFrame([(n, day(n)) for n in range(1, 11)], "id long, at timestamp")
    path = str(tmp_path / "t")
    tables.upsert_table(at, path, "id", [F.col("at").desc()], tables.id_block("id", 4))
    known = tables.high_water(spark, path, "at")
    assert known == int(at.agg(F.max(F.unix_micros("at"))).first()[0])
    late = tables.since(at, known, "at", 3)
    assert rows(late) == rows(tables.trailing_window(at, at, "at", "at", 3)) != []
    plan = tables.since(tables.read_table(spark, path), known, "at")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(at), GreaterThanOrEqual(at" in text
    assert tables.high_water(spark, str(tmp_path / "none"), "at") is None
    assert tables.since(at, None, "at").count() == 10


def test_appended_rows_are_folded_together(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(7):
        more = spark.createDataFrame([(i,)], "id long").withColumn(tables.BLOCK, F.lit(0))
        tables.append_rows(spark, path, more, most=3)
    assert rows(tables.read_table(spark, path)) == [(i,) for i in range(7)]
    assert len(tables.manifest(spark, path)["folders"]) <= 3


def test_freshness_of_stored_tables(spark, tmp_path):
    now = datetime(2024, 1, 10)
    for hours, status in ((24, "pass"), (73, "error")):
        path = str(tmp_path / str(hours))
        df = spark.createDataFrame([(now - timedelta(hours=hours),)], "created_at timestamp")
        tables.rebuild(df, path)
        stored = stored_freshness(spark, {"system_event_log": path}, Params(as_of=now))
        assert rows(stored) == rows(source_freshness({"system_event_log": df}, Params(as_of=now)))
        assert stored.first()["status"] == status


def test_row_checks_are_counted_by_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(None, "x"), (2, None), (None, None)], "k int, v string")
    conditions = {"no_k": F.col("k").isNull(), "no_v": F.col("v").isNull()}
    stored = tables.rebuild(df, path, counted=conditions)
    known = tables.counts(spark, path)
    assert known == {"no_k": 2, "no_v": 2}
    found = [checks.row_check(n, stored, c) for n, c in conditions.items()]
    summary = checks.check_summary(found, known)
    assert "FileScan" not in summary._jdf.queryExecution().executedPlan().toString()
    assert rows(summary) == rows(checks.check_summary(found))


# --- streams with state ---------------------------------------------------------------------------

EVENTS = "entity_id long, customer_key string, event_at_utc timestamp"


def burst_batches(spark, folder, batches):
    for i, events in enumerate(batches):
        rows_ = [(n, c, datetime(2024, 1, 1) + timedelta(minutes=m)) for n, c, m in events]
        spark.createDataFrame(rows_, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")


def expected_bursts(spark, events):
    rows_ = [(n, c, datetime(2024, 1, 1) + timedelta(minutes=m)) for n, c, m in events]
    return rows(event_streams.session_bursts(spark.createDataFrame(rows_, EVENTS), Params()))


BATCHES = [
    [(1, "A", 0), (2, "A", 30), (3, "B", 5), (4, "A", 200)],
    [(5, "A", 115), (2, "A", 30), (6, "C", 40_000)],  # out of order; 2 comes again
    [(7, "A", 60), (8, "A", 175), (9, "B", 65), (10, "B", 126)],  # 7 and 8 join bursts; 60 minutes exactly
    [(11, "C", 39_945), (12, "C", 39_000)],
]


def test_sessions_after_each_batch_are_those_of_the_events_so_far(spark, tmp_path):
    target, seen = str(tmp_path / "bursts"), {}
    for n, events in enumerate(BATCHES):
        fresh = [e for e in events if e[0] not in seen]
        seen |= {e[0]: e for e in events}
        rows_ = [(i, c, datetime(2024, 1, 1) + timedelta(minutes=m)) for i, c, m in fresh]
        df = spark.createDataFrame(rows_, EVENTS)
        for _ in range(2):  # a batch that runs again changes nothing
            event_streams.merge_sessions(df, target, 60, ("stream", n))
        now = event_streams.current_bursts(spark, target)
        assert rows(now) == expected_bursts(spark, seen.values())


def test_a_merge_leaves_far_weeks_alone(spark, tmp_path):
    target = str(tmp_path / "bursts")
    week = 7 * 24 * 60
    first = [(i, "A", i * week) for i in range(5)]
    merge = lambda events, n: event_streams.merge_sessions(
        spark.createDataFrame(
            [(i, c, datetime(2024, 1, 1) + timedelta(minutes=m)) for i, c, m in events], EVENTS
        ), target, 60, ("s", n),
    )
    merge(first, 0)
    before = {f["folder"] for f in tables.manifest(spark, target)["folders"]}
    merge([(9, "A", 2 * week + 30)], 1)
    after = {f["folder"] for f in tables.manifest(spark, target)["folders"]}
    assert len(before & after) == 4 and len(after) == 5


def test_a_burst_stream_that_stops_and_starts_ends_at_the_batch_result(spark, tmp_path, monkeypatch):
    source, target, state = (str(tmp_path / x) for x in ("in", "bursts", "state"))
    monkeypatch.setattr(event_streams, "cycle_events", lambda e, p: e)
    reader = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    seen, replace = {}, event_streams.replace_blocks
    for n, events in enumerate(BATCHES):
        burst_batches(spark, source, BATCHES[: n + 1][n:]) if n == 0 else spark.createDataFrame(
            [(i, c, datetime(2024, 1, 1) + timedelta(minutes=m)) for i, c, m in events], EVENTS
        ).coalesce(1).write.parquet(f"{source}/{n}")
        if n == 2:  # dies after its version is published, before the batch is recorded
            def dies(*a, **k):
                replace(*a, **k)
                raise RuntimeError("lost driver")

            monkeypatch.setattr(event_streams, "replace_blocks", dies)
            with pytest.raises(StreamingQueryException):
                event_streams.stream_bursts(reader(), target, state).awaitTermination()
            monkeypatch.setattr(event_streams, "replace_blocks", replace)
        event_streams.stream_bursts(reader(), target, state).awaitTermination()
        seen |= {e[0]: e for e in events}
        assert rows(event_streams.current_bursts(spark, target)) == expected_bursts(spark, seen.values())


def test_streamed_demand_updates_cells_batch_by_batch(spark, models, tmp_path):
    params, target = frames.TRIAL, str(tmp_path / "demand")
    source = str(tmp_path / "in")
    # spread over batches without any order, so that days and customers come back
    models.spine().repartition(3, F.pmod(F.xxhash64("entity_id"), F.lit(3))).write.parquet(source)
    stream = event_streams.read_event_stream(spark, source, files_per_batch=1)
    event_streams.stream_daily_demand(stream, target, str(tmp_path / "cp"), params).awaitTermination()
    batch_ = demand.item_demand_daily(models.spine(), params)
    got = event_streams.current_demand(spark, target, params)
    assert got.columns == batch_.columns and got.dtypes == batch_.dtypes
    assert rows(got) == rows(batch_)
    codes = tables.read_table(spark, f"{target}/customers")
    assert codes.count() == codes.select("code").distinct().count() > 0
    top = codes.agg(F.max("place")).first()[0]
    assert top * event_streams.CODE_BUCKETS < 40 * codes.count()


# --- sources --------------------------------------------------------------------------------------


def test_one_large_envelope_is_read_by_several_tasks(spark, tmp_path):
    odd = ['a "quoted" {"entity_id": 1} text', "}, {", '{"entity_id" : 5', "line\nbreak {", "{{{", "ü\\"]
    events = []
    for i in range(3000):
        event = {c: f"{c} {i}" for c in readers.EVENT_COLUMNS if c != "entity_id"}
        event["response"] = odd[i % len(odd)] if i % 3 else None
        events.append({"entity_id": i, **event} if i % 2 else {**event, "entity_id": i})
    body = {"code": 200, "msg": "{ok", "data": {"current_page": 1, "data": events, "total": 3000}}
    for name, indent in (("flat", None), ("indented", 2)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "all.json").write_text(json.dumps(body, indent=indent, ensure_ascii=indent is None))
        empty = {"code": 200, "msg": "", "data": {"current_page": 1, "data": [], "total": 0}}
        (folder / "none.json").write_text(json.dumps(empty))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        try:
            read_back = readers.read_large_envelope(spark, str(folder))
            whole = readers.read_event_envelope(spark, str(folder))
            assert Counter(map(tuple, read_back.collect())) == Counter(map(tuple, whole.collect()))
            assert read_back.rdd.getNumPartitions() > 8
            assert read_back.count() == 3000
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damaged_seed_rows_are_listed(spark, tmp_path):
    (tmp_path / "seed_codes.csv").write_text(
        'id,name\n1,"a ""b"", c"\nx,bad\n2,"two\nlines"\n3\n4,d,more\n'
    )
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    sound, rejects = readers.read_seed_checked(spark, str(tmp_path), "codes", schema)
    assert rows(sound) == [(1, 'a "b", c'), (2, "two\nlines")]
    assert sorted(r.record for r in rejects.collect()) == ["3", "4,d,more", "x,bad"]
    assert {r.file for r in rejects.collect()} == {"seed_codes.csv"}


def test_failures_of_one_source_come_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(None, "x"), (None, None), (1, "y")], "k int, v string").write.parquet(path)
    df = spark.read.parquet(path)
    found = [
        checks.not_null_check("not_null_k", df, "k"),
        checks.not_null_check("not_null_v", df, "v"),
        checks.row_check("v_is_x", df, F.col("v") != "x", "warn"),
    ]
    out = checks.failures(found)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted((r.check_name, r.severity, r.n, r.record) for r in out.collect()) == [
        ("not_null_k", "error", 1, '{"v":"x"}'),
        ("not_null_k", "error", 1, "{}"),
        ("not_null_v", "error", 1, "{}"),
        ("v_is_x", "warn", 1, '{"k":1,"v":"y"}'),
    ]


def test_a_daily_dedupe_reads_only_what_is_asked(spark, small):
    from bindings.queries import Inputs
    from orderloom.plans import supply

    stock = supply.inventory_daily(Inputs(spark, small).wms("inv_snap"))
    plan = stock.select("prtnum", "shippable_qty")._jdf.queryExecution().optimizedPlan().toString()
    assert "rcvqty" not in plan and "on_hand_qty" not in plan
