"""The given tables, read as the inputs the plans expect.

Rules are written in integer arithmetic on the tables' own columns, so that Spark and the
comparison SQL in `oracle.py` see the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.seeds import seed
from orderloom.params import Params
from orderloom.session import prepare
from orderloom.sources.readers import read_parquet_source
from orderloom.sources.schemas import WMS

TRIAL = Params(
    go_live=datetime(2024, 1, 3),
    as_of=datetime(2024, 2, 1),
)
TUNED = Params(
    go_live=TRIAL.go_live,
    as_of=TRIAL.as_of,
    cycle_gap_minutes=720,
    cycle_abandon_days=2,
    min_demand_events=3,
    trend_ratio=1.0,
    trend_min_base_views=1,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_source(prepare(spark), sf_dir, name)


def _pick(index: Column, values: list[str]) -> Column:
    """The value at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _datetime_text(at: Column, form: Column) -> Column:
    """One of the forms in which applications write a time."""
    plain = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    return (
        F.when(form == 1, _text(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), "Z"))
        .when(form == 2, _text(plain, "+08:00"))
        .when(form == 3, _text(plain, ".1234567"))
        .when(form == 4, F.date_format(at, "yyyy-M-d HH:mm:ss"))
        .when(form == 5, F.date_format(at, "yyyy-MM-dd H:mm:ss"))
        .otherwise(plain)
    )


VIEW = ["14030000", "15010000", "19010000", "10130100"]
CLICK = ["10050300", "12011600", "11010100", "18020000", "10150200"]
PURCHASE = ["04010100", "09010000", "04010200", "04050100", "09010000"]
SIGNUP = ["10050100", "10040800", "10050100", "10040100"]
ERROR = ["99990000", "BADCODE", "03110400", "05010100", "07010100", "18030000"]
CATEGORY = ["100", "8888", "-2", "6", "9991", "45", "4444", "no-such-code"]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as the raw event log; every fiftieth event comes a second time, updated."""
    return as_raw_events(table(spark, sf_dir, "events"))


def as_raw_events(events: DataFrame) -> DataFrame:
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    at = F.col("ts").cast("timestamp")
    sales = u % 3 == 0
    code = (
        F.when(kind == "view", _pick(e % 4, VIEW))
        .when(kind == "click", _pick(e % 5, CLICK))
        .when(kind == "purchase", _pick(e % 5, PURCHASE))
        .when(kind == "signup", _pick(e % 4, SIGNUP))
        .otherwise(_pick(e % 6, ERROR))
    )
    # A third of the items over the whole item range, a few beyond it, the rest popular ones.
    item = (
        F.when(e % 40 == 39, 10000 + e)
        .when(e % 3 == 0, 10000 + F.floor(e / 5))
        .otherwise(10000 + (u * 31 + e) % 50)
    ).cast("string")
    submit = _text(
        "increment_id:M",
        F.lpad(F.floor(e / 20).cast("string"), 9, "0"),
        ", ust_customer_no:C",
        u % 40,
        ", order_source:web, grand_total:",
        100 + e % 900,
        ".5, subtotal:",
        90 + e % 900,
        ", total_item_count:",
        1 + e % 9,
    )
    cart = _text(F.when(e % 17 == 0, "junk").otherwise(item), ",", 1 + e % 6, ",CAT")
    payload = (
        F.when(F.col("code").isin("04010100", "04010200"), submit)
        .when(F.col("code") == "04050100", _text("M", F.lpad(e.cast("string"), 9, "0")))
        .when(F.col("code") == "09010000", _text("C", u % 40, ",L", e))
        .when(F.col("code").isin("10050100", "10050300", "10150200"), cart)
        .when(
            F.col("code").isin("10040800", "10040100", "10130100", "14030000", "15010000"), item
        )
        .when(
            F.col("code") == "19010000",
            _text("category:", _pick(u % 8, CATEGORY), ",visits_num:2,time:15"),
        )
        .otherwise("x")
    )
    first = events.withColumn("code", code).select(
        e.alias("entity_id"),
        F.when(e % 83 == 0, "")
        .when(e % 79 == 0, "000")
        .when(sales, F.lpad((u % 7 + 1).cast("string"), 3, "0"))
        .otherwise("900")
        .alias("sales_code"),
        F.when(e % 89 == 0, "itadmin")
        .when(sales, _text("rep", u % 7))
        .otherwise(_text("C", u))
        .alias("username"),
        F.when(~sales | (e % 5 == 0), "").otherwise(_text("C", u % 40)).alias("ust_customer_no"),
        F.when(e % 4 == 0, "")
        .otherwise(_text(25 + e % 20, ",", -120 + e % 30))
        .alias("location"),
        F.when(e % 11 == 0, None).when(sales, "GMT-8").otherwise("GMT+8").alias("timezone"),
        F.when(e % 101 == 0, "")
        .when(e % 103 == 0, "garbage")
        .when(e % 3 == 0, F.unix_millis(at).cast("string"))
        .when(e % 3 == 1, F.unix_seconds(at).cast("string"))
        .otherwise(_datetime_text(at, F.floor(e / 3) % 6))
        .alias("event_time"),
        F.when(e % 193 == 0, None)
        .when(e % 97 == 0, "../../etc/passwd")
        .when(sales, _pick(u % 2, ["PDA-A", "CatalogFS-I"]))
        .otherwise(_pick(u % 2, ["Vegas-I", "Web"]))
        .alias("source"),
        F.lit("1.0").alias("version"),
        F.col("code").alias("description_code"),
        payload.alias("response"),
        F.lit("dev").alias("device_name"),
        (at - F.expr("INTERVAL 8 HOURS")).alias("created_at"),
        F.when(e % 7 == 0, "").otherwise(F.unix_millis(at).cast("string")).alias("event_id"),
    )
    # The second version is made in place: the table is read once.
    copies = F.when(F.col("entity_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return first.select("*", F.explode(copies).alias("revision")).select(
        *[c for c in first.columns if c != "event_id"],
        F.timestamp_add("HOUR", F.col("revision"), F.col("created_at")).alias("updated_at"),
        "event_id",
    )


def wms_inv_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as stock snapshots of January 2024: item numbers padded, two warehouses,
    more than one snapshot on many days."""
    part, order, line = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    day = (order + line) % 31
    step = F.when(part % 5 == 0, 1).otherwise(3)
    floor_ = F.when(part % 5 == 0, 9).when(part % 7 == 0, 0).otherwise(4)
    quantity = F.col("l_quantity").cast("bigint")
    stock = F.greatest(F.lit(0), (part * 7 + day * step) % 13 - floor_)
    midnight = F.timestamp_add("DAY", day.cast("int"), F.lit(datetime(2024, 1, 1)))
    taken = F.timestamp_add("MINUTE", (1200 + order % 200).cast("int"), midnight)
    return table(spark, sf_dir, "lineitem").select(
        _text(order, "-", line, "-", part, "-", F.col("l_suppkey")).alias("inv_snap_id"),
        F.rpad((10000 + part).cast("string"), 30, " ").alias("prtnum"),
        F.lit(" ---- ").alias("prt_client_id"),
        F.when(order % 101 == 0, None).otherwise(taken).alias("gendte"),
        quantity.alias("rcvqty"),
        (quantity % 7).alias("shpqty"),
        (quantity % 3).alias("adjqty"),
        (stock + line).cast("bigint").alias("on_hand_qty"),
        stock.cast("bigint").alias("shippable_qty"),
        (quantity % 11).alias("ordered_qty"),
        (quantity % 5).alias("planned_qty"),
        (quantity % 4).alias("pnd_rcvqty"),
        F.when(F.col("l_suppkey") % 10 == 0, "WMD1").otherwise("CABOT").alias("wh_id"),
        F.timestamp_add("HOUR", F.lit(6), taken).alias("loaddate"),
    )


def _template_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part`, once per item template; two items in three have the warehouse's own."""
    both = F.array(F.lit("----"), F.lit("CABOT"))
    return table(spark, sf_dir, "part").select(
        "*",
        F.explode(
            F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("----"))).otherwise(both)
        ).alias("template"),
    )


def wms_prtmst(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("p_partkey")
    own = F.col("template") == "CABOT"
    number = (10000 + part).cast("string")
    return _template_rows(spark, sf_dir).select(
        _text(number, " ").alias("prtnum"),
        F.lit(" ----").alias("prt_client_id"),
        F.col("template").alias("wh_id_tmpl"),
        F.col("p_type").alias("prtfam"),
        _text(" ", number).alias("dsp_prtnum"),
        _pick(F.col("p_size") % 5, ["A", "B", "C", "D", "X"]).alias("abccod"),
        F.when(own, F.col("p_brand")).otherwise("default").alias("velzon"),
        _pick(part % 3, ["EA", "CS", "PK"]).alias("stkuom"),
        F.lit("CS").alias("dspuom"),
        F.lit("A").alias("rcvsts"),
        F.lit(datetime(2024, 1, 31)).alias("loaddate"),
    )


def wms_prtdsc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item descriptions in two locales, some under a key with a byte order mark, and the
    descriptions of other things."""
    part = F.col("p_partkey")
    rows = _template_rows(spark, sf_dir).select(
        "*", F.explode(F.array(F.lit("US_ENGLISH"), F.lit("SPANISH"))).alias("locale")
    )
    key = "prtnum|prt_client_id|wh_id_tmpl"
    return rows.select(
        F.when(part % 4 == 0, "﻿" + key)
        .when(part % 23 == 0, "prtfam")
        .otherwise(key)
        .alias("colnam"),
        _text(10000 + part, " |----|", F.col("template")).alias("colval"),
        F.col("locale").alias("locale_id"),
        _text(F.col("p_name"), " ", F.col("template"), " ", F.col("locale")).alias("lngdsc"),
        F.col("p_name").alias("short_dsc"),
        F.lit(datetime(2024, 1, 30)).alias("loaddate"),
    )


# Keys that other warehouse tables refer to: one value per order, so that they repeat.
WMS_PARENT_KEYS = ("lodnum", "subnum", "wrkref", "ship_id")


def wms_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """`lineitem` as any other warehouse table: its contracted columns and a quantity."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    values = {
        "prtnum": F.rpad((10000 + F.col("l_partkey")).cast("string"), 30, " "),
        "prt_client_id": F.lit(" ---- "),
        "stcust": _text(" C", F.col("l_suppkey")),
        "wh_id": F.when(F.col("l_suppkey") % 10 == 0, "WMD1").otherwise("CABOT"),
        "uomlvl": line.cast("string"),
        "stoloc": F.when(order % 97 != 0, _text("A-", order % 500)),
        "loaddate": F.timestamp_add(
            "HOUR", (order % 24).cast("int"), F.lit(datetime(2024, 1, 29))
        ),
    }
    return table(spark, sf_dir, "lineitem").select(
        *[
            values.get(
                c, _text(f"{c}-", order) if c in WMS_PARENT_KEYS else _text(f"{c}-", order, "-", line)
            ).alias(c)
            for c in WMS[name].columns
        ],
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def admin_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`supplier` as users; many share a sales code."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("user_id"),
        F.when(s % 9 == 0, "").otherwise(_text("First", s)).alias("firstname"),
        _text(" Last", s % 13, " ").alias("lastname"),
        _text("rep", s, "@example.com").alias("email"),
        _text("rep", s).alias("username"),
        F.lit("2024-01-01 00:00:00").alias("created"),
        F.when(s % 4 == 0, " ").otherwise("2024-01-15 10:30:00").alias("modified"),
        F.lit("").alias("logdate"),
        F.when(s % 5 == 0, "many").otherwise(s.cast("string")).alias("lognum"),
        (s % 2).cast("string").alias("is_active"),
        F.lit("en_US").alias("interface_locale"),
        F.lit("1").alias("is_salesperson"),
        F.when(s % 8 == 7, "").otherwise(F.lpad((s % 8 + 1).cast("string"), 3, "0")).alias(
            "salesperson_code"
        ),
        F.lit("0").alias("convert_quotes"),
        F.lit(" 1 ").alias("receive_quote_emails"),
        F.col("s_name").alias("role_name"),
    )


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as website categories."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        p.alias("category_id"),
        F.when(p % 6 == 0, "").otherwise(F.col("p_size").cast("string")).alias("parent_id"),
        _text(" ", F.col("p_name"), " ", p % 100).alias("name"),
        _pick(p % 3, ["1", "0", ""]).alias("is_active"),
        (p % 17).cast("string").alias("position"),
        F.when(p % 19 == 0, "top").otherwise((p % 4).cast("string")).alias("level"),
        F.col("p_size").cast("string").alias("product_count"),
        F.col("p_brand").alias("meta_title"),
        F.lit("").alias("meta_keywords"),
        F.col("p_type").alias("meta_description"),
        F.lit("2023-06-01 08:00:00").alias("create_at"),
        F.when(p % 10 == 0, "").otherwise("2023-07-01 09:30:00").alias("updated_at"),
    )


def category_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as known spellings of category names."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").filter(p % 4 != 3).select(
        _text("All ", F.col("p_name"), " ", p).alias("raw_name"),
        F.when(p % 4 == 2, None).otherwise(p.cast("string")).alias("category_id"),
        _pick(p % 4, ["aggregate_view_all", "category_match", "ui_label"]).alias("alias_type"),
    )


def seeds(spark: SparkSession) -> dict[str, DataFrame]:
    prepare(spark)
    return {
        name: seed(spark, name)
        for name in (
            "app_sources",
            "system_accounts",
            "event_codes",
            "warn_event_codes",
            "app_category_codes",
            "layout_codes",
            "jdawms_code_descriptions",
        )
    }
