"""Comparison SQL for DuckDB over the same tables.

Each named step is one SELECT over the given tables or earlier steps; `oracle(step)` chains the
steps it needs. Nothing here is used by the library.
"""

from __future__ import annotations

import re

from bindings.frames import CATEGORY, CLICK, ERROR, PURCHASE, SIGNUP, VIEW, WMS_PARENT_KEYS
from bindings.seeds import seed_values
from orderloom.sources.schemas import WMS

STEPS: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    STEPS[name] = sql.strip()


def oracle(name: str, final: str | None = None) -> str:
    """The query of a step, or of `final` over it, with everything it refers to."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", sql)):
            if word in STEPS and word not in needed and STEPS[word] != sql:
                visit(STEPS[word])
                if word not in needed:
                    needed.append(word)

    body = final or STEPS[name]
    visit(body)
    if not needed:
        return body
    chain = ",\n".join(f"{n} AS (\n{STEPS[n]}\n)" for n in needed)
    if body.startswith("WITH"):
        body = f"SELECT * FROM (\n{body}\n)"
    return f"WITH {chain}\n{body}"


def _array(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def kv(column: str, key: str) -> str:
    return f"nullif(trim(regexp_extract({column}, '(^|,) *{key} *:([^,]*)', 2)), '')"


def part(column: str, position: int) -> str:
    return f"nullif(trim(split_part({column}, ',', {position})), '')"


def whole(expression: str, kind: str = "BIGINT") -> str:
    return (
        f"CASE WHEN regexp_matches(trim({expression}), '^[+-]?[0-9]+$') "
        f"THEN try_cast({expression} AS {kind}) END"
    )


def number(expression: str) -> str:
    return (
        f"CASE WHEN regexp_matches({expression}, '{NUMBER}') "
        f"THEN try_cast({expression} AS DOUBLE) END"
    )


def week(expression: str) -> str:
    return f"CAST(date_trunc('week', {expression}) AS DATE)"


for _seed in (
    "app_sources",
    "system_accounts",
    "event_codes",
    "warn_event_codes",
    "app_category_codes",
    "layout_codes",
    "jdawms_code_descriptions",
):
    step(f"seed_{_seed}", seed_values(_seed))

# --- inputs -----------------------------------------------------------------------------------

step(
    "coded_events",
    f"""
SELECT event_id AS e, user_id AS u, ts, user_id % 3 = 0 AS sales,
       CASE event_type
            WHEN 'view' THEN {_array(VIEW)}[event_id % 4 + 1]
            WHEN 'click' THEN {_array(CLICK)}[event_id % 5 + 1]
            WHEN 'purchase' THEN {_array(PURCHASE)}[event_id % 5 + 1]
            WHEN 'signup' THEN {_array(SIGNUP)}[event_id % 4 + 1]
            ELSE {_array(ERROR)}[event_id % 6 + 1] END AS code,
       CAST(CASE WHEN event_id % 40 = 39 THEN 10000 + event_id
                 WHEN event_id % 3 = 0 THEN 10000 + event_id // 5
                 ELSE 10000 + (user_id * 31 + event_id) % 50 END AS VARCHAR) AS item
FROM events
""",
)
step(
    "raw_versions",
    f"""
SELECT e AS entity_id,
       CASE WHEN e % 83 = 0 THEN '' WHEN e % 79 = 0 THEN '000'
            WHEN sales THEN lpad(CAST(u % 7 + 1 AS VARCHAR), 3, '0') ELSE '900' END AS sales_code,
       CASE WHEN e % 89 = 0 THEN 'itadmin' WHEN sales THEN 'rep' || (u % 7)
            ELSE 'C' || u END AS username,
       CASE WHEN NOT sales OR e % 5 = 0 THEN '' ELSE 'C' || (u % 40) END AS ust_customer_no,
       CASE WHEN e % 4 = 0 THEN '' ELSE (25 + e % 20) || ',' || (-120 + e % 30) END AS location,
       CASE WHEN e % 11 = 0 THEN NULL WHEN sales THEN 'GMT-8' ELSE 'GMT+8' END AS timezone,
       CASE WHEN e % 101 = 0 THEN '' WHEN e % 103 = 0 THEN 'garbage'
            WHEN e % 3 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
            WHEN e % 3 = 1 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
            WHEN e // 3 % 6 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            WHEN e // 3 % 6 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S+08:00')
            WHEN e // 3 % 6 = 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.1234567')
            WHEN e // 3 % 6 = 4 THEN strftime(ts, '%Y-%-m-%-d %H:%M:%S')
            WHEN e // 3 % 6 = 5 THEN strftime(ts, '%Y-%m-%d %-H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time,
       CASE WHEN e % 193 = 0 THEN NULL WHEN e % 97 = 0 THEN '../../etc/passwd'
            WHEN sales THEN ['PDA-A', 'CatalogFS-I'][u % 2 + 1]
            ELSE ['Vegas-I', 'Web'][u % 2 + 1] END AS source,
       '1.0' AS version,
       code AS description_code,
       CASE WHEN code IN ('04010100', '04010200') THEN
                 'increment_id:M' || lpad(CAST(e // 20 AS VARCHAR), 9, '0')
                 || ', ust_customer_no:C' || (u % 40)
                 || ', order_source:web, grand_total:' || (100 + e % 900)
                 || '.5, subtotal:' || (90 + e % 900) || ', total_item_count:' || (1 + e % 9)
            WHEN code = '04050100' THEN 'M' || lpad(CAST(e AS VARCHAR), 9, '0')
            WHEN code = '09010000' THEN 'C' || (u % 40) || ',L' || e
            WHEN code IN ('10050100', '10050300', '10150200') THEN
                 CASE WHEN e % 17 = 0 THEN 'junk' ELSE item END || ',' || (1 + e % 6) || ',CAT'
            WHEN code IN ('10040800', '10040100', '10130100', '14030000', '15010000') THEN item
            WHEN code = '19010000' THEN
                 'category:' || {_array(CATEGORY)}[u % 8 + 1] || ',visits_num:2,time:15'
            ELSE 'x' END AS response,
       'dev' AS device_name,
       ts - INTERVAL 8 HOUR AS created_at,
       ts - INTERVAL 8 HOUR + to_hours(r.revision) AS updated_at,
       CASE WHEN e % 7 = 0 THEN '' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS event_id
FROM coded_events, (VALUES (0), (1)) AS r(revision)
WHERE r.revision = 0 OR e % 50 = 0
""",
)
step(
    "raw_inv_snap",
    """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS inv_snap_id,
       rpad(CAST(10000 + l_partkey AS VARCHAR), 30, ' ') AS prtnum,
       ' ---- ' AS prt_client_id,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE taken END AS gendte,
       quantity AS rcvqty, quantity % 7 AS shpqty, quantity % 3 AS adjqty,
       CAST(stock + l_linenumber AS BIGINT) AS on_hand_qty, stock AS shippable_qty,
       quantity % 11 AS ordered_qty, quantity % 5 AS planned_qty, quantity % 4 AS pnd_rcvqty,
       CASE WHEN l_suppkey % 10 = 0 THEN 'WMD1' ELSE 'CABOT' END AS wh_id,
       taken + INTERVAL 6 HOUR AS loaddate
FROM (
    SELECT *, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(greatest(0, (l_partkey * 7 + ((l_orderkey + l_linenumber) % 31)
                * CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 3 END) % 13
                - CASE WHEN l_partkey % 5 = 0 THEN 9 WHEN l_partkey % 7 = 0 THEN 0 ELSE 4 END)
                AS BIGINT) AS stock,
           TIMESTAMP '2024-01-01' + to_days(CAST((l_orderkey + l_linenumber) % 31 AS INTEGER))
                + to_minutes(1200 + l_orderkey % 200) AS taken
    FROM lineitem)
""",
)
step(
    "item_templates",
    """
SELECT part.*, t.template FROM part, (VALUES ('----'), ('CABOT')) AS t(template)
WHERE t.template = '----' OR p_partkey % 3 <> 0
""",
)
step(
    "raw_prtmst",
    """
SELECT (10000 + p_partkey) || ' ' AS prtnum, ' ----' AS prt_client_id, template AS wh_id_tmpl,
       p_type AS prtfam, ' ' || (10000 + p_partkey) AS dsp_prtnum,
       ['A', 'B', 'C', 'D', 'X'][p_size % 5 + 1] AS abccod,
       CASE WHEN template = 'CABOT' THEN p_brand ELSE 'default' END AS velzon,
       ['EA', 'CS', 'PK'][p_partkey % 3 + 1] AS stkuom, 'CS' AS dspuom, 'A' AS rcvsts,
       TIMESTAMP '2024-01-31' AS loaddate
FROM item_templates
""",
)
step(
    "raw_prtdsc",
    """
SELECT CASE WHEN p_partkey % 4 = 0 THEN chr(65279) || 'prtnum|prt_client_id|wh_id_tmpl'
            WHEN p_partkey % 23 = 0 THEN 'prtfam'
            ELSE 'prtnum|prt_client_id|wh_id_tmpl' END AS colnam,
       (10000 + p_partkey) || ' |----|' || template AS colval,
       l.locale AS locale_id, p_name || ' ' || template || ' ' || l.locale AS lngdsc,
       p_name AS short_dsc, TIMESTAMP '2024-01-30' AS loaddate
FROM item_templates, (VALUES ('US_ENGLISH'), ('SPANISH')) AS l(locale)
""",
)
step(
    "raw_category_aliases",
    """
SELECT 'All ' || p_name || ' ' || p_partkey AS raw_name,
       CASE WHEN p_partkey % 4 <> 2 THEN CAST(p_partkey AS VARCHAR) END AS category_id,
       ['aggregate_view_all', 'category_match', 'ui_label'][p_partkey % 4 + 1] AS alias_type
FROM part WHERE p_partkey % 4 <> 3
""",
)

# --- staging ----------------------------------------------------------------------------------

step(
    "stg_event_log",
    """
SELECT * REPLACE (trim(sales_code) AS sales_code, trim(username) AS username,
                  trim(location) AS location, trim(source) AS source)
FROM raw_versions
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY updated_at DESC, created_at DESC) = 1
""",
)
step(
    "stg_admin_users",
    """
SELECT s_suppkey AS user_id, 'rep' || s_suppkey AS username,
       CASE WHEN s_suppkey % 9 <> 0 THEN 'First' || s_suppkey END AS first_name,
       'Last' || (s_suppkey % 13) AS last_name, 'rep' || s_suppkey || '@example.com' AS email,
       CASE WHEN s_suppkey % 8 <> 7 THEN lpad(CAST(s_suppkey % 8 + 1 AS VARCHAR), 3, '0') END
            AS salesperson_code,
       s_name AS role_name, 'en_US' AS interface_locale, s_suppkey % 2 AS is_active,
       CAST(1 AS BIGINT) AS is_salesperson, CAST(0 AS BIGINT) AS convert_quotes,
       CAST(1 AS BIGINT) AS receive_quote_emails,
       CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS lognum,
       CAST(NULL AS TIMESTAMP) AS logdate, TIMESTAMP '2024-01-01' AS created_at,
       CASE WHEN s_suppkey % 4 <> 0 THEN TIMESTAMP '2024-01-15 10:30:00' END AS updated_at
FROM supplier
""",
)
step(
    "stg_category",
    """
SELECT p_partkey AS entity_id,
       CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS BIGINT) END AS parent_id,
       trim(' ' || p_name || ' ' || (p_partkey % 100)) AS category_name,
       nullif(['1', '0', ''][p_partkey % 3 + 1], '') AS is_active,
       p_partkey % 17 AS position,
       CASE WHEN p_partkey % 19 <> 0 THEN p_partkey % 4 END AS category_level,
       CAST(p_size AS BIGINT) AS product_count, p_brand AS meta_title,
       CAST(NULL AS VARCHAR) AS meta_keywords, p_type AS meta_description,
       TIMESTAMP '2023-06-01 08:00:00' AS created_at,
       CASE WHEN p_partkey % 10 <> 0 THEN TIMESTAMP '2023-07-01 09:30:00' END AS updated_at
FROM part
""",
)
step(
    "stg_wms_inv_snap",
    """
SELECT * REPLACE (trim(prtnum) AS prtnum, trim(prt_client_id) AS prt_client_id)
FROM raw_inv_snap
""",
)
step(
    "stg_wms_prtmst",
    """
SELECT * REPLACE (trim(prtnum) AS prtnum, trim(prt_client_id) AS prt_client_id,
                  trim(dsp_prtnum) AS dsp_prtnum)
FROM raw_prtmst
""",
)
step("stg_wms_prtdsc", "SELECT * FROM raw_prtdsc")

_WMS_VALUES = {
    "prtnum": "CAST(10000 + l_partkey AS VARCHAR)",
    "prt_client_id": "'----'",
    "stcust": "'C' || l_suppkey",
    "wh_id": "CASE WHEN l_suppkey % 10 = 0 THEN 'WMD1' ELSE 'CABOT' END",
    "uomlvl": "CAST(l_linenumber AS VARCHAR)",
    "stoloc": "CASE WHEN l_orderkey % 97 <> 0 THEN 'A-' || (l_orderkey % 500) END",
    "loaddate": "TIMESTAMP '2024-01-29' + to_hours(l_orderkey % 24)",
}
for _name, _spec in WMS.items():
    if f"stg_wms_{_name}" not in STEPS:
        _columns = [
            _WMS_VALUES.get(c, f"'{c}-' || l_orderkey")
            + ("" if c in _WMS_VALUES or c in WMS_PARENT_KEYS else " || '-' || l_linenumber")
            + f" AS {c}"
            for c in _spec.columns
        ]
        step(
            f"stg_wms_{_name}",
            f"SELECT {', '.join(_columns)}, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem",
        )

# --- event spine ------------------------------------------------------------------------------

EVENT_TIME = """
CASE WHEN regexp_matches(trim(event_time), '^[0-9]{12,}$')
          THEN make_timestamp(CAST(trim(event_time) AS BIGINT) * 1000)
     WHEN regexp_matches(trim(event_time), '^[0-9]+$')
          THEN make_timestamp(CAST(trim(event_time) AS BIGINT) * 1000000)
     -- Spark's cast, as the models run, takes a written offset into account
     WHEN regexp_matches(trim(event_time), '[+-][0-9]{2}:[0-9]{2}$')
          THEN try_cast(left(trim(event_time), length(trim(event_time)) - 6) AS TIMESTAMP)
               - to_hours(CAST(right(trim(event_time), 6)[1:3] AS INTEGER))
     ELSE try_cast(trim(event_time) AS TIMESTAMP) END
"""
OFFSET = whole("regexp_extract(timezone, 'GMT([+-][0-9]{1,2})', 1)", "INTEGER")

step(
    "events_decoded",
    f"""
SELECT entity_id, nullif(sales_code, '') AS sales_code, nullif(username, '') AS username,
       nullif(ust_customer_no, '') AS ust_customer_no, nullif(device_name, '') AS device_name,
       source AS source_code, nullif(version, '') AS app_version, description_code,
       description_code[1:2] AS l1_code, description_code[3:4] AS l2_code,
       description_code[5:6] AS l3_code, description_code[7:8] AS l4_code,
       ({EVENT_TIME}) - to_hours(coalesce({OFFSET}, 0)) AS event_at_utc,
       timezone AS device_timezone,
       created_at + INTERVAL 8 HOUR AS created_at_utc,
       updated_at + INTERVAL 8 HOUR AS updated_at_utc,
       make_timestamp({whole("event_id")} * 1000) AS event_id_at_utc,
       {number(part("location", 1))} AS latitude, {number(part("location", 2))} AS longitude,
       CASE WHEN source LIKE 'CatalogFS-%' OR source = 'PDA-A' THEN 'sales' ELSE 'customer' END
            AS actor_type,
       CASE WHEN source LIKE 'CatalogFS-%' OR source = 'PDA-A'
            THEN coalesce(nullif(ust_customer_no, ''), {kv("response", "ust_customer_no")})
            ELSE nullif(username, '') END AS customer_key,
       response
FROM stg_event_log SEMI JOIN seed_app_sources ON source = source_code
""",
)
step(
    "events_enriched",
    """
SELECT d.*, c.function_name, c.l1_category_name, c.payload_format AS expected_payload_format,
       c.has_geo AS expects_geo, c.is_system_event, c.event_type, c.log_level,
       a.app_name, a.user_type AS app_user_type, a.platform AS app_platform,
       CASE WHEN c.function_name ILIKE '%fail%' THEN 'fail'
            WHEN c.function_name ILIKE '%success%' THEN 'success' END AS outcome,
       c.function_name IS NOT NULL AND d.description_code LIKE '1005%' AS is_add,
       c.function_name IS NOT NULL AND d.description_code LIKE '1004%' AS is_remove,
       c.function_name IS NOT NULL AND d.description_code LIKE '1015%' AS is_qty_change,
       CASE WHEN c.function_name ILIKE '%oos%' THEN 'oos_check'
            WHEN c.function_name IS NULL THEN NULL
            WHEN l1_code = '18' THEN CASE WHEN c.function_name ILIKE '%icon%' THEN 'icon_click' END
            ELSE map {'11': 'filter', '12': 'search', '14': 'item_detail',
                      '15': 'image_enlarge', '19': 'catalog_view'}[l1_code] END AS feature_name,
       CASE WHEN c.function_name ILIKE '%backorder%' THEN 'backorder'
            WHEN c.function_name ILIKE '%history%' THEN 'history'
            WHEN c.function_name ILIKE '%suggest%' THEN 'suggest'
            WHEN c.function_name ILIKE '%promo%' THEN 'promo' END AS page_context,
       CASE WHEN c.function_name IS NULL THEN NULL
            WHEN regexp_matches(d.description_code, '^10(04|05|15)') THEN 'cart'
            WHEN c.function_name ILIKE '%oos%' THEN 'stock'
            WHEN l1_code IN ('11', '12', '19')
                 OR (l1_code = '18' AND c.function_name ILIKE '%icon%') THEN 'discovery'
            WHEN l1_code IN ('14', '15') THEN 'navigation' END AS feature_group
FROM events_decoded d
LEFT JOIN seed_event_codes c USING (description_code)
LEFT JOIN seed_app_sources a USING (source_code)
WHERE d.sales_code <> '000' AND d.event_at_utc IS NOT NULL
  AND coalesce(d.username NOT IN (SELECT username FROM seed_system_accounts), true)
""",
)
step(
    "fct_events",
    """
SELECT entity_id, event_at_utc, customer_key, actor_type, source_code, app_name, app_platform,
       app_user_type, sales_code, username, description_code, l1_code, l2_code, l3_code, l4_code,
       function_name, l1_category_name, outcome, feature_name, feature_group, page_context,
       is_add, is_remove, is_qty_change, latitude, longitude, response
FROM events_enriched
""",
)
step(
    "fct_orders",
    f"""
SELECT {kv("response", "increment_id")} AS increment_id, customer_key, actor_type, source_code,
       app_name, sales_code, username, event_at_utc AS submitted_at,
       CAST(event_at_utc AS DATE) AS submitted_date,
       upper({kv("response", "order_source")}) AS order_channel,
       {number(kv("response", "grand_total"))} AS grand_total,
       {number(kv("response", "subtotal"))} AS subtotal,
       {number(kv("response", "grand_total"))} - {number(kv("response", "subtotal"))}
            AS freight_and_adj,
       {whole(kv("response", "total_item_count"), "INTEGER")} AS total_item_count
FROM events_enriched
WHERE l1_code = '04' AND response LIKE '%increment_id:%'
  AND {kv("response", "increment_id")} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {kv("response", "increment_id")}
                           ORDER BY event_at_utc DESC, entity_id DESC) = 1
""",
)

_FIRST_LOAD = "(SELECT * FROM events_enriched WHERE entity_id % 7 <> 0)"
step(
    "refresh_events",
    """
SELECT * FROM fct_events
WHERE entity_id % 7 <> 0
   OR event_at_utc >= (SELECT max(event_at_utc) FROM fct_events WHERE entity_id % 7 <> 0)
                      - INTERVAL 3 DAY
""",
)
step("first_orders", STEPS["fct_orders"].replace("FROM events_enriched", f"FROM {_FIRST_LOAD}"))
step(
    "late_orders",
    STEPS["fct_orders"].replace(
        "FROM events_enriched",
        "FROM (SELECT * FROM events_enriched WHERE event_at_utc >= "
        "(SELECT max(submitted_at) FROM first_orders) - INTERVAL 3 DAY)",
    ),
)
step(
    "refresh_orders",
    """
SELECT * FROM late_orders
UNION ALL SELECT * FROM first_orders
WHERE increment_id NOT IN (SELECT increment_id FROM late_orders)
""",
)

# --- cycles -----------------------------------------------------------------------------------


def _cycle_steps(suffix: str, gap: int, abandon: int) -> None:
    step(
        f"cycle_numbers{suffix}",
        f"""
WITH behaviour AS (
    SELECT *, l1_code = '04' AND (coalesce(response LIKE '%increment_id:%', false)
                                  OR description_code = '04050100') AS submit
    FROM events_enriched WHERE customer_key IS NOT NULL
), stepped AS (
    SELECT *, lag(event_at_utc) OVER w AS before_at, lag(submit) OVER w AS before_submit
    FROM behaviour WHERE is_add OR is_remove OR is_qty_change OR submit OR feature_name IS NOT NULL
    WINDOW w AS (PARTITION BY customer_key ORDER BY event_at_utc, entity_id)
)
SELECT *, count(*) FILTER (before_at IS NULL OR before_submit
                OR date_diff('minute', before_at, event_at_utc) >= {abandon * 1440}) OVER w
            AS cycle_seq,
       count(*) FILTER (before_at IS NULL
                OR date_diff('minute', before_at, event_at_utc) >= {gap}) OVER w AS burst_seq
FROM stepped
WINDOW w AS (PARTITION BY customer_key ORDER BY event_at_utc, entity_id
             ROWS UNBOUNDED PRECEDING)
""",
    )
    step(
        f"cycle_bursts{suffix}",
        f"""
SELECT customer_key, cycle_seq, burst_seq,
       CAST(date_diff('minute', min(event_at_utc), max(event_at_utc)) AS BIGINT) AS burst_minutes
FROM cycle_numbers{suffix} GROUP BY ALL
""",
    )
    step(
        f"cycle_dominant_app{suffix}",
        f"""
SELECT customer_key, cycle_seq, app_name, source_code
FROM (SELECT customer_key, cycle_seq, app_name, source_code, count(*) AS n
      FROM cycle_numbers{suffix} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_key, cycle_seq
                           ORDER BY n DESC, app_name, source_code) = 1
""",
    )
    step(
        f"fct_order_cycles{suffix}",
        f"""
SELECT customer_key || '-' || cycle_seq AS cycle_id, customer_key, cycle_seq,
       bool_or(actor_type = 'sales') AS is_sales_assisted,
       max(sales_code) FILTER (actor_type = 'sales') AS sales_code,
       max(username) FILTER (actor_type = 'sales') AS rep_username,
       any_value(a.app_name) AS app_name, any_value(a.source_code) AS source_code,
       min(event_at_utc) AS started_at_utc, max(event_at_utc) AS ended_at_utc,
       CAST(min(event_at_utc) AS DATE) AS started_date,
       CAST(any_value(b.bursts) AS BIGINT) AS burst_count,
       CAST(any_value(b.minutes) AS BIGINT) AS active_minutes,
       count(DISTINCT CAST(event_at_utc AS DATE)) AS days_active, count(*) AS event_count,
       count(*) FILTER (is_add) AS add_count, count(*) FILTER (is_remove) AS remove_count,
       count(*) FILTER (is_qty_change) AS qty_change_count,
       count(*) FILTER (is_add) - count(*) FILTER (is_remove) AS net_item_events,
       count(DISTINCT {part("response", 1)}) FILTER (is_add OR is_remove OR is_qty_change)
            AS distinct_skus,
       count(*) FILTER (feature_name = 'search') AS search_count,
       count(*) FILTER (feature_name = 'filter') AS filter_count,
       count(*) FILTER (feature_name = 'icon_click') AS icon_click_count,
       count(*) FILTER (feature_name = 'catalog_view') AS catalog_view_count,
       count(*) FILTER (feature_name = 'item_detail') AS item_detail_count,
       count(*) FILTER (feature_name = 'oos_check') AS oos_check_count,
       count(*) FILTER (page_context = 'promo') AS promo_count,
       count(*) FILTER (page_context = 'backorder') AS backorder_count,
       count(*) FILTER (page_context = 'history') AS history_count,
       count(*) FILTER (page_context = 'suggest') AS suggest_count,
       count(DISTINCT feature_name) AS features_used_count,
       bool_or(submit) AS is_submitted,
       max({kv("response", "increment_id")}) FILTER (l1_code = '04'
            AND response LIKE '%increment_id:%') AS submit_increment_id,
       max(event_at_utc) FILTER (submit) AS submitted_at_utc,
       CAST(date_diff('day', min(event_at_utc), max(event_at_utc) FILTER (submit)) AS INTEGER)
            AS days_to_close,
       CASE WHEN bool_or(submit) THEN 'submitted'
            WHEN date_diff('day', max(event_at_utc), TIMESTAMP '2024-02-01') >= {abandon}
            THEN 'abandoned' ELSE 'open' END AS cycle_status,
       CASE WHEN count(*) FILTER (is_remove) > count(*) FILTER (is_add) THEN 'churner'
            WHEN bool_or(submit) AND count(DISTINCT feature_name) <= 1
                 AND any_value(b.minutes) <= 15 THEN 'quick_reorder'
            WHEN count(DISTINCT feature_name) >= 3 THEN 'browser'
            ELSE 'mixed' END AS segment_name
FROM cycle_numbers{suffix} n
JOIN (SELECT customer_key, cycle_seq, count(*) AS bursts, sum(burst_minutes) AS minutes
      FROM cycle_bursts{suffix} GROUP BY ALL) b USING (customer_key, cycle_seq)
JOIN (SELECT customer_key, cycle_seq, app_name, source_code FROM cycle_dominant_app{suffix}) a
     USING (customer_key, cycle_seq)
GROUP BY customer_key, cycle_seq
""",
    )


_cycle_steps("", 60, 7)
_cycle_steps("_tuned", 720, 2)

# --- supply and demand ------------------------------------------------------------------------

step(
    "inventory_daily",
    """
SELECT prtnum, prt_client_id, wh_id, CAST(gendte AS DATE) AS snapshot_date,
       gendte AS snapshot_at, shippable_qty, on_hand_qty, ordered_qty, planned_qty, pnd_rcvqty,
       rcvqty, shpqty, adjqty
FROM stg_wms_inv_snap WHERE gendte IS NOT NULL AND prtnum IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY prtnum, prt_client_id, wh_id, CAST(gendte AS DATE)
                           ORDER BY gendte DESC, inv_snap_id DESC) = 1
""",
)
step(
    "items",
    """
SELECT m.prtnum, m.prt_client_id, m.dsp_prtnum, d.lngdsc AS item_name,
       d.short_dsc AS item_short_name, m.prtfam AS item_family, m.abccod AS abc_class,
       s.long_description AS abc_class_description, m.velzon AS velocity_zone,
       m.stkuom AS stock_uom, m.dspuom AS display_uom, m.rcvsts AS receive_status
FROM (SELECT * FROM stg_wms_prtmst
      QUALIFY row_number() OVER (PARTITION BY prtnum, prt_client_id
                                 ORDER BY wh_id_tmpl <> 'CABOT', wh_id_tmpl) = 1) m
LEFT JOIN (SELECT *, trim(split_part(colval, '|', 1)) AS item,
                  trim(split_part(colval, '|', 2)) AS client
           FROM stg_wms_prtdsc
           WHERE colnam LIKE '%prtnum|prt_client_id|wh_id_tmpl' AND locale_id = 'US_ENGLISH'
           QUALIFY row_number() OVER (
               PARTITION BY split_part(colval, '|', 1), split_part(colval, '|', 2)
               ORDER BY split_part(colval, '|', 3) <> 'CABOT', split_part(colval, '|', 3)) = 1) d
     ON d.item = m.prtnum AND d.client = m.prt_client_id
LEFT JOIN seed_jdawms_code_descriptions s ON s.code_domain = 'abccod' AND s.code_value = m.abccod
""",
)
step(
    "item_demand_daily",
    f"""
SELECT CAST(event_at_utc AS DATE) AS activity_date, sku, 'event_log' AS source_system,
       count(*) FILTER (feature_name = 'item_detail') AS item_detail_views,
       count(*) FILTER (feature_name = 'image_enlarge') AS image_enlarge_views,
       count(*) FILTER (is_add) AS cart_adds, count(*) FILTER (is_remove) AS cart_removes,
       count(*) FILTER (is_qty_change) AS cart_qty_changes,
       CAST(sum(CASE WHEN is_add THEN CASE WHEN expected_payload_format = 'positional'
                THEN {whole(part("response", 2), "INTEGER")} END ELSE 0 END) AS BIGINT)
            AS cart_add_qty,
       count(DISTINCT customer_key) AS distinct_customers,
       count(DISTINCT customer_key) FILTER (actor_type = 'customer') AS distinct_self_customers
FROM (SELECT *, CASE expected_payload_format WHEN 'positional' THEN {part("response", 1)}
                     WHEN 'sku' THEN nullif(trim(response), '') END AS sku
      FROM events_enriched
      WHERE event_at_utc BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-02-01'
        AND (is_add OR is_remove OR is_qty_change
             OR feature_name IN ('item_detail', 'image_enlarge')))
WHERE regexp_full_match(sku, '[0-9]{{3,8}}')
GROUP BY ALL
""",
)
step(
    "stock_daily",
    """
SELECT prtnum, snapshot_date, sum(shippable_qty) AS shippable, sum(on_hand_qty) AS on_hand,
       sum(planned_qty) + sum(pnd_rcvqty) AS inbound
FROM inventory_daily GROUP BY ALL
""",
)
step(
    "supply_eow",
    f"""
SELECT prtnum, {week("snapshot_date")} AS week_start,
       CAST(arg_max(shippable, snapshot_date) AS BIGINT) AS shippable_eow
FROM stock_daily GROUP BY ALL
""",
)
step(
    "oos_overlap",
    f"""
SELECT sku AS prtnum, {week("activity_date")} AS week_start,
       CAST(coalesce(sum(cart_adds) FILTER (shippable <= 0), 0) AS BIGINT) AS cart_adds_while_oos,
       CAST(coalesce(sum(item_detail_views + image_enlarge_views) FILTER (shippable <= 0), 0)
            AS BIGINT) AS views_while_oos
FROM item_demand_daily JOIN stock_daily ON prtnum = sku AND snapshot_date = activity_date
GROUP BY ALL
""",
)
step(
    "item_weeks",
    f"""
SELECT coalesce(d.sku, s.prtnum) AS prtnum,
       {week("coalesce(d.activity_date, s.snapshot_date)")} AS week_start,
       CAST(coalesce(sum(item_detail_views + image_enlarge_views), 0) AS BIGINT) AS item_views,
       CAST(coalesce(sum(cart_adds), 0) AS BIGINT) AS cart_adds,
       CAST(coalesce(sum(cart_removes), 0) AS BIGINT) AS cart_removes,
       CAST(coalesce(sum(cart_add_qty), 0) AS BIGINT) AS cart_add_qty,
       coalesce(max(distinct_customers), 0) AS peak_daily_customers,
       count(DISTINCT activity_date) AS demand_active_days,
       CAST(coalesce(sum(item_detail_views + image_enlarge_views + cart_adds), 0) AS BIGINT)
            AS demand_events,
       avg(shippable) AS avg_shippable_qty, CAST(min(shippable) AS BIGINT) AS min_shippable_qty,
       avg(on_hand) AS avg_on_hand_qty,
       CAST(arg_max(shippable, snapshot_date) AS BIGINT) AS shippable_eow,
       count(*) FILTER (shippable <= 0) AS days_out_of_stock,
       count(snapshot_date) AS snapshot_days,
       CAST(max(inbound) AS BIGINT) AS inbound_qty_peak,
       CAST(coalesce(sum(cart_adds) FILTER (shippable <= 0), 0) AS BIGINT) AS cart_adds_while_oos,
       CAST(coalesce(sum(item_detail_views + image_enlarge_views) FILTER (shippable <= 0), 0)
            AS BIGINT) AS views_while_oos
FROM item_demand_daily d FULL JOIN stock_daily s
     ON s.prtnum = d.sku AND s.snapshot_date = d.activity_date
GROUP BY 1, 2
HAVING {week("coalesce(d.activity_date, s.snapshot_date)")}
       >= (SELECT min({week("activity_date")}) FROM item_demand_daily)
""",
)


def _mart_step(suffix: str, ratio: str, floor: int, enough: int) -> None:
    step(
        f"item_demand_supply{suffix}",
        f"""
SELECT prtnum, week_start, item_name, item_family, abc_class, abc_class_description,
       velocity_zone, item_views, cart_adds, cart_removes, cart_add_qty, peak_daily_customers,
       demand_active_days, demand_events, views_prior_4wk_avg, avg_shippable_qty,
       min_shippable_qty, avg_on_hand_qty, shippable_eow, shippable_eow_prior_4wk_avg,
       days_out_of_stock, snapshot_days, inbound_qty_peak, cart_adds_while_oos, views_while_oos,
       is_trending_interest,
       CASE WHEN demand_events >= {enough} AND (days_out_of_stock >= 4 OR cart_adds_while_oos > 0)
            THEN 'missed_opportunity'
            WHEN is_trending_interest AND shippable_eow <= shippable_eow_prior_4wk_avg
            THEN 'restock_risk'
            WHEN demand_events <= 2 AND avg_shippable_qty > 0 THEN 'promote_candidate'
            ELSE 'healthy' END AS signal
FROM (SELECT *, views_prior_4wk_avg >= {floor}
                AND item_views >= {ratio} * views_prior_4wk_avg AS is_trending_interest
      FROM (SELECT *, avg(item_views) OVER w AS views_prior_4wk_avg,
                   avg(shippable_eow) OVER w AS shippable_eow_prior_4wk_avg
            FROM item_weeks
            WINDOW w AS (PARTITION BY prtnum ORDER BY week_start
                         ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)))
JOIN items USING (prtnum)
""",
    )


_mart_step("", "1.5", 5, 10)
_mart_step("_tuned", "1.0", 1, 3)

LATEST = "week_start = (SELECT max(week_start) FROM item_demand_supply_tuned)"
step(
    "missed_opportunity",
    f"""
SELECT prtnum, item_name, item_family, abc_class, week_start, item_views, cart_adds,
       cart_adds_while_oos, views_while_oos, days_out_of_stock, snapshot_days,
       avg_shippable_qty, inbound_qty_peak
FROM item_demand_supply_tuned WHERE signal = 'missed_opportunity' AND {LATEST}
""",
)
step(
    "missed_opportunity_4wk",
    """
SELECT prtnum, item_name, item_family, abc_class, count(*) AS weeks_flagged,
       CAST(sum(cart_adds_while_oos) AS BIGINT) AS cart_adds_while_oos_total,
       CAST(sum(views_while_oos) AS BIGINT) AS views_while_oos_total,
       CAST(sum(days_out_of_stock) AS BIGINT) AS days_out_of_stock_total,
       avg(avg_shippable_qty) AS avg_shippable_qty
FROM item_demand_supply_tuned
WHERE signal = 'missed_opportunity'
  AND week_start IN (SELECT DISTINCT week_start FROM item_demand_supply_tuned
                     ORDER BY week_start DESC OFFSET 1 LIMIT 4)
GROUP BY ALL
""",
)
step(
    "promote_candidates",
    f"""
SELECT prtnum, item_name, item_family, abc_class, velocity_zone, week_start, item_views,
       cart_adds, demand_events, avg_shippable_qty, avg_on_hand_qty, shippable_eow
FROM item_demand_supply_tuned WHERE signal = 'promote_candidate' AND {LATEST}
""",
)
step(
    "restock_risk",
    f"""
SELECT prtnum, item_name, item_family, abc_class, week_start, item_views, views_prior_4wk_avg,
       round(item_views / nullif(views_prior_4wk_avg, 0), 2) AS views_vs_baseline_ratio,
       shippable_eow, shippable_eow_prior_4wk_avg, inbound_qty_peak
FROM item_demand_supply_tuned WHERE signal = 'restock_risk' AND {LATEST}
""",
)

# --- scorecards -------------------------------------------------------------------------------

step(
    "customer_weekly",
    f"""
WITH seen AS (
    SELECT customer_key, {week("event_at_utc")} AS week_start, count(*) AS event_count,
           count(*) FILTER (actor_type = 'customer') AS self_events,
           count(*) FILTER (actor_type = 'sales') AS rep_events,
           count(*) FILTER (is_add) AS add_count, count(*) FILTER (is_remove) AS remove_count,
           count(*) FILTER (is_qty_change) AS qty_change_count,
           count(*) FILTER (feature_name = 'search') AS search_count,
           count(*) FILTER (feature_name = 'filter') AS filter_count,
           count(*) FILTER (feature_name = 'icon_click') AS icon_click_count,
           count(*) FILTER (feature_name = 'catalog_view') AS catalog_view_count,
           count(*) FILTER (feature_name = 'item_detail') AS item_detail_count,
           count(*) FILTER (feature_name = 'oos_check') AS oos_check_count,
           count(*) FILTER (page_context = 'promo') AS promo_count,
           count(*) FILTER (page_context = 'backorder') AS backorder_count,
           count(*) FILTER (page_context = 'history') AS history_count,
           count(*) FILTER (page_context = 'suggest') AS suggest_count,
           count(*) FILTER (l1_code = '05') AS request_review_count,
           count(*) FILTER (l1_code = '06') AS sales_review_count,
           count(*) FILTER (l1_code = '07') AS restore_order_count,
           count(*) FILTER (l1_code = '08') AS delete_order_count
    FROM events_enriched WHERE customer_key IS NOT NULL GROUP BY ALL
), worked AS (
    SELECT customer_key, {week("started_at_utc")} AS week_start, count(*) AS cycles,
           count(*) FILTER (is_submitted) AS cycles_submitted
    FROM fct_order_cycles GROUP BY ALL
), bought AS (
    SELECT customer_key, {week("submitted_at")} AS week_start, count(*) AS orders_submitted,
           sum(grand_total) AS order_value_total
    FROM fct_orders GROUP BY ALL
)
SELECT customer_key, week_start, event_count, self_events, rep_events,
       coalesce(cycles, 0) AS cycles, coalesce(cycles_submitted, 0) AS cycles_submitted,
       coalesce(orders_submitted, 0) AS orders_submitted,
       CAST(coalesce(order_value_total, 0) AS DOUBLE) AS order_value_total,
       add_count, remove_count, qty_change_count, add_count - remove_count AS net_item_events,
       search_count, filter_count, icon_click_count, catalog_view_count, item_detail_count,
       oos_check_count, promo_count, backorder_count, history_count, suggest_count,
       request_review_count, sales_review_count, restore_order_count, delete_order_count,
       request_review_count + sales_review_count + restore_order_count + delete_order_count
            + oos_check_count AS friction_total,
       CASE WHEN self_events >= 0.8 * event_count THEN 'self_service'
            WHEN self_events <= 0.2 * event_count THEN 'sales_assisted'
            ELSE 'mixed' END AS service_mode,
       CAST(remove_count > add_count AS INTEGER) AS remove_gt_add,
       remove_count > add_count AS remove_gt_add_flag,
       count(*) FILTER (remove_count > add_count) OVER (
            PARTITION BY customer_key ORDER BY week_start ROWS 2 PRECEDING) = 3 AS churn_signal
FROM seen LEFT JOIN worked USING (customer_key, week_start)
LEFT JOIN bought USING (customer_key, week_start)
""",
)
step(
    "feature_use",
    """
SELECT DISTINCT customer_key, CAST(event_at_utc AS DATE) AS used_on, feature_name
FROM events_enriched WHERE feature_name IS NOT NULL AND customer_key IS NOT NULL
""",
)
step(
    "feature_pairing",
    f"""
SELECT week_start, feature_a, feature_b, co_occurrence_days, customers_count,
       CAST(co_occurrence_days AS DOUBLE) / days_with_a AS pct_of_a_days_with_b,
       co_occurrence_days - lag(co_occurrence_days) OVER (
            PARTITION BY feature_a, feature_b ORDER BY week_start) AS wow_change
FROM (SELECT {week("used_on")} AS week_start, x.feature_name AS feature_a,
             y.feature_name AS feature_b, count(*) AS co_occurrence_days,
             count(DISTINCT customer_key) AS customers_count
      FROM feature_use x JOIN feature_use y USING (customer_key, used_on)
      WHERE x.feature_name <= y.feature_name GROUP BY ALL)
JOIN (SELECT {week("used_on")} AS week_start, feature_name AS feature_a, count(*) AS days_with_a
      FROM feature_use GROUP BY ALL) USING (week_start, feature_a)
""",
)
_TOUCHED = (
    "search",
    "filter",
    "icon_click",
    "catalog_view",
    "promo",
    "backorder",
    "history",
    "suggest",
)
_PCT = [f"pct_cycles_{t}" for t in _TOUCHED]
_AVG = [f"avg_{t}_per_cycle" for t in _TOUCHED]
step(
    "rep_weekly",
    f"""
SELECT sales_code, rep_name, week_start, coalesce(orders_submitted, 0) AS orders_submitted,
       CAST(coalesce(order_value_total, 0) AS DOUBLE) AS order_value_total,
       coalesce(cycles_worked, 0) AS cycles_worked,
       coalesce(cycles_submitted, 0) AS cycles_submitted, avg_adds_per_cycle,
       avg_removes_per_cycle, avg_net_item_events, avg_active_minutes, avg_days_to_close,
       {", ".join(_PCT + _AVG)}
FROM (SELECT sales_code, {week("started_at_utc")} AS week_start, count(*) AS cycles_worked,
             count(*) FILTER (is_submitted) AS cycles_submitted,
             avg(add_count) AS avg_adds_per_cycle, avg(remove_count) AS avg_removes_per_cycle,
             avg(net_item_events) AS avg_net_item_events,
             avg(active_minutes) AS avg_active_minutes,
             avg(days_to_close) AS avg_days_to_close,
             {", ".join(f"avg(CAST({t}_count > 0 AS DOUBLE)) AS pct_cycles_{t}" for t in _TOUCHED)},
             {", ".join(f"avg({t}_count) AS avg_{t}_per_cycle" for t in _TOUCHED)}
      FROM fct_order_cycles WHERE is_sales_assisted AND sales_code IS NOT NULL GROUP BY ALL)
FULL JOIN (SELECT sales_code, {week("submitted_at")} AS week_start,
                  count(*) AS orders_submitted, sum(grand_total) AS order_value_total
           FROM fct_orders WHERE sales_code IS NOT NULL GROUP BY ALL)
     USING (sales_code, week_start)
LEFT JOIN (SELECT salesperson_code AS sales_code, max(first_name || ' ' || last_name) AS rep_name
           FROM stg_admin_users GROUP BY ALL) USING (sales_code)
""",
)
# A rep's opens, and for each instant with opens the one with the largest number.
step(
    "opened_numbers",
    f"""
SELECT username, customer, number, sales_code, source_code, app_version,
       min(event_at_utc) AS moment
FROM (FROM events_enriched
      SELECT *, {part("response", 1)} AS customer, {part("response", 2)} AS number
      WHERE l1_category_name = 'Create Order' AND actor_type = 'sales'
        AND description_code NOT IN ('09060000', '09070000'))
GROUP BY ALL HAVING number IS NOT NULL
""",
)
step(
    "sent_orders",
    f"""
FROM (FROM events_enriched
      SELECT username, customer_key AS customer, event_at_utc,
             if(expected_payload_format = 'kv', {kv("response", "increment_id")},
                nullif(regexp_extract(response, '([A-Z][0-9]{{9}})', 1), '')) AS sent
      WHERE l1_category_name = 'Send Order' AND l3_code = '01')
SELECT username, customer, sent, min(event_at_utc) AS moment
WHERE sent IS NOT NULL GROUP BY ALL
""",
)
step(
    "first_sent",
    """
SELECT username, customer, number, min({'moment': s.moment, 'sent': s.sent}) AS earliest
FROM (SELECT username, customer, number, min(moment) AS moment FROM opened_numbers GROUP BY ALL) o
JOIN sent_orders s USING (username, customer)
WHERE s.moment > o.moment GROUP BY ALL
""",
)
step(
    "opened_before_sent",
    """
SELECT s.username, s.customer, s.sent, s.moment AS sent_at, o.moment AS opened_at, o.held
FROM sent_orders s ASOF LEFT JOIN (
     SELECT username, customer, moment, max({'number': number, 'sales_code': sales_code,
            'source_code': source_code, 'app_version': app_version}) AS held
     FROM opened_numbers GROUP BY ALL) o
  ON o.username = s.username AND o.customer = s.customer AND s.moment > o.moment
""",
)
step(
    "rep_order_cycle",
    """
SELECT b.username, b.customer AS order_customer_no, held.number AS local_id,
       b.sent AS increment_id, held.sales_code AS sales_code, held.source_code AS source_code,
       held.app_version AS app_version, opened_at, sent_at AS submitted_at,
       CAST(date_diff('day', opened_at, sent_at) AS INTEGER) AS days_to_close
FROM opened_before_sent b LEFT JOIN first_sent f
     ON f.username = b.username AND f.customer = b.customer AND f.number = b.held.number
WHERE (f.earliest.sent = b.sent AND f.earliest.moment = b.sent_at)
   OR (opened_at IS NULL AND row(sent_at, b.sent, coalesce(b.username, '~')) = (
       SELECT row(sent_at, sent, coalesce(username, '~')) FROM opened_before_sent
       WHERE opened_at IS NULL ORDER BY sent_at, sent, username NULLS LAST LIMIT 1))
"""
)
_CYCLE = (
    "username, order_customer_no, local_id, increment_id, c.sales_code, c.source_code, "
    "app_version, opened_at, submitted_at, days_to_close"
)
_ICON = "l1_category_name = 'Activity (Customer Interactions)'"
_CLICKS = ("backorder", "history", "suggest", "new", "promo", "new_promo")
_USED = {**{n: f"0{i + 2}" for i, n in enumerate(_CLICKS)}, "all_product": "08", "categories": "09"}
_RATIO = (
    "count(*) FILTER (l1_category_name = 'Order Operations' AND l2_code = '04') / "
    "nullif(count(*) FILTER (l1_category_name = 'Order Operations' AND l2_code = '05'), 0)"
)
step(
    "rep_order_journey",
    f"""
SELECT {_CYCLE},
       CASE WHEN days_to_close = 0 THEN 'same-day' WHEN days_to_close BETWEEN 1 AND 3 THEN '1-3d'
            WHEN days_to_close BETWEEN 4 AND 7 THEN '4-7d'
            WHEN days_to_close BETWEEN 8 AND 14 THEN '8-14d' ELSE '14d+' END AS cycle_bucket,
       count(*) FILTER (l1_category_name = 'Order Operations' AND l2_code = '05') AS add_count,
       count(*) FILTER (l1_category_name = 'Order Operations' AND l2_code = '04') AS remove_count,
       count(*) FILTER (l1_category_name = 'Order Operations' AND l2_code = '13')
            AS oos_check_count,
       CAST({_RATIO} AS DOUBLE) AS churn_ratio,
       {", ".join(f"count(*) FILTER ({_ICON} AND l2_code = '{_USED[n]}') AS click_{n}_count"
                  for n in _CLICKS)},
       count(*) FILTER (l1_category_name = 'Filtering & Sorting') AS filter_events,
       count(*) FILTER (l1_category_name = 'Search') AS search_events,
       count(*) FILTER ({_ICON}) AS icon_clicks,
       count(*) FILTER (l1_category_name = 'Catalog View Analytics') AS catalog_views,
       {", ".join(f"CAST(coalesce(bool_or({_ICON} AND l2_code = '{c}'), false) AS INTEGER)"
                  f" AS used_{n}" for n, c in _USED.items())},
       CAST(coalesce(bool_or({_ICON}), false) AS INTEGER) AS used_icons,
       CAST(coalesce(bool_or(l1_category_name = 'Search'), false) AS INTEGER) AS used_search,
       CAST(coalesce(bool_or(l1_category_name = 'Catalog View Analytics'), false) AS INTEGER)
            AS used_catalog_view,
       CAST(coalesce(bool_or(l1_category_name = 'Filtering & Sorting'), false) AS INTEGER)
            AS used_filter,
       CAST(coalesce(bool_or(l1_category_name = 'Send Order'), false) AS INTEGER)
            AS had_submit_attempt,
       count(*) FILTER (l1_category_name = 'Send Order' AND l3_code = '02') AS submit_fail_count,
       CASE WHEN {_RATIO} >= 0.3 THEN 'High Editor'
            WHEN {_RATIO} < 0.1 AND days_to_close <= 1 THEN 'Decisive'
            WHEN days_to_close >= 4 THEN 'Planner' ELSE 'Slow Sender' END AS behavior_segment
FROM fct_events e JOIN rep_order_cycle c USING (username)
WHERE actor_type = 'sales' AND event_at_utc BETWEEN opened_at AND submitted_at
GROUP BY {_CYCLE}
""",
)

# --- quality ----------------------------------------------------------------------------------

step(
    "quarantine_invalid_source",
    """
SELECT entity_id, source, username, ust_customer_no, location, event_time, description_code,
       response, device_name, created_at, updated_at
FROM stg_event_log
WHERE source IS NULL OR source NOT IN (SELECT source_code FROM seed_app_sources)
""",
)
step(
    "unparsed_event_times",
    f"""
SELECT entity_id, source, username, event_time, description_code, created_at
FROM stg_event_log
WHERE source IN (SELECT source_code FROM seed_app_sources)
  AND event_time <> '' AND ({EVENT_TIME}) IS NULL
""",
)
step(
    "unmapped_event_codes",
    """
SELECT description_code, regexp_full_match(description_code, '[0-9]{8}') AS is_well_formed_code,
       description_code IN ('00000000', '03110400', '10051500', '10691200', '11124000')
            AS is_known_legacy,
       description_code[1:2] AS l1_code, count(*) AS event_count,
       count(DISTINCT source_code) AS distinct_sources, min(source_code) AS example_source,
       min(created_at_utc) AS first_seen_utc, max(created_at_utc) AS last_seen_utc
FROM events_decoded ANTI JOIN seed_event_codes USING (description_code)
GROUP BY description_code
""",
)
step(
    "unmatched_demand_skus",
    """
SELECT sku, min(activity_date) AS first_seen, max(activity_date) AS last_seen,
       CAST(sum(item_detail_views + image_enlarge_views) AS BIGINT) AS item_views,
       CAST(sum(cart_adds) AS BIGINT) AS cart_adds,
       CAST(sum(cart_add_qty) AS BIGINT) AS cart_add_qty,
       CAST(sum(item_detail_views + image_enlarge_views + cart_adds) AS BIGINT) AS demand_events
FROM item_demand_daily WHERE sku NOT IN (SELECT prtnum FROM items)
GROUP BY sku
""",
)
step(
    "check_sales_code_present",
    """
SELECT entity_id, source_code, username, sales_code, created_at_utc
FROM events_decoded WHERE actor_type = 'sales' AND coalesce(trim(sales_code), '') = ''
""",
)
step("check_unique", """
SELECT entity_id, count(*) AS n_records FROM raw_versions GROUP BY entity_id HAVING count(*) > 1
""")
step("check_not_null", "SELECT entity_id, source, username FROM stg_event_log WHERE source IS NULL")
step("check_accepted_values", """
SELECT source, count(*) AS n_records FROM raw_versions
WHERE source NOT IN (SELECT source_code FROM seed_app_sources) GROUP BY source
""")
step("check_relationships", """
SELECT description_code, count(*) AS n_records
FROM events_decoded ANTI JOIN seed_event_codes USING (description_code) GROUP BY description_code
""")
step("check_unique_combination", """
SELECT prtnum, prt_client_id, wh_id, CAST(gendte AS DATE) AS snapshot_date, count(*) AS n_records
FROM stg_wms_inv_snap GROUP BY ALL HAVING count(*) > 1
""")

# Expected result of every check that the models of `check_summary` declare.
_CHECKS: list[tuple[str, str, str]] = []


def _declare(name: str, severity: str, failing: str) -> None:
    _CHECKS.append((name, severity, failing))


_MODELS = {
    "stg_event_log": "stg_event_log",
    "events_decoded": "events_decoded",
    "events_enriched": "events_enriched",
    "fct_orders": "fct_orders",
    "inventory_daily": "inventory_daily",
    "items": "items",
    "event_codes": "seed_event_codes",
}
for _m, _c in (
    ("stg_event_log", "entity_id"),
    ("events_decoded", "entity_id"),
    ("events_enriched", "entity_id"),
    ("fct_orders", "increment_id"),
    ("event_codes", "description_code"),
):
    _declare(
        f"unique_{_m}_{_c}",
        "error",
        f"SELECT count(*) FROM (SELECT {_c} FROM {_MODELS[_m]} WHERE {_c} IS NOT NULL "
        f"GROUP BY {_c} HAVING count(*) > 1)",
    )
for _m, _columns in {
    "stg_event_log": ("entity_id", "source", "description_code"),
    "events_decoded": ("entity_id", "source_code", "description_code", "created_at_utc"),
    "events_enriched": ("entity_id",),
    "fct_orders": ("increment_id", "submitted_at"),
    "inventory_daily": ("prtnum", "snapshot_date"),
    "items": ("prtnum",),
    "event_codes": ("description_code", "function_name"),
}.items():
    for _c in _columns:
        _declare(
            f"not_null_{_m}_{_c}",
            "error",
            f"SELECT count(*) FROM {_MODELS[_m]} WHERE {_c} IS NULL",
        )
for _name, _severity, _m, _keys in (
    (
        "inventory_daily",
        "error",
        "inventory_daily",
        "prtnum, prt_client_id, wh_id, snapshot_date",
    ),
    ("items", "error", "items", "prtnum, prt_client_id"),
):
    _declare(
        f"unique_combination_{_name}",
        _severity,
        f"SELECT count(*) FROM (SELECT {_keys} FROM {_m} GROUP BY ALL HAVING count(*) > 1)",
    )
for _m, _c, _values in (
    ("events_decoded", "source_code", "SELECT source_code FROM seed_app_sources"),
    ("events_decoded", "actor_type", "'sales', 'customer'"),
    ("events_enriched", "outcome", "'success', 'fail'"),
    (
        "events_enriched",
        "feature_name",
        "'search', 'filter', 'icon_click', 'catalog_view', 'item_detail', 'image_enlarge', "
        "'oos_check'",
    ),
    ("events_enriched", "page_context", "'promo', 'backorder', 'history', 'suggest'"),
    (
        "event_codes",
        "payload_format",
        "'none', 'kv', 'positional_order', 'positional', 'duration', 'sku', 'title', "
        "'bare_value', 'fail_marker'",
    ),
):
    _declare(
        f"accepted_values_{_m}_{_c}",
        "error",
        f"SELECT count(DISTINCT {_c}) FROM {_MODELS[_m]} WHERE {_c} NOT IN ({_values})",
    )
_declare(
    "relationships_events_decoded_description_code",
    "warn",
    "SELECT count(*) FROM events_decoded ANTI JOIN seed_event_codes USING (description_code)",
)
for _name, _spec in WMS.items():
    _table, _grain = f"stg_wms_{_name}", ", ".join(_spec.grain)
    _single = len(_spec.grain) == 1
    _declare(
        f"unique_wms_{_name}_{_grain}" if _single else f"unique_combination_wms_{_name}",
        "warn",
        f"SELECT count(*) FROM (SELECT {_grain} FROM {_table} "
        + (f"WHERE {_grain} IS NOT NULL " if _single else "")
        + "GROUP BY ALL HAVING count(*) > 1)",
    )
    for _c in (*(_spec.grain if _single else ()), *_spec.required):
        _declare(
            f"not_null_wms_{_name}_{_c}",
            "error",
            f"SELECT count(*) FROM {_table} WHERE {_c} IS NULL",
        )
    if _spec.parent:
        _c, _parent, _key = _spec.parent
        _declare(
            f"relationships_wms_{_name}_{_c}",
            "warn",
            f"SELECT count(*) FROM {_table} WHERE {_c} IS NOT NULL "
            f"AND {_c} NOT IN (SELECT {_key} FROM stg_wms_{_parent})",
        )
_declare("sales_code_present", "warn", "SELECT count(*) FROM check_sales_code_present")
step(
    "check_summary",
    "SELECT check_name, severity, failures, "
    "CASE WHEN failures > 0 THEN severity ELSE 'pass' END AS status FROM (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{s}' AS severity, ({q}) AS failures"
        for n, s, q in _CHECKS
    )
    + ")",
)

# The checks of all other models and seeds, for `check_summary_all`.
_OTHERS = {
    "app_sources": "seed_app_sources",
    "system_accounts": "seed_system_accounts",
    "app_category_codes": "seed_app_category_codes",
    "warn_event_codes": "seed_warn_event_codes",
    "layout_codes": "seed_layout_codes",
    "jdawms_code_descriptions": "seed_jdawms_code_descriptions",
    "categories": "website_categories",
    "category_name_aliases": "raw_category_aliases",
    "item_demand_supply": "item_demand_supply_tuned",
}
for _m, _c in (
    ("stg_admin_users", "user_id"),
    ("stg_category", "entity_id"),
    ("fct_events", "entity_id"),
    ("fct_order_cycles", "cycle_id"),
    ("quarantine_invalid_source", "entity_id"),
    ("unmapped_event_codes", "description_code"),
    ("unmatched_demand_skus", "sku"),
    ("app_sources", "source_code"),
    ("system_accounts", "username"),
    ("categories", "category_id"),
    ("app_category_codes", "app_category_code"),
    ("category_name_aliases", "raw_name"),
    ("warn_event_codes", "description_code"),
    ("layout_codes", "layout_code"),
):
    _declare(
        f"unique_{_m}_{_c}",
        "error",
        f"SELECT count(*) FROM (SELECT {_c} FROM {_OTHERS.get(_m, _m)} WHERE {_c} IS NOT NULL "
        f"GROUP BY {_c} HAVING count(*) > 1)",
    )
for _m, _columns in {
    "stg_admin_users": ("user_id",),
    "stg_category": ("entity_id",),
    "fct_events": ("entity_id",),
    "fct_order_cycles": ("cycle_id", "customer_key"),
    "item_demand_daily": ("activity_date", "sku"),
    "item_demand_supply": ("prtnum", "week_start"),
    "customer_weekly": ("customer_key", "week_start"),
    "rep_weekly": ("sales_code", "week_start"),
    "feature_pairing": ("week_start", "feature_a", "feature_b"),
    "quarantine_invalid_source": ("entity_id",),
    "unmapped_event_codes": ("description_code",),
    "unmatched_demand_skus": ("sku",),
    "app_sources": ("source_code",),
    "system_accounts": ("username",),
    "categories": ("category_id", "category_name"),
    "app_category_codes": ("app_category_code", "category_name"),
    "category_name_aliases": ("raw_name", "alias_type"),
    "warn_event_codes": ("description_code", "log_level"),
    "layout_codes": ("layout_code", "layout_name"),
    "jdawms_code_descriptions": ("code_domain", "code_value", "long_description"),
}.items():
    for _c in _columns:
        _declare(
            f"not_null_{_m}_{_c}",
            "error",
            f"SELECT count(*) FROM {_OTHERS.get(_m, _m)} WHERE {_c} IS NULL",
        )
for _m, _keys in (
    ("item_demand_daily", "sku, activity_date, source_system"),
    ("item_demand_supply", "prtnum, week_start"),
    ("jdawms_code_descriptions", "code_domain, code_value"),
):
    _declare(
        f"unique_combination_{_m}",
        "error",
        f"SELECT count(*) FROM (SELECT {_keys} FROM {_OTHERS.get(_m, _m)} "
        "GROUP BY ALL HAVING count(*) > 1)",
    )
for _m, _c, _values in (
    ("fct_order_cycles", "cycle_status", "'submitted', 'abandoned', 'open'"),
    ("fct_order_cycles", "segment_name", "'churner', 'quick_reorder', 'browser', 'mixed'"),
    ("customer_weekly", "service_mode", "'self_service', 'sales_assisted', 'mixed'"),
    (
        "item_demand_supply",
        "signal",
        "'missed_opportunity', 'restock_risk', 'promote_candidate', 'healthy'",
    ),
    ("app_sources", "user_type", "'Sales', 'Customer'"),
    ("app_sources", "platform", "'iOS', 'Android', 'Web'"),
    ("app_category_codes", "code_type", "'real_category', 'virtual_slot'"),
    (
        "category_name_aliases",
        "alias_type",
        "'aggregate_view_all', 'category_match', 'ui_label', 'search_query', 'brand_keyword', "
        "'error_payload'",
    ),
):
    _declare(
        f"accepted_values_{_m}_{_c}",
        "error",
        f"SELECT count(DISTINCT {_c}) FROM {_OTHERS.get(_m, _m)} WHERE {_c} NOT IN ({_values})",
    )
for _m, _c, _severity, _parent in (
    ("item_demand_supply", "prtnum", "error", "items"),
    ("category_name_aliases", "category_id", "warn", "website_categories"),
):
    _declare(
        f"relationships_{_m}_{_c}",
        _severity,
        f"SELECT count(*) FROM {_OTHERS.get(_m, _m)} WHERE {_c} IS NOT NULL "
        f"AND {_c} NOT IN (SELECT {_c} FROM {_parent})",
    )
step(
    "check_summary_all",
    "SELECT check_name, severity, failures, "
    "CASE WHEN failures > 0 THEN severity ELSE 'pass' END AS status FROM (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{s}' AS severity, ({q}) AS failures"
        for n, s, q in _CHECKS
    )
    + ")",
)

step(
    "source_freshness_report",
    """
SELECT source_name, max_loaded_at, CAST(floor(age / 3600) AS BIGINT) AS age_hours,
       CASE WHEN age > error_hours * 3600 THEN 'error' WHEN age > warn_hours * 3600 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT *, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max_loaded_at)) // 1000000 AS age
      FROM (SELECT 'system_event_log' AS source_name, max(created_at) AS max_loaded_at,
                   24 AS warn_hours, 72 AS error_hours FROM raw_versions
"""
    + " ".join(
        f"UNION ALL SELECT '{n}', max(loaddate), {w.warn_hours}, NULL FROM stg_wms_{n}"
        for n, w in WMS.items()
    )
    + "))",
)

# --- sources, functions, tables and decodes -----------------------------------------------------

step("flatten_envelope", "SELECT * FROM raw_versions")
step(
    "parse_functions",
    f"""
SELECT entity_id, updated_at, {kv("response", "increment_id")} AS kv_increment_id,
       {kv("response", "category")} AS kv_category, {part("response", 2)} AS second_part,
       created_at - INTERVAL 3 HOUR AS three_hours_earlier, {OFFSET} AS offset_hours,
       make_timestamp({whole("event_id")} * 1000) AS event_id_time, {EVENT_TIME} AS device_time,
       {number(kv("response", "grand_total"))} AS grand_total,
       {week("created_at")} AS week_start,
       CAST(date_diff('day', created_at, TIMESTAMP '2024-02-01') AS INTEGER) AS days_to_as_of,
       date_diff('minute', created_at, updated_at) AS minutes_to_update
FROM raw_versions
""",
)
step("incremental_upsert", """
SELECT entity_id, event_at_utc, description_code, updated_at_utc FROM events_decoded
""")
step("trailing_window", """
SELECT entity_id, event_at_utc, customer_key, description_code FROM fct_events
WHERE event_at_utc >= (SELECT max(event_at_utc) - INTERVAL 3 DAY FROM fct_events)
""")
step("website_categories", """
SELECT CAST(entity_id AS VARCHAR) AS category_id, category_name FROM stg_category
""")
step(
    "decode_app_category",
    f"""
SELECT v.entity_id, v.category_code,
       CASE WHEN a.code_type IS NOT NULL THEN 'app_code'
            WHEN w.category_id IS NOT NULL THEN 'category' ELSE 'unknown' END AS decoded_by,
       a.code_type,
       CASE WHEN a.code_type = 'real_category' THEN a.ust_category_id
            WHEN a.code_type IS NULL THEN w.category_id END AS category_id,
       coalesce(w.category_name, a.category_name) AS category_name,
       coalesce(a.code_type = 'real_category', w.category_id IS NOT NULL) AS is_product_category
FROM (SELECT entity_id, {kv("response", "category")} AS category_code
      FROM events_enriched WHERE description_code = '19010000') v
LEFT JOIN seed_app_category_codes a ON v.category_code IN (a.app_category_code, a.app_id)
LEFT JOIN website_categories w
     ON w.category_id = CASE WHEN a.code_type IS NULL THEN v.category_code
                             ELSE a.ust_category_id END
""",
)
step("classify_category_name", """
SELECT n.*, a.alias_type,
       coalesce(a.category_id, CASE WHEN a.raw_name IS NULL THEN w.category_id END) AS category_id
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
             CASE l_linenumber % 3 WHEN 0 THEN 'All ' || p_name || ' ' || l_partkey
                  WHEN 1 THEN p_name || ' ' || (l_partkey % 100)
                  ELSE 'Search:' || p_name END AS raw_name
      FROM lineitem JOIN part ON p_partkey = l_partkey) n
LEFT JOIN raw_category_aliases a USING (raw_name)
LEFT JOIN (SELECT category_name, min(category_id) AS category_id
           FROM website_categories GROUP BY ALL) w ON w.category_name = n.raw_name
""")
step("drop_warn_codes", """
SELECT entity_id, description_code, created_at_utc FROM events_decoded
WHERE description_code NOT IN (SELECT description_code FROM seed_warn_event_codes)
""")
step("decode_wms_code", """
SELECT prtnum, wh_id_tmpl, abccod, stkuom, dspuom,
       a.long_description AS abccod_description, a.short_description AS abccod_short_description,
       s.long_description AS stkuom_description, s.short_description AS stkuom_short_description,
       d.long_description AS dspuom_description, d.short_description AS dspuom_short_description
FROM stg_wms_prtmst
LEFT JOIN seed_jdawms_code_descriptions a ON a.code_domain = 'abccod' AND a.code_value = abccod
LEFT JOIN seed_jdawms_code_descriptions s ON s.code_domain = 'uomcod' AND s.code_value = stkuom
LEFT JOIN seed_jdawms_code_descriptions d ON d.code_domain = 'uomcod' AND d.code_value = dspuom
""")

# --- streams ------------------------------------------------------------------------------------

step("stream_event_upsert", "SELECT * FROM stg_event_log")
step(
    "stream_bursts",
    """
SELECT customer_key, started_at_utc, ended_at_utc, event_count,
       date_diff('minute', started_at_utc, ended_at_utc) AS burst_minutes
FROM (SELECT customer_key, min(event_at_utc) AS started_at_utc, max(event_at_utc) AS ended_at_utc,
             count(*) AS event_count
      FROM (SELECT *, count(*) FILTER (event_at_utc - before_at > INTERVAL 60 MINUTE) OVER (
                PARTITION BY customer_key ORDER BY event_at_utc, entity_id) AS session
            FROM cycle_numbers)
      GROUP BY customer_key, session)
""",
)
step("stream_daily_demand", """
SELECT * FROM item_demand_daily
""")

step("read_large_envelope", "SELECT * FROM flatten_envelope")
step("flatten_to_parquet", """
SELECT entity_id, description_code, response, updated_at FROM flatten_envelope
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY updated_at DESC NULLS LAST) = 1
""")
step("seed_rows_and_rejects", """
SELECT 'row' AS kind, p_partkey AS id,
       '"' || p_name || '", ' || p_partkey || chr(10) || 'of ' || p_brand AS name
FROM part WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'reject', p_partkey, NULL FROM part WHERE p_partkey % 10 = 0
""")
step("refresh_cycles", "SELECT * FROM fct_order_cycles")
step("rebuilt_table", "SELECT * FROM fct_orders")
step("stored_failures", """
SELECT check_name, severity, failures FROM check_summary WHERE failures > 0
""")
step("stored_freshness", """
SELECT * FROM source_freshness_report WHERE source_name = 'system_event_log'
""")

# Queries whose step goes by another name.
ALIASES = {
    "cycle_bursts": "cycle_bursts_tuned",
    "cycle_dominant_app": "cycle_dominant_app_tuned",
}


def oracles(names) -> dict[str, str]:
    return {n: oracle(ALIASES.get(n, n)) for n in names if ALIASES.get(n, n) in STEPS}
