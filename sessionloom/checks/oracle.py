"""The queries of `queries.py` in SQL, over the same tables."""

from __future__ import annotations

from .adapter import END, MIDDLE, START
from .queries import MONTHS_END, MONTHS_START, SAMPLE

EVENTS = """
SELECT date_trunc('second', ts) AS event_time,
       CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
       CAST(k % 10 AS VARCHAR) AS product_id,
       CAST(k % 3 AS VARCHAR) AS category_id,
       CASE WHEN k % 10 <> 9 THEN concat('cat.', CAST(k % 10 % 3 AS VARCHAR)) END AS category_code,
       CASE WHEN k % 10 % 5 <> 0 THEN concat('brand', CAST(k % 10 % 4 AS VARCHAR)) END AS brand,
       CAST(k % 10 * 10 + k // 50 AS DOUBLE) AS price,
       CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN k = 7 THEN concat('shared-', CAST(day(ts) AS VARCHAR))
            WHEN k <> 8 THEN concat('s-', CAST(user_id AS VARCHAR), '-', CAST(day(ts) // 3 AS VARCHAR))
       END AS user_session
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

THREE_MONTHS = f"""
SELECT * REPLACE (event_time + to_months(CAST(user_id AS INTEGER) % 3) AS event_time) FROM ({EVENTS})
"""

COLUMNS = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
KEYS = "event_time, event_type, product_id, user_id, user_session"
VARIANT = "product_id, category_code, brand, price, user_session"


def steps(start: str = START, end: str = END, events: str = EVENTS) -> str:
    """Common table expressions for each step up to the joined features."""
    return f"""
WITH ev AS ({events}),
bad AS (
  SELECT user_session, count(*) AS n FROM (SELECT DISTINCT user_session, user_id FROM ev)
  GROUP BY user_session HAVING count(*) > 1
),
cleaned AS (
  SELECT * FROM ev WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.user_session = ev.user_session)
),
kept AS (
  SELECT * FROM cleaned
  WHERE event_time >= TIMESTAMP '{start}' AND event_time <= TIMESTAMP '{end}'
),
per_product AS ({per_product("kept")}),
per_session AS ({per_session("kept")}),
joined AS (
  SELECT user_session, p.* EXCLUDE (user_session), s.* EXCLUDE (user_session)
  FROM per_product p JOIN per_session s USING (user_session)
),
history AS (
  SELECT *, CAST(coalesce(sum(num_views_product) OVER (
    PARTITION BY product_id, user_id
    ORDER BY temp_start_dt, user_session, category_code NULLS FIRST, brand NULLS FIRST, price NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS num_prev_product_views
  FROM joined
)
"""


def per_product(source: str) -> str:
    return f"""
  SELECT {VARIANT},
         max(CAST(event_type = 'purchase' AS INTEGER)) AS purchased,
         CAST(sum(CAST(event_type = 'view' AS INTEGER)) AS BIGINT) AS num_views_product
  FROM {source} WHERE event_type IN ('purchase', 'view') GROUP BY {VARIANT}
"""


def per_session(source: str) -> str:
    return f"""
  SELECT *,
         strftime(temp_start_dt, '%H:%M') AS start_time,
         strftime(temp_start_dt, '%A') AS start_weekday,
         CAST(epoch(temp_end_dt) AS BIGINT) - CAST(epoch(temp_start_dt) AS BIGINT) AS duration,
         count(user_session) OVER (
           PARTITION BY user_id ORDER BY temp_start_dt NULLS FIRST, user_session NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS num_prev_sessions
  FROM (
    SELECT user_session, user_id,
           count(DISTINCT CASE WHEN event_type = 'view' THEN product_id END) AS num_views_session,
           min(event_time) AS temp_start_dt, max(event_time) AS temp_end_dt
    FROM {source} GROUP BY user_session, user_id
  )
"""


EV = f"WITH ev AS ({EVENTS})"
STEPS = steps()
EVENT_ROWS = f"{EV} SELECT {COLUMNS} FROM ev"
CLEAN_ROWS = f"{STEPS} SELECT {COLUMNS} FROM cleaned"
FEATURES = "SELECT * EXCLUDE (temp_start_dt, temp_end_dt) FROM history"
SHARED_ROWS = "FROM ev WHERE EXISTS (SELECT 1 FROM bad WHERE bad.user_session = ev.user_session)"
FIRST_VIEWS = f"""{EV}
SELECT event_time, brand, price, user_id FROM ev WHERE event_type = 'view'
ORDER BY event_time, brand NULLS FIRST, price, user_id LIMIT 1000
"""


def _top_values(fields: tuple[str, ...] = ("event_type", "category_code", "brand")) -> str:
    per_field = [
        f"""SELECT '{field}' AS field, value, frequency FROM (
              SELECT {field} AS value, count(*) AS frequency FROM ev GROUP BY {field}
              ORDER BY frequency DESC, value NULLS FIRST LIMIT 5)"""
        for field in fields
    ]
    return f"{EV} {' UNION ALL '.join(per_field)}"


def _counts(condition: str) -> str:
    counts = [f"count(*) FILTER (WHERE {name} {condition}) AS {name}" for name in COLUMNS.split(", ")]
    return f"{EV} SELECT {', '.join(counts)} FROM ev"


def _months(table: str, column: str) -> str:
    return f"""
SELECT strftime(unnest(generate_series(
         date_trunc('month', min({column})), date_trunc('month', max({column})), INTERVAL 1 MONTH
       )), '%Y-%b') AS month
FROM {table}
"""


def _two_ranges() -> str:
    """Features of the second range in one computation over both, in which a session that the cut
    divides is one in either."""
    divided = f"""
SELECT * REPLACE (CASE WHEN user_session IS NOT NULL
    THEN concat(CASE WHEN event_time >= TIMESTAMP '{MIDDLE[1]}' THEN '2' ELSE '1' END, user_session) END AS user_session)
FROM ({EVENTS}) e WHERE user_session IS NULL OR user_session NOT IN (
  SELECT user_session FROM (SELECT DISTINCT user_session, user_id FROM ({EVENTS}))
  WHERE user_session IS NOT NULL GROUP BY user_session HAVING count(*) > 1)"""
    return f"""{steps(events=divided)}
SELECT * EXCLUDE (temp_start_dt, temp_end_dt) REPLACE (substr(user_session, 2) AS user_session)
FROM history WHERE user_session LIKE '2%'"""


ORACLES = {
    "src_csv_strings": f"""{EV}
        SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, event_type, product_id,
               category_id, category_code, brand, CAST(price AS VARCHAR) AS price, user_id, user_session
        FROM ev""",
    "src_csv_infer": f"""{EV}
        SELECT event_time, event_type, CAST(product_id AS BIGINT) AS product_id,
               CAST(category_id AS BIGINT) AS category_id, category_code, brand, price,
               CAST(user_id AS BIGINT) AS user_id, user_session
        FROM ev""",
    "src_typed_schema": EVENT_ROWS,
    "src_parse_event_time": f"{EV} SELECT {KEYS} FROM ev",
    "src_month_files": f"SELECT month || '.csv' AS filename FROM ({_months('orders', 'o_orderdate')})",
    "src_missing_months": f"""
        SELECT month FROM ({_months('lineitem', 'l_shipdate')}) required
        WHERE NOT EXISTS (
          SELECT 1 FROM orders WHERE strftime(o_orderdate, '%Y-%b') = required.month)""",
    "src_land_pending": f"SELECT {COLUMNS} FROM ({THREE_MONTHS})",
    "src_sample": f"""{EVENT_ROWS}
        WHERE CAST('0x' || substr(md5(coalesce(user_session, user_id, '')), 1, 8) AS BIGINT) < {SAMPLE} * 4294967296""",
    "snk_csv_overwrite": EVENT_ROWS,
    "snk_repartition": f"{EV} SELECT count(*) AS rows, greatest(10, count(*) // 200000) AS files FROM ev",
    "snk_rebalance": f"{EV} SELECT count(*) AS rows, TRUE AS bounded FROM ev",
    "snk_verify_files": f"{STEPS} SELECT count(*) AS written, count(*) AS found, TRUE AS bounded FROM history",
    "snk_verify": f"{STEPS} SELECT count(*) AS written, count(*) AS found FROM history",
    "snk_compression": f"{EV} SELECT count(*) AS rows, TRUE AS compressed FROM ev",
    "prof_row_count": f"""{STEPS}
        SELECT 'loaded' AS step, count(*) AS row_count FROM ev
        UNION ALL SELECT 'of one user', count(*) FROM cleaned
        UNION ALL SELECT 'in range', count(*) FROM kept
        UNION ALL SELECT 'product rows', count(*) FROM per_product""",
    "prof_non_null": _counts("IS NOT NULL"),
    "prof_null": _counts("IS NULL"),
    "prof_top_values": _top_values(),
    "prof_frequent_values": _top_values(("user_session", "user_id", "product_id")),
    "prof_distinct_sketches": f"WITH ev AS ({THREE_MONTHS}) " + " UNION ALL ".join(
        f"SELECT '{field}' AS field, count(DISTINCT {field}) AS \"distinct\" FROM ev"
        for field in ("product_id", "user_id", "user_session", "event_type", "category_code", "brand")
    ),
    "prof_approx_distinct": " UNION ALL ".join(
        f"SELECT '{field}' AS field, TRUE AS holds"
        for field in ("product_id", "user_id", "user_session", "event_type", "category_code", "brand")
    ),
    "prof_top_values_wide": f"""{EV}, top AS (
          SELECT coalesce(brand, 'null') AS label, count(*) AS n FROM ev GROUP BY brand
          ORDER BY n DESC, brand NULLS FIRST LIMIT 3)
        SELECT 'frequency' AS brand, max(n) FILTER (label = 'brand1') AS brand1,
               max(n) FILTER (label = 'brand3') AS brand3, max(n) FILTER (label = 'null') AS "null" FROM top""",
    "prof_dup_impact": f"""{STEPS}
        SELECT count(*) AS rows_to_delete, count(*) / (SELECT count(*) FROM ev) * 100 AS percent_to_delete
        {SHARED_ROWS}""",
    "prof_top_pair": f"""{STEPS}
        SELECT user_id, product_id, count(*) AS count FROM history GROUP BY user_id, product_id
        ORDER BY count DESC, user_id, product_id LIMIT 1""",
    "prof_pair_history": f"""{STEPS}, pair AS (
          SELECT user_id, product_id FROM history GROUP BY user_id, product_id
          ORDER BY count(*) DESC, user_id, product_id LIMIT 1)
        SELECT num_prev_sessions, num_views_product, num_prev_product_views, start_time, temp_start_dt
        FROM history JOIN pair USING (user_id, product_id)""",
    "flt_event_eq": f"{EVENT_ROWS} WHERE event_type = 'view'",
    "flt_event_in": f"{EVENT_ROWS} WHERE event_type IN ('purchase', 'view')",
    "flt_date_from": f"{EVENT_ROWS} WHERE event_time >= TIMESTAMP '{START}'",
    "flt_date_to": f"{EVENT_ROWS} WHERE event_time <= TIMESTAMP '{END}'",
    "flt_having": f"{STEPS} SELECT user_session, n AS count FROM bad",
    "flt_in_list": f"{STEPS} SELECT user_session, user_id {SHARED_ROWS}",
    "flt_not_in_list": f"{CLEAN_ROWS} WHERE user_session IS NOT NULL",
    "flt_point": f"{EVENT_ROWS} WHERE product_id = '3' AND user_id = '7'",
    "prj_select": f"{EV} SELECT {VARIANT}, event_type FROM ev",
    "prj_drop": f"{EV} SELECT * EXCLUDE (category_id, category_code) FROM ev",
    "prj_rename": f"{EV} SELECT category_code, count(*) AS frequency FROM ev GROUP BY category_code",
    "prj_with_column": f"""{EV}
        SELECT {KEYS}, strftime(event_time, '%H:%M') AS start_time,
               strftime(event_time, '%A') AS start_weekday FROM ev""",
    "prj_flag": f"""{EV}
        SELECT {KEYS}, CAST(event_type = 'purchase' AS INTEGER) AS purchased,
               CAST(event_type = 'view' AS INTEGER) AS viewed FROM ev""",
    "lim_n": FIRST_VIEWS,
    "jn_left_anti": CLEAN_ROWS,
    "jn_inner_equi": f"""{STEPS}
        SELECT * FROM ({per_product('cleaned')}) JOIN ({per_session('cleaned')}) USING (user_session)""",
    "jn_left_semi": f"{STEPS} SELECT {COLUMNS} {SHARED_ROWS}",
    "agg_distinct": f"{EV} SELECT DISTINCT user_session, user_id FROM ev",
    "agg_count": f"""{EV}
        SELECT user_session, count(*) AS count FROM (SELECT DISTINCT user_session, user_id FROM ev)
        GROUP BY user_session""",
    "agg_multi_key": f"""{EV}
        SELECT {VARIANT}, count(*) AS count FROM ev WHERE event_type IN ('purchase', 'view')
        GROUP BY {VARIANT}""",
    "agg_any_flag": f"{EV} SELECT * EXCLUDE (num_views_product) FROM ({per_product('ev')})",
    "agg_cond_sum": f"{EV} SELECT * EXCLUDE (purchased) FROM ({per_product('ev')})",
    "agg_cond_count_distinct": f"{EV} SELECT user_session, user_id, num_views_session FROM ({per_session('ev')})",
    "agg_min_max_time": f"{EV} SELECT user_session, user_id, temp_start_dt, temp_end_dt FROM ({per_session('ev')})",
    "win_running_count": f"""{EV}
        SELECT user_session, user_id, temp_start_dt, num_prev_sessions FROM ({per_session('ev')})""",
    "win_running_sum": f"""{EV}
        SELECT *, CAST(coalesce(sum(num_views_product) OVER (
                 PARTITION BY product_id, user_id ORDER BY temp_start_dt, user_session NULLS FIRST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS num_prev_product_views
        FROM (
          SELECT user_session, user_id, product_id,
                 CAST(sum(CAST(event_type = 'view' AS INTEGER)) AS BIGINT) AS num_views_product,
                 min(event_time) AS temp_start_dt
          FROM ev GROUP BY user_session, user_id, product_id
        )""",
    "win_session_level": f"""{STEPS}
        SELECT * EXCLUDE (temp_start_dt, temp_end_dt, num_prev_product_views),
               CAST(coalesce(sum(num_views_product) OVER (
                 PARTITION BY product_id, user_id ORDER BY temp_start_dt, user_session
                 GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS num_prev_product_views
        FROM history""",
    "win_history_start": _two_ranges(),
    "fn_time_hhmm": f"{EV} SELECT {KEYS}, strftime(event_time, '%H:%M') AS start_time FROM ev",
    "fn_weekday": f"{EV} SELECT {KEYS}, strftime(event_time, '%A') AS start_weekday FROM ev",
    "fn_epoch_diff": f"{EV} SELECT user_session, user_id, duration FROM ({per_session('ev')})",
    "fn_when": f"{EV} SELECT {KEYS}, CASE WHEN event_type = 'view' THEN brand END AS viewed_brand FROM ev",
    "fn_coalesce": f"""{EV}
        SELECT user_id, product_id,
               CAST(coalesce(sum(CASE WHEN event_type = 'view' THEN 1 END), 0) AS BIGINT) AS views
        FROM ev GROUP BY user_id, product_id""",
    "fn_cast_int": f"""{EV}
        SELECT {KEYS}, CAST(event_type IN ('purchase', 'view') AS INTEGER) AS is_product_event FROM ev""",
    "fn_compare_bool": f"""{EV}
        SELECT {KEYS}, event_type = 'view' AS is_view, event_type <> 'view' AS is_no_view,
               event_time >= TIMESTAMP '{START}' AS from_start,
               event_time <= TIMESTAMP '{END}' AS to_end, price > 50 AS over_50 FROM ev""",
    "fn_month_label": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%b') AS month FROM orders",
    "srt_sort": f"{STEPS} SELECT user_session, user_id {SHARED_ROWS} ORDER BY user_session",
    "srt_top_k": f"""{EV}
        SELECT user_id, product_id, count(*) AS frequency FROM ev GROUP BY user_id, product_id
        ORDER BY frequency DESC, user_id, product_id LIMIT 5""",
    "opt_conditional_cache": f"{STEPS} SELECT * FROM joined",
    "opt_cache_features": f"{STEPS} {FEATURES}".replace(
        "FROM history", ", (SELECT count(*) FROM history) AS observed_rows FROM history"
    ),
    "clean_sessions": CLEAN_ROWS,
    "features_product": f"{STEPS} SELECT * FROM per_product",
    "features_session": f"{STEPS} SELECT * FROM per_session",
    "features_session_product": f"{STEPS} SELECT * FROM history",
    "feature_table": f"{STEPS} {FEATURES}",
    "etl_run": f"{steps(MONTHS_START, MONTHS_END, THREE_MONTHS)} {FEATURES}",
    "etl_cloud_min": f"{EV} SELECT event_time, brand, price, user_id FROM ev WHERE event_type = 'view'",
}
