"""SQL twins of the registered queries, for DuckDB over the same tables.

``CTES`` states the shared inputs once; a twin pulls in the ones it names.
"""

from __future__ import annotations

import re

from stockweave.params import CLUSTER_FEATURES, URGENCY
from stockweave.sources.adapter import CALENDAR

ORACLE: dict[str, str] = {}

MIN_ORDERS, MIN_SUPPORT, MIN_LIFT, MIN_CONFIDENCE = 100, 0.02, 1.2, 0.2
EPS, MIN_SAMPLES = 1.2, 10


def mixed(key: str, salt: int) -> str:
    h = f"((({key}) % 2147483647 + 2147483647) % 2147483647 + {salt + 1})"
    for factor in (48271, 69621, 16807):
        h = f"(({h} * {factor} + {salt + 11}) % 2147483647)"
    return h


def values(rows) -> str:
    return "(VALUES " + ", ".join(f"({r})" for r in rows) + ")"


FESTIVALS = values(f"DATE '{d}'" for d in CALENDAR.festivals)
WINDOWS = values(f"DATE '{a}', DATE '{b}'" for a, b in CALENDAR.windows)
URGENCY_ROWS = values(f"{k}, '{v[0]}', '{v[1]}'" for k, v in URGENCY.items())

NEXT_FESTIVAL = f"least(coalesce((SELECT min(f.d) FROM {FESTIVALS} f(d) WHERE f.d >= {{day}}) - {{day}}, 30), 30)"
SLOT = (
    "CASE WHEN {h} BETWEEN 6 AND 11 THEN 'morning' WHEN {h} BETWEEN 12 AND 17 THEN 'afternoon' "
    "WHEN {h} BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END"
)
TEMP_BIN = (
    "CASE WHEN temp_max > -999 AND temp_max <= 20 THEN 'cold' WHEN temp_max > 20 AND temp_max <= 30 THEN 'mild' "
    "WHEN temp_max > 30 AND temp_max <= 999 THEN 'hot' END"
)
RAIN_BIN = (
    "CASE WHEN precipitation > -1 AND precipitation <= 1 THEN 'dry' WHEN precipitation > 1 AND precipitation <= 10 "
    "THEN 'drizzle' WHEN precipitation > 10 AND precipitation <= 9999 THEN 'heavy' END"
)
LEVEL = (
    "CAST(CASE WHEN forecast_units <= 0 THEN 1 WHEN forecast_units > current_stock AND days_to_festival <= 3 THEN 5 "
    "WHEN forecast_units > current_stock * CAST(0.8 AS DOUBLE) THEN 4 "
    "WHEN forecast_units > current_stock * CAST(0.6 AS DOUBLE) THEN 3 ELSE 2 END AS INTEGER)"
)
SLICE = "segment, time_slot, weather_bin"


def on(a: str, b: str, cols: str = SLICE) -> str:
    return " AND ".join(f"{a}.{c.strip()} = {b}.{c.strip()}" for c in cols.split(","))


def spread(a: str, b: str) -> str:
    return " + ".join(f"({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f})" for f in CLUSTER_FEATURES)


CTES: dict[str, str] = {
    "ords": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN o_orderstatus = 'P' THEN 'train' ELSE 'prior' END AS eval_set,
               CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
               CAST((o_orderkey * 7 + o_custkey) % 24 AS INTEGER) AS order_hour_of_day,
               CAST(row_number() OVER w AS INTEGER) AS order_number,
               CAST(CAST(o_orderdate AS DATE) - lag(CAST(o_orderdate AS DATE)) OVER w AS DOUBLE)
                 AS days_since_prior_order
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "ordlines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_orderkey <> first_value(l_orderkey) OVER
                 (PARTITION BY o_custkey, l_partkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS reordered
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "master": """
        SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order,
               product_id, p_name AS product_name, reordered, p_type AS aisle, p_brand AS department, order_date
        FROM ords JOIN ordlines USING (order_id) JOIN part ON product_id = p_partkey
        WHERE eval_set = 'prior'""",
    "heads": """
        SELECT DISTINCT order_id, user_id, order_number, order_dow, order_hour_of_day,
               days_since_prior_order, order_date FROM master""",
    "days": """
        SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date
        FROM orders""",
    "wx_raw": """
        SELECT date,
               CAST(CASE WHEN dayofyear(date) % 150 <> 0 THEN 15 + (dayofyear(date) * 7) % 21 END AS DOUBLE) AS temp_max,
               CAST(CASE WHEN dayofyear(date) % 100 <> 0 THEN greatest(0, (dayofyear(date) * 13) % 23 - 8) END AS DOUBLE)
                 AS precipitation,
               CAST(dayofyear(date) % 4 AS INTEGER) AS weathercode
        FROM days""",
    "wx": f"SELECT *, {TEMP_BIN} AS temp_bin, {RAIN_BIN} AS rain_bin FROM wx_raw",
    "cal": f"""
        SELECT date, CAST(date IN (SELECT d FROM {FESTIVALS} f(d)) AS INTEGER) AS is_festival,
               CAST({NEXT_FESTIVAL.format(day='date')} AS INTEGER) AS days_to_festival,
               CAST(EXISTS (SELECT 1 FROM {WINDOWS} w(a, b) WHERE date BETWEEN w.a AND w.b) AS INTEGER) AS is_ipl_match_day,
               CAST(month(date) IN (3, 4, 10, 11) AS INTEGER) AS is_exam_season,
               CAST(month(date) IN (6, 7, 8, 9) AS INTEGER) AS is_monsoon,
               CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend
        FROM days""",
    "ctx": """
        SELECT order_id, user_id, order_date, temp_bin, rain_bin, temp_max, precipitation, is_festival,
               days_to_festival, is_ipl_match_day, is_exam_season, is_monsoon, is_weekend
        FROM heads LEFT JOIN wx ON order_date = wx.date LEFT JOIN cal ON order_date = cal.date""",
    "demo": """
        SELECT c_custkey AS user_id, CAST(c_nationkey AS VARCHAR) AS pin_code, n_name AS city, r_name AS store_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "seg": """
        SELECT c_custkey AS user_id, c_mktsegment AS cluster_name,
               CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS cluster_id FROM customer""",
    "stores": """
        SELECT user_id, pin_code, city, store_id FROM (SELECT DISTINCT user_id FROM ords) LEFT JOIN demo USING (user_id)""",
    "rfm": """
        SELECT u.user_id, max(days_active) OVER () - days_active AS recency, frequency,
               avg_basket_size * reorder_ratio AS monetary_proxy, avg_basket_size, reorder_ratio,
               night_owl_score, weekend_concentration, avg_order_hour, organic_affinity, avg_days_between_orders
        FROM (SELECT user_id, coalesce(sum(days_since_prior_order), 0) AS days_active, count(*) AS frequency,
                     avg(CASE WHEN order_hour_of_day IN (22, 23, 0, 1, 2, 3) THEN 1 ELSE 0 END) AS night_owl_score,
                     avg(CASE WHEN order_dow IN (0, 6) THEN 1 ELSE 0 END) AS weekend_concentration,
                     avg(order_hour_of_day) AS avg_order_hour,
                     coalesce(avg(days_since_prior_order), 0) AS avg_days_between_orders
              FROM heads GROUP BY user_id) u
        JOIN (SELECT user_id, count(*) / count(DISTINCT order_id) AS avg_basket_size, avg(reordered) AS reorder_ratio,
                     avg(CASE WHEN regexp_matches(lower(product_name), 'red') THEN 1 ELSE 0 END) AS organic_affinity
              FROM master GROUP BY user_id) l ON u.user_id = l.user_id""",
    "uctx": """
        SELECT user_id, avg(temp_max) AS avg_temp_max,
               avg(CASE WHEN precipitation > 1 THEN 1 ELSE 0 END) AS pct_rainy_orders,
               avg(is_festival) AS pct_festival_orders, avg(is_ipl_match_day) AS pct_ipl_orders,
               avg(is_monsoon) AS pct_monsoon_orders
        FROM ctx GROUP BY user_id""",
    "fstore": "SELECT * FROM rfm LEFT JOIN demo USING (user_id) LEFT JOIN uctx USING (user_id)",
    "daily": """
        SELECT order_date, store_id, product_name, count(*) AS units_sold
        FROM master JOIN demo USING (user_id) GROUP BY ALL""",
    "tops": """
        SELECT product_name FROM daily GROUP BY product_name ORDER BY sum(units_sold) DESC, product_name LIMIT 50""",
    "kept": "SELECT * FROM daily WHERE product_name IN (SELECT product_name FROM tops)",
    "spine": """
        SELECT CAST(d.order_date AS DATE) AS order_date, s.store_id, s.product_name,
               CAST(coalesce(k.units_sold, 0) AS BIGINT) AS units_sold
        FROM (SELECT CAST(unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), CAST(max(order_date) AS TIMESTAMP),
                INTERVAL 1 DAY)) AS DATE) AS order_date FROM daily) d
        CROSS JOIN (SELECT DISTINCT store_id, product_name FROM daily) s
        LEFT JOIN daily k ON k.order_date = d.order_date AND k.store_id = s.store_id AND k.product_name = s.product_name""",
    "rolled": """
        SELECT *, lag(units_sold, 1) OVER w AS lag_1d, lag(units_sold, 7) OVER w AS lag_7d,
               lag(units_sold, 14) OVER w AS lag_14d, lag(units_sold, 30) OVER w AS lag_30d,
               avg(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7d_mean,
               coalesce(stddev_samp(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS rolling_7d_std,
               avg(units_sold) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_30d_mean
        FROM spine WINDOW w AS (PARTITION BY store_id, product_name ORDER BY order_date)""",
    "lagged": "SELECT * FROM rolled WHERE lag_30d IS NOT NULL",
    "placed": """
        SELECT *, row_number() OVER (ORDER BY order_date, store_id, product_name) AS position, count(*) OVER () AS n
        FROM lagged WHERE units_sold > 0""",
    "folds": """
        SELECT *, CASE WHEN position - 1 >= n - 5 * (n // 6)
                       THEN CAST((position - 1 - (n - 5 * (n // 6))) // (n // 6) + 1 AS INTEGER) END AS test_fold
        FROM placed""",
    "fc": """
        SELECT order_date, store_id, product_name, units_sold, CAST(lag_7d AS INTEGER) AS forecast_units,
               'seasonal_naive' AS model_type
        FROM lagged""",
    "latest": """
        SELECT * FROM fc QUALIFY row_number() OVER (PARTITION BY store_id, product_name ORDER BY order_date DESC) = 1""",
    "stock": """
        SELECT store_id, product_name, CAST(round_even(avg(units_sold) * CAST(0.8 AS DOUBLE), 0) AS INTEGER) AS current_stock
        FROM fc WHERE units_sold > 0 GROUP BY ALL""",
    "dominant": """
        SELECT store_id, cluster_name AS dominant_segment
        FROM (SELECT store_id, cluster_name, count(*) AS n FROM demo JOIN seg USING (user_id) GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY n DESC, cluster_name) = 1""",
    "lastday": """
        SELECT date, days_to_festival,
               CASE WHEN is_festival = 1 THEN 'festival_soon' WHEN is_ipl_match_day = 1 THEN 'ipl_season'
                    WHEN is_monsoon = 1 THEN 'monsoon' ELSE 'normal' END AS event_context
        FROM cal QUALIFY row_number() OVER (ORDER BY date DESC) = 1""",
    "enr": f"""
        SELECT order_id, user_id, product_name, department, cluster_name AS segment,
               {SLOT.format(h='order_hour_of_day')} AS time_slot, coalesce(rain_bin, 'nan') AS weather_bin
        FROM master JOIN seg USING (user_id) LEFT JOIN wx ON order_date = wx.date""",
    "slice_n": f"""
        SELECT {SLICE}, count(DISTINCT order_id) AS n_orders FROM enr GROUP BY {SLICE}
        HAVING count(DISTINCT order_id) >= {MIN_ORDERS}""",
    "cap": f"""
        SELECT {SLICE}, order_id, least(n, 150) AS n_orders
        FROM (SELECT *, count(*) OVER (PARTITION BY {SLICE}) AS n,
                     row_number() OVER (PARTITION BY {SLICE} ORDER BY {mixed('order_id', 42)}, order_id) AS r
              FROM (SELECT DISTINCT {SLICE}, order_id FROM enr))
        WHERE n >= {MIN_ORDERS} AND r <= 150""",
    "capped_top": f"""
        SELECT {SLICE}, item, cnt, n_orders, r - 1 AS rank
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {SLICE} ORDER BY cnt DESC, item) AS INTEGER) AS r
              FROM (SELECT {SLICE}, product_name AS item, count(DISTINCT order_id) AS cnt, any_value(n_orders) AS n_orders
                    FROM enr JOIN cap USING ({SLICE}, order_id) GROUP BY {SLICE}, product_name))
        WHERE r <= 50""",
    "enr_all": "SELECT order_id, department, 'all' AS scope FROM enr",
    "slice_all": "SELECT scope, count(DISTINCT order_id) AS n_orders FROM enr_all GROUP BY scope",
    "overall": "SELECT antecedent, consequent, lift AS global_lift FROM all_rules",
    "zraw": "SELECT user_id, " + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in CLUSTER_FEATURES) + " FROM fstore",
    "zmed": "SELECT " + ", ".join(f"quantile_cont({f}, 0.5) AS {f}" for f in CLUSTER_FEATURES) + " FROM zraw",
    "zfill": "SELECT r.user_id, "
    + ", ".join(f"coalesce(r.{f}, m.{f}) AS {f}" for f in CLUSTER_FEATURES)
    + " FROM zraw r CROSS JOIN zmed m",
    "z": "SELECT user_id, "
    + ", ".join(
        f"({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () > 0 THEN stddev_pop({f}) OVER () ELSE 1 END AS {f}"
        for f in CLUSTER_FEATURES
    )
    + " FROM zfill",
    "zl": "SELECT * FROM z JOIN seg USING (user_id)",
    "prof": "SELECT cluster_id, " + ", ".join(f"avg({f}) AS {f}" for f in CLUSTER_FEATURES)
    + " FROM zraw JOIN seg USING (user_id) GROUP BY cluster_id",
}


def mining_ctes(
    tag: str, item: str, keys: str = SLICE, source: str = "enr", sizes: str = "slice_n",
    least_confidence: float = MIN_CONFIDENCE, least_lift: float = MIN_LIFT,
) -> None:
    """Frequent itemsets of every size and their rules, over ``item``: all subsets of all baskets."""
    names = [k.strip() for k in keys.split(",")]

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{k} = {b}.{k}" for k in names)

    CTES[f"{tag}_top"] = f"""
        SELECT {keys}, {item} AS item, count(DISTINCT order_id) AS c, any_value(n_orders) AS n_orders
        FROM {source} JOIN {sizes} USING ({keys}) GROUP BY {keys}, {item}
        HAVING count(DISTINCT order_id) / any_value(n_orders) >= {MIN_SUPPORT}"""
    CTES[f"{tag}_in"] = f"""
        SELECT DISTINCT {keys}, order_id, {item} AS item, n_orders FROM {source}
        JOIN (SELECT {keys}, item AS {item}, n_orders FROM {tag}_top) USING ({keys}, {item})"""
    CTES[f"{tag}_baskets"] = f"""
        SELECT {keys}, items, n_orders, count(*) AS weight FROM (
            SELECT {keys}, order_id, list(item ORDER BY item) AS items, any_value(n_orders) AS n_orders
            FROM {tag}_in GROUP BY {keys}, order_id) GROUP BY ALL"""
    CTES[f"{tag}_lists"] = f"""
        SELECT {keys}, s, CAST(sum(weight) AS BIGINT) AS c, any_value(n_orders) AS n_orders FROM (
            SELECT {keys}, weight, n_orders, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS s
            FROM (SELECT *, unnest(range(1, 1 << len(items))) AS m FROM {tag}_baskets))
        GROUP BY {keys}, s HAVING sum(weight) / any_value(n_orders) >= {MIN_SUPPORT}"""
    CTES[f"{tag}_sets"] = f"""
        SELECT {keys}, array_to_string(s, ', ') AS itemset, CAST(len(s) AS INTEGER) AS n_items, c, n_orders FROM {tag}_lists"""
    CTES[f"{tag}_rules"] = f"""
        SELECT s.antecedent, s.consequent, s.c / s.n_orders AS support, s.c / l.c AS confidence,
               (CAST(s.c AS DOUBLE) * s.n_orders) / (CAST(l.c AS DOUBLE) * r.c) AS lift,
               {', '.join('s.' + k for k in names)}, s.n_left
        FROM (SELECT {keys}, c, n_orders, bit_count(m) AS n_left,
                     array_to_string(list_filter(s, lambda x, i: (m >> (i - 1)) & 1 = 1), ', ') AS antecedent,
                     array_to_string(list_filter(s, lambda x, i: (m >> (i - 1)) & 1 = 0), ', ') AS consequent
              FROM (SELECT *, unnest(range(1, (1 << len(s)) - 1)) AS m FROM {tag}_lists WHERE len(s) > 1)) s
        JOIN {tag}_sets l ON {same('s', 'l')} AND l.itemset = s.antecedent
        JOIN {tag}_sets r ON {same('s', 'r')} AND r.itemset = s.consequent
        WHERE s.c / l.c >= {least_confidence}
          AND (CAST(s.c AS DOUBLE) * s.n_orders) / (CAST(l.c AS DOUBLE) * r.c) >= {least_lift}"""
    CTES[f"{tag}_best"] = f"""
        SELECT antecedent, consequent, lift FROM {tag}_rules WHERE n_left = 1
        QUALIFY row_number() OVER (PARTITION BY antecedent ORDER BY lift DESC, consequent) = 1"""


mining_ctes("brand", "department")
mining_ctes("name", "product_name")
mining_ctes("all", "department", "scope", "enr_all", "slice_all", 0.0, 0.0)

ACTIONS = f"""
    SELECT a.store_id, a.product_name, forecast_units, units_sold, current_stock,
           CAST(greatest(forecast_units - current_stock, 0) AS INTEGER) AS reorder_qty,
           u.level AS urgency, u.label AS urgency_label, u.color AS urgency_color, dominant_segment,
           b.consequent AS bundle_with, round(b.lift, 6) AS bundle_lift, event_context, days_to_festival,
           TIMESTAMP '2001-08-01 09:00:00' AS generated_at
    FROM (SELECT *, {LEVEL} AS level FROM {{rows}}) a
    JOIN {URGENCY_ROWS} u(level, label, color) ON a.level = u.level
    LEFT JOIN dominant d ON a.store_id = d.store_id LEFT JOIN name_best b ON a.product_name = b.antecedent"""
CTES["acts"] = ACTIONS.format(rows="latest JOIN stock USING (store_id, product_name) CROSS JOIN lastday")
CTES["context_days"] = """
    SELECT date AS order_date, days_to_festival,
           CASE WHEN is_festival = 1 THEN 'festival_soon' WHEN is_ipl_match_day = 1 THEN 'ipl_season'
                WHEN is_monsoon = 1 THEN 'monsoon' ELSE 'normal' END AS event_context FROM cal"""
CTES["fc_until"] = "SELECT * FROM fc WHERE order_date <= DATE '1999-10-20'"
CTES["acts_as_of"] = ACTIONS.format(rows="""
    (SELECT * FROM fc_until QUALIFY row_number() OVER (PARTITION BY store_id, product_name ORDER BY order_date DESC) = 1)
    JOIN (SELECT store_id, product_name, CAST(round_even(avg(units_sold) * CAST(0.8 AS DOUBLE), 0) AS INTEGER) AS current_stock
          FROM fc_until WHERE units_sold > 0 GROUP BY ALL) USING (store_id, product_name)
    LEFT JOIN context_days USING (order_date)""")

# Inputs that several later steps read: computed once.
SHARED = {"ords", "master", "heads", "daily", "spine", "rolled", "lagged", "enr", "fstore", "z", "zl",
          "brand_in", "brand_lists", "brand_sets", "brand_rules", "name_in", "name_lists", "name_sets", "name_rules",
          "all_lists", "all_sets", "all_rules", "acts", "acts_as_of", "fc_until"}


def with_ctes(body: str) -> str:
    order: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in order:
                need(CTES[word])
                if word not in order:
                    order.append(word)

    need(body)
    if not order:
        return body
    parts = [f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}({CTES[n]})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def twin(name: str, body: str) -> None:
    ORACLE[name] = with_ctes(body)


MASTER = (
    "order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order, product_id, "
    "product_name, reordered, aisle, department"
)

# ---- scans, sources, sinks
twin("scan_csv_roundtrip", f"SELECT {MASTER} FROM master")
twin("scan_csv_pruned", "SELECT user_id, count(*) AS orders FROM ords GROUP BY user_id")
twin("scan_parquet", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem")
twin("sink_parquet_roundtrip", "SELECT * FROM daily")
twin("weather_json_explode", """
    SELECT CAST(ts AS DATE) AS date, value AS temp_max, CASE WHEN event_id % 3 <> 0 THEN value END AS precipitation,
           CAST(user_id % 100 AS INTEGER) AS weathercode FROM events""")
twin("calendar_spine", """
    SELECT date, count(order_id) AS orders FROM days LEFT JOIN ords ON order_date = date GROUP BY date""")

# ---- master, dimensions, calendar
twin("product_dim", """
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS aisle, p_brand AS department FROM part""")
twin("master_transactions", f"SELECT {MASTER} FROM master")
twin("orders_distinct", """
    SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order FROM heads""")
twin("store_assignment", "SELECT * FROM stores")
CTES["cal_orders"] = """
    SELECT cal.*, coalesce(n, 0) AS orders
    FROM cal LEFT JOIN (SELECT order_date, count(*) AS n FROM ords GROUP BY order_date) o ON cal.date = o.order_date"""
twin("event_calendar", "SELECT * FROM cal_orders")
twin("event_calendar_summary", """
    SELECT count(*) AS calendar_days, CAST(sum(is_festival) AS BIGINT) AS festival_days,
           CAST(sum(is_ipl_match_day) AS BIGINT) AS season_days,
           CAST(sum(orders * is_festival) AS BIGINT) AS festival_orders,
           CAST(sum(orders * is_ipl_match_day) AS BIGINT) AS season_orders FROM cal_orders""")
twin("days_to_festival", f"""
    SELECT order_id, order_date, CAST({NEXT_FESTIVAL.format(day='order_date')} AS INTEGER) AS days_to_festival FROM ords""")
twin("calendar_parts", """
    SELECT order_id, order_date, CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week,
           CAST(month(order_date) AS INTEGER) AS month, CAST(week(order_date) AS INTEGER) AS week_of_year FROM ords""")
twin("weather_bins", """
    SELECT order_id, temp_max, precipitation, temp_bin, rain_bin FROM ords JOIN wx ON order_date = wx.date
    WHERE eval_set = 'prior'""")
twin("time_slots", f"SELECT order_id, order_hour_of_day, {SLOT.format(h='order_hour_of_day')} AS time_slot FROM ords")
twin("latest_event_context", "SELECT * FROM lastday")

# ---- features
twin("order_dates", f"""
    SELECT order_id, user_id, order_number,
           least(first_day + CAST(sum(coalesce(days_since_prior_order, 0))
             OVER (PARTITION BY user_id ORDER BY order_number) AS INTEGER), DATE '2001-06-30') AS order_date
    FROM heads JOIN (SELECT user_id, min(order_date) AS first_day FROM ords GROUP BY user_id) USING (user_id)""")
twin("order_context", "SELECT * FROM ctx")
RFM_COLS = ", ".join(
    c if c == "frequency" else f"round({c}, 6) AS {c}"
    for c in ("recency", "frequency", "monetary_proxy", "avg_basket_size", "reorder_ratio", "night_owl_score",
              "weekend_concentration", "avg_order_hour", "organic_affinity", "avg_days_between_orders")
)
CTX_COLS = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in ("avg_temp_max", "pct_rainy_orders", "pct_festival_orders", "pct_ipl_orders", "pct_monsoon_orders")
)
twin("user_rfm", f"SELECT user_id, {RFM_COLS} FROM rfm")
twin("user_context", f"SELECT user_id, {CTX_COLS} FROM uctx")
twin("feature_store", f"""
    SELECT user_id, {RFM_COLS}, pin_code, city, store_id, {CTX_COLS} FROM fstore""")
twin("user_rfm_90d", """
    SELECT user_id, CAST(max(t) - max(order_date) AS INTEGER) AS days_since_last_order,
           count(*) FILTER (WHERE t - order_date < 90) AS orders_90d
    FROM (SELECT *, max(order_date) OVER () AS t FROM ords WHERE eval_set = 'prior') GROUP BY user_id""")

# ---- profile
twin("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM master" for c in ("user_id", "order_id", "product_id")
))
twin("value_counts", "SELECT store_id, count(*) AS n FROM demo GROUP BY store_id")
twin("value_counts_rain", "SELECT rain_bin, count(*) AS n FROM ctx GROUP BY rain_bin")
twin("value_counts_product", "SELECT product_name, count(*) AS n FROM master GROUP BY product_name")
twin("null_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c.strip()}' AS \"column\", count(*) FILTER (WHERE {c.strip()} IS NULL) AS nulls FROM master"
    for c in MASTER.split(",")
) + ") WHERE nulls > 0")
twin("orders_by_dow", """
    SELECT order_dow, orders, CAST(row_number() OVER (ORDER BY orders DESC, order_dow) = 1 AS INTEGER) AS is_peak,
           ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][order_dow + 1] AS label
    FROM (SELECT order_dow, count(*) AS orders FROM heads GROUP BY order_dow)""")
twin("orders_by_hour", """
    SELECT order_hour_of_day, orders,
           CAST(row_number() OVER (ORDER BY orders DESC, order_hour_of_day) = 1 AS INTEGER) AS is_peak
    FROM (SELECT order_hour_of_day, count(*) AS orders FROM heads GROUP BY order_hour_of_day)""")
twin("top_products", """
    SELECT product_name, count(*) AS n FROM master GROUP BY product_name ORDER BY n DESC, product_name LIMIT 50""")


def described(column: str, source: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    quart = ", ".join(f"round(quantile_cont({x}, {q}), 6) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    return f"""SELECT count({column}) AS n, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std,
        round(min({x}), 6) AS min, {quart}, round(max({x}), 6) AS max FROM ({source})"""


SIZES = "SELECT order_id, count(*) AS basket_size FROM master GROUP BY order_id"
RATES = "SELECT user_id, avg(reordered) AS reorder_rate FROM master GROUP BY user_id"
twin("basket_size_stats", described("basket_size", SIZES))
twin("reorder_rate_stats", described("reorder_rate", RATES))


def binned(column: str, source: str, bins: int, low: str, high: str) -> str:
    return f"""
        SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) + 1 AS INTEGER) AS bin, count(*) AS n
        FROM (SELECT CAST({column} AS DOUBLE) AS x, {low} AS lo, {high} AS hi FROM ({source}))
        WHERE x BETWEEN lo AND hi GROUP BY bin"""


twin("hist_basket_size", binned("basket_size", SIZES, 50, "1.0::DOUBLE", "60.0::DOUBLE"))
twin("hist_gap_days", binned("days_since_prior_order", "SELECT * FROM heads", 30,
                             "min(days_since_prior_order) OVER ()", "max(days_since_prior_order) OVER ()"))
twin("hist_reorder_rate", binned("reorder_rate", RATES, 40, "min(reorder_rate) OVER ()", "max(reorder_rate) OVER ()"))
twin("gap_peaks", """
    SELECT count(*) FILTER (WHERE days_since_prior_order = 7) AS gap_7,
           count(*) FILTER (WHERE days_since_prior_order = 30) AS gap_30 FROM heads""")
twin("dept_hour_heatmap", "SELECT department, " + ", ".join(
    f"round(max(CASE WHEN order_hour_of_day = {h} THEN n ELSE 0 END) / max(n), 6) AS h{h:02d}" for h in range(24)
) + " FROM (SELECT department, order_hour_of_day, count(*) AS n FROM master GROUP BY ALL) GROUP BY department")
CTES["thirty"] = """
    SELECT product_name AS item FROM master GROUP BY product_name ORDER BY count(*) DESC, product_name LIMIT 30"""
CTES["bought"] = "SELECT DISTINCT order_id, product_name AS item FROM master WHERE product_name IN (SELECT item FROM thirty)"
CTES["grid"] = """
    SELECT o.order_id, t.item, CASE WHEN b.item IS NULL THEN 0 ELSE 1 END AS x
    FROM (SELECT DISTINCT order_id FROM bought) o CROSS JOIN thirty t
    LEFT JOIN bought b ON b.order_id = o.order_id AND b.item = t.item"""
SHARED.add("grid")
twin("copurchase_corr", """
    SELECT a.item AS product_a, b.item AS product_b,
           CAST(sum(a.x * b.x) AS BIGINT) AS n_ab, round(corr(a.x, b.x), 6) AS correlation
    FROM grid a JOIN grid b ON a.order_id = b.order_id AND a.item < b.item GROUP BY a.item, b.item""")

# ---- demand
twin("daily_demand", "SELECT * FROM daily")
twin("demand_top_skus", "SELECT * FROM kept")
twin("demand_spine", "SELECT * FROM spine")
LAGS = "lag_1d, lag_7d, lag_14d, lag_30d"
ROLLS = ", ".join(f"round({c}, 6) AS {c}" for c in ("rolling_7d_mean", "rolling_7d_std", "rolling_30d_mean"))
twin("demand_lags", f"SELECT order_date, store_id, product_name, units_sold, {LAGS} FROM lagged")
twin("demand_rolling", f"SELECT order_date, store_id, product_name, units_sold, {ROLLS} FROM rolled")
twin("label_encode", """
    SELECT *, CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_enc,
           CAST(dense_rank() OVER (ORDER BY product_name) - 1 AS INTEGER) AS sku_enc FROM daily""")
twin("demand_features", f"""
    SELECT order_date, store_id, product_name, units_sold, temp_max, precipitation, rain_bin, is_festival,
           days_to_festival, is_ipl_match_day, is_exam_season, is_monsoon, is_weekend, {ROLLS}, {LAGS},
           CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week, CAST(month(order_date) AS INTEGER) AS month,
           CAST(week(order_date) AS INTEGER) AS week_of_year,
           CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_enc,
           CAST(dense_rank() OVER (ORDER BY product_name) - 1 AS INTEGER) AS sku_enc,
           CAST(dense_rank() OVER (ORDER BY coalesce(rain_bin, 'nan')) - 1 AS INTEGER) AS rain_enc
    FROM lagged LEFT JOIN wx ON order_date = wx.date LEFT JOIN cal ON order_date = cal.date""")
twin("event_uplift", """
    SELECT product_name, round(a, 6) AS event_mean, round(b, 6) AS normal_mean, round(a / nullif(b, 0), 6) AS uplift
    FROM (SELECT product_name, avg(units_sold) FILTER (WHERE is_festival = 1) AS a,
                 avg(units_sold) FILTER (WHERE is_festival = 0) AS b
          FROM spine JOIN cal ON order_date = date GROUP BY product_name)""")
twin("demand_by_pin", """
    SELECT pin_code, store_id, count(*) AS units, count(DISTINCT order_id) AS orders
    FROM master JOIN demo USING (user_id) GROUP BY ALL""")

# ---- forecast
twin("time_series_folds", """
    SELECT order_date, store_id, product_name, units_sold, position, test_fold FROM folds""")
APE = "avg(abs(units_sold - {p}) / (units_sold + 1.0::DOUBLE)) * 100"
twin("naive_baseline", f"""
    SELECT test_fold, count(*) AS test_rows, round({APE.format(p='lag_7d')}, 6) AS naive_mape
    FROM folds WHERE test_fold IS NOT NULL GROUP BY test_fold""")
twin("forecast_accuracy", f"""
    SELECT round(avg(m), 6) AS mape, round(avg(b), 6) AS naive_mape,
           round((avg(b) - avg(m)) / avg(b) * 100, 6) AS improvement_pct
    FROM (SELECT test_fold, {APE.format(p='rolling_30d_mean')} AS m, {APE.format(p='lag_7d')} AS b
          FROM folds WHERE test_fold IS NOT NULL GROUP BY test_fold)""")
twin("forecast_hit_rate", """
    SELECT count(*) AS test_rows, round(avg(abs(r)), 6) AS mae, round(avg(abs(units_sold - lag_7d)), 6) AS naive_mae,
           round(avg(CASE WHEN r BETWEEN lo AND hi THEN 1 ELSE 0 END), 6) AS hit_rate
    FROM (SELECT *, units_sold - rolling_30d_mean AS r FROM folds WHERE test_fold = 5)
    CROSS JOIN (SELECT quantile_cont(units_sold - rolling_30d_mean, 0.1) AS lo,
                       quantile_cont(units_sold - rolling_30d_mean, 0.9) AS hi
                FROM folds WHERE coalesce(test_fold, 0) <> 5)""")
twin("interval_hit_rate", """
    SELECT decile, count(*) AS test_rows, round(avg(CASE WHEN a <= coalesce(band, wide) THEN 1 ELSE 0 END), 6) AS hit_rate,
           round(avg(coalesce(band, wide)), 6) AS mean_band
    FROM (SELECT *, abs(units_sold - rolling_30d_mean) AS a FROM folds WHERE test_fold = 5)
    CROSS JOIN (SELECT quantile_cont(abs(units_sold - rolling_30d_mean), 0.8) AS wide FROM folds WHERE coalesce(test_fold, 0) <> 5)
    LEFT JOIN (SELECT store_id, product_name, a AS band FROM (
        SELECT store_id, product_name, abs(units_sold - rolling_30d_mean) AS a,
               row_number() OVER (PARTITION BY store_id, product_name ORDER BY abs(units_sold - rolling_30d_mean)) AS i,
               count(*) OVER (PARTITION BY store_id, product_name) AS n
        FROM folds WHERE coalesce(test_fold, 0) <> 5)
      WHERE i = CAST(ceil((n + 1) * CAST(0.8 AS DOUBLE)) AS BIGINT)) USING (store_id, product_name)
    LEFT JOIN (SELECT store_id, product_name,
                      CAST((row_number() OVER (ORDER BY units, store_id, product_name) - 1) * 10 // count(*) OVER () AS INTEGER) AS decile
               FROM (SELECT store_id, product_name, sum(units_sold) AS units FROM folds WHERE coalesce(test_fold, 0) <> 5 GROUP BY ALL))
      USING (store_id, product_name)
    GROUP BY decile""")

# ---- baskets and rules
twin("basket_enriched", f"SELECT order_id, user_id, product_name, {SLICE} FROM enr")
twin("slice_order_counts", "SELECT * FROM slice_n")
twin("slice_order_cap", "SELECT * FROM cap")
twin("slice_top_items", "SELECT * FROM capped_top")
RULE = f"antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, {SLICE}"
ORDER = f"lift DESC, antecedent, consequent, {SLICE}"
twin("context_itemsets", f"""
    SELECT {SLICE}, itemset, n_items, c AS cnt, round(c / n_orders, 6) AS support FROM brand_sets""")
twin("context_rules", f"SELECT {RULE} FROM brand_rules")
twin("rules_summary", """
    SELECT count(*) AS n_rules, round(avg(lift), 6) AS avg_lift, round(max(lift), 6) AS max_lift FROM brand_rules""")
twin("top_rules", f"""
    SELECT {RULE} FROM brand_rules QUALIFY row_number() OVER (ORDER BY {ORDER.replace('lift', 'brand_rules.lift')}) <= 5""")
twin("top_rules_per_segment", f"""
    SELECT {RULE}, CAST(r AS INTEGER) AS position
    FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY {ORDER}) AS r FROM brand_rules) WHERE r <= 10""")
twin("best_rule_per_item", "SELECT antecedent, consequent, round(lift, 6) AS lift FROM brand_best")
twin("rule_coverage", f"""
    SELECT n.segment, n.time_slot, n.weather_bin, n.n_orders, coalesce(k.c, 0) AS covered_orders,
           round(coalesce(k.c, 0) / n.n_orders, 6) AS coverage
    FROM slice_n n LEFT JOIN (
        SELECT {SLICE}, count(DISTINCT order_id) AS c FROM (
            SELECT i.segment, i.time_slot, i.weather_bin, i.order_id, a.antecedent
            FROM name_in i JOIN (SELECT DISTINCT {SLICE}, antecedent, n_left FROM name_rules) a
              ON {on('i', 'a')} AND list_contains(string_split(a.antecedent, ', '), i.item)
            GROUP BY ALL HAVING count(*) = any_value(a.n_left))
        GROUP BY {SLICE}) k ON {on('n', 'k')}""")
twin("lift_gain", f"""
    SELECT {SLICE}, antecedent, consequent, round(lift, 6) AS lift, round(global_lift, 6) AS global_lift,
           round(lift / global_lift - 1, 6) AS lift_gain
    FROM brand_rules JOIN overall USING (antecedent, consequent)""")
twin("segment_top_products", """
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY lines DESC, product_name) AS INTEGER) AS position
        FROM (SELECT segment, product_name, count(*) AS lines FROM enr GROUP BY ALL)) WHERE position <= 20""")
twin("segment_affinity", """
    SELECT segment, product_name, lines, round((lines / sum(lines) OVER (PARTITION BY segment))
             / (sum(lines) OVER (PARTITION BY product_name) / sum(lines) OVER ()), 6) AS affinity
    FROM (SELECT segment, product_name, count(*) AS lines FROM enr GROUP BY ALL)""")

CTES["ext"] = """
    SELECT translate(p_name, 'eo', 'ai') AS name, min(p_type) AS category FROM part GROUP BY 1"""
twin("fuzzy_product_match", """
    SELECT p.product_name, m.name AS match_name, m.category, CAST(m.dist AS INTEGER) AS distance
    FROM (SELECT DISTINCT p_name AS product_name FROM part) p LEFT JOIN (
        SELECT a.p_name, name, category, levenshtein(a.p_name, name) AS dist
        FROM (SELECT DISTINCT p_name FROM part) a JOIN ext ON levenshtein(a.p_name, name) <= 2
        QUALIFY row_number() OVER (PARTITION BY a.p_name ORDER BY levenshtein(a.p_name, name), name) = 1) m
    ON p.product_name = m.p_name""")

# ---- segmentation
twin("feature_medians", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round({f}, 6) AS median FROM zmed" for f in CLUSTER_FEATURES
))
twin("scaled_features", "SELECT user_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in CLUSTER_FEATURES) + " FROM z")
twin("cluster_profile", "SELECT cluster_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in CLUSTER_FEATURES) + " FROM prof")
PERSONAS = """
    SELECT cluster_id, CASE {first}
        WHEN night_owl_score > (SELECT quantile_cont(night_owl_score, 0.75) FROM {prof}) THEN 'late_night_bachelor'
        WHEN organic_affinity > (SELECT quantile_cont(organic_affinity, 0.75) FROM {prof}) THEN 'morning_health_buyer'
        WHEN weekend_concentration > (SELECT quantile_cont(weekend_concentration, 0.75) FROM {prof})
          THEN 'weekend_family_shopper'
        WHEN pct_festival_orders > (SELECT quantile_cont(pct_festival_orders, 0.75) FROM {prof}) THEN 'festival_bulk_buyer'
        WHEN frequency < (SELECT quantile_cont(frequency, 0.35) FROM {prof})
         AND avg_basket_size < (SELECT quantile_cont(avg_basket_size, 0.5) FROM {prof}) THEN 'student_exam_buyer'
        ELSE 'impulse_buyer' END AS cluster_name
    FROM {prof}"""
twin("persona_names", PERSONAS.format(first="", prof="prof"))
CTES["zsum"] = "SELECT cluster_id, count(*) AS n, sum({q}) AS q, {s} FROM zl GROUP BY cluster_id".format(
    q=" + ".join(f"{f} * {f}" for f in CLUSTER_FEATURES), s=", ".join(f"sum({f}) AS {f}" for f in CLUSTER_FEATURES))
twin("silhouette", f"""
    SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette
    FROM (SELECT user_id, max(CASE WHEN own AND n > 1 THEN t / (n - 1) END) AS a, min(CASE WHEN NOT own THEN t / n END) AS b
          FROM (SELECT p.user_id, p.cluster_id = c.cluster_id AS own, n,
                       greatest(0, n * ({' + '.join(f'p.{f} * p.{f}' for f in CLUSTER_FEATURES)})
                         - 2 * ({' + '.join(f'p.{f} * c.{f}' for f in CLUSTER_FEATURES)}) + q) AS t
                FROM zl p CROSS JOIN zsum c)
          GROUP BY user_id)""")
twin("sampled_silhouette", f"""
    SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette
    FROM (SELECT id, max(CASE WHEN own AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN NOT own THEN s / n END) AS b
          FROM (SELECT p.user_id AS id, p.cluster_id = q.cluster_id AS own, q.cluster_id, count(*) AS n,
                       sum(sqrt({spread('p', 'q')})) AS s
                FROM zl p CROSS JOIN zl q GROUP BY p.user_id, p.cluster_id, q.cluster_id)
          GROUP BY id)""")
CTES["cent"] = "SELECT cluster_id, " + ", ".join(f"avg({f}) AS {f}" for f in CLUSTER_FEATURES) + " FROM zl GROUP BY cluster_id"
CTES["wide"] = f"""
    SELECT c.*, s.s FROM cent c JOIN (SELECT p.cluster_id, avg(sqrt({spread('p', 'c')})) AS s
      FROM zl p JOIN cent c ON p.cluster_id = c.cluster_id GROUP BY p.cluster_id) s ON c.cluster_id = s.cluster_id"""
twin("davies_bouldin", f"""
    SELECT round(avg(r), 6) AS davies_bouldin FROM (
        SELECT a.cluster_id, max((a.s + b.s) / sqrt({spread('a', 'b')})) AS r
        FROM wide a JOIN wide b ON a.cluster_id <> b.cluster_id GROUP BY a.cluster_id)""")
CTES["close_pairs"] = f"""
    SELECT a.user_id AS a, b.user_id AS b FROM z a JOIN z b ON {spread('a', 'b')} <= {EPS} * {EPS}::DOUBLE"""
CTES["cores"] = f"SELECT a FROM close_pairs GROUP BY a HAVING count(*) >= {MIN_SAMPLES}"
SHARED.update({"close_pairs", "cores"})
CTES["noise"] = """
    SELECT user_id, CAST(user_id NOT IN (SELECT p.a FROM close_pairs p JOIN cores c ON p.b = c.a) AS INTEGER) AS is_noise
    FROM z"""
twin("density_outliers", "SELECT * FROM noise")
CTES["relabelled"] = """
    SELECT user_id, CAST(CASE WHEN is_noise = 1 THEN top + 1 ELSE cluster_id END AS INTEGER) AS cluster_id,
           CAST(top + 1 AS INTEGER) AS power_label
    FROM noise JOIN seg USING (user_id) CROSS JOIN (SELECT max(cluster_id) AS top FROM noise JOIN seg USING (user_id))"""
SHARED.add("relabelled")
twin("outlier_labels", "SELECT * FROM relabelled")
CTES["prof_out"] = "SELECT r.cluster_id, any_value(power_label) AS power_label, " + ", ".join(
    f"avg({f}) AS {f}" for f in CLUSTER_FEATURES
) + " FROM zraw JOIN relabelled r USING (user_id) GROUP BY r.cluster_id"
twin("persona_names_with_outliers", PERSONAS.format(first="WHEN cluster_id = power_label THEN 'power_user'", prof="prof_out"))

# ---- fusion
twin("latest_forecast", "SELECT store_id, product_name, order_date, units_sold, forecast_units, model_type FROM latest")
twin("current_stock", "SELECT * FROM stock")
twin("dominant_segment", "SELECT * FROM dominant")
MET_ORDERS = "(SELECT o_custkey AS user_id, o_orderdate AS ordered, {best}(o_orderkey) AS k FROM orders GROUP BY ALL)"
twin("asof_next_order", f"""
    SELECT e.event_id, e.user_id, o.ordered, o.k AS met_order
    FROM (SELECT event_id, user_id, ts - INTERVAL 25 YEAR AS moved FROM events) e
    ASOF LEFT JOIN {MET_ORDERS.format(best="min")} o ON e.user_id = o.user_id AND e.moved <= o.ordered""")
twin("asof_order_before_shipping", f"""
    SELECT l.order_key, l.line, l.user_id, o.ordered, o.k AS met_order
    FROM (SELECT l_orderkey AS order_key, l_linenumber AS line, o_custkey AS user_id, l_shipdate AS shipped
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l
    ASOF LEFT JOIN {MET_ORDERS.format(best="max")} o ON l.user_id = o.user_id AND l.shipped >= o.ordered""")
twin("interval_supplier_load", """
    SELECT order_key, line, first_day, last_day, count(*) AS n_lines, sum(p.l_quantity) AS units
    FROM (SELECT l_suppkey, l_orderkey AS order_key, l_linenumber AS line, CAST(l_shipdate AS DATE) AS first_day,
                 CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS last_day
          FROM lineitem WHERE l_returnflag = 'R') w
    JOIN lineitem p ON p.l_suppkey = w.l_suppkey AND CAST(p.l_shipdate AS DATE) BETWEEN first_day AND last_day
    GROUP BY ALL""")
twin("urgency_scores", f"""
    SELECT s.store_id, s.product_name, s.order_date, s.units_sold, s.forecast_units, s.current_stock, s.days_to_festival,
           u.level AS urgency, u.label AS urgency_label, u.color AS urgency_color
    FROM (SELECT f.*, current_stock, days_to_festival, {LEVEL} AS level
          FROM fc f JOIN stock USING (store_id, product_name) JOIN cal ON f.order_date = cal.date
          WHERE units_sold > 0) s
    JOIN {URGENCY_ROWS} u(level, label, color) ON s.level = u.level""")
twin("attach_bundles", """
    SELECT i.product_name, consequent AS bundle_with, round(lift, 6) AS bundle_lift
    FROM (SELECT DISTINCT product_name FROM master) i LEFT JOIN name_best ON i.product_name = antecedent""")
CTES["name_best_by"] = """
    SELECT segment, antecedent, consequent, lift FROM name_rules WHERE n_left = 1
    QUALIFY row_number() OVER (PARTITION BY segment, antecedent ORDER BY lift DESC, consequent) = 1"""
twin("attach_bundles_by_segment", """
    SELECT i.store_id, i.product_name, i.dominant_segment, coalesce(o.consequent, b.consequent) AS bundle_with,
           round(coalesce(o.lift, b.lift), 6) AS bundle_lift
    FROM (SELECT DISTINCT store_id, product_name, dominant_segment FROM daily JOIN dominant USING (store_id)) i
    LEFT JOIN name_best_by o ON i.dominant_segment = o.segment AND i.product_name = o.antecedent
    LEFT JOIN name_best b ON i.product_name = b.antecedent""")
twin("action_list", "SELECT * FROM acts")
twin("action_list_as_of", "SELECT * FROM acts_as_of")
twin("urgency_distribution", "SELECT urgency_label, urgency, count(*) AS n FROM acts GROUP BY ALL")
twin("bundle_coverage", """
    SELECT count(*) AS actions, count(bundle_with) AS with_bundle, max(bundle_lift) AS top_lift FROM acts""")
twin("critical_actions", """
    SELECT store_id, product_name, forecast_units, current_stock, reorder_qty, urgency_label, bundle_with
    FROM acts_as_of WHERE urgency = 5 ORDER BY reorder_qty DESC, store_id, product_name LIMIT 5""")
twin("store_kpis", """
    SELECT store_id, count(*) AS skus, count(*) FILTER (WHERE forecast_units > current_stock) AS stockout_risk,
           count(*) FILTER (WHERE urgency >= 4) AS alerts, CAST(sum(reorder_qty) AS BIGINT) AS units_to_reorder
    FROM acts GROUP BY store_id""")
twin("store_actions_top", """
    SELECT * FROM (SELECT *, CAST(row_number() OVER
        (PARTITION BY store_id ORDER BY urgency DESC, reorder_qty DESC, product_name) AS INTEGER) AS position FROM acts)
    WHERE position <= 50""")
CTES["lastdate"] = "SELECT max(order_date) AS d FROM lagged"
CTES["held_stock"] = """
    SELECT store_id, product_name, CAST(round_even(avg(units_sold) * CAST(0.8 AS DOUBLE), 0) AS INTEGER) AS current_stock
    FROM lagged WHERE units_sold > 0 AND order_date < (SELECT d FROM lastdate) - 29 GROUP BY ALL"""
CTES["unit_values"] = """
    SELECT p_name AS product_name, CAST(sum(CAST(trunc(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS unit_value
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name"""
twin("backtest_30d", """
    SELECT store_id, CAST(sum(checked) AS BIGINT) AS checked, CAST(sum(short) AS BIGINT) AS stockouts,
           CAST(sum(avoided) AS BIGINT) AS avoided_stockouts, CAST(sum(over) AS BIGINT) AS overstocks,
           round(sum(avoided * unit_value), 4) AS avoided_value
    FROM (SELECT store_id, product_name, count(*) AS checked, count(*) FILTER (WHERE demand > current_stock) AS short,
                 count(*) FILTER (WHERE demand > current_stock AND demand <= supply) AS avoided,
                 count(*) FILTER (WHERE demand > 0 AND supply > 2 * demand) AS over
          FROM (SELECT a.store_id, a.product_name, b.units_sold AS demand, current_stock,
                       current_stock + greatest(a.lag_7d - current_stock, 0) AS supply
                FROM lagged a JOIN lagged b ON a.store_id = b.store_id AND a.product_name = b.product_name
                     AND b.order_date = a.order_date + 1
                JOIN held_stock s ON s.store_id = a.store_id AND s.product_name = a.product_name
                WHERE a.order_date >= (SELECT d FROM lastdate) - 29)
          GROUP BY store_id, product_name) JOIN unit_values USING (product_name)
    GROUP BY store_id""")
twin("sku_actual_vs_forecast", """
    SELECT store_id, order_date, units_sold, forecast_units FROM fc
    WHERE product_name = (SELECT product_name FROM fc GROUP BY product_name ORDER BY sum(units_sold) DESC, product_name LIMIT 1)""")
