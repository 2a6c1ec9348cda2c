"""DuckDB statements for raw tables, checks and features."""

from oracles.panel import PANEL, on_panel

KEYS = "item_id, store_id, d"
YEARS = "year BETWEEN (SELECT max(year) - 1 FROM panel) AND (SELECT max(year) FROM panel)"
PRICED = "priced AS (SELECT * FROM panel WHERE sell_price IS NOT NULL)"
S = "PARTITION BY item_id, store_id"
W = f"{S} ORDER BY date"

#: A number from 0 up to 1 by the MD5 of a key.
DRAW = "(CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496)"


def frame(size):
    return f"OVER ({W} ROWS BETWEEN {28 + size - 1} PRECEDING AND 28 PRECEDING)"


CALENDAR = """CAST(week(date) AS INTEGER) AS week_of_year,
  CAST(isodow(date) AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend"""
LAGS = ", ".join(
    f"CAST(lag(sales, {n}) OVER ({W}) AS INTEGER) AS lag_{n}" for n in (*range(28, 36), 56)
)
INTERMITTENCY = f"""
  round(avg(CAST(sales > 0 AS DOUBLE)) {frame(7)}, 2) AS rolling_positive_rate_7,
  round(avg(CAST(sales > 0 AS DOUBLE)) {frame(28)}, 2) AS rolling_positive_rate_28,
  round(avg(CAST(sales = 0 AS DOUBLE)) {frame(28)}, 2) AS rolling_zero_rate_28,
  CAST(date_diff('day', max(CASE WHEN sales > 0 THEN date END)
    OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 28 PRECEDING), date) AS INTEGER)
    AS days_since_last_sale"""
RECENT = ", ".join(f"round(avg(sales) {frame(n)}, 2) AS rolling_mean_{n}" for n in (7, 28, 56))
MAGNITUDE = ", ".join(
    f"round({fn}(CASE WHEN sales > 0 THEN sales END) {frame(n)}, 2) AS rolling_positive_{out}"
    for fn, n, out in (
        ("avg", 7, "mean_7"), ("avg", 28, "mean_28"), ("median", 28, "median_28"),
        ("stddev_samp", 28, "std_28"),
    )
) + f""", CAST(max(CASE WHEN sales > 0 THEN sales END) {frame(28)} AS DOUBLE)
  AS rolling_positive_max_28"""  # fmt: skip
PRICE = f"""
  size_of AS price_unique_count, price_max, price_min, round(price_avg, 2) AS price_mean,
  round(sell_price / price_max, 2) AS price_norm,
  round(sell_price / lag(sell_price, 7) OVER ({W}), 2) AS price_weekly_change,
  round(sell_price / avg(sell_price) OVER ({S}, month, year), 2) AS price_change_m,
  round(sell_price / avg(sell_price) OVER ({S}, year), 2) AS price_change_y,
  round(sell_price / price_avg, 2) AS price_vs_usual,
  round(sell_price / (CAST(sum(CAST(sell_price AS DECIMAL(18, 4))) OVER (
    PARTITION BY store_id, dept_id, wm_yr_wk) AS DOUBLE)
    / count(sell_price) OVER (PARTITION BY store_id, dept_id, wm_yr_wk)), 2) AS price_vs_dept"""
PRICE_STATS = """price_stats AS (
  SELECT item_id, store_id, count(DISTINCT sell_price) AS size_of, max(sell_price) AS price_max,
         min(sell_price) AS price_min, avg(sell_price) AS price_avg
  FROM priced GROUP BY ALL)"""
ROLLED = """rolled AS (
  SELECT store_id, dept_id, date, round(avg(dept_sales) OVER (PARTITION BY store_id, dept_id
    ORDER BY date ROWS BETWEEN 55 PRECEDING AND 28 PRECEDING), 2) AS store_dept_rolling_avg
  FROM (SELECT store_id, dept_id, date, sum(sales) AS dept_sales FROM priced GROUP BY ALL))"""
ENCODINGS = {
    "item": "item_id",
    "store": "store_id",
    "item_store": "item_id, store_id",
    "store_dept": "store_id, dept_id",
    "store_cat": "store_id, cat_id",
}


def _encoding(name, keys):
    """Totals of a key up to each day, shown 28 days later."""
    return f"""enc_{name} AS MATERIALIZED (
  SELECT {keys}, d + 28 AS d, CAST(total AS DOUBLE) / n AS enc_{name}_mean,
    CASE WHEN n > 1 THEN sqrt((squares - CAST(total AS DOUBLE) * total / n) / (n - 1)) END
      AS enc_{name}_std
  FROM (
    SELECT {keys}, d, sum(n) OVER w AS n, sum(s) OVER w AS total, sum(q) OVER w AS squares
    FROM (SELECT {keys}, d, count(sales) AS n, sum(sales) AS s, sum(sales * sales) AS q
          FROM priced GROUP BY ALL)
    WINDOW w AS (PARTITION BY {keys} ORDER BY d ROWS UNBOUNDED PRECEDING)))"""


ENCODED_TABLES = [_encoding(n, k) for n, k in ENCODINGS.items()]
ENCODED_JOINS = " ".join(
    f"LEFT JOIN enc_{n} USING ({k}, d)" for n, k in ENCODINGS.items()
)
ENCODED_6 = ", ".join(
    f"enc_{n}_mean, round(enc_{n}_std, 6) AS enc_{n}_std"
    for n in ENCODINGS
)
TREND = """
  (rolling_mean_28 + 0.1) / nullif(enc_item_store_mean, 0) AS trend_28_vs_long,
  (rolling_mean_7 + 0.1) / (rolling_mean_28 + 0.1) AS trend_7_vs_28,
  (rolling_mean_28 + 0.1) / (rolling_mean_56 + 0.1) AS trend_28_vs_56,
  (rolling_mean_28 + 0.1) / nullif(enc_store_dept_mean, 0) AS item_vs_dept,
  (rolling_mean_28 + 0.1) / nullif(enc_store_cat_mean, 0) AS item_vs_cat,
  enc_item_store_mean / nullif(enc_item_mean, 0) AS item_store_vs_global"""


def feature(select, *extra, source="priced"):
    return on_panel(f"SELECT {KEYS}, {select} FROM {source}", PRICED, *extra)


BASE = """item_id, store_id, state_id, cat_id, dept_id, d, date, wm_yr_wk, year, month, weekday,
  sell_price, event_name_1, event_type_1, snap, sales"""


def gold(where_before="TRUE", where_after=YEARS):
    priced = PRICED.replace("WHERE", f"WHERE {where_before} AND")
    everything = f"""everything AS (
  SELECT {BASE}, min(date) OVER ({W}) AS launch_date, {CALENDAR}, {LAGS}, {INTERMITTENCY},
    {RECENT}, {MAGNITUDE}, {PRICE}, store_dept_rolling_avg,
    {', '.join(f'enc_{n}_mean, enc_{n}_std' for n in ENCODINGS)}
  FROM priced JOIN price_stats USING (item_id, store_id)
  LEFT JOIN rolled USING (store_id, dept_id, date) {ENCODED_JOINS})"""
    return on_panel(
        f"""
SELECT * EXCLUDE ({', '.join(f'enc_{n}_mean, enc_{n}_std' for n in ENCODINGS)}),
  {ENCODED_6}, {TREND}
FROM everything WHERE {where_after}""",
        priced,
        PRICE_STATS,
        ROLLED,
        *ENCODED_TABLES,
        everything,
    )


def statements():
    trend_source = f"(SELECT *, {RECENT} FROM priced) {ENCODED_JOINS}"
    raw_calendar = """
SELECT 'd_' || d AS d, date, wm_yr_wk, weekday, month, year, event_name_1, event_type_1,
       event_name_2, event_type_2,
       CAST(day(date) BETWEEN 1 AND 10 AS INTEGER) AS "snap_AFRICA",
       CAST(day(date) BETWEEN 2 AND 11 AS INTEGER) AS "snap_AMERICA",
       CAST(day(date) BETWEEN 3 AND 12 AS INTEGER) AS "snap_ASIA",
       CAST(day(date) BETWEEN 4 AND 13 AS INTEGER) AS "snap_EUROPE",
       CAST(day(date) BETWEEN 5 AND 14 AS INTEGER) AS "snap_MIDDLE EAST"
FROM (SELECT DISTINCT d, date, wm_yr_wk, weekday, month, year, event_name_1, event_type_1,
             event_name_2, event_type_2 FROM panel)"""
    prices = """prices AS (
  SELECT DISTINCT store_id, item_id, wm_yr_wk, sell_price FROM panel WHERE sell_price IS NOT NULL)"""
    return {
        "daily_sales": PANEL + """
SELECT item_id, store_id, state_id, date, units AS sales, price FROM daily""",
        "calendar_table": on_panel(raw_calendar),
        "calendar_profile": on_panel("""
SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS n_days,
  count(*) FILTER (event_name_1 <> 'No Event') AS n_event_name_1,
  count(*) FILTER (event_type_1 <> 'No Event') AS n_event_type_1,
  count(*) FILTER (event_name_2 <> 'No Event') AS n_event_name_2,
  count(*) FILTER (event_type_2 <> 'No Event') AS n_event_type_2,
  count(*) FILTER (day(date) BETWEEN 1 AND 10) AS "snap_AFRICA",
  count(*) FILTER (day(date) BETWEEN 2 AND 11) AS "snap_AMERICA",
  count(*) FILTER (day(date) BETWEEN 3 AND 12) AS "snap_ASIA",
  count(*) FILTER (day(date) BETWEEN 4 AND 13) AS "snap_EUROPE",
  count(*) FILTER (day(date) BETWEEN 5 AND 14) AS "snap_MIDDLE EAST"
FROM (SELECT DISTINCT date, event_name_1, event_type_1, event_name_2, event_type_2 FROM panel)"""),
        "calendar_event_counts": on_panel("""
SELECT event_name_1, event_type_1, count(*) AS count
FROM (SELECT DISTINCT date, event_name_1, event_type_1 FROM panel) GROUP BY ALL"""),
        "calendar_gap": on_panel("""
SELECT CAST(max(step) AS INTEGER) AS max_gap_days FROM (
  SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS step
  FROM (SELECT DISTINCT date FROM panel))"""),
        "shipping_gap": """
SELECT CAST(max(step) AS INTEGER) AS max_gap_days FROM (
  SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS step
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem))""",
        "price_table": on_panel(
            "SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices", prices
        ),
        "price_profile": on_panel("""
SELECT count(*) AS rows, count(DISTINCT store_id) AS stores, count(DISTINCT item_id) AS items,
  count(DISTINCT wm_yr_wk) AS weeks, count(*) FILTER (sell_price IS NULL) AS missing_prices,
  min(sell_price) AS min_price, round(avg(sell_price), 6) AS mean_price,
  max(sell_price) AS max_price, CAST(0 AS BIGINT) AS duplicate_rows
FROM prices""", prices),
        "melt_panel": on_panel("""
SELECT item_id || '_' || store_id AS id, item_id, dept_id, cat_id, store_id, state_id,
       'd_' || d AS d, sales
FROM panel"""),
        "silver_panel": on_panel("SELECT * FROM panel"),
        "raw_sales_profile": on_panel("""
SELECT count(*) AS observations, count(*) FILTER (item_id IS NULL) AS missing_ids,
  count(*) FILTER (sales IS NULL) AS missing_sales, count(*) FILTER (sales = 0) AS zero_sales,
  count(*) FILTER (sales = 0) / count(*) * 100 AS zero_pct,
  count(*) FILTER (sales < 0) AS negative_sales, min(sales) AS min_sales,
  max(sales) AS max_sales, avg(sales) AS mean_sales, median(sales) AS median_sales
FROM panel"""),
        "raw_id_profile": on_panel("""
SELECT count(*) - count(DISTINCT id) AS duplicate_ids,
       count(*) - count(DISTINCT (item_id, store_id)) AS duplicate_pairs
FROM (SELECT DISTINCT item_id || '_' || store_id AS id, item_id, store_id FROM panel)"""),
        "day_key_containment": on_panel("""
SELECT count(*) FILTER (c.date IS NULL) AS missing_keys,
       count(*) FILTER (c.date IS NULL) = 0 AS contained
FROM (SELECT DISTINCT date FROM daily) x LEFT JOIN (SELECT DISTINCT date FROM panel) c USING (date)
"""),
        "narrow_types": """
SELECT * FROM (VALUES ('l_orderkey', %s), ('l_partkey', %s), ('l_suppkey', %s),
  ('l_linenumber', %s), ('l_quantity', %%s), ('l_extendedprice', %%s),
  ('l_discount', %%s), ('l_tax', %%s)) AS t(column_name, storage_type)"""
        % tuple(
            f"""(SELECT CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint'
  WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
  WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END
  FROM lineitem)"""
            for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        )
        % tuple(
            f"""(SELECT CASE WHEN count(*) FILTER (CAST(CAST({c} AS FLOAT) AS DOUBLE) IS DISTINCT FROM {c}) > 0
  THEN 'double' ELSE 'float' END FROM lineitem)"""
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
        "dataset_profile": on_panel("""
SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date,
  count(DISTINCT date) AS unique_dates, count(DISTINCT item_id) AS unique_items,
  count(DISTINCT store_id) AS unique_stores FROM panel"""),
        "dataset_fingerprint": on_panel("""
SELECT *, sha256('{"columns":"item_id:string,dept_id:string,cat_id:string,store_id:string,'
  || 'state_id:string,date:date,wm_yr_wk:int,d:int,sales:int,sell_price:double,weekday:string,'
  || 'month:int,year:int,event_name_1:string,event_type_1:string,event_name_2:string,'
  || 'event_type_2:string,snap:int","max_date":"' || max_date || '","min_date":"' || min_date
  || '","row_count":' || row_count || ',"unique_dates":' || unique_dates || ',"unique_items":'
  || unique_items || ',"unique_stores":' || unique_stores || '}') AS fingerprint
FROM (SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date,
  count(DISTINCT date) AS unique_dates, count(DISTINCT item_id) AS unique_items,
  count(DISTINCT store_id) AS unique_stores FROM panel)"""),
        "null_counts": on_panel("""
SELECT count(*) FILTER (item_id IS NULL) AS item_id, count(*) FILTER (store_id IS NULL) AS store_id,
  count(*) FILTER (date IS NULL) AS date, count(*) FILTER (sales IS NULL) AS sales,
  count(*) FILTER (sell_price IS NULL) AS sell_price FROM panel"""),
        "dead_series": on_panel("""
SELECT item_id, store_id, CAST(sum(sales) AS BIGINT) AS total, round(stddev_samp(sales), 6) AS spread
FROM panel GROUP BY ALL HAVING sum(sales) = 0 OR stddev_samp(sales) = 0"""),
        "dq_panel": on_panel("""
SELECT * FROM (
  SELECT 'unique_grain' AS "check", 'silver' AS level, count(*) = 0 AS passed,
         count(*) AS failing_rows
  FROM (SELECT 1 FROM panel GROUP BY item_id, store_id, date HAVING count(*) > 1)
  UNION ALL
  SELECT 'continuous_dates', 'silver', count(*) = 0, count(*)
  FROM (SELECT 1 FROM panel GROUP BY item_id, store_id
        HAVING count(*) <> date_diff('day', min(date), max(date)) + 1)
  UNION ALL
  SELECT 'sales_not_negative', 'silver', count(*) = 0, count(*) FROM panel WHERE sales < 0
  UNION ALL
  SELECT 'sales_not_null', 'silver', count(*) = 0, count(*) FROM panel WHERE sales IS NULL
  UNION ALL
  SELECT 'price_positive', 'silver', count(*) = 0, count(*) FROM panel WHERE sell_price <= 0
  UNION ALL
  SELECT 'null_price_before_launch', 'silver', count(*) > 0,
         CASE WHEN count(*) > 0 THEN 0 ELSE 1 END
  FROM launched WHERE sell_price IS NULL AND wm_yr_wk < launch_week
  UNION ALL
  SELECT 'no_null_price_after_launch', 'silver', count(*) = 0, count(*)
  FROM launched WHERE sell_price IS NULL AND wm_yr_wk >= launch_week
  UNION ALL
  SELECT 'row_count', 'silver', n = expected, abs(n - expected)
  FROM (SELECT count(*) AS n, count(DISTINCT (item_id, store_id)) * (date_diff('day', min(date), max(date)) + 1) AS expected
        FROM panel))"""),
        "csv_round_trip": on_panel("""
SELECT store_id, year, count(*) AS rows, CAST(sum(sales) AS BIGINT) AS units, count(sell_price) AS priced,
  CAST(sum(snap) AS BIGINT) AS snap_days, count(*) FILTER (event_name_1 <> 'No Event') AS event_days
FROM panel GROUP BY store_id, year"""),
        "feature_round_trip": on_panel("""
SELECT store_id, year, count(*) AS rows, CAST(sum(week(date)) AS BIGINT) AS weeks, CAST(sum(sales) AS BIGINT) AS units
FROM panel, (SELECT max(year) AS last FROM panel)
WHERE sell_price IS NOT NULL AND (year = last - 1 OR (year = last AND state_id = 'ASIA')) GROUP BY store_id, year"""),
        "report_round_trip": on_panel("""
SELECT state_id, cat_id, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales, count(*) AS observations,
  CAST(row_number() OVER (ORDER BY state_id, cat_id) AS INTEGER) AS line
FROM panel GROUP BY state_id, cat_id"""),
        "sample_strata": on_panel(f"""
SELECT item_id, store_id, date, sales FROM panel
WHERE {DRAW.format(key="'7|' || item_id || '|' || store_id")} < CASE cat_id WHEN 'CAT_A' THEN 0.02 WHEN 'CAT_B' THEN 0.05 ELSE 0.1 END"""),
        "sample_orders": f"""
SELECT l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem
WHERE {DRAW.format(key="'3|' || l_orderkey")} < 0.05 GROUP BY l_orderkey""",
        "sample_series": on_panel(f"""
SELECT cat_id, item_id, store_id FROM (
  SELECT *, row_number() OVER (PARTITION BY cat_id ORDER BY {DRAW.format(key="'11|' || item_id || '|' || store_id")}, item_id, store_id) AS no
  FROM (SELECT DISTINCT cat_id, item_id, store_id FROM panel)) WHERE no <= 5"""),
        "append_conflicts": on_panel("""
SELECT year(date)::INT AS year, count(*) AS rows, CAST(sum(units + CASE WHEN year(date) > last THEN 1000 ELSE 0 END) AS BIGINT) AS units, mode
FROM daily, (SELECT year(max(date)) - 2 AS last FROM daily), (VALUES ('two runs'), ('one run')) AS m(mode) GROUP BY ALL"""),
        "dq_raw_tables": on_panel("""
SELECT * FROM (
  SELECT 'not_empty' AS "check", 'lineitem' AS level, count(*) > 0 AS passed,
         CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failing_rows FROM lineitem
  UNION ALL SELECT 'columns_present', 'lineitem', TRUE, 0
  UNION ALL SELECT 'not_empty', 'nation', count(*) > 0, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END
  FROM nation
  UNION ALL SELECT 'columns_present', 'nation', FALSE, 1
  UNION ALL SELECT 'row_count', 'nation', count(*) = 25, abs(count(*) - 25) FROM nation
  UNION ALL SELECT 'not_empty', 'calendar', count(*) > 0, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END
  FROM days
  UNION ALL SELECT 'columns_present', 'calendar', TRUE, 0
  UNION ALL SELECT 'row_count', 'calendar', n = want, abs(n - want)
  FROM (SELECT count(*) AS n, date_diff('day', min(lo), min(hi)) + 1 AS want FROM days, span)
  UNION ALL SELECT 'not_empty', 'prices', count(*) > 0, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END
  FROM prices
  UNION ALL SELECT 'columns_present', 'prices', TRUE, 0)""", prices),
        "dq_broken_series": on_panel("""
SELECT item_id, store_id, count(*) AS rows,
       date_diff('day', min(date), max(date)) + 1 AS expected_days
FROM daily GROUP BY ALL HAVING count(*) <> date_diff('day', min(date), max(date)) + 1"""),
        "dq_negative_balance": """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0""",
        "feat_calendar": feature(CALENDAR),
        "feat_lags": feature(LAGS),
        "feat_intermittency": feature(INTERMITTENCY),
        "feat_recent": feature(RECENT),
        "feat_magnitude": feature(MAGNITUDE),
        "feat_price": feature(
            PRICE, PRICE_STATS, source="priced JOIN price_stats USING (item_id, store_id)"
        ),
        "feat_store_dept": feature(
            "store_dept_rolling_avg", ROLLED,
            source="priced LEFT JOIN rolled USING (store_id, dept_id, date)",
        ),
        "feat_encodings": feature(
            ENCODED_6, *ENCODED_TABLES, source=f"priced {ENCODED_JOINS}"
        ),
        "feat_trend": feature(TREND, *ENCODED_TABLES, source=trend_source),
        "feat_lifecycle": on_panel(f"""
SELECT {KEYS}, launch_date, CAST(date_diff('day', launch_date, date) AS INTEGER)
    AS days_since_launch, CAST(date >= launch_date AS INTEGER) AS is_available,
  sell_price - prev AS price_change, (sell_price - prev) / nullif(prev, 0) AS price_change_pct,
  CAST(date_diff('day', max(CASE WHEN abs(sell_price - prev) > 1e-8 + 1e-5 * abs(prev)
    THEN date END) OVER ({W} ROWS UNBOUNDED PRECEDING), date) AS INTEGER)
    AS days_since_price_change,
  lag_1, lag_7, lag_14
FROM (SELECT *, lag(sell_price) OVER ({W}) AS prev, lag(sales, 1) OVER ({W}) AS lag_1,
             lag(sales, 7) OVER ({W}) AS lag_7, lag(sales, 14) OVER ({W}) AS lag_14
      FROM panel LEFT JOIN launch USING (item_id, store_id))"""),
        "gold_features": gold(),
        "gold_features_truncated": gold(where_before=YEARS),
        "acf": on_panel(f"""
SELECT item_id, store_id, CAST(unnest(generate_series(0, 56)) AS INTEGER) AS lag,
       round(unnest([{', '.join(f'c_{k} / nullif(c_0, 0)' for k in range(57))}]), 6) AS acf
FROM (SELECT item_id, store_id, {', '.join(f'sum(x * x_{k}) AS c_{k}' for k in range(57))}
  FROM (SELECT item_id, store_id, x, {', '.join(f'lag(x, {k}) OVER ({W}) AS x_{k}' for k in range(57))}
    FROM (SELECT item_id, store_id, date, sales - avg(sales) OVER ({S}) AS x FROM panel))
  GROUP BY ALL)"""),
        "missing_days": on_panel("""
SELECT item_id, store_id, count(*) AS rows,
  date_diff('day', min(date), max(date)) + 1 AS expected_days,
  date_diff('day', min(date), max(date)) + 1 - count(*) AS missing_days
FROM launched WHERE date >= launch_date GROUP BY ALL"""),
        "decompose": on_panel(f"""
SELECT item_id, store_id, d, date, observed, round(trend, 6) AS trend,
  round(seasonal_7, 6) AS seasonal_7, round(seasonal_30, 6) AS seasonal_30,
  round(seasonal_365, 6) AS seasonal_365,
  round(observed - trend - seasonal_7 - seasonal_30 - seasonal_365, 6) AS residual
FROM (
  SELECT *, avg(observed - trend - seasonal_7 - seasonal_30)
    OVER ({S}, dayofyear(date)) AS seasonal_365
  FROM (
    SELECT *, avg(observed - trend - seasonal_7) OVER ({S}, d % 30) AS seasonal_30
    FROM (
      SELECT *, avg(observed - trend) OVER ({S}, isodow(date)) AS seasonal_7
      FROM (
        SELECT item_id, store_id, d, date, CAST(sales AS DOUBLE) AS observed,
          CASE WHEN count(*) OVER ({W} ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING) = 365
            THEN avg(sales) OVER ({W} ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)
            ELSE avg(sales) OVER ({W} ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING) END AS trend
        FROM launched WHERE date >= launch_date))))"""),
    }
