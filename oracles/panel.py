"""DuckDB statement prefix that builds the long panel from the star-schema tables."""

PANEL = """
WITH daily AS (
  SELECT p.p_brand AS item_id, n.n_name AS store_id, r.r_name AS state_id,
         r.r_regionkey AS region, CAST(l.l_shipdate AS DATE) AS date,
         CAST(sum(l.l_quantity) AS BIGINT) AS units, min(p.p_retailprice) AS price
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
),
span AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem
),
series AS (SELECT DISTINCT item_id, store_id, state_id, region FROM daily),
days AS (
  SELECT CAST(u.d AS INTEGER) AS d, CAST(lo + CAST(u.d - 1 AS INTEGER) AS DATE) AS date,
         CAST(11101 + (u.d - 1) // 7 AS INTEGER) AS wm_yr_wk
  FROM span, generate_series(1, date_diff('day', lo, hi) + 1) AS u(d)
),
week_prices AS (
  SELECT item_id, store_id,
         CAST(11101 + date_diff('day', lo, date) // 7 AS INTEGER) AS wm_yr_wk,
         min(price) AS price
  FROM daily, span GROUP BY ALL
),
dense AS (
  SELECT s.*, t.d, t.date, t.wm_yr_wk, CAST(coalesce(x.units, 0) AS INTEGER) AS sales,
         last_value(w.price IGNORE NULLS) OVER (
           PARTITION BY s.item_id, s.store_id ORDER BY t.d
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price,
         CAST(ceil(CAST(substr(s.item_id, 7) AS INTEGER) / 5.0) AS INTEGER) AS dept_no
  FROM series s CROSS JOIN days t
  LEFT JOIN daily x ON x.item_id = s.item_id AND x.store_id = s.store_id AND x.date = t.date
  LEFT JOIN week_prices w
    ON w.item_id = s.item_id AND w.store_id = s.store_id AND w.wm_yr_wk = t.wm_yr_wk
),
panel AS MATERIALIZED (
  SELECT item_id, 'DEPT_' || dept_no AS dept_id,
         CASE WHEN dept_no <= 2 THEN 'CAT_A' WHEN dept_no <= 4 THEN 'CAT_B' ELSE 'CAT_C' END
           AS cat_id,
         store_id, state_id, date, wm_yr_wk, d, sales, sell_price,
         dayname(date) AS weekday, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         CASE WHEN strftime(date, '%m-%d') = '01-01' THEN 'NewYear'
              WHEN strftime(date, '%m-%d') = '07-04' THEN 'Independence'
              WHEN strftime(date, '%m-%d') = '12-25' THEN 'Christmas'
              WHEN strftime(date, '%m-%d') = '02-14' THEN 'Valentines'
              ELSE 'No Event' END AS event_name_1,
         CASE WHEN strftime(date, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 'National'
              WHEN strftime(date, '%m-%d') = '02-14' THEN 'Cultural'
              ELSE 'No Event' END AS event_type_1,
         CASE WHEN strftime(date, '%m-%d') = '10-31' THEN 'Halloween' ELSE 'No Event' END
           AS event_name_2,
         CASE WHEN strftime(date, '%m-%d') = '10-31' THEN 'Cultural' ELSE 'No Event' END
           AS event_type_2,
         CAST(day(date) BETWEEN region + 1 AND region + 10 AS INTEGER) AS snap
  FROM dense
),
launch AS (
  SELECT item_id, store_id, min(date) AS launch_date, min(wm_yr_wk) AS launch_week
  FROM panel WHERE sell_price IS NOT NULL GROUP BY ALL
),
launched AS (SELECT p.*, l.launch_date, l.launch_week FROM panel p JOIN launch l USING (item_id, store_id))
"""


def on_panel(statement: str, *extra: str) -> str:
    """Put the panel tables, and further named tables, in front of a statement."""
    tables = "".join(f",\n{e}" for e in extra)
    return f"{PANEL.rstrip()}{tables}\n{statement}"
