"""DuckDB statements for the exploratory questions."""

from oracles.panel import on_panel

ZERO_PCT = "round(count(*) FILTER (sales = 0) / count(*) * 100, 2)"
AFTER = "count(*) FILTER (date >= launch_date)"
ZERO_AFTER = "count(*) FILTER (sales = 0 AND date >= launch_date)"
POS_AFTER = "count(*) FILTER (sales > 0 AND date >= launch_date)"
DEMAND = f"""
  CASE WHEN {AFTER} > 0 THEN round({ZERO_AFTER} / {AFTER} * 100, 2) END AS zero_sales_pct,
  CASE WHEN {AFTER} > 0 THEN round({POS_AFTER} / {AFTER} * 100, 2) END AS positive_sales_pct,
  avg(sales) FILTER (date >= launch_date) AS avg_sales_all_days,
  avg(sales) FILTER (date >= launch_date AND sales > 0) AS avg_sales_positive_days"""


def _keys(keys):
    return "".join(f"{k}, " for k in keys), (f"GROUP BY {', '.join(keys)}" if keys else "")


def zero_share(*keys):
    select, group = _keys(keys)
    return on_panel(f"""
SELECT {select}count(*) AS total_observations, count(*) FILTER (sales = 0) AS zero_sales,
       {ZERO_PCT} AS zero_sales_pct
FROM panel {group}""")


def totals(*keys):
    select, group = _keys(keys)
    return on_panel(f"""
SELECT {select}CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales,
       count(*) AS observations
FROM panel {group}""")


def profile(*keys, extra=""):
    select, group = _keys(keys)
    return on_panel(f"SELECT {select}{DEMAND}{extra} FROM launched {group}")


AFTER_DAY = ", avg(sales) FILTER (date > launch_date) AS avg_sales_after_launch_day"


def zero_after(*keys, where=""):
    select, group = _keys(keys)
    return on_panel(f"""
SELECT {select}{AFTER} AS total_sales_after_launch, {ZERO_AFTER} AS zero_sales_after_launch,
       CASE WHEN {AFTER} > 0 THEN round({ZERO_AFTER} / {AFTER} * 100, 2) END
         AS zero_pct_after_launch
FROM launched {where} {group}""")


def positive_after(*keys):
    select, group = _keys(keys)
    return on_panel(f"""
SELECT {select}{AFTER} AS total_observations, {POS_AFTER} AS total_sales_after_launch,
       CASE WHEN {AFTER} > 0 THEN round({POS_AFTER} / {AFTER} * 100, 2) END
         AS sales_pct_after_launch
FROM launched {group}""")


def snap_effect(*keys):
    select, group = _keys(keys)
    return on_panel(f"""
SELECT {select}{AFTER} AS total_observations, {ZERO_AFTER} AS zero_sales,
       {POS_AFTER} AS positive_sales,
       CASE WHEN {AFTER} > 0 THEN round({ZERO_AFTER} / {AFTER}, 2) END AS zero_sales_share,
       CASE WHEN {AFTER} > 0 THEN round({POS_AFTER} / {AFTER}, 2) END AS positive_sales_share
FROM launched {group}""")


def snap_pivot(name, index, measure):
    return on_panel(f"""
SELECT {name}, max(m) FILTER (snap = 0) AS snap_0, max(m) FILTER (snap = 1) AS snap_1
FROM (SELECT {index} AS {name}, snap, {measure} AS m FROM launched GROUP BY ALL) GROUP BY {name}""")


SNAP_SHARE = f"CASE WHEN {AFTER} > 0 THEN round({POS_AFTER} / {AFTER}, 2) END"
SNAP_ZERO = f"CASE WHEN {AFTER} > 0 THEN round({ZERO_AFTER} / {AFTER} * 100, 2) END"
SNAP_MEAN = "avg(sales) FILTER (date >= launch_date AND sales > 0)"
EVENT = "CASE WHEN event_type_1 = 'No Event' THEN 'No Event' ELSE 'Event' END"


def split(keys, select):
    group = f"GROUP BY {keys}" if keys else ""
    return on_panel(f"""
SELECT {select} count(*) AS total_sales,
  count(*) FILTER (date < launch_date AND sales = 0) AS zero_sales_before_launch,
  {ZERO_AFTER} AS zero_sales_after_launch,
  round(count(*) FILTER (date < launch_date AND sales = 0) / count(*) * 100, 2)
    AS zero_pct_before_launch,
  round({ZERO_AFTER} / count(*) * 100, 2) AS zero_pct_after_launch
FROM launched {group}""")


def price_bands(bounds):
    whens = f"WHEN sell_price < {bounds[0]} THEN '< ${bounds[0]}' " + " ".join(
        f"WHEN sell_price < {high} THEN '${low}–${high}'" for low, high in zip(bounds, bounds[1:])
    )
    return on_panel(f"""
SELECT CASE WHEN sell_price IS NULL THEN NULL {whens} ELSE '${bounds[-1]}+' END AS price_bucket,
  {DEMAND}, median(sales) AS median_sales
FROM launched GROUP BY 1""")


def statements(price_bounds, max_price, tail):
    low, high, price_limit = tail
    return {
        "sales_profile": on_panel("""
SELECT count(*) AS rows, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales,
       median(sales) AS median_sales, min(sales) AS min_sales, max(sales) AS max_sales,
       round(stddev_samp(sales), 6) AS std_sales
FROM panel"""),
        "zero_share_all": zero_share(),
        "zero_share_store_item": zero_share("store_id", "item_id"),
        "zero_share_date": zero_share("date"),
        "zero_share_cat": zero_share("cat_id"),
        "zero_share_year_cat": zero_share("year", "cat_id"),
        "launch_panel": on_panel("""
SELECT DISTINCT store_id, item_id, date, launch_date, launch_week, sales, sell_price
FROM launched"""),
        "launch_one_series": on_panel("""
SELECT DISTINCT store_id, item_id, date, launch_date, launch_week, sales, sell_price
FROM launched WHERE item_id = 'Brand#13' AND store_id = 'NATION_7'"""),
        "launch_table": on_panel("SELECT * FROM launch"),
        "launch_zero_split": split("", ""),
        "launch_zero_split_series": split(
            "store_id, item_id, launch_date", "store_id, item_id, launch_date,"
        ),
        "launch_zero_split_prefix": on_panel("""
SELECT store_id, item_id, launch_date, count(*) AS total_sales
FROM launched WHERE item_id LIKE 'Brand#1%' GROUP BY ALL"""),
        "post_launch_zero_year_weekday": zero_after(
            "store_id", "item_id", "launch_date", "year", "weekday",
            where="WHERE date >= launch_date",
        ),
        "post_launch_zero_store_cat_weekday": zero_after("store_id", "cat_id", "weekday"),
        "post_launch_store_cat_weekday": positive_after("store_id", "cat_id", "weekday"),
        "post_launch_cat_month": positive_after("cat_id", "month"),
        "post_launch_store_cat_month": positive_after("store_id", "cat_id", "month"),
        "snap_effect": snap_effect("snap"),
        "snap_effect_state": snap_effect("state_id", "snap"),
        "snap_effect_state_store_cat": snap_effect("state_id", "store_id", "cat_id", "snap"),
        "snap_weekday_pivot": snap_pivot("weekday", "weekday", SNAP_SHARE),
        "snap_event_pivot": snap_pivot("event_type", EVENT, SNAP_SHARE),
        "totals_store": totals("store_id"),
        "totals_state": totals("state_id"),
        "totals_cat": totals("cat_id"),
        "totals_dept": totals("dept_id"),
        "totals_year": totals("year"),
        "totals_month": totals("month"),
        "totals_weekday": totals("weekday"),
        "totals_date": totals("date"),
        "totals_event": totals("event_type_1"),
        "duplicate_grain": on_panel("""
SELECT store_id, item_id, date, count(*) AS grain_count FROM panel
GROUP BY ALL HAVING count(*) > 1"""),
        "duplicate_order_lines": """
SELECT l_orderkey, l_linenumber, count(*) AS grain_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
        "series_slice": on_panel("""
SELECT item_id, store_id, date, CAST(sales AS BIGINT) AS sales,
       CAST(sum(sales) OVER (ORDER BY date) AS BIGINT) AS cum_sales
FROM panel WHERE item_id = 'Brand#13' AND store_id = 'NATION_7'
  AND date BETWEEN DATE '2000-03-15' AND DATE '2000-04-24'"""),
        "sales_hist": on_panel("""
SELECT sales, count(*) AS sales_dist,
       round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct
FROM panel WHERE sales IS NOT NULL GROUP BY sales"""),
        "sales_buckets": on_panel("""
SELECT CASE WHEN sales = 0 THEN '0' WHEN sales BETWEEN 1 AND 5 THEN '1-5'
            WHEN sales BETWEEN 6 AND 10 THEN '6-10' WHEN sales BETWEEN 11 AND 20 THEN '11-20'
            WHEN sales BETWEEN 21 AND 50 THEN '21-50' WHEN sales BETWEEN 51 AND 100 THEN '51-100'
            ELSE '100+' END AS sales_bucket, count(*) AS sales_dist
FROM panel GROUP BY 1"""),
        "top_sales": on_panel("""
SELECT state_id, store_id, item_id, cat_id, date, weekday, sell_price, sales, event_type_1,
       event_name_1, snap
FROM panel ORDER BY sales DESC, store_id, item_id, date LIMIT 30"""),
        "tail_profile": on_panel(f"""
SELECT store_id, cat_id, weekday, {EVENT} AS event, snap,
       CASE WHEN sell_price BETWEEN 0.0 AND {price_limit} THEN 'low_price' ELSE 'high_price' END
         AS price, count(*) AS sales_count
FROM panel WHERE sales > {low} AND sales < {high} GROUP BY ALL"""),
        "zero_timing": on_panel(f"""
SELECT count(*) AS total_observations, count(*) FILTER (sales = 0) AS zero_sales,
  count(*) FILTER (sales > 0) AS positive_sales,
  count(*) FILTER (sales = 0 AND date < launch_date) AS zero_sales_before_launch,
  {ZERO_AFTER} AS zero_sales_after_launch,
  {ZERO_PCT} AS zero_sales_pct,
  round(count(*) FILTER (sales > 0) / count(*) * 100, 2) AS positive_sales_pct,
  round(count(*) FILTER (sales = 0 AND date < launch_date) / count(*) FILTER (sales = 0) * 100, 2)
    AS pct_zero_sales_before_launch,
  round({ZERO_AFTER} / count(*) FILTER (sales = 0) * 100, 2) AS pct_zero_sales_after_launch
FROM panel LEFT JOIN launch USING (item_id, store_id)"""),
        "post_launch_zero_series": on_panel(f"""
SELECT store_id, item_id, round({ZERO_AFTER} / {AFTER} * 100, 2) AS pct_zero_sales_after_launch
FROM launched GROUP BY ALL"""),
        "post_launch_zero_distribution": on_panel(f"""
SELECT count(*) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
       quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75,
       max(x) AS max
FROM (SELECT round({ZERO_AFTER} / {AFTER} * 100, 2) AS x FROM launched GROUP BY store_id, item_id)"""),
        "post_launch_year": profile("year"),
        "post_launch_year_month": profile("year", "month", extra=AFTER_DAY),
        "post_launch_month_weekday": profile("month", "weekday", extra=AFTER_DAY),
        "post_launch_year_cat": profile("year", "cat_id"),
        "post_launch_store_cat": profile("store_id", "cat_id"),
        "post_launch_snap": profile("snap"),
        "event_snap_pivot": snap_pivot("event_type", EVENT, SNAP_MEAN),
        "weekday_snap_zero_pivot": snap_pivot("weekday", "weekday", SNAP_ZERO),
        "weekday_snap_mean_pivot": snap_pivot("weekday", "weekday", SNAP_MEAN),
        "post_launch_store_item_snap": profile("store_id", "item_id", "snap"),
        "price_quantiles": on_panel("""
SELECT min(sell_price) AS min_price, median(sell_price) AS median_price,
  quantile_cont(sell_price, 0.75) AS p75, quantile_cont(sell_price, 0.90) AS p90,
  quantile_cont(sell_price, 0.95) AS p95, quantile_cont(sell_price, 0.99) AS p99,
  max(sell_price) AS max_price
FROM launched"""),
        "price_buckets": price_bands(price_bounds),
        "item_price": on_panel(f"""
SELECT item_id, sell_price, {DEMAND} FROM launched
WHERE sell_price IS NOT NULL AND sell_price <= {max_price} GROUP BY item_id, sell_price"""),
        "hierarchy_census": on_panel("""
SELECT count(DISTINCT item_id || '_' || store_id) AS n_id, count(DISTINCT item_id) AS n_item_id,
  count(DISTINCT store_id) AS n_store_id, count(DISTINCT dept_id) AS n_dept_id,
  count(DISTINCT cat_id) AS n_cat_id, count(DISTINCT state_id) AS n_state_id,
  count(DISTINCT item_id || '_' || store_id) AS rows
FROM panel"""),
        "series_per_hierarchy": on_panel("""
SELECT state_id, store_id, cat_id, dept_id, count(*) AS count
FROM (SELECT DISTINCT state_id, store_id, cat_id, dept_id, item_id FROM panel)
GROUP BY ALL"""),
        "series_per_state": on_panel("""
SELECT state_id, count(*) AS count
FROM (SELECT DISTINCT state_id, store_id, item_id FROM panel) GROUP BY ALL"""),
        "id_dependency": on_panel("""
SELECT max(i) AS max_items, max(s) AS max_stores
FROM (SELECT count(DISTINCT item_id) AS i, count(DISTINCT store_id) AS s FROM panel
      GROUP BY item_id || '_' || store_id)"""),
        "totals_year_month": on_panel("""
SELECT strftime(date, '%Y-%m') AS year_month, CAST(sum(sales) AS BIGINT) AS total_sales,
       avg(sales) AS avg_sales, count(*) AS observations FROM panel GROUP BY 1"""),
        "totals_month_weekday": on_panel("""
SELECT month, CAST(isodow(date) - 1 AS INTEGER) AS weekday_no,
       month || '_' || dayname(date) AS month_weekday, CAST(sum(sales) AS BIGINT) AS total_sales,
       avg(sales) AS avg_sales, count(*) AS observations FROM panel GROUP BY ALL"""),
        "daily_units": on_panel(
            "SELECT date, CAST(sum(sales) AS BIGINT) AS units FROM panel GROUP BY date"
        ),
    }
