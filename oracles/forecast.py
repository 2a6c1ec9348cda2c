"""DuckDB statements for folds, baselines, scoring and error analysis."""

from oracles.panel import on_panel

LEVELS = {
    "total": [],
    "state": ["state_id"],
    "store": ["store_id"],
    "category": ["cat_id"],
    "department": ["dept_id"],
    "state_category": ["state_id", "cat_id"],
    "state_department": ["state_id", "dept_id"],
    "store_category": ["store_id", "cat_id"],
    "store_department": ["store_id", "dept_id"],
    "item": ["item_id"],
    "state_item": ["item_id", "state_id"],
    "item_store": ["item_id", "store_id"],
}

HISTORY = """history AS MATERIALIZED (
  SELECT * FROM panel WHERE sell_price IS NOT NULL AND year BETWEEN (SELECT max(year) - 1 FROM panel)
    AND (SELECT max(year) FROM panel))"""
EARLY = "history AS MATERIALIZED (SELECT * FROM panel WHERE sell_price IS NOT NULL AND d <= 84)"
BOUNDS = "bounds AS (SELECT min(date) AS first, max(date) AS last FROM history)"


def folds(n):
    return f"""folds AS (
  SELECT CAST({n} - i + 1 AS INTEGER) AS fold, first AS train_start,
         CAST(last - CAST(i * 28 AS INTEGER) AS DATE) AS train_end,
         CAST(last - CAST(i * 28 AS INTEGER) + 1 AS DATE) AS valid_start,
         CAST(last - CAST(i * 28 AS INTEGER) + 28 AS DATE) AS valid_end
  FROM bounds, (SELECT unnest(generate_series(1, {n})) AS i))"""


SPLIT = {
    "train": "train AS MATERIALIZED (SELECT h.*, fold FROM history h JOIN folds ON date <= train_end)",
    "valid": """valid AS MATERIALIZED (
  SELECT h.*, fold FROM history h JOIN folds ON date BETWEEN valid_start AND valid_end)""",
}
SEASONAL = """seasonal AS MATERIALIZED (
  SELECT v.*, CAST(coalesce(w.units, 0) AS DOUBLE) AS prediction
  FROM valid v LEFT JOIN (
    SELECT item_id, store_id, fold, isodow(date) AS wd, sales AS units
    FROM train JOIN folds USING (fold) WHERE date > train_end - 7) w
  ON v.item_id = w.item_id AND v.store_id = w.store_id AND v.fold = w.fold
     AND isodow(v.date) = w.wd)"""
NAIVE = """naive AS MATERIALIZED (
  SELECT v.*, CAST(coalesce(w.units, 0) AS DOUBLE) AS prediction
  FROM valid v LEFT JOIN (
    SELECT item_id, store_id, fold, sales AS units
    FROM train JOIN folds USING (fold) WHERE date = train_end) w
  ON v.item_id = w.item_id AND v.store_id = w.store_id AND v.fold = w.fold)"""


def _levels(source, measures, by, levels=LEVELS):
    parts = []
    for level, keys in levels.items():
        sid = " || '_' || ".join(keys) if keys else "'total'"
        parts.append(f"SELECT '{level}' AS level, {sid} AS series_id, {by}, {measures} "
                     f"FROM {source} GROUP BY ALL")  # fmt: skip
    return "\nUNION ALL ".join(parts)


def scoring(predictions, levels=LEVELS):
    """Named tables scales, errors, weights and metrics for a table of predictions."""
    daily_train = _levels("train", "sum(sales) AS x", "fold, date", levels)
    daily_valid = _levels(
        predictions, "sum(sales) AS a, sum(prediction) AS p", "fold, date", levels
    )
    recent = "(SELECT t.* FROM train t JOIN folds USING (fold) WHERE date > train_end - 28)"
    weights = _levels(recent, "sum(sales * sell_price) AS dollar_sales", "fold", levels)
    return [
        f"""scales AS MATERIALIZED (
  SELECT level, series_id, fold, avg(CASE WHEN before > 0 OR level = 'total' THEN step * step END)
    AS scale
  FROM (SELECT *, x - lag(x) OVER w AS step,
               sum(x) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM ({daily_train}) WINDOW w AS (PARTITION BY level, series_id, fold ORDER BY date))
  GROUP BY ALL)""",
        f"""errors AS MATERIALIZED (
  SELECT level, series_id, fold, avg((a - p) * (a - p)) AS mse FROM ({daily_valid}) GROUP BY ALL)""",
        f"weights AS MATERIALIZED ({weights})",
        """metrics AS (
  SELECT * FROM scales JOIN errors USING (level, series_id, fold)
  JOIN weights USING (level, series_id, fold))""",
        """level_scores AS (
  SELECT level, fold, sum(sqrt(mse / scale) * dollar_sales / total) AS wrmsse_level
  FROM (SELECT *, sum(dollar_sales) OVER (PARTITION BY level, fold) AS total
        FROM metrics WHERE scale > 0)
  GROUP BY ALL)""",
    ]


def base(n=1):
    return [HISTORY, BOUNDS, folds(n), SPLIT["train"], SPLIT["valid"]]


ERR = """err AS MATERIALIZED (
  SELECT *, prediction - sales AS error, abs(prediction - sales) AS abs_error,
    (prediction - sales) * (prediction - sales) AS squared_error,
    CASE WHEN sales = 0 THEN 'zero_sales' ELSE 'positive_sales' END AS demand_status,
    CAST(date_diff('day', min(date) OVER (PARTITION BY fold), date) + 1 AS INTEGER) AS horizon_day,
    CASE WHEN event_name_1 = 'No Event' THEN 0 ELSE 1 END AS is_event,
    lag(sell_price) OVER (PARTITION BY item_id, store_id, fold ORDER BY date) AS prev
  FROM seasonal)"""
BASIC = "count(*) AS n, avg(error) AS bias, avg(abs_error) AS mae"
DIRECTIONS = """avg(CAST(error < 0 AS INTEGER)) * 100 AS pct_underforecast,
  avg(CAST(error > 0 AS INTEGER)) * 100 AS pct_overforecast"""
MEANS = "avg(prediction) AS mean_predicted_sales, avg(sales) AS mean_actual_sales"
CHANGED = """(sell_price IS NOT NULL AND prev IS NOT NULL
  AND abs(sell_price - prev) > 1e-8 + 1e-5 * abs(prev))"""
SERIES_KIND = """series_kind AS (
  SELECT item_id, store_id, count(DISTINCT date) AS n_dates, avg(error) AS bias,
    avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse, stddev_samp(error) AS error_std,
    avg(CAST(sales = 0 AS INTEGER)) * 100 AS pct_actual_zero, """ + DIRECTIONS + """
  FROM err GROUP BY ALL)"""


def frequency(n=91):
    return f"""frequency AS (
  SELECT item_id, store_id, nonzero_rate,
    CASE WHEN nonzero_rate >= 0 AND nonzero_rate <= 0.1 THEN 'Highly intermittent'
         WHEN nonzero_rate > 0.1 AND nonzero_rate <= 0.5 THEN 'Moderately intermittent'
         WHEN nonzero_rate > 0.5 AND nonzero_rate <= 1.000001 THEN 'Low intermittency' END
      AS sale_frequency
  FROM (SELECT item_id, store_id, avg(CAST(sales > 0 AS INTEGER)) AS nonzero_rate
        FROM train JOIN folds USING (fold) WHERE date > train_end - {n} GROUP BY ALL))"""


DECILES = """volume AS (
  SELECT item_id, store_id, avg(sales) AS mean_sales
  FROM train JOIN folds USING (fold) WHERE date > train_end - 28 GROUP BY ALL),
deciles AS (
  SELECT item_id, store_id, mean_sales, 'D' || lpad(CAST(CAST(greatest(
    ceil((row_number() OVER (ORDER BY mean_sales, item_id, store_id) - 1) * 10
      / greatest(count(*) OVER () - 1, 1)), 1) AS INTEGER) AS VARCHAR), 2, '0') AS volume_decile
  FROM volume WHERE mean_sales > 0
  UNION ALL SELECT item_id, store_id, mean_sales, 'D00 no sales' FROM volume WHERE mean_sales <= 0)"""
BANDS = """bands AS (
  SELECT item_id, store_id, mean_price,
    CASE WHEN mean_price < 0 THEN NULL WHEN mean_price < 1 THEN '<$1' WHEN mean_price < 2 THEN '$1-2'
         WHEN mean_price < 5 THEN '$2-5' WHEN mean_price < 10 THEN '$5-10' ELSE '$10+' END
      AS price_band
  FROM (SELECT item_id, store_id, avg(sell_price) AS mean_price FROM seasonal GROUP BY ALL))"""


def profile(root="sqrt(mse / scale)"):
    return f"""profile AS MATERIALIZED (
  SELECT *, dollar_sales / sum(dollar_sales) OVER () AS weight
  FROM (SELECT DISTINCT item_id, store_id, cat_id, dept_id, state_id,
               item_id || '_' || store_id AS series_id FROM seasonal)
  JOIN (SELECT series_id, scale, mse, dollar_sales, {root} AS rmsse
        FROM metrics WHERE level = 'item_store' AND scale > 0) USING (series_id)
  JOIN bands USING (item_id, store_id) JOIN deciles USING (item_id, store_id)
  LEFT JOIN frequency USING (item_id, store_id))"""


BOTTOM = {"item_store": LEVELS["item_store"]}


def with_profile(root="sqrt(mse / scale)"):
    return [
        *base(), SEASONAL, *scoring("seasonal", BOTTOM), frequency(), DECILES, BANDS, profile(root),
    ]


def slices(select, dims, where=""):
    parts = [
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, * FROM profile {where}"
        for d in dims
    ]
    return f"SELECT dimension, value, {select} FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"


DIMS = ("store_id", "cat_id", "dept_id", "price_band", "volume_decile", "sale_frequency")


def statements():
    seasonal = [*base(), SEASONAL]
    err = [*seasonal, ERR]
    err5 = [*base(5), SEASONAL, ERR]
    score = [*base(), SEASONAL, *scoring("seasonal")]
    early = [EARLY, *score[1:]]
    prof = with_profile()
    median6 = "round(median(rmsse), 6) AS median_rmsse"

    def by(keys, measures=BASIC, tables=err):
        return on_panel(f"SELECT {keys}, {measures} FROM err GROUP BY ALL", *tables)

    def pivot(flag, names, tables):
        low, high = names
        return on_panel(f"""
SELECT *, ({high} / {low} - 1) * 100 AS change_pct FROM (
  SELECT cat_id, avg(abs_error) FILTER ({flag} = 0) AS {low},
         avg(abs_error) FILTER ({flag} = 1) AS {high} FROM err GROUP BY cat_id)""", *tables)  # fmt: skip

    def cv(table, definition):
        return on_panel(
            "SELECT fold, round(avg(wrmsse_level), 6) AS wrmsse FROM level_scores GROUP BY fold",
            *base(3), definition, *scoring(table),
        )

    renamed = [
        s.replace("errors AS", "errors_n AS").replace("metrics AS", "metrics_n AS")
        .replace("JOIN errors", "JOIN errors_n").replace("FROM metrics", "FROM metrics_n")
        .replace("level_scores AS", "level_scores_n AS")
        for s in scoring("naive") if s.startswith(("errors", "metrics", "level_scores"))
    ]
    both = [*base(3), SEASONAL, NAIVE, *scoring("seasonal"), *renamed]
    scores = """scores AS (
  SELECT 'baseline' AS model, fold, avg(wrmsse_level) AS wrmsse FROM level_scores_n GROUP BY fold
  UNION ALL
  SELECT 'seasonal', fold, avg(wrmsse_level) FROM level_scores GROUP BY fold)"""
    return {
        "folds": on_panel(
            "SELECT fold AS folds, train_start, train_end, valid_start, valid_end FROM folds",
            HISTORY, BOUNDS, folds(3),
        ),
        "fold_rows": on_panel("""
SELECT f.fold, t.n AS train_rows, v.n AS valid_rows, v.lo AS valid_start, v.hi AS valid_end
FROM folds f JOIN (SELECT fold, count(*) AS n FROM train GROUP BY fold) t USING (fold)
JOIN (SELECT fold, count(*) AS n, min(date) AS lo, max(date) AS hi FROM valid GROUP BY fold) v
USING (fold)""", *base(3)),
        "holdout_rows": on_panel("""
SELECT (SELECT count(*) FROM train) AS num_train_rows,
  (SELECT count(DISTINCT date) FROM train) AS num_train_days,
  (SELECT min(date) FROM train) AS train_start_date, (SELECT max(date) FROM train) AS train_end_date,
  (SELECT count(*) FROM valid) AS num_test_rows,
  (SELECT count(DISTINCT date) FROM valid) AS num_test_days,
  (SELECT min(date) FROM valid) AS test_start_date, (SELECT max(date) FROM valid) AS test_end_date""",
            *base()),
        "load_window": on_panel("""
SELECT item_id, store_id, d, sales, sell_price FROM panel
WHERE d <= (SELECT max(d) FROM panel) - 28 AND year >= (SELECT max(year) - 1 FROM panel)
  AND sell_price IS NOT NULL"""),
        "stored_predictions": on_panel(
            "SELECT fold, item_id, store_id, date, sales, prediction FROM seasonal",
            *base(3), SEASONAL,
        ),
        "forecast_duplicates": on_panel(
            """SELECT count(*) - count(DISTINCT (fold, item_id, store_id, date)) AS duplicates
FROM seasonal""", *base(3), SEASONAL,
        ),
        "naive_forecast": on_panel(
            "SELECT item_id, store_id, date, sales, prediction FROM naive", *base(), NAIVE
        ),
        "seasonal_forecast": on_panel(
            "SELECT item_id, store_id, date, sales, prediction FROM seasonal", *seasonal
        ),
        "scales": on_panel("SELECT level, series_id, scale FROM scales", *score),
        "mse": on_panel("SELECT level, series_id, mse FROM errors", *score),
        "weights": on_panel(
            "SELECT level, series_id, round(dollar_sales, 2) AS dollar_sales FROM weights", *score
        ),
        "wrmsse_levels": on_panel(
            "SELECT level, round(wrmsse_level, 6) AS wrmsse_level FROM level_scores", *score
        ),
        "wrmsse": on_panel(
            "SELECT round(avg(wrmsse_level), 6) AS wrmsse FROM level_scores", *score
        ),
        "wrmsse_naive": on_panel(
            "SELECT round(avg(wrmsse_level), 6) AS wrmsse FROM level_scores",
            *base(), NAIVE, *scoring("naive"),
        ),
        "wrmsse_keep_zero_scale": on_panel("""
SELECT round(avg(s), 6) AS wrmsse FROM (
  SELECT level, sum(CASE WHEN dollar_sales = 0 OR NOT mse > 0 THEN 0 WHEN scale = 0 THEN CAST('inf' AS DOUBLE)
                         ELSE sqrt(mse / scale) END * dollar_sales / total) AS s
  FROM (SELECT *, sum(dollar_sales) OVER (PARTITION BY level) AS total FROM metrics)
  GROUP BY level)""", *score),
        "wrmsse_folds_naive": cv("naive", NAIVE),
        "wrmsse_folds_seasonal": cv("seasonal", SEASONAL),
        "zero_scale_audit": on_panel("""
SELECT level, series_id, scale, mse, round(dollar_sales, 2) AS dollar_sales,
  round(dollar_sales / total, 6) AS weight, dollar_sales / total > 0 AS causes_inf
FROM (SELECT *, sum(dollar_sales) OVER (PARTITION BY level) AS total FROM metrics)
WHERE scale IS NULL OR scale <= 0""", *score),
        "zero_scale_audit_early": on_panel("""
SELECT level, series_id, scale, mse, round(dollar_sales, 2) AS dollar_sales,
  round(dollar_sales / total, 6) AS weight, dollar_sales / total > 0 AS causes_inf
FROM (SELECT *, sum(dollar_sales) OVER (PARTITION BY level) AS total FROM metrics)
WHERE scale IS NULL OR scale <= 0""", *early),
        "zero_scale_counts_early": on_panel("""
SELECT level, count(*) AS series, count(*) FILTER (dollar_sales > 0) AS series_with_weight
FROM metrics WHERE scale IS NULL OR scale <= 0 GROUP BY level""", *early),
        "wrmsse_keep_early": on_panel("""
SELECT level, round(sum(CASE WHEN dollar_sales = 0 OR NOT mse > 0 THEN 0 WHEN scale = 0 THEN CAST('inf' AS DOUBLE)
                             ELSE sqrt(mse / scale) END * dollar_sales) / sum(dollar_sales), 6) AS wrmsse_level
FROM metrics GROUP BY level""", *early),
        "cv_report": on_panel("""
SELECT s.model, round(f1, 6) AS fold_1, round(f2, 6) AS fold_2, round(f3, 6) AS fold_3,
  round((f1 + f2 + f3) / 3, 6) AS mean_wrmsse,
  round(((f1 - b1) + (f2 - b2) + (f3 - b3)) / 3, 6) AS mean_delta,
  CAST((f1 > b1) AS INTEGER) + CAST((f2 > b2) AS INTEGER) + CAST((f3 > b3) AS INTEGER) AS folds_worse
FROM (SELECT model, max(wrmsse) FILTER (fold = 1) AS f1, max(wrmsse) FILTER (fold = 2) AS f2,
             max(wrmsse) FILTER (fold = 3) AS f3 FROM scores GROUP BY model) s,
     (SELECT max(wrmsse) FILTER (fold = 1) AS b1, max(wrmsse) FILTER (fold = 2) AS b2,
             max(wrmsse) FILTER (fold = 3) AS b3 FROM scores WHERE model = 'baseline') b""",
            *both, scores),
        "fold_summary": on_panel("""
SELECT round(avg(wrmsse), 6) AS wrmsse_mean, round(stddev_pop(wrmsse), 6) AS wrmsse_std,
  round(max(wrmsse), 6) AS wrmsse_worst_fold FROM scores WHERE model = 'seasonal'""",
            *both, scores),
        "ensemble_baselines": on_panel("""
SELECT item_id, store_id, date, sales, s.prediction AS pred_seasonal, n.prediction AS pred_naive,
  (s.prediction + n.prediction) / 2 AS prediction
FROM seasonal s JOIN naive n USING (item_id, store_id, date, sales)""", *base(), SEASONAL, NAIVE),
        "err_overall": on_panel(f"""
SELECT count(*) AS n_forecasts, avg(error) AS bias, avg(abs_error) AS mae,
  sqrt(avg(squared_error)) AS rmse, round(stddev_samp(error), 6) AS error_std, {DIRECTIONS},
  avg(CAST(error = 0 AS INTEGER)) * 100 AS pct_exact,
  avg(CAST(sales = 0 AS INTEGER)) * 100 AS pct_actual_zero FROM err""", *err),
        "err_series": on_panel("""
SELECT * REPLACE (round(error_std, 6) AS error_std) FROM series_kind""", *err, SERIES_KIND),
        "err_series_status": by(
            "item_id, store_id, demand_status", f"{BASIC}, {DIRECTIONS}"
        ),
        "err_status": by("demand_status"),
        "err_horizon": by(
            "horizon_day", f"{BASIC}, sqrt(avg(squared_error)) AS rmse, {DIRECTIONS}"
        ),
        "err_horizon_folds": by(
            "horizon_day", f"{BASIC}, sqrt(avg(squared_error)) AS rmse, {DIRECTIONS}", err5
        ),
        "err_horizon_status": by("horizon_day, demand_status"),
        "err_date": by("date"),
        "err_cat_date": by("cat_id, date, dayname(date) AS day_name"),
        "err_weekday": by("dayname(date) AS day_name", f"{BASIC}, {MEANS}"),
        "err_weekend": by(
            "CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend", f"{BASIC}, {MEANS}"
        ),
        "err_frequency": on_panel(f"""
SELECT sale_frequency, {BASIC} FROM err JOIN profile USING (item_id, store_id)
WHERE sale_frequency IS NOT NULL GROUP BY ALL""", *prof, ERR),
        "err_frequency_status": on_panel(f"""
SELECT sale_frequency, demand_status, {BASIC} FROM err JOIN profile USING (item_id, store_id)
WHERE sale_frequency IS NOT NULL GROUP BY ALL""", *prof, ERR),
        "err_event": by("is_event", f"{BASIC}, {MEANS}", err5),
        "err_event_ratio": on_panel("""
SELECT avg(abs_error) FILTER (is_event = 1) / avg(abs_error) FILTER (is_event = 0) AS event_ratio
FROM err""", *err5),
        "err_event_cat": by("is_event, cat_id", f"{BASIC}, {MEANS}", err5),
        "err_event_pivot": pivot("is_event", ("normal_day_mae", "event_day_mae"), err5),
        "err_snap": by("snap", f"{BASIC}, {MEANS}"),
        "err_snap_status": by("snap, demand_status", f"{BASIC}, {MEANS}"),
        "err_snap_cat": by("snap, cat_id", f"{BASIC}, {MEANS}"),
        "err_snap_pivot": pivot("snap", ("normal_day_mae", "snap_day_mae"), err),
        "err_price_change": by(f"{CHANGED} AS price_changed"),
        "err_price_change_cat": by(f"{CHANGED} AS price_changed, cat_id"),
        "err_context": on_panel("""
SELECT item_id, store_id, date, prediction, event_name_1, event_type_1, snap, sell_price
FROM seasonal""", *seasonal),
        "err_profile": on_panel("""
SELECT item_id, store_id, cat_id, dept_id, state_id, scale, mse, round(dollar_sales, 2)
  AS dollar_sales, rmsse, round(mean_price, 6) AS mean_price, price_band, mean_sales,
  volume_decile, nonzero_rate, sale_frequency, round(weight, 8) AS weight FROM profile""", *prof),
        "volume_decile": on_panel("SELECT * FROM deciles", *base(), DECILES),
        "sale_frequency": on_panel("SELECT * FROM frequency", *base(), frequency()),
        "price_band": on_panel(
            "SELECT item_id, store_id, round(mean_price, 6) AS mean_price, price_band FROM bands",
            *seasonal, BANDS,
        ),
        "err_unweighted_slice": on_panel(f"""
SELECT *, n_series / sum(n_series) OVER (PARTITION BY dimension) AS share_of_series FROM (
{slices(f"count(*) AS n_series, round(avg(rmsse), 6) AS mean_rmsse, {median6}", DIMS)})
WHERE value IS NOT NULL""", *prof),
        "err_slice": on_panel(f"""
SELECT *, n_series / sum(n_series) OVER (PARTITION BY dimension) AS share_of_series FROM (
{slices(f"count(rmsse) AS n_series, round(avg(rmsse), 6) AS mean_rmsse, {median6}, "
        "avg(CAST(rmsse > 1 AS INTEGER)) * 100 AS pct_rmsse_gt_1", DIMS)})""", *prof),
        "err_slice_squared": on_panel(f"""
SELECT *, n_series / sum(n_series) OVER (PARTITION BY dimension) AS share_of_series FROM (
{slices(f"count(rmsse) AS n_series, round(avg(rmsse), 6) AS mean_rmsse, {median6}, "
        "avg(CAST(rmsse > 1 AS INTEGER)) * 100 AS pct_rmsse_gt_1", ["cat_id", "store_id"])})""",
            *with_profile("mse / scale")),
        "err_weighted_slice": on_panel(f"""
SELECT dimension, value, n_series, mean_rmsse, median_rmsse,
  round(c, 6) AS weighted_error_contribution, round(total_weight, 6) AS total_weight,
  round(c / sum(c) OVER (PARTITION BY dimension), 6) AS share_of_weighted_error
FROM ({slices(f"count(*) AS n_series, round(avg(rmsse), 6) AS mean_rmsse, {median6}, "
              "sum(weight * rmsse) AS c, sum(weight) AS total_weight", DIMS)})""", *prof),
        "err_summary": on_panel("""
SELECT count(*) AS n_series, round(avg(rmsse), 6) AS mean_rmsse,
  round(median(rmsse), 6) AS median_rmsse, round(quantile_cont(rmsse, 0.9), 6) AS p90_rmsse,
  round(quantile_cont(rmsse, 0.95), 6) AS p95_rmsse,
  round(quantile_cont(rmsse, 0.99), 6) AS p99_rmsse,
  avg(CAST(rmsse > 1 AS INTEGER)) * 100 AS pct_series_rmsse_gt_1 FROM profile""", *prof),
        "err_high": on_panel("""
SELECT item_id, store_id, rmsse, round(dollar_sales, 2) AS dollar_sales, round(weight, 8) AS weight
FROM profile WHERE rmsse > 1""", *prof),
        **{
            f"err_{kind}": on_panel(f"""
SELECT item_id, store_id, rmsse, round(weight * rmsse, 8) AS contribution,
  round(weight, 8) AS total_weight
FROM profile WHERE weight > 0 ORDER BY {column} {direction}, item_id, store_id LIMIT 10""", *prof)
            for kind, column, direction in (
                ("worst", "weight * rmsse", "DESC"), ("best", "weight * rmsse", "ASC"),
                ("worst_rmsse", "rmsse", "DESC"), ("best_rmsse", "rmsse", "ASC"),
            )
        },
        "err_kind_slice": on_panel(f"""
SELECT * FROM (
{slices('''count(item_id) AS n_series, round(avg(bias), 6) AS mean_bias,
  round(avg(mae), 6) AS mean_mae, round(median(mae), 6) AS median_mae,
  round(avg(error_std), 6) AS mean_error_std,
  round(avg(pct_actual_zero), 6) AS mean_pct_actual_zero,
  round(avg(pct_underforecast), 6) AS mean_pct_underforecast,
  round(avg(pct_overforecast), 6) AS mean_pct_overforecast''',
  ['cat_id', 'store_id', 'sale_frequency', 'price_band'],
  'LEFT JOIN series_kind USING (item_id, store_id)')}) WHERE value IS NOT NULL""",
            *prof, ERR, SERIES_KIND),
        "recent_peaks": on_panel("""
SELECT * FROM (SELECT item_id, store_id, date, sales FROM train
  WHERE item_id = 'Brand#13' AND store_id = 'NATION_7' ORDER BY date DESC LIMIT 50)
WHERE sales >= 5""", *base()),
    }
