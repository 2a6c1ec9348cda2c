"""Registered queries on folds, baselines, scoring and error analysis.

The forecasts behind the error queries are the seasonal baseline: every number can be checked
in SQL.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.catalog.feature_queries import panel_days, training_years
from stocktide.catalog.panel_queries import ONE_SERIES, rounded
from stocktide.config import HORIZON
from stocktide.functions import columns as C
from stocktide.operators import features, hierarchy, quality, scoring
from stocktide.operators.joins import join_checked
from stocktide.plans import baselines, errors, reports, validation
from stocktide.plans.gold import in_years
from stocktide.session import cut_lineage, shared_folder
from stocktide.sources import star_schema as star
from stocktide.sources import tables

BY_FOLD = ["fold"]
# Eight weeks of training and four of validation.
EARLY_DAYS = 84
# Five folds reach back to July, so the windows hold an event day.
EVENT_FOLDS = 5


def history(spark, folder):
    """Priced rows of the training years, stored once because scoring reads them many times."""
    rows = features.priced_rows(star.sales_panel(spark, folder))
    return cut_lineage(in_years(rows, *training_years(spark, folder)))


def fold_frames(rows, n_folds=3):
    """The last training days and the validation rows of all folds; the history isn't copied."""
    folds = validation.folds_of(rows, n_folds)
    return validation.recent_windows(rows, folds), validation.valid_windows(rows, folds)


def fold_bases(rows, n_folds=3):
    """Scales and weights of all folds, stored: a row per series, level and fold."""
    folds = validation.folds_of(rows, n_folds)
    scales = hierarchy.level_scales_at(rows, validation.ends(folds))
    weights = hierarchy.level_weights(validation.recent_windows(rows, folds), by=BY_FOLD)
    return cut_lineage(scales.join(weights, ["level", "series_id", *BY_FOLD]))


def scored(rows, bases, forecast, n_folds=3):
    recent, valid = fold_frames(rows, n_folds)
    found = bases.join(hierarchy.level_errors(forecast(recent, valid, BY_FOLD), by=BY_FOLD), ["level", "series_id", *BY_FOLD])
    return scoring.wrmsse(scoring.weighted_levels(found, by=BY_FOLD), BY_FOLD)


def split(spark, folder):
    return validation.holdout(history(spark, folder))


def seasonal(spark, folder):
    return baselines.seasonal_forecast(*split(spark, folder))


def naive(spark, folder):
    return baselines.naive_forecast(*split(spark, folder))


def metrics(spark, folder, forecast=baselines.seasonal_forecast):
    train, valid = split(spark, folder)
    return scoring.series_metrics(train, forecast(train, valid))


def early_metrics(spark, folder):
    """Metrics of the panel's first days, where some series have no scale yet."""
    rows = features.priced_rows(star.sales_panel(spark, folder)).where(F.col("d") <= EARLY_DAYS)
    train, valid = validation.holdout(cut_lineage(rows))
    return scoring.series_metrics(train, baselines.seasonal_forecast(train, valid))


def _early_audit(spark, folder):
    audit = scoring.zero_scale_audit(early_metrics(spark, folder))
    return rounded(rounded(audit, "dollar_sales", digits=2), "weight")


def errors_of(spark, folder):
    return scoring.with_errors(seasonal(spark, folder))


def fold_errors(spark, folder, n_folds=EVENT_FOLDS):
    train, valid = fold_frames(history(spark, folder), n_folds)
    return scoring.with_errors(baselines.seasonal_forecast(train, valid, BY_FOLD))


def profile_and_errors(spark, folder, squared=False):
    """Series profile and forecast errors.

    The profile is stored: it is one row per series and every slice reads it again.
    """
    train, valid = split(spark, folder)
    forecast = baselines.seasonal_forecast(train, valid)
    stored = cut_lineage(errors.series_profile(train, forecast, squared))
    return stored, scoring.with_errors(forecast)


def profile(spark, folder, squared=False):
    return profile_and_errors(spark, folder, squared)[0]


def fold_scores(rows, forecast, n_folds=3):
    return scored(rows, fold_bases(rows, n_folds), forecast, n_folds)


def both_scores(spark, folder):
    """Fold scores of the two baselines in long form; a handful of rows, stored once."""
    rows = history(spark, folder)
    bases = fold_bases(rows)
    models = {reports.BASELINE: baselines.naive_forecast, "seasonal": baselines.seasonal_forecast}
    parts = [scored(rows, bases, forecast).withColumn("model", F.lit(model)) for model, forecast in models.items()]
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def _folds(spark, folder):
    folds = validation.folds_of(history(spark, folder))
    return validation.fold_table(spark, folds)


def _fold_rows(spark, folder):
    rows = history(spark, folder)
    folds = validation.folds_of(rows)
    valid = validation.valid_windows(rows, folds).groupBy("fold").agg(
        F.count("*").alias("valid_rows"), F.min("date").alias("valid_start"), F.max("date").alias("valid_end")
    )
    return validation.train_sizes(rows, folds).join(valid, "fold")


def _holdout_rows(spark, folder):
    train, test = split(spark, folder)
    facts = reports.window_facts(train, "train")
    other = reports.window_facts(test, "test")
    return facts.withColumns({c: other.select(c).scalar() for c in other.columns})


def new_folder(spark, kind):
    return f"{shared_folder(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def _load_window(spark, folder):
    """The stored panel up to the end of the last test window but one."""
    path = new_folder(spark, "panels")
    tables.write_panel(star.sales_panel(spark, folder), path)
    first_year, _ = training_years(spark, folder)
    return tables.load_window(
        tables.read_panel(spark, path),
        panel_days(spark, folder)[0] - 2 * HORIZON,
        include_test=True,
        filters=[F.col("year") >= first_year, F.col("sell_price").isNotNull()],
        columns=["item_id", "store_id", "d", "sales", "sell_price"],
    )


def fold_forecasts(spark, folder):
    columns = ["fold", "item_id", "store_id", "date", "sales", "prediction"]
    found = baselines.seasonal_forecast(*fold_frames(history(spark, folder)), BY_FOLD)
    return found.select(*columns)


def _stored_predictions(spark, folder):
    path = new_folder(spark, "predictions")
    tables.write_predictions(fold_forecasts(spark, folder), path)
    return spark.read.parquet(path)


def _ensemble(spark, folder):
    keys = ["item_id", "store_id", "date"]
    train, valid = split(spark, folder)
    one = baselines.seasonal_forecast(train, valid).select(
        *keys, "sales", F.col("prediction").alias("pred_seasonal")
    )
    two = baselines.naive_forecast(train, valid).select(
        *keys, F.col("prediction").alias("pred_naive")
    )
    both = join_checked(one, two, keys, "inner", "one_to_one", keep_rows=True)
    return both.withColumn("prediction", (F.col("pred_seasonal") + F.col("pred_naive")) / 2)


def _context(spark, folder):
    keys = ["item_id", "store_id", "date", "prediction"]
    columns = ["event_name_1", "event_type_1", "snap", "sell_price"]
    rows = history(spark, folder)
    forecast = baselines.seasonal_forecast(*validation.holdout(rows))
    return errors.attach_context(forecast.select(*keys), rows, columns)


def on_errors(build, *args, source=errors_of, **kwargs):
    return lambda spark, folder: build(source(spark, folder), *args, **kwargs)


def on_profile(build, *args, round_to=(), **kwargs):
    def query(spark, folder):
        return rounded(build(profile(spark, folder), *args, **kwargs), *round_to)

    return query


def _extreme(by, worst):
    def query(spark, folder):
        out = errors.extreme_series(profile(spark, folder), by, worst)
        return rounded(out, "contribution", "total_weight", digits=8)

    return query


def _frequency(by_status):
    def query(spark, folder):
        found, forecast_errors = profile_and_errors(spark, folder)
        return errors.frequency_errors(forecast_errors, found, by_status)

    return query


def queries():
    slice_means = ("mean_rmsse", "median_rmsse")
    return {
        "folds": _folds,
        "fold_rows": _fold_rows,
        "holdout_rows": _holdout_rows,
        "load_window": _load_window,
        "stored_predictions": _stored_predictions,
        "forecast_duplicates": lambda s, f: quality.duplicate_rows(
            fold_forecasts(s, f), ["fold", "item_id", "store_id", "date"]
        ),
        "naive_forecast": lambda s, f: naive(s, f).select(
            "item_id", "store_id", "date", "sales", "prediction"
        ),
        "seasonal_forecast": lambda s, f: seasonal(s, f).select(
            "item_id", "store_id", "date", "sales", "prediction"
        ),
        "scales": lambda s, f: hierarchy.level_scales(split(s, f)[0]),
        "mse": lambda s, f: hierarchy.level_errors(seasonal(s, f)),
        "weights": lambda s, f: rounded(
            hierarchy.level_weights(split(s, f)[0]), "dollar_sales", digits=2
        ),
        "wrmsse_levels": lambda s, f: rounded(
            scoring.weighted_levels(metrics(s, f)), "wrmsse_level"
        ),
        "wrmsse": lambda s, f: rounded(
            scoring.wrmsse(scoring.weighted_levels(metrics(s, f))), "wrmsse"
        ),
        "wrmsse_naive": lambda s, f: rounded(
            scoring.wrmsse(scoring.weighted_levels(metrics(s, f, baselines.naive_forecast))), "wrmsse"
        ),
        "wrmsse_keep_zero_scale": lambda s, f: rounded(
            scoring.wrmsse(scoring.weighted_levels(metrics(s, f), "keep")), "wrmsse"
        ),
        "wrmsse_folds_naive": lambda s, f: rounded(
            fold_scores(history(s, f), baselines.naive_forecast), "wrmsse"
        ),
        "wrmsse_folds_seasonal": lambda s, f: rounded(
            fold_scores(history(s, f), baselines.seasonal_forecast), "wrmsse"
        ),
        "zero_scale_audit": lambda s, f: rounded(
            rounded(scoring.zero_scale_audit(metrics(s, f)), "dollar_sales", digits=2), "weight"
        ),
        "zero_scale_audit_early": _early_audit,
        "zero_scale_counts_early": lambda s, f: scoring.zero_scale_counts(scoring.zero_scale_audit(early_metrics(s, f))),
        "wrmsse_keep_early": lambda s, f: rounded(
            scoring.weighted_levels(early_metrics(s, f), "keep"), "wrmsse_level"
        ),
        "cv_report": lambda s, f: rounded(
            reports.cv_report(both_scores(s, f), [1, 2, 3]),
            "fold_1", "fold_2", "fold_3", "mean_wrmsse", "mean_delta",
        ),
        "fold_summary": lambda s, f: rounded(
            reports.fold_summary(fold_scores(history(s, f), baselines.seasonal_forecast)),
            "wrmsse_mean", "wrmsse_std", "wrmsse_worst_fold",
        ),
        "ensemble_baselines": _ensemble,
        "err_overall": lambda s, f: rounded(scoring.point_metrics(errors_of(s, f)), "error_std"),
        "err_series": lambda s, f: rounded(
            errors.series_error_kind(seasonal(s, f)), "error_std"
        ),
        "err_series_status": on_errors(errors.series_status_errors),
        "err_status": on_errors(errors.error_by, ["demand_status"]),
        "err_horizon": on_errors(errors.horizon_errors),
        "err_horizon_folds": on_errors(errors.horizon_errors, BY_FOLD, source=fold_errors),
        "err_horizon_status": on_errors(errors.horizon_status_errors),
        "err_date": on_errors(errors.error_by, ["date"]),
        "err_cat_date": lambda s, f: errors.error_by(
            errors_of(s, f), ["cat_id", "date", C.day_name().alias("day_name")]
        ),
        "err_weekday": lambda s, f: errors.error_and_level_by(
            errors_of(s, f), [C.day_name().alias("day_name")]
        ),
        "err_weekend": lambda s, f: errors.error_and_level_by(
            errors_of(s, f), [C.weekend_flag().alias("is_weekend")]
        ),
        "err_frequency": _frequency(False),
        "err_frequency_status": _frequency(True),
        "err_event": on_errors(errors.event_errors, source=fold_errors),
        "err_event_ratio": on_errors(errors.event_ratio, source=fold_errors),
        "err_event_cat": on_errors(errors.event_errors, ["cat_id"], source=fold_errors),
        "err_event_pivot": on_errors(errors.event_pivot, source=fold_errors),
        "err_snap": on_errors(errors.error_and_level_by, ["snap"]),
        "err_snap_status": on_errors(errors.error_and_level_by, ["snap", "demand_status"]),
        "err_snap_cat": on_errors(errors.error_and_level_by, ["snap", "cat_id"]),
        "err_snap_pivot": on_errors(errors.snap_pivot),
        "err_price_change": on_errors(errors.price_change_errors),
        "err_price_change_cat": on_errors(errors.price_change_errors, ["cat_id"]),
        "err_context": _context,
        "err_profile": lambda s, f: rounded(
            rounded(rounded(profile(s, f), "mean_price"), "dollar_sales", digits=2),
            "weight",
            digits=8,
        ),
        "volume_decile": lambda s, f: errors.volume_deciles(
            errors.recent_volume(split(s, f)[0])
        ),
        "sale_frequency": lambda s, f: errors.sale_frequency(split(s, f)[0]),
        "price_band": lambda s, f: rounded(errors.price_bands(seasonal(s, f)), "mean_price"),
        "err_unweighted_slice": on_profile(errors.unweighted_slices, round_to=slice_means),
        "err_slice": on_profile(errors.slice_errors, round_to=slice_means),
        "err_slice_squared": lambda s, f: rounded(
            errors.slice_errors(profile(s, f, squared=True), ["cat_id", "store_id"]), *slice_means
        ),
        "err_weighted_slice": on_profile(
            errors.weighted_slices,
            round_to=(
                *slice_means, "weighted_error_contribution", "total_weight",
                "share_of_weighted_error",
            ),
        ),
        "err_summary": on_profile(
            errors.summary,
            round_to=("mean_rmsse", "median_rmsse", "p90_rmsse", "p95_rmsse", "p99_rmsse"),
        ),
        "err_high": lambda s, f: rounded(
            rounded(errors.high_errors(profile(s, f)), "dollar_sales", digits=2),
            "weight",
            digits=8,
        ),
        "err_worst": _extreme("contribution", True),
        "err_best": _extreme("contribution", False),
        "err_worst_rmsse": _extreme("rmsse", True),
        "err_best_rmsse": _extreme("rmsse", False),
        "err_kind_slice": lambda s, f: rounded(
            errors.error_kind_by_slice(*profile_and_errors(s, f)),
            "mean_bias", "mean_mae", "median_mae", "mean_error_std", "mean_pct_actual_zero",
            "mean_pct_underforecast", "mean_pct_overforecast",
        ),
        "recent_peaks": lambda s, f: errors.recent_peaks(
            split(s, f)[0].select("item_id", "store_id", "date", "sales"), *ONE_SERIES, 5
        ),
    }


def oracle_sql():
    from oracles import forecast as sql

    return sql.statements()
