"""Registered queries that fit models, and checks on their forecasts that SQL can state.

Trees, grids, folds, seeds and search take the settings of `config`, as the library does.
"""

from __future__ import annotations

import contextvars
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from stocktide.catalog.feature_queries import training_years
from stocktide.config import (
    GLOBAL_TREES, N_FOLDS, N_TRIALS, SEARCH_ROUNDS, SEEDS, STORE_ROUNDS, STORE_TREE_GRID, STORE_TREES, TREE_GRID,
)
from stocktide.plans import gold, models, reports, validation
from stocktide.session import cut_lineage, shared_folder
from stocktide.sources import star_schema as star

FOLDS = list(range(1, N_FOLDS + 1))


def feature_rows(spark, folder):
    """The feature table of the training years, stored: every fit reads it again."""
    panel = star.sales_panel(spark, folder)
    return cut_lineage(gold.build_features(panel, *training_years(spark, folder)))


def split(spark, folder):
    return validation.holdout(feature_rows(spark, folder))


def _glm_forecast(spark, folder):
    return models.fit_predict(*split(spark, folder), models.default_features())[1]


def _tree_forecast(spark, folder):
    return models.tree_forecast(*split(spark, folder), models.default_features())


def _stores(train, test):
    return models.store_forecasts(train, test, models.default_features(), STORE_TREES, STORE_ROUNDS)


def _store_models(spark, folder):
    return _stores(*split(spark, folder))


def _fold_forecasts(spark, folder):
    """Rows, folds and the per-store forecasts of all folds at every tree count."""
    rows = feature_rows(spark, folder)
    folds = validation.folds_of(rows)
    return rows, folds, models.store_out_of_fold(rows, folds, models.default_features(), STORE_TREES, STORE_TREE_GRID)


def _store_folds(spark, folder):
    found = _fold_forecasts(spark, folder)[2]
    return found.groupBy("fold", "store_id").agg(
        F.count("*").alias("rows"), F.sum(models.pred(STORE_ROUNDS)).alias("predicted_units")
    )


def _store_grid(spark, folder):
    rows, folds, found = _fold_forecasts(spark, folder)
    return reports.tree_report(models.store_tree_scores(rows, folds, found, STORE_TREE_GRID), FOLDS)


def _tree_grid(spark, folder):
    rows = feature_rows(spark, folder)
    return reports.tree_report(models.tree_count_scores(rows, validation.folds_of(rows), TREE_GRID), FOLDS)


def _best_trees(spark, folder):
    return reports.best_trees(_tree_grid(spark, folder))


def _group_drop(spark, folder):
    rows = feature_rows(spark, folder)
    scores = models.cross_validate(rows, validation.folds_of(rows), models.group_drops())
    return reports.cv_report(scores, FOLDS)


def _combined(train, test):
    """The mean of both forecasts, fitted at the same time: neither fit keeps all cores busy."""
    names = models.default_features()
    with ThreadPoolExecutor(max_workers=1) as pool:
        # The thread sees the caller's context, so tables that it stores are released with the caller's.
        wide = pool.submit(contextvars.copy_context().run, models.tree_forecast, train, test, names)
        stores = _stores(train, test)
        return cut_lineage(models.ensemble(wide.result(), stores))


def _ensemble(spark, folder):
    train, test = split(spark, folder)
    return models.ensemble_scores(train, _combined(train, test))


def _search(spark, folder):
    rows = feature_rows(spark, folder)
    return models.random_search(rows, validation.folds_of(rows), models.default_features(), N_TRIALS, SEARCH_ROUNDS, seeds=SEEDS)


def _early_stopping(spark, folder):
    """Score by seeds, rounds that forecasts take and rounds that were fitted."""
    train, test = split(spark, folder)
    per_seed, fits = models.early_stopped(train, test, models.default_features(), GLOBAL_TREES, SEARCH_ROUNDS, SEEDS)
    means = models.seed_mean(train, cut_lineage(per_seed), [f.used for f in fits])
    row = (means["wrmsse"], means["trees"], max(f.rounds for f in fits))
    return spark.createDataFrame([row], "wrmsse double, trees int, rounds_fitted int")


def _importance(spark, folder):
    names = models.default_features()
    return models.feature_importance(spark, names, models.fit_trees(split(spark, folder)[0], names)[1])


def _stored_model(spark, folder):
    train, test = split(spark, folder)
    names = models.default_features()
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    models.fit_predict(train, test, names)[0].write().save(path)
    whole = models.score_stored_model(path, train, test, names).withColumn("rows", F.lit("all"))
    weekend = models.score_stored_model(path, train, test, names, "is_weekend = 1").withColumn("rows", F.lit("weekend"))
    return whole.unionByName(weekend)


def _checks(forecast):
    """Per store the rows and distinct keys of a forecast, its units and how many values no forecast may have."""
    bad = F.col("prediction").isNull() | F.isnan("prediction") | (F.col("prediction") < 0)
    return forecast.groupBy("store_id").agg(
        F.count("*").alias("rows"), F.countDistinct(*models.KEYS).alias("keys"),
        F.sum("sales").cast("long").alias("units"), F.count_if(bad).alias("bad_values"),
    )


def _glm_checks(spark, folder):
    return _checks(_glm_forecast(spark, folder))


def _stored_fit(spark, folder):
    """A fit with few rounds, taken up with more and read back: it must forecast what one fit does, in each case."""
    train, test = split(spark, folder)
    names, few = models.default_features(), {**GLOBAL_TREES, "num_leaves": 4, "learning_rate": 0.5}
    once = models.tree_forecast(train, test, names, few, 4)
    again = models.tree_forecast(train, test, names, few, 4)
    both = once.join(again.select(*models.KEYS, F.col("prediction").alias("again")), models.KEYS)
    return _checks(once).join(
        both.groupBy("store_id").agg(F.count_if(F.col("prediction") != F.col("again")).alias("changed")), "store_id"
    )


def queries():
    return {
        "glm_forecast": _glm_forecast,
        "gbt_forecast": _tree_forecast,
        "store_models": _store_models,
        "store_fold_forecasts": _store_folds,
        "store_tree_grid": _store_grid,
        "tree_grid": _tree_grid,
        "best_trees": _best_trees,
        "group_drop": _group_drop,
        "ensemble_models": _ensemble,
        "hyper_search": _search,
        "early_stopping": _early_stopping,
        "feature_importance": _importance,
        "stored_model_score": _stored_model,
        "glm_forecast_checks": _glm_checks,
        "stored_fit_checks": _stored_fit,
    }


def oracle_sql():
    from oracles import models as statements

    return statements.statements()
