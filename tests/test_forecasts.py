from datetime import date
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocktide.config import FEATURE_GROUPS, HIERARCHY_LEVELS
from stocktide.operators import hierarchy, ranking, scoring
from stocktide.plans import baselines, boosting, errors, models, reports, validation


@pytest.fixture(scope="module")
def parts(dense):
    return validation.holdout(dense)


def direct_scale(frame, keys):
    daily = frame.groupby([*keys, "date"])["sales"].sum() if keys else frame.groupby("date")["sales"].sum()
    if not keys:
        return {"total": daily.diff().pow(2).mean()}
    out = {}
    for key, s in daily.groupby(level=list(range(len(keys)))):
        started = s.cumsum().shift(1) > 0
        name = key if isinstance(key, str) else "_".join(key)
        out[name] = s.diff().pow(2).where(started).mean()
    return out


def test_scales_of_all_levels(parts):
    train, _ = parts
    frame = train.toPandas()
    got = {(r["level"], r["series_id"]): r["scale"] for r in hierarchy.level_scales(train).collect()}
    want = {
        (level, name): value
        for level, keys in HIERARCHY_LEVELS.items()
        for name, value in direct_scale(frame, list(keys)).items()
    }
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


def test_leading_zeros_do_not_count(make_panel):
    sales = [0, 0, 0, 0, 4, 2, 2]
    panel = make_panel([("i1", "s1", d + 1, s, 1.0) for d, s in enumerate(sales)])
    scale = {r["level"]: r["scale"] for r in hierarchy.level_scales(panel).collect()}
    assert scale["item_store"] == pytest.approx((4 + 0) / 2)
    assert scale["total"] == pytest.approx((16 + 4 + 0) / 6)


def test_perfect_forecast_scores_zero(parts):
    train, valid = parts
    perfect = valid.withColumn("prediction", F.col("sales").cast("double"))
    assert scoring.score(train, perfect).first()["wrmsse"] == 0


def test_weights_cover_28_days_and_every_level_sums_alike(parts):
    train, _ = parts
    frame = train.toPandas()
    recent = frame[pd.to_datetime(frame["date"]) > pd.to_datetime(frame["date"]).max() - pd.Timedelta(days=28)]
    want = (recent["sales"] * recent["sell_price"]).sum()
    sums = hierarchy.level_weights(train).groupBy("level").agg(F.sum("dollar_sales").alias("s"))
    assert {round(r["s"], 6) for r in sums.collect()} == {round(want, 6)}
    assert sums.count() == 12


def test_series_never_sold_is_dropped_or_kept(make_panel):
    rows = [("i1", "s1", d, d % 3, 1.0) for d in range(1, 61)]
    rows += [("i2", "s1", d, 0 if d <= 32 else 1, 1.0) for d in range(1, 61)]
    train, valid = validation.holdout(make_panel(rows))
    metrics = scoring.series_metrics(train, baselines.naive_forecast(train, valid))
    audit = scoring.zero_scale_audit(metrics)
    assert {r["series_id"] for r in audit.collect()} == {"i2", "i2_S1", "i2_s1"}
    assert not any(r["causes_inf"] for r in audit.collect())
    assert scoring.zero_scale_counts(audit).count() == 3
    assert scoring.wrmsse(scoring.weighted_levels(metrics)).first()[0] > 0


def test_folds_roll_and_never_overlap():
    folds = validation.make_folds(date(2015, 1, 1), date(2015, 12, 31))
    assert [f.folds for f in folds] == [1, 2, 3]
    assert folds[-1].valid_end == date(2015, 12, 31)
    for f in folds:
        assert (f.valid_start - f.train_end).days == 1 and (f.valid_end - f.valid_start).days == 27
    assert folds[0].valid_end < folds[1].valid_start


def test_holdout_is_28_days(parts):
    train, valid = parts
    assert valid.select("date").distinct().count() == 28
    assert train.agg(F.max("d")).first()[0] == 72


def test_baselines_fill_new_series_with_zero(make_panel):
    rows = [("i1", "s1", d, d, 1.0) for d in range(1, 61)]
    rows += [("i2", "s1", d, 9, 1.0) for d in range(40, 61)]
    train, valid = validation.holdout(make_panel(rows))
    naive = {(r["item_id"], r["d"]): r["prediction"] for r in baselines.naive_forecast(train, valid).collect()}
    assert naive["i1", 33] == naive["i1", 60] == 32 and naive["i2", 50] == 0
    season = {(r["item_id"], r["d"]): r["prediction"] for r in baselines.seasonal_forecast(train, valid).collect()}
    assert season["i1", 33] == 26 and season["i1", 40] == 26 and season["i1", 39] == 32
    assert season["i2", 50] == 0


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=n), 1)
    df = spark.createDataFrame([(float(v), "a" if i % 3 else None) for i, v in enumerate(x)], "x double, k string")
    points = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    row = ranking.exact_quantiles(df, "x", points).first()
    for name, p in points.items():
        assert row[name] == pytest.approx(np.quantile(x, p))
    by_key = {r["k"]: r["p50"] for r in ranking.exact_quantiles(df, "x", points, ["k"]).collect()}
    assert by_key[None] == pytest.approx(np.median(x[::3]))


def test_volume_deciles_equal_qcut_on_ranks(spark):
    rows = [(f"i{n:02d}", "s1", float(n % 9 + 1)) for n in range(23)] + [("z", "s1", 0.0)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, mean_sales double")
    got = {r["item_id"]: r["volume_decile"] for r in errors.volume_deciles(df).collect()}
    frame = pd.DataFrame(rows[:-1], columns=["item_id", "s", "m"]).sort_values(["m", "item_id"])
    cut = pd.qcut(np.arange(1, 24), 10, labels=[f"D{d:02d}" for d in range(1, 11)])
    assert got.pop("z") == "D00 no sales"
    assert got == dict(zip(frame["item_id"], cut.astype(str)))


def test_price_change_needs_a_previous_price(make_panel):
    panel = make_panel([("i1", "s1", d + 1, 1, p) for d, p in enumerate([2.0, 2.0, 2.5, 2.5, None, 3.0])])
    marked = errors.with_price_changed(panel).orderBy("d")
    assert [r["price_changed"] for r in marked.collect()] == [False, False, True, False, False, False]


def test_cv_report(spark):
    rows = [("baseline", 1, 1.0), ("baseline", 2, 2.0), ("x", 1, 1.5), ("x", 2, 1.8)]
    scores = spark.createDataFrame(rows, "model string, fold int, wrmsse double")
    report = {r["model"]: r for r in reports.cv_report(scores, [1, 2]).collect()}
    assert report["x"]["mean_delta"] == pytest.approx(0.15) and report["x"]["folds_worse"] == 1
    assert report["baseline"]["mean_delta"] == 0
    trees = spark.createDataFrame([(5, 1, 0.7), (9, 1, 0.6), (20, 1, 0.6)], "trees int, fold int, wrmsse double")
    assert reports.best_trees(reports.tree_report(trees, [1])).first()["best_trees"] == 9


def test_drawn_settings_stay_in_range():
    import random

    space = {"a": (31, 255, True), "b": (0.4, 1.0, False)}
    one, two = (models.draw(space, random.Random(1)) for _ in range(2))
    assert one == two and 31 <= one["a"] <= 255 and isinstance(one["a"], int) and 0.4 <= one["b"] <= 1


NAMES = ["lag", "day_of_week"]
SMALL = {"num_leaves": 8, "min_data_in_leaf": 1, "max_bin": 31, "learning_rate": 0.5,
         "bagging_fraction": 1.0, "feature_fraction": 1.0, "seed": 1, "num_iterations": 4}


@pytest.fixture(scope="module")
def model_rows(make_panel):
    rows = [
        (i, s, d, (d % 7 == 0) * 6 + (d % 7 == 6) * 3 + (i == "i2"), 2.0)
        for i in ("i1", "i2") for s in ("s1", "s2") for d in range(1, 99)
    ]
    panel = make_panel(rows).withColumn("day_of_week", F.weekday("date") + 1)
    return validation.holdout(panel.withColumn("lag", (F.col("item_id") == "i2").cast("int")))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 3)


def test_trees_beat_naive_and_any_prefix_is_a_model(model_rows, small_blocks):
    train, valid = model_rows
    inputs = models.tree_inputs(train, NAMES)
    vectors = inputs.vectors(train)
    model = boosting.fit(vectors, SMALL, 8)
    assert [b.getNumTrees for b in model.blocks] == [3, 3, 2] and model.used == 8
    wide = models.with_tree_counts(inputs, model, valid, [2, 3, 7, 8, 99])
    for n in (3, 8):  # ends of blocks, against a fit of so many rounds
        alone = models.never_negative(boosting.fit(vectors, SMALL, n).forecast(inputs.vectors(valid, *models.OUTPUT), "_t"), "_t")
        both = wide.join(alone, ["item_id", "store_id", "date"])
        assert both.where(F.abs(F.col("prediction") - F.col(f"pred_{n}")) > 1e-9).count() == 0
    trees = model.blocks[0].trees
    first_two = trees[1].setPredictionCol("b").transform(trees[0].setPredictionCol("a").transform(inputs.vectors(valid, *models.OUTPUT)))
    by_hand = first_two.select(*models.KEYS, (F.col("a") + F.col("b") * model.blocks[0].treeWeights[1]).alias("sum"))
    both = wide.join(by_hand, models.KEYS)
    assert both.where(F.abs(F.greatest(F.col("sum"), F.lit(0.0)) - F.col("pred_2")) > 1e-9).count() == 0
    assert wide.where("pred_8 <> pred_99").count() == 0
    naive = scoring.score(train, baselines.naive_forecast(train, valid)).first()[0]
    scores = {r["trees"]: r["wrmsse"] for r in models.score_variants(train, models.long_predictions(wide, [2, 8]), "trees").collect()}
    assert scores[8] < naive and scores[8] < scores[2]


def test_a_stored_fit_is_taken_up(spark, model_rows, small_blocks, tmp_path):
    train, valid = model_rows
    inputs = models.tree_inputs(train, NAMES)
    vectors, folder = inputs.vectors(train), str(tmp_path / "fit")
    boosting.fit(vectors, SMALL, 3, folder=folder)
    longer = boosting.fit(vectors, SMALL, 6, folder=folder)
    again = boosting.fit(vectors, SMALL, 6, folder=folder)
    whole = boosting.fit(vectors, SMALL, 6)
    assert [b.uid for b in again.blocks] == [b.uid for b in longer.blocks] and len(longer.blocks) == 2
    target = inputs.vectors(valid, *models.OUTPUT)
    found = again.forecast(target, "a").join(whole.forecast(target, "b").select(*models.KEYS, "b"), models.KEYS)
    assert found.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert boosting.fit(vectors, SMALL, 2, folder=folder).used == 2  # fewer rounds of the same fit
    other = valid.withColumn("sales", F.col("sales") + F.col("day_of_week"))
    score = models.score_stored_trees(folder, train, other, NAMES, 6).first()[0]
    some = models.score_stored_trees(folder, train, other, NAMES, 6, "day_of_week < 4").first()[0]
    assert score > 0 and some > 0 and score != some
    with pytest.raises(ValueError, match="holds 6 rounds"):
        models.score_stored_trees(folder, train, valid, NAMES, 60)
    one, other = boosting.fingerprint(train, NAMES), boosting.fingerprint(train.where("d > 5"), NAMES)
    assert one == boosting.fingerprint(train.repartition(5), NAMES) != other
    names = {boosting.fit_folder(spark, d, p) for d in (one, other) for p in (SMALL, {**SMALL, "num_leaves": 4}, {**SMALL, "num_iterations": 9})}
    assert len(names) == 4


def test_plans_of_kept_rows_do_not_double_with_blocks(model_rows):
    inputs = models.tree_inputs(model_rows[0], NAMES)
    kept = boosting._Margins(boosting.in_tasks(inputs.vectors(model_rows[0])), [])
    block = boosting.learner(SMALL, 1).fit(kept.left())
    first, sizes = kept.left().orderBy("left").first()["left"], []
    layout = [r.n for r in kept.rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()]
    for _ in range(11):
        kept.move(block)
        sizes.append(len(kept.rows._jdf.queryExecution().toString()))
    assert max(sizes[4:]) <= 2 * max(sizes[:4])
    step = block.transform(kept.rows).agg(F.max(F.abs(F.col("margin") - 11 * F.col("step")))).first()[0]
    assert step < 1e-9 and first == min(r.label for r in kept.rows.collect())
    assert layout == [r.n for r in kept.rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()]
    folder = Path(kept.folder.removeprefix("file:"))
    assert folder.is_dir()
    kept.release()
    assert not folder.exists()


def test_boosting_stops_when_the_tail_gets_no_better(model_rows, small_blocks):
    errors = [5.0, 4.0, 4.5, 4.2, 3.0, *[3.1] * 50, 2.0]
    assert boosting.best_round(errors) == 5 and boosting.best_round(errors, 1) == 2 and boosting.best_round([2.0]) == 1
    assert boosting.best_round(errors, 60) == len(errors)
    train, valid = model_rows
    marked = models.with_stop_rows(train)
    noisy = marked.withColumn("sales", F.when(F.col("stop_row"), F.lit(1)).otherwise(F.col("sales")))
    inputs = models.tree_inputs(noisy.where("NOT stop_row"), NAMES)
    fitted, tail = inputs.vectors(noisy.where("NOT stop_row")), inputs.vectors(noisy.where("stop_row"), "item_id")
    model = boosting.fit(fitted, SMALL, 300, stop_rows=tail, patience=4)
    assert model.rounds <= model.used + boosting.BLOCK + 4 < 300
    wide = model.staged(tail, range(1, model.rounds + 1), models.pred)
    by_hand = wide.agg(*[F.avg((F.col("label") - F.col(models.pred(n))) ** 2) for n in range(1, model.rounds + 1)]).first()
    plain = [e for e in model.errors]
    assert len(plain) == model.rounds and model.used == min(range(len(plain)), key=lambda k: plain[k]) + 1
    assert by_hand[model.used - 1] == pytest.approx(plain[model.used - 1], abs=1e-6)
    found, fits = models.early_stopped(train, valid, NAMES, SMALL, 6, (1, 2))
    assert found.count() == 2 * valid.count() and all(1 <= f.used <= 6 for f in fits)


def test_store_models_and_ensemble(spark, model_rows, small_blocks):
    train, valid = model_rows
    stores = models.store_forecasts(train, valid, NAMES, SMALL, 2, workers=2)
    assert stores.count() == valid.count() and stores.columns == [*models.OUTPUT, "prediction"]
    alone = models.tree_forecast(train.where("store_id = 's1'"), valid.where("store_id = 's1'"), NAMES, SMALL, 2)
    both = stores.join(alone.select(*models.KEYS, F.col("prediction").alias("alone")), models.KEYS)
    assert both.count() == alone.count() and both.where(F.abs(F.col("prediction") - F.col("alone")) > 1e-9).count() == 0
    grid = models.store_forecasts(train, valid, NAMES, SMALL, 4, (1, 4))
    assert grid.columns == [*models.OUTPUT, "pred_1", "pred_4"]
    combined = models.ensemble(models.tree_forecast(train, valid, NAMES, SMALL, 2), stores)
    row = combined.first()
    assert row["prediction"] == pytest.approx((row["pred_global"] + row["pred_store"]) / 2)
    assert models.ensemble_scores(train, combined).count() == 3
    importance = models.feature_importance(spark, NAMES, models.fit_trees(train, NAMES, SMALL, 4)[1])
    assert importance.agg(F.sum("gain_pct")).first()[0] == pytest.approx(100)
    top = models.feature_importance(spark, NAMES, models.fit_trees(train, NAMES, SMALL, 4)[1], top=1).collect()
    assert len(top) == 1 and top[0]["gain"] == importance.agg(F.max("gain")).first()[0]


def test_folds_of_store_models(model_rows, small_blocks):
    train, _ = model_rows
    folds = validation.folds_of(train, 2, 7)
    found = models.store_out_of_fold(train, folds, NAMES, SMALL, (1, 2))
    assert {(r.fold, r["count"]) for r in found.groupBy("fold").count().collect()} == {(1, 28), (2, 28)}
    assert models.store_tree_scores(train, folds, found, (1, 2)).count() == 4
    assert models.tree_count_scores(train, folds, (1, 2), NAMES, SMALL).count() == 4


def test_linear_inputs_tell_unknown_from_none_and_leave_out_constants(spark, model_rows):
    train, _ = model_rows
    rows = train.withColumns({
        "lag": F.when(F.col("d") > 40, F.col("lag")), "fixed": F.lit(3.0), "weekday": F.date_format("date", "EEEE"),
    })
    inputs = models.glm_inputs(rows, ["lag", "fixed", "weekday", "item_id", "store_id"], id_width=16)
    assert inputs.places["fixed"] == [] and len(inputs.places["lag"]) == 2 and len(inputs.places["weekday"]) == 7
    assert 1 <= len(inputs.places["item_id"]) <= 2
    made = inputs.vectors(rows, "d", "item_id")
    size = sum(map(len, inputs.places.values()))
    one = {(r.d, r.item_id): r.features.toArray().tolist() for r in made.where("d IN (40, 41) AND store_id = 's1'" if "store_id" in made.columns else "d IN (40, 41)").collect()}
    assert all(len(v) == size for v in one.values())
    at = inputs.places["lag"]
    assert [one[40, "i2"][i] for i in at] == [0.0, 1.0] and [one[41, "i1"][i] for i in at] == [0.0, 0.0] and one[41, "i2"][at[0]] > 0
    assert inputs.without(["weekday", "fixed"]) == sorted(inputs.places["lag"] + inputs.places["item_id"] + inputs.places["store_id"])


def test_group_drops_slice_one_vector(model_rows):
    train, _ = model_rows
    names = [*NAMES, "item_id"]
    folds = validation.folds_of(train, 1, 14)
    drops = models.group_drops({"ids": ("item_id",), "lags": ("lag",), "other": ("snap",)}, names)
    assert list(drops) == ["baseline", "ids_dropped", "lags_dropped"]
    assert "ids_dropped" in models.group_drops() and len(models.group_drops()) == 1 + len(FEATURE_GROUPS) - 1  # year is excluded
    scores = {r.model: r.wrmsse for r in models.cross_validate(train, folds, drops, names).collect()}
    part, valid = validation.split(train, folds[0])
    for model, kept in (("baseline", names), ("ids_dropped", NAMES)):
        alone = models.fit_predict(part, valid, kept)[1].withColumn("model", F.lit(model))
        assert scores[model] == pytest.approx(models.score_variants(part, alone, "model").first()["wrmsse"], rel=1e-6)


def test_search_reports_what_learners_read(model_rows, small_blocks):
    train, _ = model_rows
    found = models.random_search(train, validation.folds_of(train, 1, 14), NAMES, 2, 3, start={**SMALL, "tweedie_variance_power": 1.1}, seeds=(1,))
    rows = {(r.learner, r.number): r for r in found.collect()}
    assert set(rows) == {("trees", 0), ("trees", 1), ("glm", 0), ("glm", 1)}
    assert rows["trees", 0].num_leaves == 8 and rows["trees", 1].lambda_l2 is None and rows["trees", 0].trees >= 1
    assert rows["glm", 0].tweedie_variance_power == 1.1 and rows["glm", 1].num_leaves is None and rows["glm", 1].trees is None


def test_forecasts_of_an_ensemble_are_fitted_at_the_same_time(monkeypatch):
    from threading import Barrier

    from stocktide.catalog import model_queries as q

    both = Barrier(2)
    for name in ("tree_forecast", "store_forecasts"):  # each waits until the other has begun
        monkeypatch.setattr(models, name, lambda *a, name=name, **k: both.wait(20) is not None and name)
    monkeypatch.setattr(models, "ensemble", lambda *a: a)
    monkeypatch.setattr(q, "cut_lineage", lambda df: df)
    assert q._combined("train", "test") == ("tree_forecast", "store_forecasts")


def test_model_queries_take_the_settings(monkeypatch):
    from datetime import date

    from stocktide import config
    from stocktide.catalog import model_queries as q

    seen = {}
    windows = lambda rows, n=config.N_FOLDS: validation.make_folds(date(2015, 1, 1), date(2016, 12, 31), n)
    monkeypatch.setattr(q, "feature_rows", lambda spark, folder: "rows")
    monkeypatch.setattr(q, "split", lambda spark, folder: ("train", "test"))
    monkeypatch.setattr(q, "cut_lineage", lambda df: df)
    monkeypatch.setattr(validation, "folds_of", windows)
    for name in ("tree_count_scores", "cross_validate", "random_search", "store_forecasts", "store_out_of_fold", "tree_forecast", "store_tree_scores"):
        monkeypatch.setattr(models, name, lambda *a, name=name, **k: seen.update({name: (a, k)}))
    monkeypatch.setattr(models, "early_stopped", lambda *a: seen.update(early_stopped=(a, {})) or (None, [boosting.Boosted([], 0)]))
    monkeypatch.setattr(models, "seed_mean", lambda *a: {"wrmsse": 0.0, "trees": 0})
    monkeypatch.setattr(models, "ensemble", lambda *a: None)
    monkeypatch.setattr(models, "ensemble_scores", lambda *a: None)
    for name in ("tree_report", "cv_report"):
        monkeypatch.setattr(reports, name, lambda scores, folds, name=name: seen.update({name: folds}))

    class Session:
        def createDataFrame(self, rows, schema):
            return rows

    for name in ("tree_grid", "store_tree_grid", "group_drop", "hyper_search", "early_stopping", "store_models", "ensemble_models", "gbt_forecast"):
        q.queries()[name](Session(), "folder")
    for name in ("tree_count_scores", "cross_validate", "random_search", "store_out_of_fold"):
        assert [f.folds for f in seen[name][0][1]] == [1, 2, 3]
    full = models.default_features()
    assert len(full) == 58 and set(models.IDS) <= set(full) | {"year"}
    assert seen["tree_count_scores"][0][2] == config.TREE_GRID and not seen["tree_count_scores"][1]
    assert seen["store_out_of_fold"][0][2:] == (full, config.STORE_TREES, config.STORE_TREE_GRID)
    assert seen["store_forecasts"][0] == ("train", "test", full, config.STORE_TREES, 200)
    assert seen["tree_forecast"] == (("train", "test", full), {})
    assert seen["tree_report"] == seen["cv_report"] == [1, 2, 3]
    assert seen["random_search"][0][3:] == (config.N_TRIALS, 3000) and config.N_TRIALS > 10
    assert seen["random_search"][1] == {"seeds": (1, 2, 3)}
    assert seen["early_stopped"][0][3:] == (config.GLOBAL_TREES, 3000, (1, 2, 3))


def test_all_store_fits_of_a_chain_run_at_the_same_time(model_rows, monkeypatch):
    from threading import Barrier
    from types import SimpleNamespace

    all_at_once = Barrier(25)

    def fit(rows, *args, **kwargs):  # each waits until the fits of all stores have begun
        all_at_once.wait(60)
        n = rows.count()
        return SimpleNamespace(staged=lambda target, counts, name: target.withColumns({name(c): F.lit(float(n)) for c in counts}))

    many = [r.crossJoin(r.sparkSession.range(25).withColumnRenamed("id", "_s")).withColumn("store_id", F.format_string("s%02d", "_s")).drop("_s")
            for r in (rows.where("store_id = 's1' AND item_id = 'i1'") for rows in model_rows)]
    monkeypatch.setattr(boosting, "fit", fit)
    made = models.store_forecasts(*many, NAMES, SMALL, 2)
    each = many[0].count() // 25
    assert each > 0 and made.count() == many[1].count() and {r.prediction for r in made.collect()} == {float(each)}


def test_search_computes_sure_scores_side_by_side(spark, monkeypatch):
    """Sure scores begin at the same time; the trials, and which of them are stopped, are those of one after another."""
    import random
    import statistics
    from threading import Barrier
    from types import SimpleNamespace

    together, asked, gone = Barrier(2), [], []

    def value(setting, fold):
        return sum(float(v) for v in setting.values()) * (1 + fold * 0.37) % 7

    class Trials:
        def __init__(self, train, valid, *_):
            self.fold = valid

        def score(self, setting):
            if len(asked) < 2:  # each waits until another one has begun
                asked.append((self.fold, tuple(setting.values())))
                together.wait(20)
            else:
                asked.append((self.fold, tuple(setting.values())))
            return value(setting, self.fold), 3 + self.fold

        def release(self):
            gone.append(self.fold)

    monkeypatch.setattr(models, "_TreeTrials", Trials)
    monkeypatch.setattr(models, "split", lambda rows, fold: ("train", fold.folds))
    folds = [SimpleNamespace(folds=k) for k in (1, 2, 3)]
    found = models.random_search(spark.range(1), folds, NAMES, 12, 3, learners=("trees",), warm_up=4).collect()

    generator, history, expected, computed = random.Random(42), [], [], []
    for number in range(12):
        setting = {k: models.GLOBAL_TREES[k] for k in models.TREE_SPACE} if number == 0 else models.draw(models.TREE_SPACE, generator)
        running, state = [], "complete"
        for k in (1, 2, 3):
            computed.append((k, tuple(setting.values())))
            running.append((sum(running[-1:]) * len(running) + value(setting, k)) / (len(running) + 1))
            if len(history) >= 4 and running[-1] > statistics.median(h[k - 1] for h in history):
                state = "stopped"
                break
        history += [running] if state == "complete" else []
        expected.append((number, state, running[-1]))
    assert [(r.number, r.state, r.wrmsse) for r in found] == expected
    assert {r.state for r in found} == {"complete", "stopped"}
    assert sorted(asked) == sorted(computed) and sorted(gone) == [1, 2, 3]


def test_stored_references_give_the_same_score(model_rows):
    train, valid = model_rows
    made = valid.select(*models.OUTPUT, F.lit(2.0).alias("prediction"), F.lit("a").alias("model"))
    plain = models.score_variants(train, made, "model").first()["wrmsse"]
    assert plain > 0 and models.score_variants(train, made, "model", against=models.references(train)).first()["wrmsse"] == pytest.approx(plain, rel=1e-12)


def test_store_fits_of_all_folds_run_at_the_same_time(model_rows, monkeypatch):
    from threading import Barrier
    from types import SimpleNamespace

    train, _ = model_rows
    folds = validation.folds_of(train, 3, 7)
    windows = [validation.split(train, f) for f in folds]
    of_each = [{r.store_id: r["count"] for r in part.groupBy("store_id").count().collect()} for part, _ in windows]
    all_at_once = Barrier(sum(map(len, of_each)))

    def fit(rows, *args, **kwargs):  # each waits until the fits of all folds have begun
        all_at_once.wait(60)
        n = rows.count()
        return SimpleNamespace(staged=lambda target, counts, name: target.withColumns({name(c): F.lit(float(n)) for c in counts}))

    monkeypatch.setattr(boosting, "fit", fit)
    found = models.store_out_of_fold(train, folds, NAMES, SMALL, (1, 2)).collect()
    assert len(found) == sum(valid.count() for _, valid in windows) > 0
    assert {(r.fold, r.store_id, r.pred_1, r.pred_2) for r in found} == {
        (f.folds, s, float(n), float(n)) for f, each in zip(folds, of_each) for s, n in each.items()
    }
