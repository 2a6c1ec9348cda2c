"""Forecast models on `pyspark.ml`: inputs, fits, group drops, tree counts, search, stores, ensembles.

Two learners share their inputs' names. The generalised linear model minimises the Tweedie deviance with a log
link; boosted trees (`plans.boosting`) take squared loss and their forecasts are cut at zero. Inputs are assembled
to vectors once; variants without some of them slice the vector. All variants of an experiment are
scored in one job, and fits that don't depend on each other run side by side.
"""

from __future__ import annotations

import math
import random
import statistics
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.config import (
    CATEGORICAL_FEATURES,
    FEATURE_GROUPS,
    GLM_SPACE,
    GLOBAL_TREES,
    HORIZON,
    ID_WIDTH,
    SERIES_KEYS,
    TREE_SPACE,
    model_features,
)
from stocktide.operators import scoring
from stocktide.operators.hierarchy import level_scales, level_weights
from stocktide.operators.joins import join_checked
from stocktide.plans import boosting
from stocktide.plans.boosting import FEATURES_COLUMN, PATIENCE, Boosted, side_by_side
from stocktide.plans.validation import Fold, split
from stocktide.session import cut_lineage, shared_folder

KEYS = [*SERIES_KEYS, "date"]
OUTPUT = ["item_id", "store_id", "cat_id", "dept_id", "state_id", "date", "sales", "sell_price"]
IDS = FEATURE_GROUPS["ids"]
#: Fits that run at a time.
WORKERS = 4
#: The same for fits of one store: their stages are one or a few small tasks, so more of them fill the cores, and in
#: fewer turns, each of which ends with idle cores.
STORE_WORKERS = 32
#: Trials of a search that are scored at a time; each of them fits its seeds side by side.
TRIAL_WORKERS = 2


def default_features(drop_group: str | None = None) -> list[str]:
    """All features of all groups, or of all but one."""
    return model_features(drop_group=drop_group)


def prepare(features: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast model inputs to double, mark unknown values (no history yet) with NULL, and add the label."""
    numeric = [n for n in names if n not in CATEGORICAL_FEATURES]
    return features.withColumns({n: F.col(n).cast("double") for n in numeric}).withColumn("label", F.col("sales").cast("double"))


@dataclass
class Inputs:
    """Fitted stages from prepared rows to `features`, and which places of the vector each input name fills.

    The places of inputs that don't vary in the rows they were fitted on are left out: they tell nothing, and
    a solver of normal equations breaks on them.
    """

    stages: PipelineModel
    places: dict[str, list[int]]

    def vectors(self, rows: DataFrame, *keep: str) -> DataFrame:
        kept = dict.fromkeys([*keep, "label", FEATURES_COLUMN])
        return self.stages.transform(prepare(rows, self.places)).select(*kept)

    def without(self, dropped: Iterable[str]) -> list[int]:
        """Places of all inputs but the dropped ones."""
        gone = set(dropped)
        return sorted(i for n, places in self.places.items() if n not in gone for i in places)


def tree_inputs(train: DataFrame, names: Sequence[str], bins: int = GLOBAL_TREES["max_bin"]) -> Inputs:
    """One place per name: unknown numbers are -1, which trees can split off; names are indexed.

    Names of more values than a tree has bins can't be split as sets; they count as numbers in order of frequency.
    """
    rows = prepare(train, names)
    words = [n for n in names if n in CATEGORICAL_FEATURES]
    known = ", ".join(f"coalesce(`{n}`, -1D) AS `{n}_in`" for n in names if n not in words)
    stages: list = [SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__")] if known else []
    if words:
        indexer = StringIndexer(inputCols=words, outputCols=[f"{n}_code" for n in words], handleInvalid="keep").fit(rows)
        plain = ", ".join(
            f"{n}_code + 0D AS {n}_in" if len(labels) >= bins else f"{n}_code AS {n}_in" for n, labels in zip(words, indexer.labelsArray)
        )
        stages += [indexer, SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__")]
    stages.append(VectorAssembler(inputCols=[f"{n}_in" for n in names], outputCol=FEATURES_COLUMN))
    return Inputs(Pipeline(stages=stages).fit(rows), {n: [i] for i, n in enumerate(names)})


def glm_inputs(train: DataFrame, names: Sequence[str], id_width: int = ID_WIDTH) -> Inputs:
    """Logarithms of numbers, a flag for each that can be unknown, one-hot names, and ids hashed to `id_width` places.

    Under a log link a raw level of 100 units would enter as exp(100 b); its logarithm enters as a power of the
    level. The width of ids doesn't grow with their number.
    """
    rows = prepare(train, names)
    words = [n for n in names if n in CATEGORICAL_FEATURES and n not in IDS]
    ids = [n for n in names if n in IDS]
    numbers = [n for n in names if n not in CATEGORICAL_FEATURES]
    columns = [f"coalesce(signum(`{n}`) * ln(1 + abs(`{n}`)), 0D) AS `{n}_log`, CAST(`{n}` IS NULL AS DOUBLE) AS `{n}_unknown`" for n in numbers]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")] if columns else []
    inputs = [(n, f"{n}_{kind}") for n in numbers for kind in ("log", "unknown")]
    if words:
        codes, hot = [f"{n}_code" for n in words], [f"{n}_hot" for n in words]
        stages.append(StringIndexer(inputCols=words, outputCols=codes, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, handleInvalid="keep"))
        inputs += list(zip(words, hot))
    for n in ids:
        stages.append(FeatureHasher(inputCols=[n], outputCol=f"{n}_hashed", numFeatures=id_width))
        inputs.append((n, f"{n}_hashed"))
    whole = "_all_features"
    stages.append(VectorAssembler(inputCols=[c for _, c in inputs], outputCol=whole))
    fitted = Pipeline(stages=stages).fit(rows)
    made = fitted.transform(rows)
    spread = made.select(Summarizer.variance(F.col(whole))).first()[0].toArray()
    one = made.first()
    owner = [n for n, c in inputs for _ in range(len(one[c]) if hasattr(one[c], "__len__") else 1)]
    varying = [i for i, v in enumerate(spread) if v > 0]
    slicer = VectorSlicer(inputCol=whole, outputCol=FEATURES_COLUMN, indices=varying)
    places: dict[str, list[int]] = {n: [] for n in names}
    for at, i in enumerate(varying):
        places[owner[i]].append(at)
    return Inputs(PipelineModel(stages=[*fitted.stages, slicer]), places)


def glm(variance_power: float = 1.1, regularisation: float = 0.1, max_iterations: int = 10, column: str = FEATURES_COLUMN) -> GeneralizedLinearRegression:
    """Tweedie regression with a log link."""
    return GeneralizedLinearRegression(
        family="tweedie", variancePower=variance_power, linkPower=0.0, regParam=regularisation,
        maxIter=max_iterations, featuresCol=column, labelCol="label", predictionCol="_glm",
    )


def never_negative(made: DataFrame, column: str, name: str = "prediction") -> DataFrame:
    return made.select(*OUTPUT, F.greatest(F.col(column), F.lit(0.0)).alias(name))


def fit_predict(
    train: DataFrame, valid: DataFrame, names: Sequence[str], learner: GeneralizedLinearRegression | None = None
) -> tuple[PipelineModel, DataFrame]:
    """A fitted linear model with its input stages, and its forecasts."""
    inputs = glm_inputs(train, names)
    vectors = boosting.in_tasks(inputs.vectors(train)).persist()
    try:
        fitted = (learner or glm()).fit(vectors)
    finally:
        vectors.unpersist()
    model = PipelineModel(stages=[*inputs.stages.stages, fitted])
    return model, predict(model, valid, names)


def predict(model: PipelineModel, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return never_negative(model.transform(prepare(rows, names)), "_glm")


def fit_trees(
    train: DataFrame, names: Sequence[str], params: Mapping[str, float] = GLOBAL_TREES, rounds: int | None = None
) -> tuple[Inputs, Boosted]:
    """Boosted trees on all rows; the same rows and settings take the stored blocks of an earlier fit."""
    inputs = tree_inputs(train, names, int(params["max_bin"]))
    digest = boosting.fingerprint(train, [*names, "sales"])
    folder = boosting.fit_folder(train.sparkSession, digest, params)
    return inputs, boosting.fit(inputs.vectors(train), params, rounds, folder=folder)


def tree_forecast(
    train: DataFrame, valid: DataFrame, names: Sequence[str], params: Mapping[str, float] = GLOBAL_TREES, rounds: int | None = None
) -> DataFrame:
    inputs, model = fit_trees(train, names, params, rounds)
    return never_negative(model.forecast(inputs.vectors(valid, *OUTPUT), "_trees"), "_trees")


def pred(n: int) -> str:
    return f"pred_{n}"


def with_tree_counts(inputs: Inputs, model: Boosted, rows: DataFrame, grid: Sequence[int]) -> DataFrame:
    """Forecasts of the first n trees for every n of the grid, as columns, from one fit and one pass."""
    return model.staged(inputs.vectors(rows, *OUTPUT), grid, pred).select(*OUTPUT, *map(pred, grid))


def long_predictions(wide: DataFrame, grid: Sequence[int], label: str = "trees") -> DataFrame:
    """One row per forecast and tree count."""
    pairs = [F.struct(F.lit(n).alias(label), F.col(pred(n)).alias("prediction")) for n in grid]
    return wide.withColumn("_p", F.explode(F.array(*pairs))).select(*OUTPUT, f"_p.{label}", "_p.prediction")


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def references(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scales and weights of all levels, stored: for forecasts of one window that are scored in many jobs."""
    return cut_lineage(level_scales(train)), cut_lineage(level_weights(train))


def score_variants(
    train: DataFrame, predictions: DataFrame, variant: str, fold: int = 1, against: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Score of every variant stacked in `predictions`, in one job; scales are computed once, or are those of `against`."""
    scales, weights = against or (level_scales(train), level_weights(train))
    mse = scoring.level_errors(predictions, by=[variant])
    metrics = mse.join(scales, ["level", "series_id"]).join(weights, ["level", "series_id"])
    levels = scoring.weighted_levels(metrics, by=[variant])
    return scoring.wrmsse(levels, [variant]).withColumn("fold", F.lit(fold))


def group_drops(groups: Mapping[str, Sequence[str]] = FEATURE_GROUPS, names: Sequence[str] | None = None) -> dict[str, list[str]]:
    """What each variant leaves out: nothing for the baseline, then one group after another that has an input."""
    full = list(names or default_features())
    return {"baseline": [], **{f"{g}_dropped": list(c) for g, c in groups.items() if set(c) & set(full)}}


def cross_validate(
    rows: DataFrame,
    folds: Sequence[Fold],
    drops: Mapping[str, Sequence[str]],
    names: Sequence[str] | None = None,
    learner=glm,
    workers: int = WORKERS,
) -> DataFrame:
    """Scores (model, fold, wrmsse) of the linear model without each variant's inputs.

    A fold's vectors are assembled once and kept; each variant slices its places out of them, and the fits of a
    fold run side by side. All variants' forecasts of a fold are scored in one job.
    """
    names = list(names or default_features())
    scores = []
    for fold in folds:
        train, valid = split(rows, fold)
        inputs = glm_inputs(train, names)
        vectors = boosting.in_tasks(inputs.vectors(train)).persist()
        vectors.count()

        def one(dropped: Sequence[str]) -> tuple[VectorSlicer, GeneralizedLinearRegressionModel]:
            cut = VectorSlicer(inputCol=FEATURES_COLUMN, outputCol="_sliced", indices=inputs.without(dropped))
            return cut, learner(column="_sliced").fit(cut.transform(vectors))

        try:
            fits = side_by_side(rows.sparkSession, [lambda d=d: one(d) for d in drops.values()], workers)
        finally:
            vectors.unpersist()
        wide = inputs.vectors(valid, *OUTPUT)
        for i, (cut, model) in enumerate(fits):
            wide = model.setPredictionCol(f"_p{i}").transform(cut.transform(wide)).drop("_sliced")
        pairs = [F.struct(F.lit(n).alias("model"), F.greatest(F.col(f"_p{i}"), F.lit(0.0)).alias("prediction")) for i, n in enumerate(drops)]
        stacked = wide.select(*OUTPUT, F.explode(F.array(*pairs)).alias("p")).select(*OUTPUT, "p.*")
        scores.append(score_variants(train, cut_lineage(stacked), "model", fold.folds))
    return cut_lineage(stack(scores))


def tree_count_scores(
    rows: DataFrame,
    folds: Sequence[Fold],
    grid: Sequence[int],
    names: Sequence[str] | None = None,
    params: Mapping[str, float] = GLOBAL_TREES,
    workers: int = WORKERS,
) -> DataFrame:
    """Scores (trees, fold, wrmsse): one fit per fold at the largest count, scored at every count.

    The folds' fits run side by side; each is stored, so another grid, or the choice of the best count,
    takes the same fits.
    """
    names = list(names or default_features())

    def one(fold: Fold) -> DataFrame:
        train, valid = split(rows, fold)
        inputs, model = fit_trees(train, names, params, max(grid))
        wide = cut_lineage(with_tree_counts(inputs, model, valid, grid))
        return score_variants(train, long_predictions(wide, grid), "trees", fold.folds)

    return cut_lineage(stack(side_by_side(rows.sparkSession, [lambda f=f: one(f) for f in folds], workers)))


def stores_of(rows: DataFrame) -> list[str]:
    """Store names; a store is the unit a model is fitted for, so there are few."""
    return [r["store_id"] for r in rows.select("store_id").distinct().orderBy("store_id").collect()]


def store_forecasts(
    train: DataFrame,
    valid: DataFrame,
    names: Sequence[str],
    params: Mapping[str, float],
    rounds: int,
    grid: Sequence[int] = (),
    workers: int = STORE_WORKERS,
) -> DataFrame:
    """Forecasts of one model per store: column `prediction`, or one for each tree count of `grid`.

    Vectors are assembled once for all stores and stored by store, so a fit reads one folder; a store of any size is
    spread over the cluster like any other frame. Each fit is stored under its settings and rows, and writes its
    forecasts to a folder of its own; the result reads all those folders at once, whatever their number.
    """
    out, fits = _store_fits(train, valid, names, params, rounds, grid)
    side_by_side(train.sparkSession, fits, workers)
    return train.sparkSession.read.parquet(out).drop("fit")


def _store_fits(
    train: DataFrame, valid: DataFrame, names: Sequence[str], params: Mapping[str, float], rounds: int, grid: Sequence[int]
) -> tuple[str, list[Callable[[], None]]]:
    """The folder of the forecasts, and for each store what fits its model and writes them there."""
    spark = train.sparkSession
    inputs = tree_inputs(train, names, int(params["max_bin"]))
    of_store = cut_lineage(inputs.vectors(train, "store_id"), ["store_id"])
    target = cut_lineage(inputs.vectors(valid, *OUTPUT), ["store_id"])
    sizes = {r["store_id"]: (r["count"], r["d"]) for r in of_store.groupBy("store_id").agg(
        F.count("*").alias("count"), F.bit_xor(F.xxhash64("label", FEATURES_COLUMN)).alias("d")).collect()}
    out = f"{shared_folder(spark).rstrip('/')}/store_forecasts/{uuid.uuid4().hex}"
    counts, name = (grid, pred) if grid else ([rounds], lambda n: "prediction")

    def one(number: int, store: str) -> None:
        mine = F.col("store_id") == store
        model = boosting.fit(of_store.where(mine).select("label", FEATURES_COLUMN), params, rounds,
                             folder=boosting.fit_folder(spark, str(sizes.get(store)), params, store))
        made = model.staged(target.where(mine).select(*OUTPUT, FEATURES_COLUMN), counts, name)
        made.select(*OUTPUT, *map(name, counts)).write.parquet(f"{out}/fit={number}")

    stores = [s for s in stores_of(target) if s in sizes]
    return out, [lambda i=i, s=s: one(i, s) for i, s in enumerate(stores)]


def store_out_of_fold(
    rows: DataFrame, folds: Sequence[Fold], names: Sequence[str], params: Mapping[str, float], grid: Sequence[int], workers: int = STORE_WORKERS
) -> DataFrame:
    """Per-store forecasts for every validation window at every tree count of the grid, marked with the fold.

    The folds' vectors are assembled side by side, and the fits of all folds share the workers: no fold waits for the
    last fits of the one before it.
    """
    spark = rows.sparkSession
    made = side_by_side(spark, [lambda f=f: _store_fits(*split(rows, f), names, params, max(grid), grid) for f in folds])
    side_by_side(spark, [fit for _, fits in made for fit in fits], workers)
    return stack([spark.read.parquet(out).drop("fit").withColumn("fold", F.lit(f.folds)) for f, (out, _) in zip(folds, made)])


def store_tree_scores(rows: DataFrame, folds: Sequence[Fold], forecasts: DataFrame, grid: Sequence[int]) -> DataFrame:
    """Scores (trees, fold, wrmsse) of per-store forecasts at every tree count, all stores together."""
    scores = []
    for fold in folds:
        train, _ = split(rows, fold)
        mine = forecasts.where(F.col("fold") == fold.folds)
        scores.append(score_variants(train, long_predictions(mine, grid), "trees", fold.folds))
    return cut_lineage(stack(scores))


def ensemble(global_forecast: DataFrame, store_forecast: DataFrame) -> DataFrame:
    """Equal mean of two forecasts; they must cover the same rows, each once."""
    one = global_forecast.withColumnRenamed("prediction", "pred_global")
    two = store_forecast.select(*KEYS, F.col("prediction").alias("pred_store"))
    both = join_checked(one, two, KEYS, "inner", "one_to_one", keep_rows=True)
    return both.withColumn("prediction", (F.col("pred_global") + F.col("pred_store")) / 2)


def ensemble_scores(train: DataFrame, combined: DataFrame) -> DataFrame:
    """Scores of the global, store and mean forecasts."""
    names = {"global only": "pred_global", "stores only": "pred_store", "average": "prediction"}
    pairs = [
        F.struct(F.lit(k).alias("model"), F.col(c).alias("prediction")) for k, c in names.items()
    ]
    rows = combined.withColumn("_p", F.explode(F.array(*pairs))).select(
        *OUTPUT, "_p.model", "_p.prediction"
    )
    return score_variants(train, rows, "model").drop("fold")


def with_stop_rows(train: DataFrame, days: int = HORIZON, name: str = "stop_row") -> DataFrame:
    """Mark the last days of the training rows for early stopping."""
    last = train.agg(F.max("date").alias("last")).scalar()
    return train.withColumn(name, F.col("date") > F.date_sub(last, days))


@dataclass
class StopRows:
    """Assembled rows of an early-stopped fit: those it is fitted on, the training tail, and those it forecasts.

    They are stored, as every seed and every trial reads them again.
    """

    train: DataFrame
    fitted: DataFrame
    tail: DataFrame
    target: DataFrame
    digest: str

    @classmethod
    def of(cls, train: DataFrame, valid: DataFrame, names: Sequence[str], bins: int = GLOBAL_TREES["max_bin"]) -> StopRows:
        marked = with_stop_rows(train)
        earlier, tail = marked.where("NOT stop_row"), marked.where("stop_row")
        inputs = tree_inputs(earlier, names, bins)
        digest = boosting.fingerprint(earlier, [*names, "sales"])
        stored = [cut_lineage(inputs.vectors(rows, *keep)) for rows, keep in ((earlier, ()), (tail, ()), (valid, OUTPUT))]
        return cls(train, *stored, digest)


def stopped_fits(
    rows: StopRows, params: Mapping[str, float], max_trees: int, seeds: Sequence[int], patience: int = PATIENCE, workers: int = WORKERS
) -> tuple[DataFrame, list[Boosted]]:
    """Forecasts per seed by the trees up to the best round on the training tail, and the fits.

    Boosting ends with the block in which `patience` rounds on the tail have gone by without a smaller error, so no more
    than a block and the patience beyond the best round are fitted. Seeds run side by side.
    """
    spark = rows.train.sparkSession

    def one(seed: int) -> Boosted:
        mine = {**params, "seed": seed}
        folder = boosting.fit_folder(spark, rows.digest, mine, "stops")
        return boosting.fit(rows.fitted, mine, max_trees, stop_rows=rows.tail, patience=patience, folder=folder)

    fits = side_by_side(spark, [lambda s=s: one(s) for s in seeds], workers)
    parts = [never_negative(f.forecast(rows.target, "_trees"), "_trees").withColumn("seed", F.lit(s)) for s, f in zip(seeds, fits)]
    return stack(parts), fits


def early_stopped(
    train: DataFrame, valid: DataFrame, names: Sequence[str], params: Mapping[str, float], max_trees: int,
    seeds: Sequence[int] = (1, 2, 3), patience: int = PATIENCE, workers: int = WORKERS,
) -> tuple[DataFrame, list[Boosted]]:
    """`stopped_fits` of one training window and the rows after it."""
    return stopped_fits(StopRows.of(train, valid, names, int(params["max_bin"])), params, max_trees, seeds, patience, workers)


def seed_mean(
    train: DataFrame, per_seed: DataFrame, counts: Sequence[int], against: tuple[DataFrame, DataFrame] | None = None
) -> dict[str, float]:
    """Mean score and mean tree count over seeds."""
    scores = [r["wrmsse"] for r in score_variants(train, per_seed, "seed", against=against).collect()]
    return {"wrmsse": statistics.fmean(scores), "trees": int(statistics.fmean(counts))}


def draw(space: Mapping[str, tuple], generator: random.Random) -> dict[str, float]:
    """One random setting; ranges of whole numbers give whole numbers."""
    setting = {}
    for name, (low, high, log) in space.items():
        if log:
            value = math.exp(generator.uniform(math.log(low), math.log(high)))
        else:
            value = generator.uniform(low, high)
        whole = isinstance(low, int) and isinstance(high, int)
        setting[name] = min(high, max(low, round(value))) if whole else value
    return setting


class _TreeTrials:
    """Early-stopped trees of a fold; the fold's vectors, scales and weights are made once for all trials."""

    def __init__(self, train, valid, names, start, max_trees, seeds):
        self.rows, self.start, self.max_trees, self.seeds = StopRows.of(train, valid, names, int(start["max_bin"])), start, max_trees, seeds
        self.against = references(train)

    def score(self, setting: Mapping[str, float]) -> tuple[float, int]:
        per_seed, fits = stopped_fits(self.rows, {**self.start, **setting}, self.max_trees, self.seeds)
        result = seed_mean(self.rows.train, per_seed, [f.used for f in fits], self.against)
        return result["wrmsse"], result["trees"]

    def release(self) -> None:
        """A fit keeps rows of its own only while it runs."""


class _GlmTrials:
    """Linear models of a fold, on vectors assembled and kept once for all trials."""

    def __init__(self, train, valid, names, *_):
        inputs = glm_inputs(train, names)
        self.train, self.against = train, references(train)
        fitted, self.target = (cut_lineage(inputs.vectors(rows, *keep)) for rows, keep in ((train, ()), (valid, OUTPUT)))
        self.vectors = boosting.in_tasks(fitted).persist()

    def score(self, setting: Mapping[str, float]) -> tuple[float, None]:
        model = glm(setting["tweedie_variance_power"], setting["lambda_l2"]).fit(self.vectors)
        found = never_negative(model.transform(self.target), "_glm").withColumn("model", F.lit("glm"))
        return score_variants(self.train, found, "model", against=self.against).first()["wrmsse"], None

    def release(self) -> None:
        self.vectors.unpersist()


def random_search(
    rows: DataFrame,
    folds: Sequence[Fold],
    names: Sequence[str],
    n_trials: int,
    max_trees: int,
    *,
    learners: Sequence[str] = ("trees", "glm"),
    start: Mapping[str, float] = GLOBAL_TREES,
    seeds: Sequence[int] = (1, 2, 3),
    warm_up: int = 10,
    seed: int = 42,
    workers: int = TRIAL_WORKERS,
) -> DataFrame:
    """Trials (learner, number, mean score, state, settings): for each learner random settings of its own ranges.

    The first trial takes the current settings. After `warm_up` complete trials of a learner, one whose running mean is
    above the median of the earlier trials at the same fold is stopped. Settings that a learner doesn't read are NULL
    on its rows.

    The learners are searched at the same time. Scores that are needed whatever the others are (all folds of the first
    `warm_up` trials, the first fold of each later one) are computed side by side; only the folds that a trial may be
    stopped before wait for the trials ahead of it.
    """
    kinds = {"trees": (TREE_SPACE, _TreeTrials), "glm": (GLM_SPACE, _GlmTrials)}
    columns = [*TREE_SPACE, *GLM_SPACE]
    spark = rows.sparkSession

    def search(kind: str) -> list[tuple]:
        space, trials = kinds[kind]
        generator = random.Random(seed)
        current = {k: start.get(k, low) for k, (low, _, _) in space.items()}
        settings = [current if number == 0 else draw(space, generator) for number in range(n_trials)]
        if not settings:
            return []
        made = side_by_side(spark, [lambda f=f: trials(*split(rows, f), names, start, max_trees, seeds) for f in folds], workers)
        sure = [(number, step) for number in range(n_trials) for step in range(len(folds)) if number < warm_up or step == 0]
        try:
            scores = side_by_side(spark, [lambda n=n, s=s: made[s].score(settings[n]) for n, s in sure], workers)
            return decide(kind, settings, made, dict(zip(sure, scores)))
        finally:
            for fold in made:
                fold.release()

    def decide(kind: str, settings: Sequence[Mapping[str, float]], made: Sequence, known: Mapping[tuple[int, int], tuple]) -> list[tuple]:
        table, history = [], []
        for number, setting in enumerate(settings):
            running: list[float] = []
            trees: list[int | None] = []
            state = "complete"
            for step in range(len(folds)):
                score, used = known[number, step] if (number, step) in known else made[step].score(setting)
                trees.append(used)
                running.append((sum(running[-1:]) * len(running) + score) / (len(running) + 1))
                earlier = [h[step] for h in history if len(h) > step]
                if len(history) >= warm_up and earlier and running[-1] > statistics.median(earlier):
                    state = "stopped"
                    break
            if state == "complete":
                history.append(running)
            mean_trees = int(statistics.fmean(trees)) if kind == "trees" else None
            table.append((kind, number, state, float(running[-1]), mean_trees, *[float(setting[k]) if k in setting else None for k in columns]))
        return table

    found = side_by_side(spark, [lambda k=k: search(k) for k in learners], max(1, len(learners)))
    typed = ", ".join(f"{k} double" for k in columns)
    return spark.createDataFrame(
        [row for table in found for row in table], f"learner string, number int, state string, wrmsse double, trees int, {typed}"
    )


def feature_importance(spark: SparkSession, names: Sequence[str], model: Boosted, top: int | None = None) -> DataFrame:
    """Gain and split shares in percent of boosted trees, largest gain first, all inputs or the `top` ones."""
    found = model.importance()
    total_gain, total_splits = sum(g for g, _ in found) or 1.0, sum(s for _, s in found) or 1
    rows = [(n, float(g), s, float(g) / total_gain * 100, s / total_splits * 100) for n, (g, s) in zip(names, found)]
    columns = "feature string, gain double, split int, gain_pct double, split_pct double"
    out = spark.createDataFrame(rows, columns).orderBy(F.desc("gain"), "feature")
    return out if top is None else out.limit(top)


def unused_features(importance: DataFrame) -> DataFrame:
    return importance.where((F.col("split") == 0) | (F.col("gain") == 0)).select("feature")


def score_stored_model(path: str, train: DataFrame, test: DataFrame, names: Sequence[str], where: str | None = None) -> DataFrame:
    """Load a fitted linear model, forecast the hold-out, or the rows of it that `where` names, and score them."""
    model = PipelineModel.load(path)
    test = test.where(where) if where else test
    return scoring.score(train, predict(model, test, names))


def score_stored_trees(folder: str, train: DataFrame, test: DataFrame, names: Sequence[str], rounds: int, where: str | None = None) -> DataFrame:
    """The same for a stored fit of boosted trees on `train`; fails where it has fewer rounds."""
    inputs, model = tree_inputs(train, names), boosting.stored(train.sparkSession, folder, rounds)
    test = test.where(where) if where else test
    return scoring.score(train, never_negative(model.forecast(inputs.vectors(test, *OUTPUT), "_trees"), "_trees"))
