"""Boosted trees in blocks of rounds: fits that stop, resume, are stored and shared, and staged forecasts.

A model is a run of blocks. Each is a `GBTRegressor` fitted on what the blocks before it left over (the label less
their forecast), so the forecast of the first n rounds is a running sum of block columns, and a fit can be
stopped, stored and taken up again after any block. The library opens each block with a full step and takes
the learning rate after it; its squared-loss steps are twice the residual, hence half the rate.

A fit whose rows one task can hold is grown in that task, and one of up to `ROWS_TOGETHER` rows in tasks that hold some of the
columns each, where Spark runs on one machine: some blocks a job (`plans.tree_growth`), by the library's rules and stored in its
format. Larger fits are the library's own: every level of every tree is a job. The assembled vectors are kept while such a
model is fitted, with the forecast so far beside them; lost blocks of them are computed again from the stored rows. A stored fit lies in a folder named by the settings and by a
fingerprint of its rows: what reads the same rows with the same settings takes the fitted blocks and only fits
those that are missing. A block counts once its row stands in the fit's log.
"""

from __future__ import annotations

import contextvars
import hashlib
import json
import math
import pickle
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.config import GLOBAL_TREES
from stocktide.plans import tree_growth as growth
from stocktide.plans.tree_growth import PATIENCE, best_round
from stocktide.session import checkpointed, cut_lineage, delete_folder, on_one_machine, released_tables, shared_folder

FEATURES_COLUMN = "features"
#: Rounds of a block; the tree counts of all grids are multiples of it.
BLOCK = 50
#: Training rows that are worth a task of their own, and most rows of one task.
ROWS_PER_TASK, MOST_ROWS = 50_000, 2_000_000
#: Blocks after which kept rows are checkpointed. The plan of a kept frame names that of the frame it is computed from
#: twice (adaptive execution shows a first and a final plan), so without a cut it doubles with every block.
CUT = 4
#: Blocks that tasks grow in one job, after which they are stored.
TURN = 4
#: Most rows of a fit that is grown in tasks with all of its rows; above, every level of every tree is a job of the library.
ROWS_TOGETHER = 4_000_000
LOG = "block int, rounds int, errors array<double>, turn int"


def learner(params: Mapping[str, float] = GLOBAL_TREES, rounds: int = BLOCK) -> GBTRegressor:
    """Boosted trees of the given settings: leaves, leaf size, bins, rate, fractions and seed."""
    share = params["feature_fraction"]
    return GBTRegressor(
        featuresCol=FEATURES_COLUMN,
        labelCol="left",
        predictionCol="step",
        maxIter=rounds,
        stepSize=float(params["learning_rate"]) / 2,
        maxDepth=max(1, math.ceil(math.log2(params["num_leaves"]))),
        minInstancesPerNode=int(params["min_data_in_leaf"]),
        maxBins=int(params["max_bin"]) + 1,
        subsamplingRate=float(params["bagging_fraction"]),
        featureSubsetStrategy="all" if share >= 1 else str(share),
        seed=int(params["seed"]),
        maxMemoryInMB=512,
    )


@dataclass
class Boosted:
    """Fitted blocks; `used` is the number of rounds that forecasts take."""

    blocks: list[GBTRegressionModel]
    used: int
    #: Mean squared error after each round on the rows kept for stopping.
    errors: list[float] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return sum(b.getNumTrees for b in self.blocks)

    def staged(self, rows: DataFrame, counts: Sequence[int], name: Callable[[int], str]) -> DataFrame:
        """Forecasts of the first n rounds for each n, never negative, from one pass over the rows.

        A block that ends at or before a count is one column; one that a count cuts is summed tree by tree.
        """
        wanted = sorted({min(n, self.rounds) for n in counts})
        out, total, sums, at = rows, F.lit(0.0), {}, 0
        for k, block in enumerate(self.blocks):
            n = block.getNumTrees
            if any(at < w < at + n for w in wanted):
                for i, (tree, weight) in enumerate(zip(block.trees, block.treeWeights)):
                    column = f"_tree_{k}_{i}"
                    out = tree.setFeaturesCol(FEATURES_COLUMN).setPredictionCol(column).transform(out)
                    total = total + F.col(column) * float(weight)
                    sums[at + i + 1] = total
            else:
                column = f"_block_{k}"
                out = block.copy().setFeaturesCol(FEATURES_COLUMN).setPredictionCol(column).transform(out)
                total = total + F.col(column)
                sums[at + n] = total
            at += n
            if at >= wanted[-1]:
                break
        found = {name(n): F.greatest(sums[min(n, self.rounds)], F.lit(0.0)) for n in counts}
        return out.select(*rows.columns, *[c.alias(a) for a, c in found.items()])

    def forecast(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        return self.staged(rows, [self.used], lambda _: name)

    def importance(self) -> list[tuple[float, int]]:
        """Gain share and number of splits of each place of the vector, over all blocks."""
        size = self.blocks[0].numFeatures
        gains, splits = [0.0] * size, [0] * size
        for block in self.blocks:
            for i, gain in enumerate(block.featureImportances.toArray()):
                gains[i] += float(gain) * block.getNumTrees / self.rounds
            # Each inner node prints one If line and one Else line.
            for index in re.findall(r"If \(feature (\d+)", block.toDebugString):
                splits[int(index)] += 1
        return list(zip(gains, splits))


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> str:
    """Digest of a frame's content, whatever the order of its rows, from one aggregate."""
    code = F.xxhash64(*columns)
    found = rows.agg(F.count("*"), F.bit_xor(code), F.sum(F.shiftright(code, 24))).first()
    return hashlib.sha256(json.dumps([list(columns), *found]).encode()).hexdigest()[:20]


def fit_folder(spark: SparkSession, rows_digest: str, params: Mapping[str, float], *also: Any) -> str:
    """Folder of the stored fit of these settings on these rows; the number of rounds isn't part of it."""
    settings = {k: v for k, v in params.items() if k != "num_iterations"}
    name = hashlib.sha256(json.dumps([rows_digest, sorted(settings.items()), BLOCK, "turns", *also]).encode()).hexdigest()[:24]
    return f"{shared_folder(spark).rstrip('/')}/fits/{name}"


def _turn_folder(folder: str, number: int) -> str:
    return f"{folder}/turn={number}"


def _cut(model: GBTRegressionModel, rounds: Sequence[int]) -> list[GBTRegressionModel]:
    """The blocks of so many rounds that a model of all their trees is made of."""
    if len(rounds) == 1:
        return [model]
    context, at, out = SparkSession.active().sparkContext, 0, []
    kind, trees, weights = context._jvm.org.apache.spark.ml.regression, model._java_obj.trees(), model.treeWeights
    for number, n in enumerate(rounds):
        some = context._gateway.new_array(kind.DecisionTreeRegressionModel, n)
        rates = context._gateway.new_array(context._jvm.double, n)
        for i in range(n):
            some[i], rates[i] = trees[at + i], float(weights[at + i])
        made = kind.GBTRegressionModel(f"{model.uid}_{number}", some, rates, model.numFeatures)
        out.append(GBTRegressionModel(made).setFeaturesCol(FEATURES_COLUMN).setPredictionCol("step"))
        at += n
    return out


def _stored(spark: SparkSession, folder: str) -> tuple[list[GBTRegressionModel], list[float]]:
    try:
        log = sorted(spark.read.schema(LOG).parquet(f"{folder}/log").collect())  # one row per block
    except AnalysisException:
        return [], []
    turns: dict[int, list[int]] = {}
    for r in log:
        turns.setdefault(r.turn, []).append(r.rounds)
    blocks = [b for t, rounds in turns.items() for b in _cut(GBTRegressionModel.load(_turn_folder(folder, t)), rounds)]
    return blocks, [e for r in log for e in r.errors]


def _log(spark: SparkSession, folder: str, number: int, rounds: Sequence[int], errors: Sequence[Sequence[float]]) -> None:
    """Note the blocks of a turn, which count from now on; `number` is that of the first."""
    rows = [(number + i, n, list(e), number) for i, (n, e) in enumerate(zip(rounds, errors))]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")


def stored(spark: SparkSession, folder: str, rounds: int) -> Boosted:
    """The first rounds of a stored fit."""
    blocks, errors = _stored(spark, folder)
    found = Boosted(blocks, rounds, errors)
    if found.rounds < rounds:
        raise ValueError(f"{folder} holds {found.rounds} rounds, not {rounds}")
    return found


class _Margins:
    """Vectors, labels and the forecast so far, kept in memory from block to block."""

    def __init__(self, vectors: DataFrame, blocks: Sequence[GBTRegressionModel]):
        self.rows = vectors.select("label", FEATURES_COLUMN, F.lit(0.0).alias("margin"))
        for block in blocks:
            self.rows = self._moved(block)
        self.rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.moves, self.folder = 0, ""

    def _moved(self, block: GBTRegressionModel) -> DataFrame:
        made = block.transform(self.rows)
        return made.select("label", FEATURES_COLUMN, (F.col("margin") + F.col("step")).alias("margin"))

    def left(self) -> DataFrame:
        return self.rows.select((F.col("label") - F.col("margin")).alias("left"), FEATURES_COLUMN)

    def move(self, block: GBTRegressionModel) -> None:
        before, made, folder = self.rows, self._moved(block), self.folder
        self.moves += 1
        if self.moves % CUT == 0:
            made, self.folder = checkpointed(made)
        self.rows = made.persist(StorageLevel.MEMORY_AND_DISK)
        self.rows.count()  # fills it before what it is computed from goes
        before.unpersist()
        if folder and folder != self.folder:
            delete_folder(made.sparkSession, folder)

    def release(self) -> None:
        self.rows.unpersist()
        if self.folder:
            delete_folder(self.rows.sparkSession, self.folder)


def tasks_of(n_rows: int, cores: int) -> int:
    """Tasks for one round of the cores, or as many rounds as tasks of `MOST_ROWS` need."""
    few = min(math.ceil(n_rows / ROWS_PER_TASK), cores)
    return max(1, few, cores * math.ceil(n_rows / (cores * MOST_ROWS)) if n_rows > cores * MOST_ROWS else 0)


def in_tasks(vectors: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Rows dealt to tasks, as few as fill the cores.

    Every level of every tree may be a job over all rows, so small tasks cost more than they save.
    """
    n_rows = vectors.count() if n_rows is None else n_rows
    return vectors.repartition(tasks_of(n_rows, vectors.sparkSession.sparkContext.defaultParallelism))


def _values(vectors: DataFrame) -> dict[int, int]:
    """Number of values of each place of the vector that holds the codes of names."""
    named = vectors.schema[FEATURES_COLUMN].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in named.get("nominal", [])}
    return {**found, **{a["idx"]: 2 for a in named.get("binary", [])}}


def growth_spec(params: Mapping[str, float], vectors: DataFrame, n_columns: int) -> growth.Spec:
    share = float(params["feature_fraction"])
    return growth.Spec(
        depth=max(1, math.ceil(math.log2(params["num_leaves"]))),
        rate=float(params["learning_rate"]) / 2,
        least=int(params["min_data_in_leaf"]),
        bins=int(params["max_bin"]) + 1,
        share=float(params["bagging_fraction"]),
        n_subset=n_columns if share >= 1 else math.ceil(share * n_columns),
        seed=int(params["seed"]),
        arity=_values(vectors),
    )


class _Library:
    """Blocks by the library: rows lie wherever they are, and every level of every tree is a job."""

    def __init__(self, train: DataFrame, tail: DataFrame | None, blocks: Sequence[GBTRegressionModel], params: Mapping[str, float]):
        self.params = params
        self.train = _Margins(train, blocks)
        self.tail = _Margins(tail, blocks) if tail is not None else None
        self.moved = len(blocks)

    def grow(self, blocks: Sequence[GBTRegressionModel], rounds: Sequence[int], ended: Callable, path: str) -> tuple[list[int], list[list[float]]]:
        """One block after the others, stored at the path; its rounds and errors on the rows kept for stopping."""
        for block in blocks[self.moved :]:
            for rows in (self.train, self.tail):
                if rows:
                    rows.move(block)
        self.moved = len(blocks)
        made = learner(self.params, rounds[0]).fit(self.train.left())
        errors = list(made.evaluateEachIteration(self.tail.left(), "squared")) if self.tail else []
        made.write().overwrite().save(path)
        return [rounds[0]], [errors]

    def release(self) -> None:
        self.train.release()
        if self.tail:
            self.tail.release()


def _write_trees(spark: SparkSession, path: str, found: Mapping[str, Any], params: Mapping[str, float], n_columns: int) -> None:
    """Grown trees as a model folder of the library."""
    settings = {p.name: v for p, v in learner(params, len(found["weights"])).extractParamMap().items()}
    kind, now = "org.apache.spark.ml.regression.", {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {}}
    about = {"class": f"{kind}GBTRegressionModel", **now, "uid": f"GBTRegressor_{uuid.uuid4().hex[:12]}", "paramMap": settings,
             "numFeatures": n_columns, "numTrees": len(found["weights"])}
    own = {k: settings[k] for k in ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed")}
    trees = [
        (i, json.dumps({"class": f"{kind}DecisionTreeRegressionModel", **now, "uid": f"dtr_{uuid.uuid4().hex[:12]}", "paramMap": own}), w)
        for i, w in enumerate(found["weights"])
    ]
    nodes = pa.ipc.open_stream(found["nodes"]).read_all()
    spark.createDataFrame(nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


class _Tasks:
    """Blocks by tasks that hold all rows as bins and stay for a turn: one task, or several with some columns each."""

    def __init__(self, train: DataFrame, tail: DataFrame | None, params: Mapping[str, float], n_rows: int):
        self.spark, self.params, self.n_rows = train.sparkSession, params, n_rows
        self.train = train.persist(StorageLevel.MEMORY_AND_DISK)
        self.tail = tail.persist(StorageLevel.MEMORY_AND_DISK) if tail is not None else None
        self.n_columns = len(train.first()[FEATURES_COLUMN])
        self.spec = growth_spec(params, train, self.n_columns)
        self.size = min(tasks_of(n_rows, self.spark.sparkContext.defaultParallelism), self.n_columns)
        self.dealt = None

    def _rows(self, blocks: Sequence[GBTRegressionModel]) -> DataFrame:
        """Rows of the fit, then those kept for stopping, with the forecast of the blocks so far."""

        def flat(vectors: DataFrame, tail: int) -> DataFrame:
            out = vectors.select("label", FEATURES_COLUMN, F.lit(0.0).alias("margin"))
            for block in blocks:
                out = block.transform(out).select("label", FEATURES_COLUMN, (F.col("margin") + F.col("step")).alias("margin"))
            unknown = F.col("label").isNull() | F.isnan("label")
            label = F.when(unknown, F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))).otherwise(F.col("label")).alias("label")
            return out.select(label, "margin", F.lit(tail).alias("tail"), vector_to_array(FEATURES_COLUMN).alias("features"))

        train = flat(self.train, 0)
        return train if self.tail is None else train.unionAll(flat(self.tail, 1))

    def _deal(self, blocks: Sequence[GBTRegressionModel]) -> None:
        """Bins of all rows, stored by the task that holds the columns; labels and margins in their order."""
        drawn = self.train.select(vector_to_array(FEATURES_COLUMN).alias("features")).mapInArrow(
            growth.draw_sample(self.n_rows, self.spec), "part int, rows int, drawn binary").collect()
        drawn.sort()
        self.parts = [r.rows for r in drawn]
        sampled = np.concatenate([np.frombuffer(r.drawn).reshape(-1, self.n_columns) for r in drawn])
        self.cuts = growth.cuts_of(sampled, self.n_rows, self.spec)
        stored = cut_lineage(self._rows(blocks).mapInArrow(
            growth.deal_columns(self.cuts, self.spec, self.size),
            "rank int, part int, batch int, tail int, bins binary, label binary, margin binary"))
        known = sorted(stored.where("rank = 0").select("tail", "part", "batch", "label", "margin").collect())
        self.label = np.concatenate([np.frombuffer(r.label) for r in known])
        self.margin = np.concatenate([np.frombuffer(r.margin) for r in known])
        self.dealt = stored.select("rank", "tail", "part", "batch", "bins").rdd.map(growth.keyed).partitionBy(self.size, growth.same)

    def grow(self, blocks: Sequence[GBTRegressionModel], rounds: Sequence[int], ended: Callable, path: str) -> tuple[list[int], list[list[float]]]:
        """The blocks of a turn, stored at the path as one model; their rounds and errors on the rows kept for stopping."""
        if self.size == 1:
            rows = self._rows(blocks).coalesce(1).mapInArrow(growth.grow_alone(self.spec, rounds, ended), "grown binary")
            found = pickle.loads(rows.first().grown)
        else:
            if self.dealt is None:
                self._deal(blocks)
            run = growth.grow_together(self.spec, self.cuts, self.parts, self.size, self.label, self.margin, rounds, ended)
            found = pickle.loads(self.dealt.barrier().mapPartitions(run).collect()[0])
            self.margin = found["margin"]
        _write_trees(self.spark, path, found, self.params, self.n_columns)
        return [n for n, _ in found["blocks"]], [e for _, e in found["blocks"]]

    def release(self) -> None:
        self.train.unpersist()
        if self.tail is not None:
            self.tail.unpersist()


def _grown_in_tasks(vectors: DataFrame, tail: DataFrame | None, params: Mapping[str, float], n_rows: int) -> bool:
    """Whether tasks can hold all rows of the fit: one those of a small fit, several those of a larger one.

    Several tell each other what they find through memory, so Spark must run on one machine.
    """
    bins = int(params["max_bin"]) + 1
    if not n_rows or bins > 256 or any(n > min(bins, n_rows) for n in _values(vectors).values()):
        return False
    if n_rows > ROWS_PER_TASK and tasks_of(n_rows, vectors.sparkSession.sparkContext.defaultParallelism) == 1:
        return False
    few = n_rows + (tail.count() if tail is not None else 0) <= ROWS_TOGETHER
    return few and (n_rows <= ROWS_PER_TASK or on_one_machine(vectors.sparkSession))


def fit(
    vectors: DataFrame,
    params: Mapping[str, float] = GLOBAL_TREES,
    rounds: int | None = None,
    *,
    stop_rows: DataFrame | None = None,
    patience: int = PATIENCE,
    folder: str | None = None,
) -> Boosted:
    """Fit (or take up) a model on `vectors` of `label` and `features`.

    With `stop_rows` boosting ends with the block in which `patience` rounds have gone by without a smaller error
    on them, and forecasts take the rounds up to the best one. With `folder` blocks are stored and reused.
    """
    spark = vectors.sparkSession
    rounds = int(rounds or params["num_iterations"])
    blocks, errors = _stored(spark, folder) if folder else ([], [])
    at = sum(b.getNumTrees for b in blocks)

    def ended() -> bool:
        return at >= rounds or over()([])

    def over() -> Callable[[list[float]], bool]:
        return growth.stops(errors, patience) if stop_rows is not None else growth.never

    if not ended():
        kept = folder or f"{shared_folder(spark).rstrip('/')}/fits/{uuid.uuid4().hex}"
        n_rows = vectors.count()
        train, tail = in_tasks(vectors, n_rows), in_tasks(stop_rows) if stop_rows is not None else None
        in_place = _grown_in_tasks(vectors, tail, params, n_rows)
        with released_tables(spark):
            work = _Tasks(train, tail, params, n_rows) if in_place else _Library(train, tail, blocks, params)
            try:
                while not ended():
                    number, left = len(blocks), rounds - at
                    sizes = [min(BLOCK, left - k) for k in range(0, left, BLOCK)][:TURN]
                    grown, now = work.grow(blocks, sizes, over(), _turn_folder(kept, number))
                    if folder:
                        _log(spark, folder, number, grown, now)
                    made = _cut(GBTRegressionModel.load(_turn_folder(kept, number)), grown)
                    blocks, errors, at = [*blocks, *made], [e for some in (errors, *now) for e in some], at + sum(grown)
            finally:
                work.release()
                if not folder:
                    delete_folder(spark, kept)
    used = min(rounds, at)
    return Boosted(blocks, best_round(errors[:used], patience) if stop_rows is not None else used, errors)


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], Any]], workers: int = 4) -> list[Any]:
    """Results of tasks that each run Spark jobs, some at a time, each in a scheduler pool of its own."""
    context = spark.sparkContext

    def run(number: int, task: Callable[[], Any]) -> Any:
        context.setLocalProperty("spark.scheduler.pool", f"fit-{number % workers}")
        try:
            return task()
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=workers) as pool:
        # Each task sees the caller's context, so tables that it stores are released with the caller's.
        running = [pool.submit(contextvars.copy_context().run, run, i, t) for i, t in enumerate(tasks)]
        try:
            return [r.result() for r in running]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)  # what hasn't begun would only delay the error
            raise


