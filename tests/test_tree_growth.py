"""Trees that tasks grow against the library's, and how many jobs they take."""

import random
import uuid

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from stocktide.plans import boosting

PARAMS = {"num_leaves": 16, "min_data_in_leaf": 5, "max_bin": 15, "learning_rate": 0.2,
          "bagging_fraction": 0.7, "feature_fraction": 0.6, "seed": 7, "num_iterations": 9}
WHOLE = {**PARAMS, "bagging_fraction": 1.0, "feature_fraction": 1.0}


@pytest.fixture(scope="module")
def vectors(spark):
    """Numbers with many zeros, one that stands twice, one that doesn't vary, and names."""
    draw = random.Random(3)
    rows = []
    for _ in range(900):
        a, b, c = draw.choice((0, 0, 0, 1, 2, 5)), draw.uniform(-1, 1), draw.choice("uvwxyz")
        rows.append((float(max(0, a + round(3 * b) + (c in "uz") * 2)), float(a), b, b * b, float(a), 1.0, c))
    made = spark.createDataFrame(rows, "label double, a double, b double, c double, twin double, fixed double, name string").coalesce(1)
    stages = [StringIndexer(inputCol="name", outputCol="code"), VectorAssembler(inputCols=["a", "code", "b", "c", "twin", "fixed"], outputCol="features")]
    return Pipeline(stages=stages).fit(made).transform(made).select("label", "features").cache()


def texts(trees):
    return [t.toDebugString.split("\n", 1)[1] for t in trees]


@pytest.mark.parametrize("params", [PARAMS, WHOLE])
def test_one_task_grows_the_trees_of_the_library(vectors, params, monkeypatch):
    kept = vectors.repartition(1).cache()
    monkeypatch.setattr(boosting, "in_tasks", lambda rows, n_rows=None: kept)
    monkeypatch.setattr(boosting, "BLOCK", 6)
    library = boosting.learner(params, 6).fit(kept.select(F.col("label").alias("left"), "features"))
    grown = boosting.fit(vectors, params, 9)
    assert [b.getNumTrees for b in grown.blocks] == [6, 3]
    assert texts(grown.blocks[0].trees) == texts(library.trees)
    assert list(grown.blocks[0].treeWeights) == list(library.treeWeights)
    assert grown.blocks[0].featureImportances == library.featureImportances
    monkeypatch.setattr(boosting, "_grown_in_tasks", lambda *_: False)
    by_jobs = boosting.fit(vectors, params, 9)
    both = by_jobs.forecast(grown.forecast(kept, "a"), "b")
    assert both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9


def test_several_tasks_grow_what_one_does(vectors, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 4)
    monkeypatch.setattr(boosting, "TURN", 2)
    tail = vectors.limit(50)
    one = boosting.fit(vectors, WHOLE, 10, stop_rows=tail, patience=100)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 300)
    several = boosting.fit(vectors, WHOLE, 10, stop_rows=tail, patience=100)
    assert boosting.in_tasks(vectors).rdd.getNumPartitions() == 3 and several.rounds == one.rounds == 10
    assert several.errors == pytest.approx(one.errors)
    both = one.forecast(several.forecast(vectors, "a"), "b")
    assert both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9


@pytest.mark.parametrize("per_task", [50_000, 300])
def test_jobs_of_a_fit_do_not_grow_with_its_rounds(spark, vectors, per_task, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", per_task)

    def jobs(rounds):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "fit")
        try:
            boosting.fit(vectors, WHOLE, rounds)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(20) <= jobs(5) + 5  # four jobs a tree before


@pytest.mark.parametrize("per_task", [50_000, 300])
def test_unknown_labels_are_an_error(vectors, per_task, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", per_task)
    unknown = vectors.withColumn("label", F.when(F.col("label") > 1, F.col("label")))
    with pytest.raises(Exception, match="Labels MUST NOT be Null or NaN"):
        boosting.fit(unknown, WHOLE, 2)
