"""One-pass forms against the plain ones, samples, append order, the shared folder."""

import shutil
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocktide import session
from stocktide.operators import hierarchy, quality, sampling, scoring
from stocktide.plans import baselines, ingestion, validation
from stocktide.streaming import append
from tests.conftest import START


@pytest.fixture(scope="module")
def ragged(make_panel):
    """Series that start late, never sell, miss days or sell only on the last day."""
    rows = [("i1", "s1", d, d % 5, 2.0) for d in range(1, 99)]
    rows += [("i2", "s1", d, 0, 3.0) for d in range(1, 99)]
    rows += [("i3", "s2", d, (d * d) % 7, 1.5) for d in range(60, 99)]
    rows += [("i1", "s2", d, d % 3, 2.5) for d in range(1, 99) if d % 11]
    rows += [("i4", "s2", d, 4 if d == 42 else 0, 2.5) for d in range(30, 99)]
    return make_panel(rows).cache()


def as_rows(frame):
    names = sorted(frame.columns)
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in frame.select(*names).collect()), key=repr)


def test_scales_of_all_folds_equal_those_of_each(ragged):
    folds = validation.folds_of(ragged, 3, 14)
    at_once = hierarchy.level_scales_at(ragged, validation.ends(folds))
    for f in folds:
        alone = hierarchy.level_scales(validation.train_part(ragged, f)).withColumn("fold", F.lit(f.folds))
        assert as_rows(at_once.where(F.col("fold") == f.folds)) == as_rows(alone)


def test_a_step_needs_no_more_than_one_shuffle_of_rows(ragged):
    for frame in (hierarchy.level_scales(ragged, bottom_only=True), hierarchy.level_scales_at(ragged, {1: START + timedelta(days=50)}, bottom_only=True)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_windows_of_folds(ragged):
    folds = validation.folds_of(ragged, 3, 14)
    both = validation.valid_windows(ragged, folds)
    for f in folds:
        assert as_rows(both.where(F.col("fold") == f.folds).drop("fold")) == as_rows(validation.valid_part(ragged, f))
    first = folds[0].train_end
    spans = {1: (first, first + timedelta(days=3)), 2: (first + timedelta(days=2), first + timedelta(days=5))}
    counts = {r.fold: r["count"] for r in validation.windows(ragged, spans).groupBy("fold").count().collect()}
    days = ragged.where(F.col("date").between(first, first + timedelta(days=5))).groupBy("date").count().collect()
    by_day = {r.date: r["count"] for r in days}
    assert counts == {f: sum(by_day[a + timedelta(days=i)] for i in range((b - a).days + 1)) for f, (a, b) in spans.items()}
    assert validation.windows(ragged, {}).count() == 0
    sizes = {r.fold: r.train_rows for r in validation.train_sizes(ragged, folds).collect()}
    assert sizes == {f.folds: validation.train_part(ragged, f).count() for f in folds}


def test_seasonal_forecasts_need_only_the_last_days(ragged):
    folds = validation.folds_of(ragged, 2, 14)
    valid = validation.valid_windows(ragged, folds)
    found = baselines.seasonal_forecast(validation.recent_windows(ragged, folds), valid, ["fold"])
    for f in folds:
        alone = baselines.seasonal_forecast(*validation.split(ragged, f))
        assert as_rows(found.where(F.col("fold") == f.folds).drop("fold")) == as_rows(alone)


def test_series_without_a_scale_are_audited_and_counted(ragged):
    train, valid = ragged.where("d <= 42"), ragged.where("d > 42 AND d <= 70")
    metrics = scoring.series_metrics(train, baselines.seasonal_forecast(train, valid))
    audit = scoring.zero_scale_audit(metrics)
    bottom = {r.series_id: r.causes_inf for r in audit.where("level = 'item_store'").collect()}
    assert bottom == {"i2_s1": False, "i4_s2": True}  # never sold; sold on the last day only
    counts = {r.level: (r.series, r.series_with_weight) for r in scoring.zero_scale_counts(audit).collect()}
    assert counts["item_store"] == (2, 1) and counts["item"] == (2, 1)
    kept = {r.level: r.wrmsse_level for r in scoring.weighted_levels(metrics, "keep").collect()}
    dropped = {r.level: r.wrmsse_level for r in scoring.weighted_levels(metrics, "drop").collect()}
    assert kept["item_store"] != dropped["item_store"] and kept["total"] == dropped["total"]


def outcome(frame):
    return {r["check"]: (r["passed"], r["failing_rows"]) for r in frame.collect()}


def test_one_pass_of_checks_finds_what_single_checks_find(make_panel):
    nan = float("nan")
    rows = [("i1", "s1", d, 1, 2.0) for d in (1, 2, 4, 5, 5, 5)] + [("i2", "s1", 1, -1, 2.0), ("i2", "s1", 2, None, 0.0), ("i2", "s1", 3, 1, nan)]
    rows += [("i3", "s1", d, 0, None if d <= 7 or d == 16 else 2.0) for d in range(1, 20)] + [("i3", "s1", 3, 0, None)]
    rows += [("i4", "s2", d, 0, None) for d in range(1, 5)]
    for panel, n in ((make_panel(rows), 30), (make_panel(rows[:1]), 1), (make_panel(rows).limit(0), 0)):
        single = {}
        for part in (quality.unique_grain(panel), quality.continuous_dates(panel), quality.value_checks(panel, n), quality.launch_price_checks(panel)):
            single |= outcome(part)
        together = outcome(quality.panel_checks(panel, n))
        assert together == single and len(together) == 8
    assert "row_count" not in outcome(quality.panel_checks(make_panel(rows)))


def test_a_repeated_day_of_the_calendar_fails_the_panel(spark):
    wide = spark.createDataFrame([("a", "A", "D", "C", "S", "CA", 1)], "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 int")
    day = ("2020-01-01", 11101, "Monday", 1, 2020, "d_1", "No Event", "No Event", "No Event", "No Event", 1)
    names = "date string, wm_yr_wk int, weekday string, month int, year int, d string, event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, snap_CA int"
    prices = spark.createDataFrame([("S", "A", 11101, 2.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    good, bad = spark.createDataFrame([day], names), spark.createDataFrame([day, day], names)
    assert ingestion.build_panel(wide, good, prices).count() == 1
    with pytest.raises(Exception, match="CardinalityError: calendar side repeats"):
        ingestion.build_panel(wide, bad, prices).collect()
    with pytest.raises(Exception, match="CardinalityError: price side repeats"):
        ingestion.build_panel(wide, good, prices.unionByName(prices)).collect()
    assert ingestion.build_panel(wide, bad, prices, check_keys=False).count() == 2


def test_samples_follow_the_keys(spark):
    rows = [(i, f"k{i % 500}", "abc"[i % 3]) for i in range(3000)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "n int, k string, g string")
    small, large = (sampling.sample(df, ["k"], s, seed=4) for s in (0.1, 0.3))
    assert as_rows(small) == as_rows(sampling.sample(df.repartition(7), ["k"], 0.1, seed=4))
    keys = {r.k for r in small.select("k").distinct().collect()}
    assert keys < {r.k for r in large.select("k").distinct().collect()} and 25 < len(keys) < 80
    assert small.count() == df.where(F.col("k").isin([k for k in keys if k])).count() + 3 * (None in keys)
    assert sampling.sample(df, ["k"], 0.0).count() == 0 and sampling.sample(df, ["k"], 1.0).count() == len(rows)
    strata = sampling.sample_strata(df, ["n"], "g", {"a": 1.0, "b": 0.5}, seed=1).groupBy("g").count().collect()
    found = {r.g: r["count"] for r in strata}
    assert found["a"] == 1000 and 400 < found["b"] < 600 and "c" not in found
    for wrong in (lambda: sampling.sample(df, ["k"], 1.5), lambda: sampling.sample_strata(df, ["n"], "g", {"a": -1.0})):
        with pytest.raises(ValueError):
            wrong()
    some = sampling.smallest_of_each(df.where("n IS NOT NULL"), ["n"], "g", 7, seed=2)
    frame = df.where("n IS NOT NULL").select("g", "n", sampling.uniform(["n"], 2).alias("u")).toPandas()
    want = frame.sort_values(["u", "n"]).groupby("g").head(7)
    assert sorted(map(tuple, some.collect())) == sorted(want[["g", "n"]].itertuples(index=False, name=None))
    few = sampling.smallest_of_each(df.where("n < 5"), ["n"], "g", 7)
    assert few.count() == 5
    assert isinstance(frame, pd.DataFrame)


def test_of_files_that_disagree_the_first_one_stays(spark, dense, tmp_path):
    rows = dense.select("item_id", "store_id", "date", "sales", "year")
    other = rows.withColumn("sales", F.col("sales") + 100)

    def panel(name, parts, at_once):
        base = tmp_path / name
        for i, part in enumerate(parts):
            part.coalesce(1).write.mode("append").parquet(str(base / "in"))
            if not at_once or i == len(parts) - 1:
                append.append_new_files(spark, str(base / "in"), rows.schema, str(base / "panel"), str(base / "marks"))
        return as_rows(spark.read.parquet(str(base / "panel")))

    one, two = panel("a", [rows, other], False), panel("b", [rows, other], True)
    assert one == two == as_rows(rows.withColumn("year", F.col("year").cast("int")))
    assert panel("c", [other, rows, other], True) == as_rows(other.withColumn("year", F.col("year").cast("int")))
    within = rows.unionByName(other).coalesce(1)
    first = panel("d", [within], True)
    assert first == panel("e", [other.unionByName(rows).coalesce(1)], True) and len(first) == rows.count()
    shutil.rmtree(tmp_path / "a")


def test_no_machine_s_own_folder_on_a_cluster():
    class Conf(dict):
        pass

    class Fake:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    assert session.shared_folder(Fake(spark_checkpoint_dir="/shared")) == "/shared"
    assert session.shared_folder(Fake(spark_sql_warehouse_dir="file:/w", spark_master="local[4]")) == "file:/w/_intermediate"
    assert session.shared_folder(Fake(spark_sql_warehouse_dir="s3a://b/w", spark_master="yarn")) == "s3a://b/w/_intermediate"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(Fake(spark_sql_warehouse_dir="/w", spark_master=master))
