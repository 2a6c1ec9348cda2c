from datetime import date

import pytest
from pyspark.sql import functions as F

from stocktide import config
from stocktide.functions import columns as C
from stocktide.operators import joins, narrowing, reshape, series


def values(spark, column, *rows, schema="x double"):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(column).collect()]


def test_settings_refuse_contradictions():
    with pytest.raises(config.SettingsError):
        config.Settings(start_year=2016, end_year=2016)
    with pytest.raises(config.SettingsError):
        config.Settings(id_columns=("a", "a"))
    with pytest.raises(config.SettingsError):
        config.Settings(panel_columns=("item_id", "store_id"))
    with pytest.raises(config.SettingsError):
        config.Settings(series_keys=("item_id",))


def test_model_features_leave_out_groups_and_names():
    names = config.model_features(drop_group="lags")
    assert "lag_28" not in names and "year" not in names and "rolling_mean_7" in names


def test_cuts(spark):
    left = C.cut_left_closed("x", C.MEAN_PRICE_EDGES, C.MEAN_PRICE_LABELS)
    assert values(spark, left, (0.5,), (1.0,), (9.99,), (10.0,), (-1.0,), (None,)) == [
        "<$1", "$1-2", "$5-10", "$10+", None, None,
    ]
    right = C.cut_right_closed("x", C.SALE_RATE_EDGES, C.SALE_RATE_LABELS)
    assert values(spark, right, (0.0,), (0.1,), (0.11,), (0.5,), (1.0,)) == [
        "Highly intermittent", "Highly intermittent", "Moderately intermittent",
        "Moderately intermittent", "Low intermittency",
    ]


def test_null_price_keeps_its_own_band(spark):
    assert values(spark, C.price_bucket("x"), (None,), (1.99,), (2.0,), (18.0,)) == [
        None, "< $2", "$2–$3", "$18+",
    ]


def test_sales_buckets(spark):
    got = values(spark, C.sales_bucket("x"), (0,), (5,), (6,), (100,), (101,), schema="x int")
    assert got == ["0", "1-5", "6-10", "51-100", "100+"]


def test_close_to_and_tokens(spark):
    df = spark.createDataFrame([(2.0, 2.00001, "d_12")], "a double, b double, d string")
    row = df.select(
        C.close_to("a", "b"), C.strip_prefix_int("d", "d_"), C.last_token_int("d")
    ).first()
    assert tuple(row) == (True, 12, 12)


def test_select_by_value_defaults_to_zero(spark):
    df = spark.createDataFrame([("CA", 1, 0), ("ZZ", 1, 1)], "s string, snap_CA int, snap_TX int")
    picked = C.select_by_value("s", {"CA": "snap_CA", "TX": "snap_TX"})
    assert [r[0] for r in df.select(picked).collect()] == [1, 0]


def test_melt_is_undone_by_pivot(spark):
    wide = spark.createDataFrame([("a", 1, 2, 3), ("b", 4, 5, 6)], "id string, d_1 int, d_2 int, d_3 int")
    days = reshape.columns_with_prefix(wide, "d_")
    long = reshape.melt(wide, ["id"], days)
    assert long.count() == 6
    back = reshape.pivot_value(long, "id", "d", days, "sales").select(wide.columns)
    assert sorted(back.collect()) == sorted(wide.collect())


def test_join_checked_refuses_repeats_and_losses(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    twice = spark.createDataFrame([(1, 0), (1, 1)], "k int, w int")
    with pytest.raises(joins.CardinalityError):
        joins.require_unique(twice, ["k"], "right")
    # The checks are part of the plan: no job before the action, and the action fails.
    tracker, jobs = spark.sparkContext.statusTracker(), lambda: len(tracker.getJobIdsForGroup("checked"))
    spark.sparkContext.setJobGroup("checked", "joins that check themselves")
    repeated = joins.join_checked(left, twice, ["k"])
    once = spark.createDataFrame([(1, 0)], "k int, w int")
    kept = joins.join_checked(left, once, ["k"])
    lost = joins.join_checked(left, once, ["k"], "inner", keep_rows=True)
    both = joins.join_checked(left, left.withColumnRenamed("v", "u"), ["k"], "inner", "one_to_one", keep_rows=True)
    assert jobs() == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="CardinalityError: right side repeats .*k.*1"):
        repeated.collect()
    assert sorted(map(tuple, kept.collect())) == [(1, "x", 0), (2, "y", None)]
    with pytest.raises(Exception, match="CardinalityError: rows changed .*k.*2"):
        lost.count()
    assert both.columns == ["k", "v", "u"] and both.count() == 2
    with pytest.raises(Exception, match="CardinalityError: left side repeats"):
        joins.join_checked(twice, once.withColumnRenamed("w", "u"), ["k"], "left", "one_to_one").collect()
    with pytest.raises(ValueError, match="several partners"):
        joins.join_checked(left, twice, ["k"], "inner", "one_to_many", keep_rows=True)
    assert joins.join_checked(left, twice, ["k"], "inner", "one_to_many").count() == 2
    assert joins.key_containment(left, once, ["k"]).first().asDict() == {
        "missing_keys": 1, "contained": False,
    }


def test_narrow_types_by_value_range(spark):
    df = spark.createDataFrame([(1, 40000, 2.5), (200, 7, 1.0)], "a long, b long, c double")
    assert narrowing.narrowest_types(df) == {"a": "smallint", "b": "int", "c": "float"}
    assert narrowing.narrow_types(df).agg(F.sum("a")).first()[0] == 201


def test_launch_by_window_and_by_join_agree(make_panel):
    panel = make_panel(
        [("i1", "s1", d, 0, None if d <= 10 else 2.0) for d in range(1, 21)]
        + [("i2", "s1", d, 0, None) for d in range(1, 4)]
    )
    for how in ("inner", "left"):
        one = series.with_launch(panel, how).select("item_id", "d", "launch_date", "launch_week")
        launches = series.launch_table(panel)
        two = series.with_launch(panel, how, launches).select(one.columns)
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    stored = series.with_launch(panel)
    assert series.with_launch(stored) is not None and series.with_launch(stored).count() == 20
    assert series.launch_table(panel).first()["launch_date"] == date(2015, 1, 11)


def test_largest_gap_sees_gaps_inside_and_across_years(spark):
    def gap(*days):
        return series.largest_gap(spark.createDataFrame([(d,) for d in days], "date date")).first()[0]

    assert gap(date(2015, 1, 1), date(2015, 1, 5), date(2015, 1, 6)) == 4
    assert gap(date(2015, 12, 30), date(2016, 1, 4), date(2016, 1, 5)) == 5


def test_autocorrelation_of_a_weekly_series(make_panel):
    panel = make_panel([("i1", "s1", d, 7 * (d % 7 == 0), 1.0) for d in range(1, 141)])
    acf = {r["lag"]: r["acf"] for r in series.autocorrelation(panel, 14).collect()}
    assert acf[0] == pytest.approx(1.0)
    assert acf[7] > 0.9 and acf[7] > acf[14] > 0.85 and abs(acf[3]) < 0.3


def test_decompose_adds_up(dense):
    parts = series.decompose(dense)
    total = sum(F.col(c) for c in ("trend", "seasonal_7", "seasonal_30", "seasonal_365", "residual"))
    assert parts.where(F.abs(total - F.col("observed")) > 1e-9).count() == 0
