"""Results that were once wrong."""

from stocktide.operators import narrowing, scoring
from stocktide.plans import eda, errors
from stocktide.sources import tables


def test_infinite_error_without_weight_adds_nothing(spark):
    rows = [("L", "a", 0.0, 4.0, 0.0), ("L", "b", 1.0, 1.0, 10.0)]
    metrics = spark.createDataFrame(rows, "level string, series_id string, scale double, mse double, dollar_sales double")
    assert scoring.weighted_levels(metrics, "keep").first().wrmsse_level == 1.0


def test_overwritten_panel_has_no_stale_years(make_panel, spark, tmp_path):
    panel = make_panel([("i1", "s1", d, 1, 2.0) for d in (1, 2, 400)])
    path = str(tmp_path / "panel")
    tables.write_panel(panel, path)
    tables.write_panel(panel.where("year = 2016"), path)
    assert [r.year for r in spark.read.parquet(path).select("year").distinct().collect()] == [2016]


def test_overwritten_predictions_have_no_stale_folds(spark, tmp_path):
    path = str(tmp_path / "predictions")
    for n in (5, 3):
        tables.write_predictions(spark.range(n).withColumnRenamed("id", "fold").selectExpr("fold", "1.0D AS prediction"), path)
    assert spark.read.parquet(path).count() == 3


def test_doubles_stay_where_a_float_would_change_them(spark):
    df = spark.createDataFrame([(16777217.0, 1e300, 0.5, None), (1.0, 2.0, 2.5, 1.0)], "a double, b double, c double, d double")
    assert narrowing.narrowest_types(df) == {"a": "double", "b": "double", "c": "float", "d": "float"}
    assert narrowing.narrow_types(df).first().a == 16777217.0


def test_a_series_without_known_volume_keeps_its_row(spark):
    rows = [("i1", "s1", 2.0), ("i2", "s1", 0.0), ("i3", "s1", None)]
    found = errors.volume_deciles(spark.createDataFrame(rows, "item_id string, store_id string, mean_sales double"))
    assert {r.item_id: r.volume_decile for r in found.collect()} == {
        "i1": "D01", "i2": errors.NO_SALES_DECILE, "i3": errors.UNKNOWN_DECILE,
    }


def test_histogram_has_large_values_unless_limited(make_panel):
    panel = make_panel([("i1", "s1", d, s, 2.0) for d, s in ((1, 1), (2, 5000), (3, 1))])
    assert {r.sales for r in eda.sales_histogram(panel).collect()} == {1, 5000}
    assert [(r.sales, r.pct) for r in eda.sales_histogram(panel, 1000).collect()] == [(1, 100.0)]
