import shutil

import pytest
from pyspark.sql import functions as F

from stocktide import session
from stocktide.config import ID_COLUMNS, Settings
from stocktide.operators import quality
from stocktide.plans import ingestion
from stocktide.sources import bronze, tables
from stocktide.streaming import append

CALENDAR = """date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI
2011-01-29,11101,Saturday,1,1,2011,d_1,,,,,1,0,0
2011-01-30,11101,Sunday,2,1,2011,d_2,SuperBowl,Sporting,,,0,1,0
2011-01-31,11101,Monday,3,1,2011,d_3,,,,,0,0,1
2011-02-01,11102,Tuesday,4,2,2011,d_4,,,,,1,1,1
2011-02-02,11102,Wednesday,5,2,2011,d_5,,,,,0,0,0
"""
PRICES = """store_id,item_id,wm_yr_wk,sell_price
CA_1,A,11102,2.50
TX_1,A,11101,1.25
TX_1,A,11102,1.50
WI_1,B,11102,8.00
"""
SALES = """id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3,d_4,d_5
A_CA_1,A,D,C,CA_1,CA,0,0,0,3,1
A_TX_1,A,D,C,TX_1,TX,1,0,2,0,4
B_WI_1,B,D,C,WI_1,WI,0,0,0,0,7
"""


@pytest.fixture
def raw(tmp_path):
    paths = {}
    for name, text in (("calendar", CALENDAR), ("prices", PRICES), ("sales", SALES)):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        paths[name] = str(path)
    return paths


def small_settings():
    return Settings(
        expected_rows={"calendar": 5, "prices": 4, "sales_wide": 3, "sales_melted": 15}
    )


def test_ingestion_from_csv(spark, raw, tmp_path):
    out = str(tmp_path / "silver")
    summary = ingestion.run(
        spark, raw["calendar"], raw["prices"], raw["sales"], out, small_settings()
    )
    assert summary == {"total_rows": 15, "output_path": out}
    rows = {(r["store_id"], r["d"]): r for r in tables.read_panel(spark, out).collect()}
    assert rows["CA_1", 1]["sell_price"] is None and rows["CA_1", 4]["sell_price"] == 2.5
    assert rows["TX_1", 2]["event_name_1"] == "SuperBowl" and rows["TX_1", 2]["snap"] == 1
    assert rows["TX_1", 1]["event_name_1"] == "No Event" and rows["CA_1", 1]["snap"] == 1
    assert rows["WI_1", 5]["sales"] == 7 and str(rows["WI_1", 5]["date"]) == "2011-02-02"


def test_ingestion_stops_on_a_wrong_row_count(spark, raw, tmp_path):
    with pytest.raises(quality.QualityError, match="calendar.row_count"):
        ingestion.run(spark, raw["calendar"], raw["prices"], raw["sales"], str(tmp_path / "x"))


def test_schema_comes_from_the_header(spark, raw):
    wide = bronze.read_sales_wide(spark, raw["sales"])
    assert dict(wide.dtypes)["d_5"] == "int" and wide.columns[:6] == list(ID_COLUMNS)
    assert dict(bronze.read_prices(spark, raw["prices"]).dtypes)["sell_price"] == "decimal(10,2)"


def test_window_filters_reach_the_scan(spark, dense, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_features(dense, path)
    rows = tables.load_window(
        tables.read_panel(spark, path), 72, filters=[F.col("year") >= 2015], columns=["d", "sales"]
    )
    assert rows.agg(F.max("d")).first()[0] == 72
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(d,72)" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<d:int,sales:int>" in plan
    test = tables.load_window(tables.read_panel(spark, path), 72, include_test=True)
    assert test.agg(F.max("d")).first()[0] == 100


def test_reports_and_runs(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0.5)], "fold int, prediction double")
    tables.write_report(frame, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).columns == ["fold", "prediction"]
    tables.write_predictions(frame, str(tmp_path / "p"))
    assert (tmp_path / "p" / "fold=1").is_dir()
    for score in (0.5, 0.6):
        tables.append_run(spark, str(tmp_path / "runs"), {"stage": "cv", "wrmsse": score})
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_stored_rows_live_in_the_shared_folder(spark, dense):
    stored = session.cut_lineage(dense)
    assert stored.inputFiles()[0].startswith("file://" + session.shared_folder(spark))
    assert stored.schema == dense.schema and stored.count() == dense.count()


def test_append_takes_only_new_rows(spark, dense, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "panel", "marks"))
    first, second = dense.where("d <= 50"), dense.where("d > 40")

    def run():
        append.append_new_files(spark, source, dense.schema, target, marks)

    first.coalesce(1).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(target).count() == first.count()
    second.coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert spark.read.parquet(target).count() == dense.count()
    shutil.copytree(source, source + "_again")
    append.append_new_files(spark, source + "_again", dense.schema, target, marks + "_2")
    assert spark.read.parquet(target).count() == dense.count()


def test_released_tables_go_and_kept_ones_stay(spark):
    import os

    from stocktide.session import cut_lineage, released_tables

    def folder(df):
        return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))

    with released_tables(spark):
        with released_tables(spark):
            inner, kept = cut_lineage(spark.range(3)), cut_lineage(spark.range(4), keep=True)
            paths = folder(inner), folder(kept)
        assert not os.path.exists(paths[0]) and kept.count() == 4
    assert not os.path.exists(paths[1])
    assert cut_lineage(spark.range(5)).count() == 5
