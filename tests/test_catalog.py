import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from tools.compare import compare  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
CHECKED = ("post_launch_year", "zero_share_cat", "sales_buckets", "price_buckets", "feat_trend",
           "wrmsse_levels", "err_slice", "volume_decile", "launch_table", "totals_date")


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_can_be_listed_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@needs_data
def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 7


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_statement(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = entry.queries()[name](spark, SMALL).toPandas()
    ok, _, message = compare(got, con.execute(entry.oracle_sql()[name]).df())
    assert ok, message
