import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocktide.operators import features as f
from stocktide.plans import gold

ROLLING = ("lag_", "rolling_", "days_since_last_sale", "enc_", "store_dept_rolling")


@pytest.fixture(scope="module")
def table(dense):
    return (
        gold.build_features(dense, 2015, 2016)
        .toPandas()
        .sort_values(["item_id", "store_id", "d"])
        .reset_index(drop=True)
    )


def test_lags_and_windows_match_a_direct_computation(table):
    for _, g in table.groupby(["item_id", "store_id"]):
        s = g["sales"].to_numpy(float)
        for i in (0, 27, 28, 33, 60, 99):
            row = g.iloc[i]
            assert row["lag_28"] == s[i - 28] if i >= 28 else pd.isna(row["lag_28"])
            for size in (7, 28, 56):
                window = s[max(0, i - 27 - size) : max(0, i - 27)]
                if len(window):
                    assert row[f"rolling_mean_{size}"] == pytest.approx(
                        np.floor(window.mean() * 100 + 0.5) / 100
                    )
                else:
                    assert pd.isna(row[f"rolling_mean_{size}"])
            window = s[max(0, i - 55) : max(0, i - 27)]
            sold = window[window > 0]
            if len(sold) > 1:
                assert row["rolling_positive_median_28"] == pytest.approx(np.median(sold), abs=0.0051)
                assert row["rolling_positive_std_28"] == pytest.approx(sold.std(ddof=1), abs=0.0051)
                assert row["rolling_positive_max_28"] == sold.max()
                assert row["rolling_positive_rate_28"] == pytest.approx(
                    len(sold) / len(window), abs=0.0051
                )


def test_three_rolling_means_differ(table):
    """Each mean has its own window length."""
    late = table[table["d"] > 90]
    assert (late["rolling_mean_7"] != late["rolling_mean_28"]).any()
    assert (late["rolling_mean_28"] != late["rolling_mean_56"]).any()


def test_encodings_use_their_own_keys(table):
    for name, keys in {
        "item": ["item_id"], "store": ["store_id"], "item_store": ["item_id", "store_id"],
        "store_dept": ["store_id", "dept_id"], "store_cat": ["store_id", "cat_id"],
    }.items():
        for _, g in table.groupby(keys):
            known = g[g["d"] <= 80 - 28]["sales"]
            at = g[g["d"] == 80].iloc[0]
            assert at[f"enc_{name}_mean"] == pytest.approx(known.mean())
            assert at[f"enc_{name}_std"] == pytest.approx(known.std())


def test_nothing_looks_inside_the_horizon(dense):
    """Changing the sales of the last 28 days must not change any feature of the last day."""
    last = 100
    changed = dense.withColumn(
        "sales", F.when(F.col("d") > last - 28, F.col("sales") + 50).otherwise(F.col("sales"))
    )

    def at_end(panel):
        out = gold.build_features(panel, 2015, 2016).where(F.col("d") == last)
        names = [c for c in out.columns if c.startswith(ROLLING) or c.startswith(("trend", "item_"))]
        return sorted(map(str, out.select(*names, "store_id").collect()))

    assert at_end(dense) == at_end(changed)


def test_year_cut_before_or_after(make_panel):
    """By default the launch and the lags come from the whole history."""
    panel = make_panel([("i1", "s1", d, d % 5, 2.0) for d in range(330, 401)])
    first = F.col("date") == F.lit("2016-01-01").cast("date")
    full = gold.build_features(panel, 2016, 2016).where(first).first()
    cut = gold.build_features(panel, 2016, 2016, truncate_first=True).where(first).first()
    assert str(full["launch_date"]) == "2015-11-26" and full["lag_28"] is not None
    assert str(cut["launch_date"]) == "2016-01-01" and cut["lag_28"] is None


def test_rows_without_a_price_are_left_out(make_panel):
    nan = float("nan")
    panel = make_panel([("i1", "s1", 1, 0, None), ("i1", "s1", 2, 0, nan), ("i1", "s1", 3, 0, 2.0)])
    assert [r["d"] for r in f.priced_rows(panel).collect()] == [3]


def test_price_steps(make_panel):
    prices = [2.0] * 7 + [2.5] * 14 + [2.0] * 7
    panel = make_panel([("i1", "s1", d + 1, 1, p) for d, p in enumerate(prices)])
    out = {r["d"]: r for r in f.price_features(panel).collect()}
    assert out[8]["price_weekly_change"] == 1.25 and out[16]["price_weekly_change"] == 1.0
    assert out[1]["price_weekly_change"] is None and out[1]["price_unique_count"] == 2
    assert out[1]["price_norm"] == 0.8 and out[28]["price_vs_dept"] == 1.0
    life = {r["d"]: r for r in f.lifecycle_features(panel, (1,)).collect()}
    assert life[10]["days_since_price_change"] == 2 and life[5]["days_since_price_change"] is None
    assert life[8]["price_change"] == 0.5 and life[8]["price_change_pct"] == 0.25
    assert life[28]["days_since_launch"] == 27 and life[2]["lag_1"] == 1
