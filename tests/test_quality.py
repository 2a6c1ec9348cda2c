import pytest

from stocktide.operators import quality


def outcome(results):
    return {r["check"]: r["passed"] for r in results.collect()}


def test_clean_panel_passes(make_panel):
    panel = make_panel([("i1", "s1", d, d % 3, None if d <= 7 else 2.0) for d in range(1, 22)])
    assert all(outcome(quality.panel_checks(panel, 21)).values())
    quality.raise_on_failure(quality.panel_checks(panel, 21))


def test_gap_and_duplicate_are_found(make_panel):
    rows = [("i1", "s1", d, 1, 2.0) for d in (1, 2, 4, 5, 5)]
    panel = make_panel(rows)
    assert not outcome(quality.unique_grain(panel))["unique_grain"]
    # One missing and one doubled day cancel in the row count, as the rule counts rows.
    assert outcome(quality.continuous_dates(panel))["continuous_dates"]
    assert not outcome(quality.continuous_dates(panel.dropDuplicates()))["continuous_dates"]


def test_bad_values_are_counted(make_panel):
    nan = float("nan")
    panel = make_panel(
        [("i1", "s1", 1, -1, 2.0), ("i1", "s1", 2, None, 0.0), ("i1", "s1", 3, 1, nan)]
    )
    found = {r["check"]: r["failing_rows"] for r in quality.value_checks(panel, 5).collect()}
    assert found == {
        "sales_not_negative": 1, "sales_not_null": 1, "price_positive": 1, "row_count": 2,
    }
    with pytest.raises(quality.QualityError, match="sales_not_negative"):
        quality.raise_on_failure(quality.value_checks(panel))


def test_price_around_launch(make_panel):
    late = [("i1", "s1", d, 0, None if d <= 7 else 2.0) for d in range(1, 15)]
    assert all(outcome(quality.launch_price_checks(make_panel(late))).values())
    hole = late + [("i1", "s1", 15, 0, None)]
    assert not outcome(quality.launch_price_checks(make_panel(hole)))["no_null_price_after_launch"]
    early = [("i1", "s1", d, 0, 2.0) for d in range(1, 8)]
    assert not outcome(quality.launch_price_checks(make_panel(early)))["null_price_before_launch"]


def test_raw_table_rules(make_panel):
    panel = make_panel([("i1", "s1", 1, 1, 2.0)])
    assert outcome(quality.check_raw_table(panel, ["item_id", "x"], 1, "raw")) == {
        "not_empty": True, "columns_present": False, "row_count": True,
    }


def test_duplicates_dead_series_and_fingerprint(make_panel):
    panel = make_panel([("i1", "s1", d, 3, 2.0) for d in (1, 2, 2)])
    assert quality.duplicate_rows(panel, ["item_id", "store_id", "date"]).first()[0] == 1
    assert quality.dead_series(panel).count() == 1
    one = quality.dataset_profile(panel).first()["fingerprint"]
    assert one == quality.dataset_profile(panel).first()["fingerprint"]
    assert one != quality.dataset_profile(panel.limit(1)).first()["fingerprint"]
