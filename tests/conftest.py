import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stocktide.session import build_session  # noqa: E402

START = date(2015, 1, 1)
SCHEMA = (
    "item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, "
    "wm_yr_wk int, d int, sales int, sell_price double, weekday string, month int, year int, "
    "event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, snap int"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def panel_row(item, store, day, sales, price, dept="D1", cat="C1", state="S1"):
    when = START + timedelta(days=day - 1)
    return (
        item, dept, cat, store, state, when, 11101 + (day - 1) // 7, day, sales, price,
        when.strftime("%A"), when.month, when.year, "No Event", "No Event", "No Event",
        "No Event", int(when.day <= 10),
    )


@pytest.fixture(scope="session")
def make_panel(spark):
    """Panel from (item, store, day, sales, price[, dept, cat, state]) rows."""

    def make(rows):
        return spark.createDataFrame([panel_row(*r) for r in rows], SCHEMA)

    return make


def units(item, store, day):
    """A fixed, irregular demand with many zeros."""
    x = (day * 7 + len(item) * 3 + ord(item[-1]) * 5 + ord(store[-1]) * 11) % 13
    return max(0, x - 6) + (day % 7 == 0) * 2


DENSE_DAYS = 100


@pytest.fixture(scope="session")
def dense(make_panel):
    """Two items in two stores over 100 days; prices step every 20 days."""
    return make_panel(
        [
            (i, s, d, units(i, s, d), 2.0 + 0.25 * ((d // 20) % 3), dept, cat, "S" + s[-1])
            for i, dept, cat in (("i1", "D1", "C1"), ("i2", "D2", "C1"))
            for s in ("s1", "s2")
            for d in range(1, DENSE_DAYS + 1)
        ]
    ).cache()
