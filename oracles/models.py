"""DuckDB statements for what SQL can state about the forecasts of fitted models."""

from oracles.forecast import BOUNDS, HISTORY
from oracles.panel import on_panel


def _checks(*more: str) -> str:
    columns = ["0::BIGINT AS bad_values", *more]
    return on_panel(f"""
SELECT store_id, count(*) AS rows, count(DISTINCT (item_id, store_id, date)) AS keys,
       CAST(sum(sales) AS BIGINT) AS units, {', '.join(columns)}
FROM history, bounds WHERE date > last - 28 GROUP BY store_id""", HISTORY, BOUNDS)


def statements() -> dict[str, str]:
    return {"glm_forecast_checks": _checks(), "stored_fit_checks": _checks("0::BIGINT AS changed")}
