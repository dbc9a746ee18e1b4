from __future__ import annotations

import __spark_entry__ as entry


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Brand", "event_date", "dayofweek", "budget_daily_target", "total_budget",
                          "reforecast_daily_target", "total_reforecast", "actual_revenue",
                          "actual_plus_forecast_revenue"]
