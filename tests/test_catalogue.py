"""Every checked query against DuckDB on the smallest sample."""

import pytest
from check_queries import compare, database

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
QUICK = sorted(set(entry_points.oracle_sql()) - {
    # covered by the check tool on the middle sample; their parts are tested below
    "daily_service", "daily_global", "feature_detail", "agent_profile", "agent_scatter", "load_projection",
    "balanced_reallocation", "balance_kpis", "sustained_overload", "overload_alerts", "event_adjusted_forecast",
    "tfidf_ngrams", "stream_velocity", "stream_sessions", "stream_load_sliding", "service_p75", "alert_streak",
    "union_train_val", "inject_anomalies", "stratified_split", "walk_forward_task_folds", "chrono_split",
})


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_sql(spark, con, name):
    result = entry_points.queries()[name](spark, SF).toArrow()
    assert compare(result, con.sql(entry_points.oracle_sql()[name]).to_arrow_table()) is None
