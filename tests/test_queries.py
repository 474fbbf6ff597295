"""Every registered query against its SQL on the same tables, and the shape of its plan."""

import pytest

from compare import TESTDATA, compare, open_tables, plan
from parcelwise.plans import QUERIES, SQL

FOLDER = f"{TESTDATA}/sf0.001"

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
# Windows over small frames: categories, backtest periods, one row per day, evaluations of one rule.
SMALL_WINDOWS = {
    "d10_firing_alerts",
    "e1_frequency_index",
    "flagship_feature_job",
    "m2_chronological_split",
    "m2_nested_split",
    "m3_time_series_folds",
    "m4_expanding_windows",
    "m10_linear_folds",
    "m5_backtest_periods",
    "m5_linear_backtest",
    "w7_chronological_position",
}


def plan_problems(name, df):
    """Python workers, cartesian products, sorts of whole inputs in one task."""
    text = plan(df)
    found = [w for w in PYTHON if w in text and name != "k7_admissions_table"]
    found += [j for j in ("CartesianProduct", "BroadcastNestedLoopJoin") if j in text]
    if name not in SMALL_WINDOWS and "Exchange SinglePartition" in text.split("Window [", 1)[-1] and "Window [" in text:
        found.append("window in one task")
    return found


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare(tables, SQL[name], df) == []
    assert plan_problems(name, df) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    assert plan_problems(name, df) == []


def test_names_are_plain():
    assert set(SQL) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n]
