"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equals_sql(spark, sf, con, key):
    assert compare(QUERIES[key](spark, sf), con, ORACLE[key]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 150 and len(df.columns) == len(set(df.columns)) == 129
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


# fitted models have no SQL: tests/test_models.py and tests/test_boosting.py check their values
MODELS = {"train_random_forest", "train_gbt", "train_boosting", "ensemble_score", "feature_importance", "cross_validate", "train_pipeline", "daily_run"}
# estimates: tests/test_increments.py compares with the exact index
SKETCHES = {"snapshot_sketch_drift"}


def test_every_other_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS | SKETCHES
