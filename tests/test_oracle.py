"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); rows-only keys must run."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from tillwise.catalog import REGISTRY, oracle_text  # noqa: E402
import oracle_check  # noqa: E402

from settings import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF_SMALL)


# Spark ML boosting with the reference's tree counts takes minutes locally;
# its code path is covered with few trees in test_properties.
SLOW = {"cv_report", "gbt_regressor"}


@pytest.mark.parametrize("key", sorted(k for k in REGISTRY if k not in SLOW))
def test_query_matches_oracle(spark, duck, key):
    e = REGISTRY[key]
    r = oracle_check.compare(spark, duck, key, e.build, oracle_text(e), SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_contract(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() >= 0
    assert set(se.oracle_sql()) <= set(se.queries())
