"""Physical-plan checks: pushdown, pruning, no cartesian products."""

from tillwise.catalog import REGISTRY

from settings import SF_SMALL


def _plan(df) -> str:
    """The ``explain("formatted")`` text of the executed plan."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_pushes_filters_and_prunes_columns(spark):
    df = REGISTRY["scan_table"].build(spark, SF_SMALL)
    plan = _plan(df)
    assert "EqualTo(l_returnflag,R)" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    # only the projected and filtered columns are read
    assert "l_tax" not in read and "l_discount" not in read and "l_linestatus" not in read


def test_governance_scans_are_pruned(spark):
    df = REGISTRY["governance_run"].build(spark, SF_SMALL)
    plan = _plan(df)
    assert plan.count("ReadSchema:") == 3
    for read in [x.split("\n")[0] for x in plan.split("ReadSchema:")[1:]]:
        assert "l_discount" not in read and "l_tax" not in read


# Nested-loop joins whose one side has a bound: the folds of a split (n_splits
# rows). Their keys are listed; any other key must have none.
BOUNDED_LOOPS = {"group_ts_split", "group_ts_split_template"}
# Spark ML boosting with the reference's tree counts takes minutes to build.
SLOW = {"cv_report", "gbt_regressor", "virtual_ensemble"}


def test_no_cartesian_products_or_nested_loops_in_registered_plans(spark):
    bad = []
    for key, e in REGISTRY.items():
        if key in SLOW:
            continue
        plan = _plan(e.build(spark, SF_SMALL))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan and key not in BOUNDED_LOOPS:
            bad.append(key)
    assert not bad, bad
