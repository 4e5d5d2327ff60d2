"""Correlations of many columns with one, against numpy, whatever the number of tasks and batches."""

import numpy as np
import pytest

from cohortlab.operators.stats import correlations_with


@pytest.mark.parametrize("parts, batch", [(1, 10_000), (7, 13), (90, 10_000)])
def test_moments_of_tasks_give_the_correlation(spark, parts, batch):
    rng = np.random.default_rng(3)
    y = [None if rng.random() < 0.2 else float(v) for v in rng.integers(0, 3, 300)]
    x = [None if rng.random() < 0.3 else 1e6 + float(v) for v in rng.normal(size=300)]
    late = [None if i < 200 else float(i % 7) for i in range(300)]
    rows = [(a, 0.1, None, c, b) for a, b, c in zip(x, y, late)]
    df = spark.createDataFrame(rows, "`a b` double, same double, none double, late double, y double").repartition(parts)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r.feature: r.r for r in correlations_with(df, ["a b", "same", "none", "late"], "y").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for name, values in (("a b", x), ("late", late)):
        pairs = np.array([(a, b) for a, b in zip(values, y) if a is not None and b is not None])
        assert abs(got[name] - np.corrcoef(pairs.T)[0, 1]) < 1e-9
    assert got["same"] is None and got["none"] is None
    assert correlations_with(df.limit(0), ["a b"], "y").where("r is not null").count() == 0


def test_cells_of_the_importance_table_are_no_rows(spark):
    from cohortlab.plans import q_eval
    plan = q_eval.importance(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
