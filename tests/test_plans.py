"""Plan checks: scoring is broadcast joins only, nothing runs in Python, scans are pruned."""

import re

import pytest

from conftest import SF_SMALL
from tallyline.plans import jobs
from tallyline.sources import fixtures as fx


def _plan(df) -> str:
    df.collect()  # the frame's own execution: a write would run another one
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_scoring_plan_has_no_shuffle(spark):
    model = jobs.train_task1(fx.bookings_v(spark, SF_SMALL))
    plan = _plan(jobs.score_task1(model, fx.task1_test_v(spark, SF_SMALL)))
    assert plan.count("BroadcastHashJoin") == 1
    for node in ("SortMergeJoin", "ShuffledHashJoin", "Exchange hashpartitioning", "Exchange rangepartitioning"):
        assert node not in plan, node
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert node not in plan, node


def test_scoring_without_broadcasts_is_one_join(spark):
    model = jobs.train_task1(fx.bookings_v(spark, SF_SMALL))
    inputs = fx.task1_test_v(spark, SF_SMALL)
    want = sorted(tuple(r) for r in jobs.score_task1(model, inputs, with_level=True).collect())
    model.extra.clear()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        scored = jobs.score_task1(model, inputs, with_level=True)
        plan = _plan(scored)
        assert sorted(tuple(r) for r in scored.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joined = plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin")
    assert joined == 1 and plan.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plan


def test_threshold_units_and_measured_width(spark):
    from tallyline.operators import joins

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, want in (("100MB", 100 << 20), ("-1", 0), ("10k", 10240), ("7", 7), ("1g", 1 << 30), ("256kb", 256 << 10)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert joins.broadcast_threshold(spark) == want
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
        fact = spark.range(10).withColumnRenamed("id", "task_id")
        wide = spark.range(10).selectExpr("id as task_id", "repeat('x', 1000) as note")
        narrow = spark.range(10).selectExpr("id as task_id", "'x' as note")
        hint = lambda d: "broadcast" in joins.merge_with_dimension(fact, d)._jdf.queryExecution().optimizedPlan().toString()
        assert hint(narrow) and not hint(wide)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_training_plan_is_jvm_only_and_pruned(spark):
    rows = jobs.task1_training_rows(fx.bookings_v(spark, SF_SMALL))
    from tallyline.operators.hierarchy import HierarchicalMedian
    from tallyline import schemas as S

    table, _ = HierarchicalMedian(S.TASK1_LEVELS["code"], "processing_time_minutes").fit_table(rows)
    plan = _plan(table)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    model = jobs.train_task1(fx.bookings_v(spark, SF_SMALL))
    scored = jobs.score_task1(model, fx.task1_test_v(spark, SF_SMALL))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # the orders scan reads only the three columns the inputs are built from
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in _formatted(scored)


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_fit_plans_never_use_a_single_partition(spark):
    from tallyline import schemas as S
    from tallyline.operators.hierarchy import HierarchicalMedian

    rows = jobs.task1_training_rows(fx.bookings_v(spark, SF_SMALL))
    table, _ = HierarchicalMedian(S.TASK1_LEVELS["code"], "processing_time_minutes").fit_table(rows)
    assert "SinglePartition" not in _plan(table)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_hot_group_is_ranked_in_even_parts(spark, tmp_path, threshold):
    """Two thirds of the rows in one of 100 groups, nearly all values distinct: after the
    histogram no task gets more than its share, whether joins are broadcast or not."""
    from pyspark.sql import functions as F

    from tallyline import session
    from tallyline.operators.median import grouped_median

    n, parts = 200_000, 40
    g = F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 100).alias("g")
    df = spark.range(n).select(g, (F.col("id") * 7919 % 1_000_003).cast("double").alias("v"))
    conf = {
        "spark.sql.shuffle.partitions": str(parts), "spark.sql.autoBroadcastJoinThreshold": threshold,
        # the test's few bytes are otherwise one partition by right
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    written = []
    keep = session.materialize

    def seen(frame, name, *args, **kwargs):
        out = keep(frame, name, *args, **kwargs)
        written.append(out)
        return out

    from tallyline.operators import median

    median.materialize = seen
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        med = grouped_median(df, ["g"], "v")
        med.collect()  # the frame's own execution, so its plan is the final one
        plan = med._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        sizes = [r["count"] for r in written[0].groupBy("g", "_part").count().collect()]
    finally:
        median.materialize = keep
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(sizes) <= 4 * n / parts
    by = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan)
    assert any("_part" in x for x in by)  # rows are ranked by (group, part)
    # whatever is dealt out by the group alone has been reduced to totals or picked rows
    exact = df.groupBy("g").agg(F.expr("median(v)").alias("m")).collect()
    assert {r["g"]: r["median"] for r in med.collect()} == {r["g"]: r["m"] for r in exact}
