"""Rolling origins: the one fit equals k separate fits; ties in time, empty rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators.hierarchy import HierarchicalMedian
from tallyline.plans.rolling import ORIGIN, origins, rolling_metrics

LEVELS = [["k", "h"], ["k"], ["h"]]
SCHEMA = "k string, h int, y double, t bigint"


def predict(model, rows):
    return model.predict(rows, "p")


def separate(rows, cuts, k):
    out = []
    for i in range(k):
        train, test = rows.where(F.col("t") <= cuts[i]), rows.where(F.col("t") > cuts[i])
        test = test.where(F.col("t") <= cuts[i + 1]) if i + 1 < k else test
        err = F.col("p") - F.col("y")
        fitted = HierarchicalMedian(LEVELS, "y").fit(train)
        m = predict(fitted, test).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")).first()
        out.append((i, train.where("y is not null").count(), m["n"], m["mae"], m["rmse"]))
    return out


def check(got, want):
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3]
        for a, b in zip(g[3:], w[3:], strict=True):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-12))


@pytest.mark.parametrize("times", [400, 3])  # 3: most origins tie
def test_equals_separate_fits(spark, times):
    rnd = random.Random(times)
    data = [(rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([1, 2, None]), float(rnd.randrange(50)), rnd.randrange(times)) for _ in range(500)]
    data += [("a", 1, None, 5), ("late", 1, 3.0, 10**6)]
    rows = spark.createDataFrame(data, SCHEMA)
    known = rows.where("y is not null")
    cuts = origins(known, "t", 4, 0.4)
    got = sorted(tuple(r) for r in rolling_metrics(rows, LEVELS, "y", "t", predict, "p", 4, 0.4).collect())
    check(got, separate(known, cuts, 4))


def test_rows_without_time_and_empty_rows(spark):
    rows = spark.createDataFrame([("a", 1, 2.0, None), ("a", 1, 2.0, 1), ("a", 1, 4.0, 2)], SCHEMA)
    got = sorted(tuple(r) for r in rolling_metrics(rows, LEVELS, "y", "t", predict, "p", 2, 0.5).collect())
    assert [g[:3] for g in got] == [(0, 1, 0), (1, 1, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert sorted(tuple(r) for r in rolling_metrics(none, LEVELS, "y", "t", predict, "p", 2).collect()) == [(i, 0, 0, None, None) for i in range(2)]


def test_reads_its_rows_as_often_as_one_fit_and_score(spark, tmp_path):
    data = [("a" if i % 3 else "b", i % 5, float(i % 7), i) for i in range(200)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = rolling_metrics(rows, LEVELS, "y", "t", predict, "p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [k#") == 1 and ORIGIN in plan  # all five tests read one scan; the fit is a written table
