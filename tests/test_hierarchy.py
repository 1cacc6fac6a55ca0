"""Hierarchical medians: the fallback chain, NULL and unseen keys, level usage, persistence."""

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_MID
from tallyline import schemas as S
from tallyline.operators import hierarchy
from tallyline.operators.hierarchy import HierarchicalMedian, HierarchicalMedianModel, fit_simple_stats, level_usage
from tallyline.plans import jobs
from tallyline.sources import fixtures as fx

LEVELS = [["a", "b"], ["a"], ["b"]]


def _train(spark):
    rows = [("x", 1, 10.0), ("x", 1, 20.0), ("x", 2, 30.0), ("y", 1, 5.0), (None, 3, 7.0), ("z", None, 100.0), ("z", None, None)]
    return spark.createDataFrame(rows, "a string, b int, t double")


def test_fallback_chain_and_null_keys(spark):
    model = HierarchicalMedian(LEVELS, "t").fit(_train(spark))
    probe = spark.createDataFrame(
        [(1, "x", 1), (2, "x", 9), (3, "q", 1), (4, "q", 3), (5, None, 3), (6, "q", 9), (7, None, None), (8, "z", 1)],
        "id int, a string, b int",
    )
    got = {r["id"]: (r["prediction"], r["level"]) for r in model.predict(probe).collect()}
    assert got[1] == (15.0, 0)  # (x, 1)
    assert got[2] == (20.0, 1)  # a = x only
    assert got[3] == (10.0, 2)  # b = 1 only: 10, 20, 5 -> 10
    assert got[4] == (7.0, 2)  # b = 3 from the row with a NULL a
    assert got[5] == (7.0, 2)  # NULL a skips levels 0 and 1
    assert got[6] == (15.0, -1)  # unseen everything: global median of 10, 20, 30, 5, 7, 100
    assert got[7] == (15.0, -1)
    assert got[8] == (100.0, 1)  # z known only at level a (its b was NULL in training)


def test_missing_key_column_skips_levels(spark):
    model = HierarchicalMedian(LEVELS, "t").fit(_train(spark))
    probe = spark.createDataFrame([(1, "x")], "id int, a string")
    r = model.predict(probe).collect()[0]
    assert (r["prediction"], r["level"]) == (20.0, 1)


def test_level_usage_sums_to_rows(spark):
    model = HierarchicalMedian(LEVELS, "t").fit(_train(spark))
    probe = spark.createDataFrame([(i, "x" if i % 2 else "q", i % 4) for i in range(40)], "id int, a string, b int")
    usage = level_usage(model.predict(probe)).collect()
    assert sum(r["rows"] for r in usage) == 40
    assert abs(sum(r["percent"] for r in usage) - 100.0) < 1e-6


def test_save_load_roundtrip(spark, tmp_path):
    model = HierarchicalMedian(LEVELS, "t").fit(_train(spark))
    model.save(str(tmp_path / "m"))
    loaded = HierarchicalMedianModel.load(spark, str(tmp_path / "m"), LEVELS, "t")
    assert sorted(loaded.table.collect()) == sorted(model.table.collect())
    assert loaded.global_median == 15.0


def test_simple_stats_requires_all_keys(spark):
    m = fit_simple_stats(_train(spark), ["a", "b"], "t", "mean")
    probe = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "q", 1)], "id int, a string, b int")
    got = {r["id"]: r["prediction"] for r in m.predict(probe).collect()}
    glob = (10 + 20 + 30 + 5 + 7 + 100) / 6
    assert got == {1: 15.0, 2: glob, 3: glob}


def test_sparse_training_uses_every_level(spark):
    """FIXTURES §2 sparse bookings: scoring the Task 1 inputs walks the whole chain;
    every row's level and value agree with a pandas brute force."""
    b = fx.bookings_v(spark, SF_MID)
    ts = F.col("appointment_time")
    sparse = b.where((F.col("booking_id") % 20 == 0) & (F.hour(ts) != 3) & ~((F.hour(ts) == 5) & (F.weekday(ts) == 2)))
    model = jobs.train_task1(sparse)
    scored = jobs.score_task1(model, fx.task1_test_v(spark, SF_MID), with_level=True)
    counts = {r["level"]: r["rows"] for r in level_usage(scored).collect()}
    assert set(counts) == {0, 1, 2, 3, 4, 5, 6, -1}

    train = jobs.task1_training_rows(sparse).where(F.col("processing_time_minutes").isNotNull()).toPandas()
    test = jobs.features.task1_score_features(fx.task1_test_v(spark, SF_MID)).toPandas()
    maps = [train.dropna(subset=lv).groupby(lv)["processing_time_minutes"].median().to_dict() for lv in S.TASK1_LEVELS["code"]]
    glob = train["processing_time_minutes"].median()
    got = {r["row_id"]: (r["true_processing_time_minutes"], r["level"]) for r in scored.collect()}
    for _, row in test.iterrows():
        want = (glob, -1)
        for i, lv in enumerate(S.TASK1_LEVELS["code"]):
            key = tuple(row[c] for c in lv)
            if any(pd.isna(k) for k in key):
                continue
            key = key[0] if len(key) == 1 else key
            if key in maps[i]:
                want = (maps[i][key], i)
                break
        assert got[row["row_id"]][1] == want[1]
        assert got[row["row_id"]][0] == int(round(round(min(max(want[0], 0), 480), 6)))


def test_many_keys_under_one_anchor_are_paged(spark):
    """30,000 medians under one of a few anchors: bounded map rows, joined on anchor and page, same answers."""
    ids = 30_000
    rows = spark.range(ids + 300).select(
        F.when(F.col("id") < ids, "hot").otherwise("cold").alias("k"), F.col("id").cast("string").alias("who"),
        (F.col("id") % 5).cast("int").alias("h"), (F.col("id") % 97).cast("double").alias("t"),
    )
    model = HierarchicalMedian([["k", "who", "h"], ["k", "h"], ["k"]], "t").fit(rows)
    pred = model.predict(rows.unionByName(spark.createDataFrame([("hot", "nobody", 1, 0.0), (None, "1", 1, 0.0), ("hot", None, 9, 0.0)], "k string, who string, h int, t double")))
    got = pred.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") != F.col("t")).alias("wrong")).collect()
    levels = {r["level"]: (r["n"], r["wrong"]) for r in got}
    assert levels[0] == (ids + 300, 0) and levels[1][0] == 1 and levels[2][0] == 1 and levels[-1][0] == 1
    paged = model.extra[("paged", "k", 0)]
    sizes = paged.agg(F.max(F.size("_m0")).alias("most"), F.sum(F.size("_m0")).alias("all"), F.count(F.lit(1)).alias("pages")).first()
    assert sizes["most"] <= hierarchy.PAGE_ENTRIES and sizes["all"] == ids + 300 and sizes["pages"] > 100
    assert ("k", (1, 2)) in model.extra  # the small levels stay one row per anchor


def test_whole_number_keys_need_no_count_and_texts_may_hold_the_separator(spark):
    rows = spark.createDataFrame([("a", "x\x1fy", "z", 3, 1.0), ("a", "x", "y\x1fz", 3, 2.0), ("a", "x", "z", 4, 5.0)], "k string, p string, q string, h int, t double")
    model = HierarchicalMedian([["k", "p", "q"], ["k", "h"]], "t").fit(rows)
    assert {(r["p"], r["prediction"]) for r in model.predict(rows).collect()} == {("x\x1fy", 1.0), ("x", 2.0), ("x", 5.0)}
    assert model.key_values == {"h": 2}
