"""End to end: CSV in, both tasks trained and scored, outputs validated; streaming = batch."""

import time

import pytest
from conftest import SF_SMALL
from tallyline.plans import fullrun, jobs
from tallyline.sources import csv as csvio
from tallyline.sources import fixtures as fx
from tallyline.streaming import scoring as stream


def _inputs(spark, tmp_path):
    paths = {}
    for name, maker in [("bookings", fx.bookings_v), ("tasks", fx.tasks_v), ("staffing", fx.staffing_v),
                        ("t1", fx.task1_test_v), ("t2", fx.task2_test_v)]:
        paths[name] = str(tmp_path / name)
        csvio.write_csv(maker(spark, SF_SMALL), paths[name])
    return paths


def test_full_run_validates(spark, tmp_path):
    p = _inputs(spark, tmp_path)
    for m1, m2 in [("baseline", "baseline"), ("ensemble", "patterns"), ("nonsense", "linear"), ("linear", "ensemble")]:
        res = fullrun.full_run(spark, p["bookings"], p["tasks"], p["staffing"], p["t1"], p["t2"], str(tmp_path / f"out-{m1}-{m2}"), m1, m2)
        assert res.model1_ok and res.model2_ok
        for summary in (res.summary1, res.summary2):
            row = summary.collect()[0]
            assert row["training_samples"] > 0 and row["mae"] >= 0 and row["rmse"] >= row["mae"]
        for report in (res.task1, res.task2, res.submission1, res.submission2):
            r = report.collect()[0]
            assert r["valid"], (m1, m2, r)
        n_in = fx.task1_test_v(spark, SF_SMALL).count()
        assert res.submission1.collect()[0]["rows"] == n_in


def test_saved_model_check(spark, tmp_path):
    model = jobs.train_task2(fx.staffing_v(spark, SF_SMALL))
    path = str(tmp_path / "m2")
    model.save(path)
    from tallyline import schemas as S

    assert fullrun.validate_model_table(spark, path, S.TASK2_LEVELS["code"], jobs.TASK2_TARGET)


def test_streaming_scoring_equals_batch(spark, tmp_path):
    p = _inputs(spark, tmp_path)
    model = jobs.train_task1(fx.bookings_v(spark, SF_SMALL))
    out = str(tmp_path / "stream-out")
    q = stream.score_task1_stream(spark, model, p["t1"], out, str(tmp_path / "ckpt"), available_now=True)
    assert q.awaitTermination(300)
    got = {(str(r[0]), r[1]) for r in spark.read.parquet(out).collect()}
    batch = jobs.score_task1(model, csvio.read_csv_tolerant(spark, p["t1"]))
    want = {(str(r[0]), r[1]) for r in batch.collect()}
    assert got == want and len(got) == fx.task1_test_v(spark, SF_SMALL).count()


def test_seven_rows_fit_a_linear_model_but_no_ensemble_part(spark):
    from tallyline import schemas as S
    from tallyline.operators import linear

    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(7)], "x double, t double")
    plain = linear.fit_numeric(df, "t")
    got = [r["linear_prediction"] for r in plain.predict(df).orderBy("x").collect()]
    assert plain.fitted and all(abs(a - (2 * i + 1)) < 1e-6 for i, a in enumerate(got))
    assert not linear.fit_numeric(df, "t", min_rows=S.MIN_ROWS_FOR_LINEAR).fitted
    assert not linear.fit_numeric(df.limit(0), "t").fitted


def test_linear_model_on_all_features_equals_least_squares(spark, tmp_path):
    import numpy as np

    from tallyline.operators import linear

    rng = np.random.default_rng(0)
    n = 300
    rows = []
    for i in range(n):
        x = float(rng.normal())
        rows.append((i, "abc"[i % 3], None if i % 7 == 0 else x, float("nan") if i % 11 == 0 else 2 * x, float("inf") if i % 13 == 0 else 1.0 + i % 5,
                     bool(i % 2), float(i % 3 + 2 * x + rng.normal() * 0.1)))
    df = spark.createDataFrame(rows, "row_id int, s string, a double, b double, c double, f boolean, t double")
    model = linear.fit_numeric(df, "t", booleans=True)
    assert sorted(model.feature_cols) == ["a", "b", "c", "f", "s"]
    design = np.array([["abc".index(r[1]), np.nan if r[2] is None else r[2], r[3], r[4], r[5]] for r in rows], float)
    for j in range(5):  # fill with the median, infinite values in, then 0 for those
        col = design[:, j]
        col[np.isnan(col)] = np.median(col[~np.isnan(col)])
        col[np.isinf(col)] = 0
    y = np.array([r[6] for r in rows])
    want = np.c_[np.ones(n), design] @ np.linalg.lstsq(np.c_[np.ones(n), design], y, rcond=None)[0]
    model.save(str(tmp_path / "ols"))
    for m in (model, linear.LinearModel.load(spark, str(tmp_path / "ols"))):
        got = [r["linear_prediction"] for r in m.predict(df).orderBy("row_id").collect()]
        assert np.allclose(got, want, atol=1e-6)
    # a text feature and a number that are absent at scoring take their defaults
    model.defaults = {"s": "b", "c": 1}
    part = model.predict(df.select("row_id", "a", "b", "f")).count()
    assert part == n


@pytest.mark.parametrize(
    ("name", "some"),
    [
        ("ensemble_blend_all_features", {"task_id", "section_id", "appt_hour", "appt_month", "booking_advance_hours", "queue_number", "satisfaction_rating"}),
        ("ensemble_blend_task2_all_features", {"section_id", "weekday", "month", "is_weekend", "total_task_time_minutes", "task_time_category"}),
        ("linear_model_all_features", {"section_id", "weekday", "month", "is_weekend", "total_task_time_minutes", "task_time_category"}),
    ],
)
def test_registered_models_fit_all_features(spark, monkeypatch, name, some):
    import numpy as np

    import __spark_entry__ as ent
    from tallyline.operators import linear

    fit, seen = linear.fit_linear, []

    def recorded(df, target, cols, **kw):
        model = fit(df, target, cols, **kw)
        x = linear._filled(linear._doubles(df, cols), cols, model.fills).select(*cols, target, model.expression().alias("got"))
        seen.append((set(cols), x.toPandas().astype(float)))
        return model

    monkeypatch.setattr(linear, "fit_linear", recorded)
    out = ent.queries()[name](spark, SF_SMALL)
    inputs = fx.task1_test_v(spark, SF_SMALL) if name == "ensemble_blend_all_features" else fx.task2_test_v(spark, SF_SMALL)
    assert out.count() == inputs.count() and out.dropna().count() == out.count()
    ((cols, x),) = seen
    assert some <= cols, cols
    design = x.drop(columns="got").to_numpy()
    y, design = design[:, -1], design[:, :-1]
    centred = design - design.mean(0)
    scaled = np.c_[np.ones(len(y)), centred / np.where(centred.std(0) > 0, centred.std(0), 1)]
    # equal columns are collinear (about 1e-16); the codes of section and its name differ by about 1e-7 and are not
    want = scaled @ np.linalg.lstsq(scaled, y, rcond=1e-9)[0]
    assert np.abs(x["got"] - want).max() < 1e-3 * y.std()


def test_non_integer_outputs_are_truncated_and_written_anew(spark, tmp_path):
    inputs = spark.createDataFrame([(1,), (2,), (3,)], "row_id int")
    path = str(tmp_path / "p")
    csvio.write_csv(spark.createDataFrame([(1, 12.7), (2, 3.0), (3, 0.2)], "row_id int, v double"), path)
    report, rows = fullrun.rewrite_truncated(spark, path, "v", inputs, ["row_id", "v"])
    assert report.first()["non_integer"] == 2
    assert sorted((r[0], r[1]) for r in rows.collect()) == [("1", 12), ("2", 3), ("3", 0)]
    assert sorted(r[1] for r in csvio.read_csv_tolerant(spark, path).collect()) == ["0", "12", "3"]


def test_queries_leave_models_and_results_only(spark):
    import os

    import __spark_entry__ as ent
    from tallyline.plans import catalog
    from tallyline.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    kept = ("median-model", "median-lookup", "median-pages", "past-medians", "dimension", "pattern-", "category-codes", "simple-stats", "task-complexity", "impute-fills", "result-")
    for name in ("describe_target", "train_metrics_task2", "section_aggregates", "simple_stats_mean", "duration_quality", "full_run", "clean_staffing"):
        before = set(os.listdir(folder))
        ent.queries()[name](spark, SF_SMALL).collect()
        new = set(os.listdir(folder)) - before
        assert all(x.startswith(kept) for x in new), (name, new)
    assert catalog.QUERIES


def test_least_squares_of_least_norm_with_collinear_and_constant_columns(spark):
    """Equal and constant columns, and codes that differ by less than 1e-5 of their spread: the solution of least norm on
    standardised features, small directions kept."""
    import numpy as np

    from tallyline.operators import linear

    rng = np.random.default_rng(4)
    n = 500
    a, b = rng.integers(0, 24, n), rng.normal(size=n)
    wide = np.where(rng.random(n) < 0.2, 999_999, rng.integers(0, 3, n))
    near = np.where(wide == 999_999, wide, rng.integers(0, 4, n))
    y = 3.0 * a - 2.0 * b + 5.0 * (near - wide) + rng.normal(size=n) * 0.1
    columns = {"a": a, "again": a, "b": b, "one": np.full(n, 7), "wide": wide, "near": near, "sum": 2 * a - 3 * b}
    rows = [tuple(float(v[i]) for v in columns.values()) + (float(y[i]),) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", t double")
    model = linear.fit_linear(df, "t", list(columns), coded=["wide", "near"])
    x = np.stack([v.astype(float) for v in columns.values()], axis=1)
    spread = x.std(0)
    z = (x - x.mean(0)) / np.where(spread > 0, spread, 1)
    basis = np.stack([a, b, wide / 1e6, near - wide, np.ones(n)], axis=1).astype(float)  # the same space
    want = basis @ np.linalg.lstsq(basis, y, rcond=None)[0]
    got = np.array([r["p"] for r in df.select(model.expression().alias("p")).collect()])
    assert np.abs(got - want).max() < 1e-6
    w = np.array(model.coefficients)
    digits = 1e-9 * np.abs(w).max()  # the codes' weights are about a million
    assert w[3] == 0 and abs(w[0] - w[1]) < digits
    least = np.linalg.lstsq(z, y - y.mean(), rcond=1e-9)[0]
    assert np.abs(w - least)[[0, 1, 2, 6]].max() < digits
    assert linear.fit_linear(df.select("one", "t"), "t", ["one"]).coefficients == [0.0]


def test_gram_needs_one_aggregate_and_no_copy(spark):
    from tallyline.operators import linear

    df = spark.range(1000).selectExpr("cast(id % 7 as double) as a", "cast(id % 5 as double) as b", "cast(id as double) as t")
    n, mean, covariance, with_t, t = linear.gram(df.selectExpr("array(a, b) as v", "t as y"), 2)
    want = df.toPandas()
    assert n == 1000 and abs(t - want.t.mean()) < 1e-9
    assert abs(mean - want[["a", "b"]].mean().to_numpy()).max() < 1e-9
    assert abs(covariance - want[["a", "b"]].cov(ddof=0).to_numpy()).max() < 1e-9
    assert abs(with_t - want.cov(ddof=0).loc[["a", "b"], "t"].to_numpy()).max() < 1e-9
    assert linear.gram(df.limit(0).selectExpr("array(a, b) as v", "t as y"), 2)[0] == 0
