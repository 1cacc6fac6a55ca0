"""One-step commits: a save that ends midway leaves the model before; versions, checksums, sweeping."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline.operators import linear
from tallyline.sources import modelstore


def tables(spark, n):
    return {"a": spark.range(n), "b": spark.range(3).select(F.lit(n).alias("n"), F.lit(None).cast("string").alias("s"))}


def rows(spark, path):
    found, settings = modelstore.load(spark, path, verify=True)
    return found["a"].count(), found["b"].first()["n"], settings


def test_newest_version_is_loaded_and_older_ones_go(spark, tmp_path):
    path = str(tmp_path / "m")
    assert not modelstore.is_store(spark, path)
    with pytest.raises(FileNotFoundError):
        modelstore.load(spark, path)
    for n in (5, 0, 7, 9):
        modelstore.save(spark, path, tables(spark, n), {"n": n, "text": "ä"})
        assert rows(spark, path) == (n, n, {"n": n, "text": "ä"})
    names = [x for x in os.listdir(path) if not x.startswith(".")]
    assert sorted(x for x in names if x.startswith("manifest")) == ["manifest-00000003", "manifest-00000004"]
    assert len([x for x in names if x.startswith("data-")]) == modelstore.KEPT and not [x for x in names if "draft" in x]


@pytest.mark.parametrize("broken", ["second table", "rename"])
def test_a_save_that_ends_midway_leaves_the_old_model(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "m")
    modelstore.save(spark, path, tables(spark, 4))

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    with monkeypatch.context() as m:
        if broken == "rename":
            m.setattr(modelstore._Files, "rename", lost)
        else:
            write = modelstore._write
            m.setattr(modelstore, "_write", lambda df, p: lost() if p.endswith("/b") else write(df, p))
        with pytest.raises(Lost):
            modelstore.save(spark, path, tables(spark, 6))
    assert rows(spark, path) == (4, 4, {})
    modelstore.sweep(spark, path)
    assert len([x for x in os.listdir(path) if x.startswith(("data-", "_draft-"))]) == 1
    assert rows(spark, path) == (4, 4, {})
    modelstore.save(spark, path, tables(spark, 6))
    assert rows(spark, path) == (6, 6, {})


def test_a_changed_table_is_an_error(spark, tmp_path):
    path = str(tmp_path / "m")
    modelstore.save(spark, path, tables(spark, 4))
    folder = next(x for x in os.listdir(path) if x.startswith("data-"))
    spark.range(1, 5).write.mode("overwrite").parquet(f"{path}/{folder}/a")
    assert modelstore.load(spark, path)[0]["a"].count() == 4
    with pytest.raises(ValueError, match="table a"):
        modelstore.load(spark, path, verify=True)


def test_linear_model_is_replaced_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ols")
    data = spark.createDataFrame([(float(x), float(x % 3), 2.0 * x + 1) for x in range(20)], "x double, z double, y double")
    first, second = linear.fit_linear(data, "y", ["x"]), linear.fit_linear(data, "y", ["x", "z"])
    first.save(path)
    with monkeypatch.context() as m:
        m.setattr(modelstore._Files, "write", lambda *_: (_ for _ in ()).throw(OSError))
        with pytest.raises(OSError):
            second.save(path)
    assert linear.LinearModel.load(spark, path, verify=True).feature_cols == ["x"]
    second.save(path)
    assert linear.LinearModel.load(spark, path).coefficients == second.coefficients
