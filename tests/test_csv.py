"""Tolerant CSV scan: short, long and quoted rows, encoding fallback, missing files."""

import random

import pandas as pd
import pytest

from tallyline.sources import csv as csvio


def _write(tmp_path, name, data: bytes):
    p = tmp_path / name
    p.write_bytes(data)
    return str(p)


def test_short_rows_padded_long_rows_dropped(spark, tmp_path):
    text = (
        "a,b,c\n"
        "1,2,3\n"          # normal
        "4,5\n"            # short -> padded
        "6,7,8,9\n"        # long -> dropped
        '10,"x,y",12\n'    # quoted comma
        '13,"p,q",15,16\n'  # quoted comma and long -> dropped
    )
    path = _write(tmp_path, "t.csv", text.encode())
    rows = sorted(tuple(r) for r in csvio.read_csv_tolerant(spark, path).collect())
    assert rows == [("1", "2", "3"), ("10", "x,y", "12"), ("4", "5", None)]


def test_latin1_fallback(spark, tmp_path):
    path = _write(tmp_path, "l.csv", "name,city\nJosé,Málaga\n".encode("latin-1"))
    rows = [tuple(r) for r in csvio.read_csv_tolerant(spark, path).collect()]
    assert rows == [("José", "Málaga")]


def test_utf8_kept(spark, tmp_path):
    path = _write(tmp_path, "u.csv", "name,city\nJosé,Málaga\n".encode("utf-8"))
    assert [tuple(r) for r in csvio.read_csv_tolerant(spark, path).collect()] == [("José", "Málaga")]


def test_missing_file_gives_empty_declared_schema(spark, tmp_path):
    df = csvio.read_or_empty(spark, str(tmp_path / "nope.csv"), ["x", "y"])
    assert df.columns == ["x", "y"] and df.count() == 0


def test_roundtrip_and_required_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "row_id int, v string")
    out = str(tmp_path / "o")
    csvio.write_csv(df, out)
    back = csvio.read_csv_tolerant(spark, out)
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a"), ("2", None)]
    csvio.validate_columns(back, ["row_id", "v"])
    try:
        csvio.validate_columns(back, ["row_id", "missing"], "inputs")
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert "missing" in str(e)


def test_dialect_equals_pandas(spark, tmp_path):
    text = (
        'a,b,c\n"a ""b"" c","q"",z",1\n"line\nbreak",x,2\nNA,N/A,nan\n"NA","",null\n'
        'None,#N/A,NULL\nna,none,Null\n" lead",trail ,"""quoted"""\n5,6\n7,8,9,10\n"",-nan,\\"\n'
    )
    path = _write(tmp_path, "d.csv", text.encode())
    want = pd.read_csv(path, dtype=str, engine="python", on_bad_lines="skip")
    key = lambda r: tuple("" if x is None or x != x else str(x) for x in r)
    got = csvio.read_csv_tolerant(spark, path).collect()
    assert sorted(map(key, got)) == sorted(map(key, want.itertuples(index=False)))


def test_written_file_reads_back_in_pandas(spark, tmp_path):
    rows = [("1", 'say "hi", you'), ("2", "two\nlines"), ("3", "é \ufffd"), ("4", None), ("5", 'tail"')]
    csvio.write_csv(spark.createDataFrame(rows, "id string, v string"), str(tmp_path / "w"), single_file=True)
    part = next((tmp_path / "w").glob("part-*.csv"))
    back = pd.read_csv(part, dtype=str, encoding="utf-8", engine="python", on_bad_lines="skip")
    assert sorted((i, None if v != v else v) for i, v in back.values.tolist()) == sorted(rows, key=lambda r: r[0])
    assert sorted(tuple(r) for r in csvio.read_csv_tolerant(spark, str(tmp_path / "w")).collect()) == rows


def test_genuine_replacement_character_stays(spark, tmp_path):
    path = _write(tmp_path, "r.csv", "näme,city\nJosé,M\ufffdx\n".encode())
    df = csvio.read_csv_tolerant(spark, path)
    assert df.columns == ["näme", "city"] and [tuple(r) for r in df.collect()] == [("José", "M\ufffdx")]


def test_folder_of_both_encodings_is_read_once(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    _write(folder, "a.csv", "name\nJosé\n".encode())
    _write(folder, "b.csv", "name\nMálaga\n".encode("latin-1"))
    df = csvio.read_csv_tolerant(spark, str(folder))
    assert sorted(r[0] for r in df.collect()) == ["José", "Málaga"]


def test_only_a_missing_path_is_an_empty_table(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises((AnalysisException, Exception)):
        csvio.read_or_empty(spark, "no-such-scheme://x/y.csv", ["a"]).collect()


# byte ranges ------------------------------------------------------------------------------------


def _ranges(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def small_ranges(spark):
    _ranges(spark, 200)
    yield
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def _field(rng):
    if rng.random() < 0.4:
        return rng.choice(["a", "12", "x y", "é", "NA", "", 'b"c', " lead", "tr "])
    return '"' + "".join(rng.choice(["a", ",", "\n", '""', "b c", "é", "\n\n"]) for _ in range(rng.randrange(7))) + '"'


@pytest.mark.parametrize(("seed", "newline"), [(0, "\n"), (1, "\r\n"), (2, "\n")])
def test_any_record_over_any_border_equals_pandas(spark, tmp_path, small_ranges, seed, newline):
    rng = random.Random(seed)
    rows = ["a,b,c"]
    for i in range(150):
        rows.append(",".join([str(i), *(_field(rng) for _ in range((2 if i == 0 else rng.choice([2, 2, 2, 1, 0, 3]))))]))
        rows += [""] * (rng.random() < 0.05)
    path = _write(tmp_path, "r.csv", newline.join(rows).encode())
    want = pd.read_csv(path, dtype=str, engine="python", on_bad_lines="skip")
    key = lambda r: tuple("" if x is None or x != x else str(x).replace("\r\n", "\n") for x in r)
    got = csvio.read_csv_tolerant(spark, path).collect()
    assert sorted(map(key, got)) == sorted(map(key, want.itertuples(index=False)))
    assert spark.read.text(path).rdd.getNumPartitions() > 5


def test_a_long_quoted_text_spans_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, of many" for i in range(200))
    path = _write(tmp_path, "s.csv", f'id,t\n1,"{long}"\n2,short\n3,"{long}"'.encode())
    got = {r["id"]: r["t"] for r in csvio.read_csv_tolerant(spark, path).collect()}
    assert got == {"1": long, "2": "short", "3": long}


def test_one_file_is_read_by_as_many_tasks_as_ranges_without_a_shuffle(spark, tmp_path, small_ranges):
    rows = "".join(f'{i},"text, {i}",x\n' for i in range(400))
    path = _write(tmp_path, "t.csv", ("a,b,c\n" + rows).encode())
    df = csvio.read_csv_tolerant(spark, path)
    ranges = spark.read.text(path).rdd.getNumPartitions()
    assert ranges > 20 and df.rdd.getNumPartitions() == ranges
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted((int(r["a"]), r["b"]) for r in df.collect()) == [(i, f"text, {i}") for i in range(400)]


def test_encoding_is_one_for_a_file(spark, tmp_path):
    """A latin-1 file with a field whose bytes happen to be UTF-8, and a UTF-8 file, in one folder."""
    (tmp_path / "l.csv").write_bytes("k,v\n1,Ã©\n2,Málaga\n".encode("latin-1"))
    (tmp_path / "u.csv").write_bytes("k,v\n3,é\n4,\ufffd\n".encode())
    got = {r["k"]: r["v"] for r in csvio.read_csv_tolerant(spark, str(tmp_path)).collect()}
    assert got == {"1": "Ã©", "2": "Málaga", "3": "é", "4": "\ufffd"}


def test_headers_of_a_folder_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"id,name\n1,a\n")
    (tmp_path / "b.csv").write_bytes(b"name,id\nb,2\n")
    with pytest.raises(Exception, match="different headers"):
        csvio.read_csv_tolerant(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_bytes(b"\n\nid,name\n2,b\nid,name\n")
    assert sorted(map(tuple, csvio.read_csv_tolerant(spark, str(tmp_path)).collect())) == [("1", "a"), ("2", "b"), ("id", "name")]


def test_empty_and_header_only_files(spark, tmp_path):
    path = _write(tmp_path, "h.csv", b"a,b\n")
    df = csvio.read_csv_tolerant(spark, path)
    assert df.columns == ["a", "b"] and df.count() == 0
    with pytest.raises(ValueError, match="no header"):
        csvio.read_csv_tolerant(spark, _write(tmp_path, "e.csv", b""))
