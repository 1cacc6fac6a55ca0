"""Properties on random frames: hierarchical predictions equal a pandas brute force,
every input row gets exactly one prediction, and level usage sums to the row count."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyline.operators.hierarchy import HierarchicalMedian, level_usage

LEVELS = [["k1", "k2"], ["k1"], ["k2"]]
key1 = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
key2 = st.one_of(st.none(), st.integers(0, 3))
value = st.one_of(st.none(), st.integers(-5, 40).map(float), st.floats(0, 100, allow_nan=False).map(lambda x: round(x, 2)))
rows = st.lists(st.tuples(key1, key2, value), min_size=1, max_size=40)
probes = st.lists(st.tuples(key1, key2), min_size=1, max_size=15)


def brute(train: list, probe: tuple) -> tuple[float, int]:
    df = pd.DataFrame(train, columns=["k1", "k2", "t"]).dropna(subset=["t"])
    for i, lv in enumerate(LEVELS):
        key = tuple(probe[0 if c == "k1" else 1] for c in lv)
        if any(k is None for k in key):
            continue
        sub = df.dropna(subset=lv)
        for c, k in zip(lv, key):
            sub = sub[sub[c] == k]
        if len(sub):
            return float(sub["t"].median()), i
    return (float(df["t"].median()) if len(df) else 0.0), -1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(train=rows, probe=probes)
def test_hierarchy_equals_brute_force(spark, train, probe):
    tdf = spark.createDataFrame(train, "k1 string, k2 int, t double")
    pdf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(probe)], "id int, k1 string, k2 int")
    model = HierarchicalMedian(LEVELS, "t").fit(tdf)
    out = model.predict(pdf)
    got = {r["id"]: (r["prediction"], r["level"]) for r in out.collect()}
    assert len(got) == len(probe)
    for i, p in enumerate(probe):
        want = brute(train, p)
        assert got[i][1] == want[1]
        assert abs(got[i][0] - want[0]) < 1e-9
    assert sum(r["rows"] for r in level_usage(out).collect()) == len(probe)
