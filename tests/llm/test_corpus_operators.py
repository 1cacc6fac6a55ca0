"""Operators over the whole corpus against plain Python, on the small tables and on odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF_SMALL, make_docs, odd_texts  # noqa: F401
from pyspark.sql import functions as F

from tallyline.llm import common, exchange, jaccard, lm, substring
from tallyline.llm.components import connected_components
from tallyline.llm.queries import QUERIES


def query(spark, prefix):
    name = next(n for n in QUERIES if n.startswith(prefix))
    return QUERIES[name](spark, SF_SMALL).toPandas().set_index("doc_id")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").toPandas()


def words(t, lower=True):
    b = (t or "").encode()
    return (b.lower() if lower else b).split()


# helpers --------------------------------------------------------------------------------------


def test_components_of_paths_stars_and_ties(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (301, 300), (301, 300), (5, 2)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_random_components(spark):
    rng = np.random.default_rng(0)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 200, (150, 2))]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in got} and {x for a, b in edges if a != b for x in (a, b)} == set(got)


def test_totals_come_back_in_order(spark):
    rng = np.random.default_rng(1)
    held = {b: np.unique(rng.integers(0, 2**64, 50, np.uint64) // np.uint64(2**58) * np.uint64(2**58)) for b in range(4)}
    rows = [r for b, k in held.items() for r in exchange.request_rows(b, 3, k, [np.full(len(k), b + 1)], 5)]
    asked = spark.createDataFrame(exchange.table_of(iter(rows)).to_pandas(), exchange._REQUEST)
    got = exchange.totals(asked, 1).toArrow()
    want = Counter()
    for b, keys in held.items():
        want.update({int(x): b + 1 for x in keys})
    for b, keys in held.items():
        own = got.filter([x == b for x in got.column("block").to_pylist()])
        assert exchange.replies_of(own, 3, 1)[0].tolist() == [want[int(x)] for x in keys]


def test_totals_over_32_bits_come_back_exact(spark):
    keys = np.array([1, 2**40, 2**63 + 5], np.uint64)
    counts = [np.array([3_000_000_001, 7, 2**32 - 1]), np.array([1, 2**32 - 1, 0])]
    rows = [r for b in range(3) for r in exchange.request_rows(b, 3, keys, counts, 2)]
    asked = spark.createDataFrame(exchange.table_of(iter(rows)).to_pandas(), exchange._REQUEST)
    got = exchange.totals(asked, 2).toArrow()
    assert sum(got.column("total").to_pylist()) == 3 * int(counts[0].sum())
    for b in range(3):
        own = got.filter([x == b for x in got.column("block").to_pylist()])
        assert [x.tolist() for x in exchange.replies_of(own, 3, 2)] == [(3 * c).tolist() for c in counts]


# language model ---------------------------------------------------------------------------------


def brute_base(texts, train):
    c = Counter()
    for t, own in zip(texts, train, strict=True):
        if own:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for t in texts:
        w = [*words(t), None]
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


def test_lm_base_matches_brute_force_and_the_model_is_better(spark, documents):
    got = query(spark, "op1_")
    train = [zlib.crc32(str(k).encode()) % 7 != 2 for k in documents.doc_id]
    for k, own, want in zip(documents.doc_id, train, brute_base(documents.text, train), strict=True):
        r = got.loc[k]
        assert r.held_out == (not own) and (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3])
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_lm_probabilities_sum_to_one(spark, make_docs):
    """Over all first words: those of the training texts, the end, and an unseen one."""
    train = ["a b a b c", "a c", "b", None] * 10
    vocab = ["a", "b", "c", "unseen"]
    n = len(train)
    # P(w) P(end | w) for a word w, P(end) for the empty text, and P(w) P(w | w) P(end | w)
    docs = make_docs(train + vocab + [""] + [f"{w} {w}" for w in vocab])
    got = 10 ** lm.score(docs, F.col("doc_id") < n).toPandas().set_index("doc_id").score
    assert got.between(0, 1).all()
    assert got.loc[n : n + 4].sum() < 1 and got.loc[n] > got.loc[n + 5]


def test_lm_weights_by_expectation_maximisation():
    # bucket 3: bigrams twice as likely on 3 of 4 tokens and impossible on the rest
    cell = lambda b, r: b * 4 * lm._LIMIT + r + lm._LIMIT
    w = lm.learn_weights([(cell(3, lm.FINE), 300), (cell(3, -lm._LIMIT), 100), (cell(5, 4 * lm.FINE), 10)], 2000)
    r = 2 ** ((lm.FINE + 0.5) / lm.FINE)
    assert w[3] == pytest.approx(max(0.75 - 0.25 / (r - 1), 1e-6), abs=1e-3) and w[5] > 0.99 and w[0] == 0


def test_lm_odd_rows(spark, make_docs, odd_texts):
    docs = make_docs([*enumerate(odd_texts), (1, "again"), (None, "no id")])
    got = lm.score(docs, F.col("doc_id") >= 0).toPandas()
    want = brute_base([*odd_texts, "again", "no id"], [True] * (len(odd_texts) + 1) + [False])
    key = lambda x: (x[0], x[1], x[2], round(x[3], 6))
    assert sorted(map(key, got[["n_tokens", "n_known", "train_tokens", "base_score"]].values.tolist())) == sorted(map(key, want))
    nothing = lm.score(make_docs(["a", None]), F.lit(None).cast("boolean")).toPandas()
    assert nothing.train_tokens.tolist() == [0, 0] and np.isfinite(nothing.score).all()
    assert lm.score(make_docs([]), F.lit(True)).count() == 0


# near duplicates --------------------------------------------------------------------------------


def brute_classes(rows, size, percent):
    """Rows of one id are one vertex, with the links of all its texts."""
    sets = []
    for k, t in rows:
        w = words(t)
        sets.append((k, frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    parent = {k: k for k, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            at.setdefault(g, []).append(i)
    both = Counter((a, b) for own in at.values() for i, a in enumerate(own) for b in own[i + 1 :])
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = root(sets[a][0]), root(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {k: (max(len(s) for i, s in sets if i == k), root(k)) for k in parent} if len(sets) < 500 else {k: (len(s), root(k)) for k, s in sets}


def found_classes(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_jaccard_matches_brute_force(spark, documents):
    got = query(spark, "op3_")
    want = brute_classes(zip(documents.doc_id, documents.text, strict=True), 4, 85)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.iterrows()} == want


def edited(rng, base, k, vocab):
    """``k`` variants of a text around the threshold, sharing a passage with others."""
    out = []
    for _ in range(k):
        w = list(base)
        for _ in range(int(rng.integers(0, 6))):
            w[int(rng.integers(0, len(w)))] = str(rng.choice(vocab))
        out.append(" ".join(w))
    return out


def test_jaccard_groups_of_edited_copies(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 16)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 800)
    monkeypatch.setattr(jaccard, "FINER", ((64, 128), (128, 256)))
    rng = np.random.default_rng(2)
    vocab = [f"w{i}" for i in range(400)]
    common_part = rng.choice(vocab, 30).tolist()
    texts = []
    for n in (40, 60, 90, 200):
        texts += edited(rng, rng.choice(vocab, n).tolist() + common_part, 45, vocab)
    texts += [" ".join(rng.choice(vocab, 30).tolist() + common_part) for _ in range(60)] + texts[:30]
    rng.shuffle(texts)
    want = brute_classes(enumerate(texts), 5, 80)
    assert 5 < len({c for _, c in want.values()}) < 200
    assert found_classes(jaccard.join(make_docs(texts))) == want


def test_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    n = rng.integers(5, 60, 300)
    points = np.stack([np.bincount(rng.integers(0, 4, k), minlength=8) for k in n])
    got = {(min(x, y), max(x, y)) for i, j in jaccard.Tree(points, n).pairs(85) for x, y in zip(i.tolist(), j.tolist(), strict=True)}
    want = {
        (x, y) for x in range(300) for y in range(x + 1, 300)
        if 100 * min(n[x], n[y]) >= 85 * max(n[x], n[y]) and np.minimum(points[x], points[y]).sum() >= jaccard.needed(n[x], n[y], 85)
    }
    assert got == want


def test_jaccard_odd_rows(spark, make_docs, odd_texts):
    rows = [*enumerate(odd_texts), (7, "same text here now"), (3, "another short"), (None, "same text here now"), (50, "Another short")]
    want = brute_classes([r for r in rows if r[0] is not None], 4, 85)
    assert found_classes(jaccard.join(make_docs(rows), 4, 85)) == want
    assert jaccard.join(make_docs([])).count() == 0


def test_jaccard_links_all_texts_of_an_id(spark, make_docs):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, a), (1, b), (2, b), (3, a), (9, "alone and apart from them all"), (1, ""), (2, None)]
    assert found_classes(jaccard.join(make_docs(rows))) == {1: (3, 1), 2: (2, 1), 3: (3, 1), 9: (2, 9)}
    rng = np.random.default_rng(7)
    vocab = [f"v{i}" for i in range(40)]
    bases = [list(rng.choice(vocab, 30)) for _ in range(25)]
    texts = [t for base in bases for t in edited(rng, base, 4, vocab)]
    rows = [(int(rng.integers(0, 70)), t) for t in texts for _ in range(int(rng.integers(1, 3)))]
    assert found_classes(jaccard.join(make_docs(rows))) == brute_classes(rows, 5, 80)


# repeated passages ------------------------------------------------------------------------------


def brute_removed(texts, size):
    split = [words(t, False) for t in texts]
    c = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [0] * len(w)
        for i in range(len(w) - size + 1):
            if c[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [1] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def removed(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_substrings_match_brute_force(spark, documents):
    got = query(spark, "op9_")
    for k, want in zip(documents.doc_id, brute_removed(documents.text, 35), strict=True):
        assert tuple(got.loc[k]) == want


@pytest.mark.parametrize("letters", [2, 3, 40])
def test_substrings_of_periodic_and_random_words(spark, make_docs, monkeypatch, letters):
    monkeypatch.setattr(exchange, "SHARD_KEYS", 20)
    rng = np.random.default_rng(letters)
    vocab = [chr(97 + i % 26) * (1 + i // 26) for i in range(letters)]
    texts = []
    for _ in range(40):
        w = rng.choice(vocab, int(rng.integers(1, 120))).tolist()
        if rng.random() < 0.5:
            w += ["a"] * int(rng.integers(1, 50))
        if rng.random() < 0.5:
            w += ["a", "b"] * int(rng.integers(1, 30))
        if texts and rng.random() < 0.5:
            old = texts[int(rng.integers(0, len(texts)))].split()
            at = int(rng.integers(0, len(old)))
            w = w[:20] + old[at : at + 50] + w[20:]
        texts.append(" ".join(w))
    for size in (10, 35):
        got = removed(substring.repeated(make_docs(texts).repartition(3), size))
        assert got == dict(enumerate(brute_removed(texts, size)))


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(6)
    hashes = common.WordHashes()
    passage = rng.integers(0, 9, 35)
    seen = set()
    for _ in range(50):
        left, right = rng.integers(0, 9, int(rng.integers(0, 30))), rng.integers(0, 9, int(rng.integers(0, 30)))
        h = hashes.of([b"%d" % x for x in np.concatenate([left, passage, right])])
        parse = substring.Parse(h, np.array([len(h)]))
        at = parse.anchors(np.array([len(left)]), 35, len(h))[0]
        seen.add(None if at < 0 else int(parse.name[at]))
    assert len(seen) == 1


def test_substrings_odd_rows(spark, make_docs, odd_texts):
    got = removed(substring.repeated(make_docs(odd_texts), 3))
    assert got == dict(enumerate(brute_removed(odd_texts, 3)))
    twice = substring.repeated(make_docs([(1, "a b c d"), (1, "a b c d"), (None, "x a b c")]), 3).toPandas()
    assert sorted(twice.kept) == ["", "", "x"]
    assert substring.repeated(make_docs([]), 3).count() == 0
