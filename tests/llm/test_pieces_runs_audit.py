"""Piece encoding, periodic runs and the filter audit against the library, brute force and SQL."""

import hashlib
import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF_SMALL, make_docs, odd_texts  # noqa: F401

from tallyline.llm import audit, periodic, queries, sentencepieces

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# pieces ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return sentencepieces.Encoder(PIECES)


def ids_of(encoder, text):
    return [i for ids, _ in encoder.encode([text]) for i in ids.tolist()]


def test_pieces_equal_the_librarys_on_random_texts(encoder):
    rng = random.Random(5)
    pieces = [p.replace("▁", " ") for p in encoder.pieces]
    texts = []
    for _ in range(3000):
        chars = "".join(rng.choice("ab e▁ \n\tthinéç漢🙂<>0x_\x00") for _ in range(rng.randrange(40)))
        mixed = "".join(rng.choice(pieces) for _ in range(rng.randrange(10)))
        texts += [chars, mixed]
    got = [np.split(ids, np.cumsum(size)[:-1]) for ids, size in encoder.encode(texts)]
    assert [x.tolist() for part in got for x in part] == [encoder.library.encode(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab" * 3000, "=-" * 2000 + "=" * 77, "<s></s><0x0A>", "é​﻿�"])
def test_pieces_of_long_runs_and_marks(encoder, text):
    assert ids_of(encoder, text) == encoder.library.encode(text)


def test_neighbours_are_told_as_by_plain_merging(encoder):
    rng = random.Random(9)
    pieces = sorted(encoder.first)
    for left, right in [(rng.choice(pieces), rng.choice(pieces)) for _ in range(20000)] + [("aa", "a"), ("a", "aa"), ("▁▁", "▁")]:
        if left in encoder.first and right in encoder.first:
            assert encoder.together(left, right) == (encoder.merged(left + right)[0] == [left, right])


def test_memories_are_emptied_without_a_difference(monkeypatch):
    monkeypatch.setattr(sentencepieces, "CACHED_WORDS", 5)
    monkeypatch.setattr(sentencepieces, "CACHED_PAIRS", 5)
    monkeypatch.setattr(sentencepieces, "SLICE_BYTES", 64)
    model = sentencepieces.Encoder(PIECES)
    texts = [f"Some words, {i} of them: quite different ones {i * i}.\nAnd a line" for i in range(60)]
    got = [x for ids, size in model.encode(texts) for x in np.split(ids, np.cumsum(size)[:-1])]
    assert [x.tolist() for x in got] == [model.library.encode(t) for t in texts]


def test_dead_ends_are_left_again(encoder):
    """Longest matches alone would differ: some text needs a shorter piece."""
    text = next(p + q for p in sorted(encoder.shorter) for q in "abcdefgh" if len(p) > 3 and encoder.merged(p + q)[0][0] not in (p, p + q))
    assert encoder.split(text) == encoder.merged(text)[0]


def test_piece_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    library = sentencepieces.library(PIECES)
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_sentencepiece_backtracking"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "")
        r = got[doc_id]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(library.decode(ids))


def test_pieces_of_odd_rows(make_docs, odd_texts):  # noqa: F811
    docs = make_docs([*odd_texts, (None, "no id"), (0, "again"), (0, "again")])
    tokens = sentencepieces.encode(docs, PIECES)
    assert tokens.columns == ["doc_id", "ids"]
    back = sentencepieces.decode(tokens, PIECES).collect()
    assert sorted(r["text"] for r in back) == sorted([t or "" for t in odd_texts] + ["no id", "again", "again"])
    assert sentencepieces.decode(sentencepieces.encode(docs.limit(0), PIECES), PIECES).count() == 0


# runs -----------------------------------------------------------------------------------------


def brute_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            a = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            s = a - q
            if i > a and i - s >= max(least, times * q) and not any(w[s + p : i] == w[s : i - p] for p in range(1, q)):
                out.append((s, i - s, q))
            i += i == a
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    w = []
    while len(w) < rng.randrange(80):
        unit = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 12))]
        w += unit if rng.random() < 0.5 else (unit * 10)[: len(unit) * rng.randrange(2, 7) + rng.randrange(4)]
    return w


@pytest.mark.parametrize(("least", "times"), [(6, 4), (3, 3), (10, 5)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(600):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        assert periodic.runs_of(texts, least, times) == [brute_runs(w, least, times) for w in texts]


def test_runs_of_one_word_and_of_none_take_linear_steps():
    n = 200_000
    assert periodic.runs_of([[b"x"] * n], 6, 4) == [[(0, n, 1)]]
    assert periodic.runs_of([[b"%d" % (i % 49_999) for i in range(n)]], 6, 4) == [[(0, n, 49_999)]]
    thue_morse = [b"ab"[i.bit_count() % 2 :][:1] for i in range(n)]
    assert periodic.runs_of([thue_morse], 6, 4) == [[]]
    found = sum(len(a) for a, _ in periodic.earlier(np.zeros(n, np.int64), n // 4))
    assert found < n  # one diagonal, of lag 1


def planted(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def test_run_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    seen = 0
    for doc_id, text in docs:
        w = planted(doc_id, text)
        runs = brute_runs(w) if len(w) < 3000 else periodic.runs_of([w], 6, 4)[0]
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
        assert r["collapsed_sha256"] == sha(b" ".join(kept).decode())
        seen += bool(runs)
    assert seen > 10


def test_runs_of_odd_rows(make_docs, odd_texts):  # noqa: F811
    docs = make_docs([*odd_texts, (None, "a b " * 6), (0, "x " * 6), (0, "x " * 6), (77, "q " * 5)])
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(docs).collect()]
    assert got.count((0, [(0, 6, 1)], "x")) == 2 and (None, [(0, 12, 2)], "a b") in got and (77, [], "q q q q q") in got
    assert (6, [(0, 30000, 1)], "long") in got and (0, [], "") in got and (1, [], "") in got and (2, [], "") in got
    assert periodic.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="three"):
        periodic.find(docs, times=2)


# audit ----------------------------------------------------------------------------------------


def test_positional_popcount_equals_plain_sums():
    rng = np.random.default_rng(2)
    for n, groups in [(0, 1), (1, 1), (7, 3), (5000, 1), (5000, 40), (300, 300)]:
        words = rng.integers(0, 2**32, n, np.uint64).astype(np.uint32)
        times, group = rng.integers(1, 1000, n), rng.integers(0, groups, n)
        times[: n // 50] = 2**40 + 1
        want = np.zeros((groups, 32), np.int64)
        for w, t, g in zip(words.tolist(), times.tolist(), group.tolist(), strict=True):
            want[g] += [t * (w >> b & 1) for b in range(32)]
        assert (audit.positional_popcount(words, times, group, groups) == want).all()


def plain_audit(docs, labels):
    """``docs``: (doc_id, text, source); ``labels``: doc_id -> (good, toxic)."""
    first = {}
    for k, t, _ in docs:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)
    rows = []
    for k, t, source in docs:
        t = t or ""
        w = t.encode().split()
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": k is not None and k > first[t],
        }
        rows.append((source or "", {f for f, x in fails.items() if x}, *labels.get(k, (False, False))))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if f in r[1]]
                alive = [r for r in alive if f not in r[1]]
                total[f] += len(gone)
                failing = [r for r in own if f in r[1]]
                out[part, "".join(order), step] = [
                    len(alive), len(gone), len(failing) - len(gone), sum(len(r[1]) == 1 for r in failing),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for key in [k for k in out if k[0] == part]:
            out[key].append(total[key[1][key[2] - 1]])
    return out


def test_audit_of_odd_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(300))
    docs = [
        (1, None, "s"), (2, "", "s"), (3, "SHOUT # here", None), (4, long_text, ""), (5, long_text, "s"), (5, long_text, "s"),
        (None, long_text, "s"), (6, "word " * 30000, "t"), (7, "a a a a #", "t"), (4, long_text, ""), (8, "É" * 40 + "A", "t"),
    ]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, n int, part string")
    labels = [(1, 1, 0), (3, 0, 1), (4, 1, 1), (5, None, 1), (5, 1, None), (9, 1, 1), (None, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.interactions(audit.judge(frame, told)).collect()
    want = plain_audit(docs, {1: (True, False), 3: (False, True), 4: (True, True), 5: (True, True)})
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == want and len(got) == len(want) == 3 * 600
    assert audit.interactions(audit.judge(frame.limit(0), told)).count() == 0
    assert audit.interactions(audit.judge(frame, told.limit(0))).count() == 1800


def test_audit_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rows = queries.QUERIES["op13_filter_interactions"](spark, SF_SMALL)
    want = con.execute(queries.ORACLES["op13_filter_interactions"]).fetchdf()[rows.columns]
    assert sorted(map(tuple, rows.collect())) == sorted(tuple(x) for x in want.itertuples(index=False))
