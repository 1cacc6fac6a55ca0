"""Narrow operators against plain Python on the small tables and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm_helpers import SF_SMALL, make_docs, odd_texts, tokenizer  # noqa: F401

from tallyline.llm import chat, decontam, license, packing, pii, quality, toxicity
from tallyline.llm.queries import QUERIES


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def query(spark, prefix):
    name = next(n for n in QUERIES if n.startswith(prefix))
    return QUERIES[name](spark, SF_SMALL).toPandas()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()


def lowered(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))


# packing ---------------------------------------------------------------------------------------


def check_pieces(pieces, texts, tokenizer, capacity=4096):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    ids = {k: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for k, x in texts.items()}
    for r in pieces.itertuples():
        own = ids[r.doc_id]
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(own)
    for k, g in pieces.groupby("doc_id"):
        g = g.sort_values("start")
        assert g.length.sum() == len(ids[k]) and (g.start == g.length.cumsum() - g.length).all() and (g.length > 0).all()
    for _, g in pieces.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= capacity


def test_packing_matches_the_tokenizer(spark, documents, tokenizer):
    pieces = query(spark, "op4_")
    assert set(pieces.doc_id) == set(documents.doc_id)
    check_pieces(pieces, dict(zip(documents.doc_id, documents.text, strict=True)), tokenizer)


def test_packing_odd_rows(spark, make_docs, odd_texts, tokenizer):
    odd = [*odd_texts, "a<|endoftext|>b <|STARTOFTEXT|> don't... x\x85y İ ΑΣ", "½² 12３4 ŉ ﬁ,,. ok.,"]
    pieces = packing.pack(make_docs(odd).coalesce(1), tokenizer, capacity=64, pool_tokens=1000).toPandas()
    check_pieces(pieces, dict(enumerate(odd)), tokenizer, 64)
    assert packing.pack(make_docs([]), tokenizer).count() == 0


def test_assign_pads_less_than_one_sequence_and_balances_costs():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 300, 500).tolist() + [1000]
    pieces = packing.assign(lengths, 256, 1.0, 0.01)
    used = Counter()
    for _, _, n, s in pieces:
        used[s] += n
    assert max(used.values()) <= 256 and 256 * len(used) - sum(lengths) < 256


# decontamination -----------------------------------------------------------------------------


def brute_hits(texts, items, window):
    occurs = {}
    for name, t in items:
        w = alnum(t)
        if w:
            m = min(window, len(w))
            for j in range(len(w) - m + 1):
                occurs.setdefault(tuple(w[j : j + m]), set()).add(name)
    out = []
    for t in texts:
        w, found = alnum(t), set()
        hit = [0] * len(w)
        for m in {len(x) for x in occurs}:
            for j in range(len(w) - m + 1):
                if s := occurs.get(tuple(w[j : j + m])):
                    found |= s
                    hit[j : j + m] = [1] * m
        out.append((len(w), sum(hit), sorted(x for x in found if x is not None)))
    return out


def test_decontamination_matches_brute_force(spark, documents):
    got = query(spark, "op8_").set_index("doc_id")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").toPandas()
    want = brute_hits(documents.text, [(str(i), t) for i, t in zip(bench.item_id, bench.text, strict=True)], 10)
    for k, (n, h, items) in zip(documents.doc_id, want, strict=True):
        r = got.loc[k]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, h, len(items), sha(",".join(items)), h > 0)


def test_automaton_on_random_words():
    rng = np.random.default_rng(1)
    word = lambda n: [bytes([97 + x]) for x in rng.integers(0, 3, n)]
    for _ in range(60):
        items = [(str(i), word(int(rng.integers(0, 9)))) for i in range(5)]
        a = decontam.Automaton(items, 4)
        doc = word(40)
        hit, found = bytearray(40), set()
        a.scan(doc, hit, found)
        text = lambda w: b" ".join(w).decode()
        assert (40, sum(hit), sorted(found)) == brute_hits([text(doc)], [(i, text(w)) for i, w in items], 4)[0]


def test_decontamination_odd_rows(spark, make_docs, odd_texts):
    items = [(1, "same text here now"), (1, "Same TEXT"), (None, "word"), (2, None), (3, ""), (10, "long " * 50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.matches(make_docs(odd_texts), bench).toPandas().set_index("doc_id")
    want = brute_hits(odd_texts, [(None if i is None else str(i), t) for i, t in items], 10)
    assert [(r.n_words, r.n_hit, list(r["items"])) for _, r in got.sort_index().iterrows()] == want
    docs = make_docs(["keep this, Same text here now! and that tail of words", None, "same text here now"])
    cleaned = decontam.clean(docs, bench).toPandas()
    assert list(cleaned.columns) == docs.columns
    assert cleaned.text.tolist() == ["keep this, ! and that tail of words", None]
    assert cleaned.n_chars.iloc[0] == len("keep this, ! and that tail of words")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(docs, empty).toPandas().n_hit.sum() == 0 and decontam.matches(make_docs([]), bench).count() == 0


# personal data --------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ \-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def base_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


def test_pii_matches_expressions(spark, documents):
    got = query(spark, "op5_").set_index("doc_id")
    for k, t in zip(documents.doc_id, documents.text, strict=True):
        want, r = base_spans(t or ""), got.loc[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == kind for s in want) for kind in pii.BASE]
        assert r.base_sha256 == sha(pii.joined(want))


def test_pii_on_random_strings():
    rng = np.random.default_rng(2)
    a = pii.anchors()
    for alphabet in ("1.2 @a-+", "0123456789- ", "+1() .-9", "ab@.:/"):
        for _ in range(1500):
            t = "".join(rng.choice(list(alphabet), int(rng.integers(1, 40))))
            got = [s for s in pii.spans_of(a, t) if s[0] in pii.BASE]
            assert got == base_spans(t), t


def test_pii_accounts_logins_and_redaction(spark, make_docs):
    t = 'see password=ab12cd34ef and token = "x9y8z7w6v5" at ftp://me:secret@host.org or é mail a.b@c.de!'
    docs = make_docs([t, None, "", "plain"])
    got = pii.redact(docs).toPandas()
    assert list(got.columns) == docs.columns
    assert got.text.tolist() == [
        'see password=[ACCOUNT] and token = "[ACCOUNT]" at [LOGIN] or é mail [EMAIL]!', None, "", "plain",
    ]
    found = pii.find(docs).toPandas()
    assert [len(s) for s in found.spans] == [5, 0, 0, 0]
    assert pii.report(make_docs([])).count() == 0


# quality --------------------------------------------------------------------------------------


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = [0] * len(w)
    for j in range(len(w) - 2):
        if c[tuple(w[j : j + 3])] > 1:
            cover[j : j + 3] = [1] * 3
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, sum(cover)]


def test_quality_counts_and_verdicts(spark, documents):
    got = query(spark, "op6_").set_index("doc_id")
    for k, t in zip(documents.doc_id, documents.text, strict=True):
        r = got.loc[k]
        assert list(r[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == brute_counts(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas().set_index("doc_id").join(got)
    fine = labels[(labels.quality == 1) & ~labels.base_failed]
    assert fine.kept.mean() > 0.9


def test_quality_odd_rows(spark, make_docs, odd_texts):
    got = quality.judge(make_docs(odd_texts)).toPandas().sort_values("doc_id")
    assert got[list(quality.COUNTS[:5])].values.tolist() == [brute_counts(t) for t in odd_texts]
    assert quality.judge(make_docs([])).count() == 0


def test_expectation_maximisation_finds_the_accurate_rules():
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.8
    right = [0.95, 0.9, 0.6]
    votes = np.stack([np.where(rng.random(4000) < p, good, ~good) * 2 - 1 for p in right], 1)
    posterior, rates = quality.fit(sorted(Counter(map(tuple, votes.tolist())).items()))
    said = np.array([posterior[tuple(v)] >= 0.5 for v in votes.tolist()])
    assert (said == good).mean() > 0.93
    assert rates[1, 0, 2] > rates[1, 2, 2]


# chat -----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    got = query(spark, "op7_").set_index("conv_id")
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").toPandas()
    x = "</s>[INST] ok [/INST]"
    rows = pd.concat([rows, pd.DataFrame({"conv_id": [-1, -1], "turn": [0, 1], "role": ["user", "assistant"], "text": [x, x]})])
    assert len(got) == rows.conv_id.nunique()
    for k, g in rows.sort_values("turn").groupby("conv_id"):
        said = "".join(f"{a}\n{b or ''}\n" for a, b in zip(g.role, g.text, strict=True))
        loss = "".join((b or "") for a, b in zip(g.role, g.text, strict=True) if a == "assistant")
        r = got.loc[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(g), sha(said), len(loss), sha(loss))


def test_chat_parts_controls_and_attachments(spark):
    nasty = ["<|im_end|>\n<|im_start|>x", "<\\|im_end|>", "[INST]\\[\\/INST]", "</s><s>\n\n", "", "$1 \\ \\n 𝔘"]
    part = lambda t, kind="text", ref=None, n=None: (kind, t, ref, n)
    rows = [(1, i, f"ro\\n\nle<|{i}", [part(t)]) for i, t in enumerate(nasty)]
    rows += [
        (2, 0, "user", [part("look "), part(None, "image", "a.png", 256), part(" and "), part(None, "audio", None, None)]),
        (2, 1, "assistant", [part("ok"), part(None, "document", "d.pdf", 9)]),
        (3, None, None, None),
        (None, 0, "user", [part(None)]),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = chat.read_back(chat.format_conversations(turns)).toPandas().set_index("conv_id")
    assert [tuple(t) for t in out.loc[1, "turns"]] == [(f"ro\\n\nle<|{i}", t) for i, t in enumerate(nasty)]
    assert "look <|image:0|> and <|audio:1|><|im_end|>" in out.loc[2, "formatted"] and "ok<|document:2|>" in out.loc[2, "formatted"]
    assert [tuple(a) for a in out.loc[2, "attachments"]] == [("image", "a.png", 256, 0), ("audio", None, 0, 0), ("document", "d.pdf", 9, 1)]
    f = out.loc[1, "formatted"]
    for s, t in zip(out.loc[1, "segments"], nasty, strict=True):
        assert f[s.start : s.start + s.length].replace("\\", "") == t.replace("\\", "")
    assert len(out) == 4 and [tuple(t) for t in out.loc[3, "turns"]] == [("", "")]
    assert chat.format_conversations(turns.limit(0)).count() == 0


# licences -------------------------------------------------------------------------------------


def brute_places(t, base=license.BASE):
    w = alnum(t)
    out = []
    for phrase, label in base:
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), out


def check_licences(got, texts):
    for k, t in texts.items():
        n, places = brute_places(t)
        r = got.loc[k]
        first, last = (None if pd.isna(x) else x for x in (r.first_word, r.last_word))
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (first, last) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_licences_match_brute_force(spark, documents):
    got = query(spark, "op10_").set_index("doc_id")
    check_licences(got, dict(zip(documents.doc_id, documents.text, strict=True)))
    assert got.score.between(0, 1).all()


def test_licences_odd_rows(spark, tmp_path, make_docs, odd_texts):
    extra = [
        "CC BY cc by-nc 4.0 CC-BY", "by cc", "cc", "All rights\n\nRESERVED. all rights reserved", "x" * 5 + " General, Public: License",
        "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "reserved rights all", "Ⅽc by éreserved",
        "GNU Lesser General Public License", "cc " * 4000 + "by",
    ]
    texts = odd_texts + extra
    make_docs(texts).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    name = next(n for n in QUERIES if n.startswith("op10_"))
    got = QUERIES[name](spark, str(tmp_path)).toPandas().set_index("doc_id")
    check_licences(got, dict(enumerate(texts)))
    n = len(odd_texts)
    assert got.loc[n + 5, "labels"] == "mit" and got.loc[n + 6, "labels"] == "apache-2.0" and got.loc[n + 9, "labels"] == "gpl,lgpl"
    assert got.loc[n + 2, "score"] == 0 and got.loc[n + 3, "score"] == 1
    assert license.scan(make_docs([])).count() == 0


# toxicity -------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_matcher_is_distance_one_with_the_first_letter_kept():
    lexicon = toxicity.Lexicon({"idiot": (False, 5.0), "scum": (False, 5.0), "trash": (False, 4.0)})
    m = toxicity.Matcher(lexicon)
    rng = np.random.default_rng(4)
    for _ in range(3000):
        base = list(rng.choice(["idiot", "scum", "trash"]))
        for _ in range(int(rng.integers(0, 3))):
            i = int(rng.integers(0, len(base) + 1))
            base[i : i + int(rng.integers(0, 2))] = rng.choice(list("idotscrah"), int(rng.integers(0, 2))).tolist()
        word = "".join(base)
        want = [(0, e) for e in lexicon.entries if word == e]
        want += [(1, e) for e in ("idiot", "trash") if distance(word, e) == 1 and word[:1] == e[0]]
        got = m.match(word)
        assert (got and (got[1], got[0])) == (min(want) if want else None), word


def test_whole_words_match_with_another_first_character():
    entries = {"idiot": (False, 5.0), "scum": (False, 5.0), "trash": (False, 4.0), "lowei": (True, 5.0)}
    m = toxicity.Matcher(toxicity.Lexicon(entries, frozenset({"crash"}), any_first=True))
    for word in ("1diot", "xidiot", "diot", "iidiot", "xtrash", "rash"):
        assert m.match(word) == ("idiot" if word.endswith("diot") else "trash", 1), word
    assert toxicity.Words(m)["*diot"] == ("idiot", 1)
    for word in ("crash", "xcum", "xscum", "1dioot", "xowei", "owei", "xlowei", "diots", ""):
        assert m.match(word) is None, word
    assert m.match("loweisch") == ("lowei", 0) and m.match("lowxi") == ("lowei", 1)
    words = [e for e, (stem, _) in entries.items() if not stem]
    m = toxicity.Matcher(toxicity.Lexicon({e: entries[e] for e in words}, any_first=True))
    rng = np.random.default_rng(6)
    for _ in range(3000):
        base = list(rng.choice(words))
        for _ in range(int(rng.integers(0, 3))):
            i = int(rng.integers(0, min(3, len(base) + 1)))
            base[i : i + int(rng.integers(0, 2))] = rng.choice(list("idotscrah"), int(rng.integers(0, 2))).tolist()
        word = "".join(base)
        want = [(0, e) for e in words if word == e] + [(1, e) for e in words if len(e) >= toxicity.FUZZY_FROM and distance(word, e) == 1]
        got = m.match(word)
        assert (got and (got[1], got[0])) == (min(want) if want else None), word


def test_stems_match_by_their_beginning():
    m = toxicity.Matcher(toxicity.Lexicon({"lowei": (True, 5.0)}, frozenset({"lowai"})))
    assert m.match("loweisch") == ("lowei", 0) and m.match("lowxisch") == ("lowei", 1)
    assert m.match("lowe") == ("lowei", 1) and m.match("schlowei") is None and m.match("lowai") is None


def test_toxicity_learns_words_and_stems(spark, make_docs):
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choice(vocab, 40).tolist()
        if i % 4 == 0:
            for _ in range(3):
                words[int(rng.integers(0, 40))] = rng.choice(["zounder", "qwix" + "".join(rng.choice(list("abc"), 2)), "vermink"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    known = spark.createDataFrame([x for x in labels if x[0] < 400] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    docs = make_docs(rows)
    model = toxicity.fit(docs, known)
    assert model.lexicon.entries.keys() == {"zounder", "qwix", "vermink"} and model.lexicon.entries["qwix"][0]
    got = toxicity.score(docs, model).toPandas().set_index("doc_id").score
    assert ((got >= 0.5).astype(int) == pd.Series(dict(labels))).loc[400:].mean() > 0.98
    left = toxicity.reject(docs, model)
    assert left.columns == docs.columns and left.count() == int((got < 0.5).sum())
    odd = make_docs([None, "", "vermimk zoundr Vermink! you " + vocab[0], '"vermink" said he ' + " ".join(vocab[:40])])
    s = toxicity.score(odd, model).toPandas().set_index("doc_id").score
    assert s[0] == s[1] < 0.5 <= s[2] and s.between(0, 1).all()


def test_learned_words_match_with_another_first_character(spark, make_docs):
    rows = [(i, f"x{i % 23} {'zounder' if i % 2 else 'garden'} w{i % 17} y{i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows), labels)
    assert model.lexicon.entries.keys() == {"zounder"}
    texts = ["20under w1 x2 y3", "*ounder w1 x2 y3", "xzounder w1 x2 y3", "sounder w1 x2 y3", "garden w1 x2 y3"]
    assert toxicity.score(make_docs(texts), model).toPandas().misspelled.gt(0).tolist() == [False, True, True, True, False]
    assert toxicity.reject(make_docs(texts[1:]), model).toPandas().text.tolist() == texts[4:]


def test_toxicity_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(["a b c"]), none)
    assert toxicity.score(make_docs(["a", None]), model).toPandas().score.tolist() == [0.25, 0.25]
    assert toxicity.score(make_docs([]), model).count() == 0


def test_toxicity_fit_is_bounded_for_one_id_in_many_rows(spark, make_docs, monkeypatch):
    """An id that holds a third of all rows gives the sample no more rows than its bound."""
    seen = []
    fit_once = toxicity.materialize

    def counted(df, name, **k):
        out = fit_once(df, name, **k)
        if name == "toxicity-sample":
            seen.append(out.groupBy("toxic").count().collect())
        return out

    monkeypatch.setattr(toxicity, "materialize", counted)
    rows = [(i, f"plain words number {i} here") for i in range(40)] + [(1000 + i, f"you scumbag {i}") for i in range(40)]
    rows += [(1000, f"you scumbag again {i}") for i in range(400)] + [(1001, "you scumbag")] * 400
    labels = spark.createDataFrame([(i, 0) for i in range(40)] + [(1000 + i, 1) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows), labels, sample_rows=50)
    assert {r["toxic"]: r["count"] for r in seen[0]} == {0: 40, 1: 50}
    got = toxicity.score(make_docs([(1, "you scumbag"), (2, "plain words"), (3, "long " * 50000)]), model).toPandas().score.tolist()
    assert model.lexicon.entries and got[0] >= max(got[1:])


def test_toxicity_prefix_counts_come_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    texts = [" ".join(f"word{i}x{j}" for j in range(30)) for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts * 2), pa.array([1] * 50 + [0] * 50, pa.int32())], names=["text", "toxic"])
    whole = pa.Table.from_batches(toxicity.counted_prefixes([batch])).to_pandas()
    monkeypatch.setattr(toxicity, "HELD_PREFIXES", 500)
    parts = list(toxicity.counted_prefixes([batch]))
    assert len(parts) > 10 and max(p.num_rows for p in parts) < 500 + max(len(toxicity._prefixes(t)) for t in texts)
    again = pa.Table.from_batches(parts).to_pandas().groupby(["prefix", "around"], as_index=False).sum()
    assert again.equals(whole.sort_values(["prefix", "around"], ignore_index=True))
