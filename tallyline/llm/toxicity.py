"""Toxicity by Levenshtein automata over a learned lexicon trie.

The lexicon is learned from labelled rows: entries are whole words, or stems that many different
words of toxic texts begin with. They form a trie; its product with the Levenshtein automaton
of distance 1 is determinised lazily, one state at a time, so a word is matched by one table
step per character; a stem keeps its first character, a whole word need not. An exact entry, a misspelled one and their context (quotation marks and reporting
words near by against direct address) give each hit a weight; a logistic model over a text's
hits, also fitted on the labelled rows, gives the score.

``fit`` reads at most ``sample_rows`` toxic rows and three times as many clean ones, equal rows once (the
smallest hashes of ``doc_id``, then of id and text); all else covers every row and every whole text, without a shuffle.

Defined cases: null or empty texts have no hits and get the model's score for that; labels without a
document, null labels and null ids are left out of the fit; of several labels for one id the largest
counts; without any labelled row of both classes the lexicon is empty and every score is the smoothed
rate of toxic labels; repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_scope

from . import common

#: Labelled rows of each class that the fit reads, at most.
SAMPLE_ROWS = 4000
#: Entries of at least this length also match at distance 1.
FUZZY_FROM = 5
#: Weight of a misspelled hit against an exact one.
MISSPELLED = 0.8
#: Remembered words of a worker, and states of the automaton.
CACHED = 1 << 18
#: Prefixes with contexts that a task of the fit holds before it passes them on.
HELD_PREFIXES = 1 << 16

_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…"
# Cues of reported speech and of direct address.
_QUOTING = ("said", "says", "quote", "quoted", "called", "wrote", "reported", "according", "term", "word")
_ADDRESS = ("you", "your", "you're", "youre", "u", "ur")
_QUOTES = "\"“”«»„"


@dataclass
class Lexicon:
    """Entries as text -> (is a stem, weight), and words that look misspelled but are clean."""

    entries: dict[str, tuple[bool, float]] = field(default_factory=dict)
    clean: frozenset[str] = frozenset()
    #: how far a misspelled hit of an entry is trusted; less, the more clean words are near it
    trust: dict[str, float] = field(default_factory=dict)
    #: whole words also match with their first character replaced, dropped or preceded by another
    any_first: bool = False


_FIRST = 2


class Matcher:
    """The lexicon trie times the Levenshtein automaton of distance 1, determinised lazily.

    A state is a set of (trie node, edits); a word's characters lead from state to state. An edit of the
    first character counts as ``_FIRST`` edits: it is one that only whole words accept, since stems keep
    their beginning. The best hit is exact before misspelled, then the heavier entry.
    """

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.entry: list[str | None] = [None]
        self.long: list[bool] = [False]  # an entry of FUZZY_FROM or more lies at or below
        self.word: list[bool] = [False]  # such an entry that is a whole word
        for text in sorted(lexicon.entries):
            node = 0
            path = [0]
            for ch in text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.entry.append(None)
                    self.long.append(False)
                    self.word.append(False)
                node = self.children[node][ch]
                path.append(node)
            self.entry[node] = text
            if len(text) >= FUZZY_FROM:
                for n in path:
                    self.long[n] = True
                    self.word[n] |= not lexicon.entries[text][0]
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset[tuple[int, int]], int] = {}
        self.sets: list[frozenset[tuple[int, int]]] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state of ``pairs`` and of the trie characters left out after them."""
        for node, edits in list(pairs):
            if not edits:
                pairs.update(self._others(node))
        key = frozenset((n, e) for n, e in pairs if not any((n, x) in pairs for x in range(e)))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.states[key]

    def _others(self, node: int) -> Iterator[tuple[int, int]]:
        """What an edit at ``node`` leads to over one trie character."""
        if node:
            return ((n, 1) for n in self.children[node].values() if self.long[n])
        return ((n, _FIRST) for n in self.children[0].values() if self.word[n] and self.lexicon.any_first)

    def _step(self, state: int, ch: str) -> int:
        to: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            child = self.children[node].get(ch)
            if child is not None:
                to.add((child, edits))
            if not edits:
                if self.long[node] if node else self.word[0] and self.lexicon.any_first:
                    to.add((node, 1 if node else _FIRST))  # a character too many
                to.update(self._others(node))  # another one
        got = self.steps[state][ch] = self._state(to)
        return got

    def _accepted(self, state: int, whole: bool) -> tuple[str, int] | None:
        best = None
        for node, edits in self.sets[state]:
            text = self.entry[node]
            if text is None or (edits and len(text) < FUZZY_FROM):
                continue
            stem, weight = self.lexicon.entries[text]
            if edits == _FIRST and stem:
                continue
            edits = min(edits, 1)
            # a misspelled stem counts only with all of its characters read
            if (stem or whole) and (best is None or (edits, -weight, text) < best[0]):
                best = ((edits, -weight, text), (text, edits))
        return best[1] if best else None

    def match(self, word: str) -> tuple[str, int] | None:
        """The entry that ``word`` is, begins with or misspells, and the distance."""
        if len(self.sets) >= CACHED:
            self._reset()
        state, got = self.start, None
        for ch in word:
            to = self.steps[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if not self.sets[state]:
                break
            if stem := self._accepted(state, False):
                got = min(got, stem, key=lambda x: x[1]) if got else stem
        else:
            end = self._accepted(state, True)
            if end and (got is None or end[1] < got[1]):
                got = end
        return None if got and got[1] and word in self.lexicon.clean else got


class Words(dict):
    """Raw word -> hit or None, for a bounded number of words."""

    def __init__(self, matcher: Matcher) -> None:
        self.matcher = matcher

    def __missing__(self, raw: str) -> tuple[str, int] | None:
        if len(self) >= CACHED:
            self.clear()
        hit = self[raw] = self.matcher.match(normal(raw))
        return hit


def normal(word: str) -> str:
    return word.lower().strip(_STRIP)


def context(words: list[str], at: int, reach: int = 6) -> float:
    """Over 0 where the words around sound like direct address, under 0 like quotation."""
    score = 0.0
    if words[at][0] in _QUOTES or words[at].rstrip(".,;:!?")[-1:] in _QUOTES:
        score -= 1
    for w in words[max(0, at - reach) : at + reach + 1]:
        w = normal(w)
        score += (w in _ADDRESS) - (w in _QUOTING)
    return max(-2.0, min(2.0, score))


FEATURES = ("weight", "misspelled", "address", "quotation", "share")


def features(known: Words, text: str | None) -> list[float]:
    """A text's hits as numbers: their summed weights, those of misspelled ones, context, and share."""
    words = text.split() if text else []
    hits = list(map(known.__getitem__, words))
    total = fuzzy = address = quotation = 0.0
    n = 0
    if any(hits):
        entries, trust = known.matcher.lexicon.entries, known.matcher.lexicon.trust
        for i, hit in enumerate(hits):
            if hit is None:
                continue
            n += 1
            around = context(words, i)
            weight = entries[hit[0]][1] * (0.5 if around < 0 else 1.0)
            if hit[1]:
                weight *= MISSPELLED * trust.get(hit[0], 1.0)
                fuzzy += weight
            total += weight
            address += max(0.0, around)
            quotation += max(0.0, -around)
    return [*map(math.log1p, (total, fuzzy, address, quotation, 100 * n / max(1, len(words))))]


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float]  # the intercept, then one per feature


def _tail(k: int, n: int, p: float) -> float:
    """The probability of ``k`` or more of ``n`` at rate ``p``, at most."""
    if k <= n * p:
        return 1.0
    q = k / n
    kl = q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0)
    return math.exp(-n * kl)


def choose(rows: list[tuple[str, int, int, int]], n_toxic: int, n_clean: int) -> dict[str, tuple[bool, float]]:
    """The lexicon from ``(prefix, toxic texts, clean texts, contexts)``; a whole word's prefix ends in ``$``.

    A prefix counts where toxic texts with it are too many for chance (different contexts stand
    for independent cases, so copies of one text are one case) and clean texts with it are rare. Of
    nested prefixes the shortest with real branches is a stem; where one continuation has nearly all
    cases, that one is taken instead.
    """
    rate = n_toxic / (n_toxic + n_clean)
    table = {}
    for prefix, tox, clean, contexts in rows:
        k = min(tox, contexts)
        if tox * n_clean >= 20 * clean * n_toxic and _tail(k, k + clean, rate) < 1e-6:
            table[prefix] = (tox, clean)
    longer: dict[str, list[str]] = defaultdict(list)
    for p in table:
        longer[p[:-1]].append(p)
    out: dict[str, tuple[bool, float]] = {}
    for p in sorted(table):
        if p[:-1] in table:
            continue  # reached from its beginning
        todo = [p]
        while todo:
            at = todo.pop()
            tox, clean = table[at]
            if at.endswith("$"):
                entry, stem = at[:-1], False
            else:
                main = [x for x in longer[at] if table[x][0] >= 0.9 * tox]
                if main or len(at) < 4:
                    todo += main or longer[at]
                    continue
                entry, stem = at, True
            odds = math.log((tox + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
            out[entry] = (stem, min(odds, 6.0))
    return out


def _prefixes(text: str | None) -> dict[str, int]:
    """Prefixes (3 to 16 characters) and whole words of a text, each with a hash of one context."""
    words = [normal(w) for w in text.split()] if text else []
    out: dict[str, int] = {}
    for i, w in enumerate(words):
        if 3 <= len(w) <= 32 and w + "$" not in out:
            around = hash_of(f"{words[i - 1] if i else ''} {w} {words[i + 1] if i + 1 < len(words) else ''}")
            for n in range(3, min(len(w), 16) + 1):
                out.setdefault(w[:n], around)
            out[w + "$"] = around
    return out


def counted_prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of texts with one context each (toxic texts; clean ones need none) and the number of toxic and of
    clean texts that hold them. A task holds ``HELD_PREFIXES`` of them and those of one text; the rest is
    added up by Spark."""
    counted: dict[tuple[str, int], list[int]] = {}

    def flush() -> pa.RecordBatch:
        keys, numbers = zip(*counted, strict=True), zip(*counted.values(), strict=True)
        prefix, around = map(list, keys)
        clean, toxic = map(list, numbers)
        counted.clear()
        columns = [pa.array(prefix, pa.string()), *(pa.array(c, pa.int64()) for c in (around, toxic, clean))]
        return pa.RecordBatch.from_arrays(columns, names=["prefix", "around", "toxic", "clean"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            for p, around in _prefixes(text.as_py()).items():
                counted.setdefault((p, around if toxic else -1), [0, 0])[toxic] += 1
            if len(counted) >= HELD_PREFIXES:
                yield flush()
    if counted:
        yield flush()


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode()) >> 1


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    with scratch_scope(spark):
        known = materialize(known, "toxicity-labels")
        total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n1, n0 = total.get(1, 0), total.get(0, 0)
        prior = math.log((n1 + 0.5) / (n0 + 1.5))
        nothing = Model(Lexicon(), [prior] + [0.0] * len(FEATURES))
        order = F.xxhash64("doc_id")
        part = lambda v, n: known.where(F.col("toxic") == v).orderBy(order, "doc_id").limit(n)
        chosen = part(1, sample_rows).unionByName(part(0, 3 * sample_rows))
        # at most 4 * sample_rows ids; an id may stand in any number of rows, so different texts are counted again
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
        keys = materialize(rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "text_key", "toxic").agg(F.lit(1).alias("one")), "toxicity-rows")
        order = [F.xxhash64("doc_id", "text_key"), "doc_id", "text_key"]
        part = lambda v, n: keys.where(F.col("toxic") == v).orderBy(*order).limit(n).drop("one")
        picked = part(1, sample_rows).unionByName(part(0, 3 * sample_rows))  # at most 4 * sample_rows rows
        sample = rows.join(F.broadcast(picked), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
        sample = materialize(sample.select("doc_id", "text", "toxic"), "toxicity-sample")
        sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        if not n_toxic or not n_clean:
            return nothing

        found = (
            sample.select("text", "toxic").mapInArrow(counted_prefixes, "prefix string, around long, toxic long, clean long")
            .groupBy("prefix", "around").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count(F.when(F.col("around") >= 0, 1)).alias("contexts"))
            .where(f"contexts >= 3 and toxic * {n_clean} >= 20 * clean * {n_toxic}")
        )
        lexicon = Lexicon(choose([tuple(r) for r in found.collect()], n_toxic, n_clean), any_first=True)
        if not lexicon.entries:
            return nothing
        half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))

        # words of clean texts that look misspelled, from half of them; the model is fitted on the rest
        def misspelled():
            words = Words(Matcher(lexicon))

            def step(batch):
                seen = {(normal(w), h[0]) for t in batch.column(1).to_pylist() for w in (t or "").split() if (h := words[w]) and h[1]}
                return {"word": [w for w, _ in sorted(seen)], "entry": [e for _, e in sorted(seen)]}

            return step

        clean = common.map_batches(sample.where((F.col("toxic") == 0) & (half == 0)), misspelled, "word string, entry string").distinct().collect()
        lexicon.clean = frozenset(r["word"] for r in clean)
        near = Counter(r["entry"] for r in clean)
        lexicon.trust = {e: 1 / (1 + n) for e, n in near.items()}
        rows = _features(sample.where((F.col("toxic") == 1) | (half == 1)), lexicon, "toxic").collect()
    x = np.array([list(r["x"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    if len(set(y)) < 2:
        return nothing
    weights = _logistic(x, y)
    weights[0] += prior - math.log(y.sum() / (len(y) - y.sum()))
    return Model(lexicon, weights.tolist())


def _features(docs: DataFrame, lexicon: Lexicon, *others: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample

    def task():
        words = Words(Matcher(held.value))

        def step(batch):
            out = {"x": [features(words, t) for t in batch.column(0).to_pylist()]}
            return out | {o: batch.column(i + 1) for i, o in enumerate(others)}

        return step

    schema = "x array<double>" + "".join(f", {o} {docs.schema[o].dataType.simpleString()}" for o in others)
    return common.map_batches(docs.select("text", *others), task, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` a ``score`` in 0 to 1, and the features it comes from."""
    terms = [F.lit(model.weights[0])] + [F.lit(w) * F.get("x", F.lit(i)) for i, w in enumerate(model.weights[1:])]
    logit = terms[0]
    for t in terms[1:]:
        logit = logit + t
    names = [F.get("x", F.lit(i)).alias(n) for i, n in enumerate(FEATURES)]
    return _features(docs, model.lexicon, "doc_id").select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"), *names)


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows that score ``threshold`` or more."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def task():
        words = Words(Matcher(held.value.lexicon))
        weights = held.value.weights
        limit = math.log(threshold / (1 - threshold))

        def step(batch):
            keep = [
                weights[0] + sum(w * x for w, x in zip(weights[1:], features(words, t), strict=True)) < limit
                for t in batch.column(at).to_pylist()
            ]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            return {n: kept.column(i) for i, n in enumerate(names)}

        return step

    from .decontam import _ddl

    return common.map_batches(docs, task, _ddl(docs.schema))
