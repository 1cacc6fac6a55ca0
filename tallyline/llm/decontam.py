"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised items go into suffix automata on the driver, each over at most
``part_words`` item words, and each automaton is broadcast. Every document streams its words
through them, tracking the longest suffix that occurs in some item: a match of ``window`` words,
or one that covers a whole shorter item, is a hit. Documents are never shuffled.

Defined cases: null or empty texts have no words and no hits; items without words match
nothing; rows of one ``item_id`` are items of one name; an item with a null id still hits words
but is not listed; repeated document rows are judged one by one; an empty benchmark hits
nothing; other columns are ignored (``clean`` passes them through).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from . import common

#: Item words in one automaton; a larger benchmark is split over several.
PART_WORDS = 1 << 20
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of its windows."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.shortest = window
        kept = []
        for name, words in items:
            if not words:
                continue
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            self.shortest = min(self.shortest, len(ids))
            kept.append((name, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # the items a state's strings occur in, and the short items that end there
        self.items: list[set[str]] = [set() for _ in self.next]
        self.whole: list[list[tuple[int, str | None]]] = [[] for _ in self.next]
        for name, ids in kept:
            state, seen = 0, set()
            for c in ids:
                state = self.next[state][c]
                up = state
                while up > 0 and up not in seen:
                    seen.add(up)
                    if name is not None:
                        self.items[up].add(name)
                    up = self.link[up]
            if len(ids) < window:
                while self.size[self.link[state]] >= len(ids):
                    state = self.link[state]
                self.whole[state].append((len(ids), name))
        for state in sorted(range(1, len(self.next)), key=self.size.__getitem__):
            if above := self.whole[self.link[state]]:
                self.whole[state] = self.whole[state] + above
        self.run = re.compile(b"\x01{%d,}" % self.shortest)

    def _new(self, size: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.size.append(size)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of the strings that are one word longer than ``p``'s, apart from ``q``."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._new(self.size[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, self.next[last][c], c)
        new = self._new(self.size[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, self.next[p][c], c)
        return new

    def scan(self, words: list[bytes], hit: bytearray, found: set[str]) -> int:
        """Mark hit words and add the items of occurring windows; the longest match's length."""
        vocab, nxt, link, size, window = self.vocab, self.next, self.link, self.size, self.window
        longest = 0
        for run in self.run.finditer(bytes(map(vocab.__contains__, words))):
            state = length = 0
            for i in range(run.start(), run.end()):
                c = vocab[words[i]]
                while c not in nxt[state] and state:
                    state = link[state]
                    length = size[state]
                if c in nxt[state]:
                    state = nxt[state][c]
                    length += 1
                longest = max(longest, length)
                if length >= window:
                    hit[i + 1 - window : i + 1] = b"\x01" * window
                    up = state
                    while size[link[up]] >= window:
                        up = link[up]
                    found |= self.items[up]
                for m, name in self.whole[state]:
                    if m <= length:
                        hit[i + 1 - m : i + 1] = b"\x01" * m
                        if name is not None:
                            found.add(name)
        return longest


def automata(benchmark: DataFrame, window: int, part_words: int = PART_WORDS) -> list:
    """Broadcast automata of ``benchmark(item_id, text)``. A part's items are collected
    together; parts are sized by characters, of which a word has at least one."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (part_words * 2)))
    out = []
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        pairs = [(r[0], common.alnum_words(r[1])) for r in rows]
        out.append(spark.sparkContext.broadcast(Automaton(sorted(pairs, key=lambda x: (x[0] or "", x[1])), window)))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: words, hit words, the items with occurring windows
    (sorted as strings) and the longest match in words."""
    held = automata(benchmark, window)

    def task():
        def step(batch):
            out = {k: [] for k in ("doc_id", "n_words", "n_hit", "items", "longest")}
            for key, text in zip(batch.column(0).to_pylist(), common.binary_list(batch.column(1)), strict=True):
                words = common.alnum_words(text)
                hit, found, longest = bytearray(len(words)), set(), 0
                for a in held:
                    longest = max(longest, a.value.scan(words, hit, found))
                for k, v in zip(out, (key, len(words), sum(hit), sorted(found), longest), strict=True):
                    out[k].append(v)
            return out

        return step

    schema = "doc_id long, n_words long, n_hit long, items array<string>, longest long"
    return common.map_batches(docs.select("doc_id", "text"), task, schema)


def _cut(text: bytes, hit: bytearray) -> str:
    """The text without the stretches from a run's first hit word to its last."""
    spans = [m.span() for m in _WORD.finditer(text)]
    kept, at, i = [], 0, 0
    while i < len(hit):
        if not hit[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(hit) and hit[j + 1]:
            j += 1
        kept.append(text[at : spans[i][0]])
        at, i = spans[j][1], j + 1
    return (b"".join(kept) + text[at:]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans; a document whose words are hit in a share over
    ``max_coverage`` goes altogether. ``n_chars``, where it is a column, is counted anew."""
    held = automata(benchmark, window)
    names = docs.columns
    at = names.index("text")
    schema = docs.schema

    def task():
        def step(batch):
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            keep, texts = [], []
            for text in common.binary_list(batch.column(at)):
                words = common.alnum_words(text)
                hit, found = bytearray(len(words)), set()
                for a in held:
                    a.value.scan(words, hit, found)
                n = sum(hit)
                keep.append(not n or n <= max_coverage * len(words))
                texts.append(_cut(text, hit) if n else text.decode() if text is not None else None)
            chosen = pa.array(keep)
            out = {n: c.filter(chosen) for n, c in columns.items()}
            out["text"] = [t for t, k in zip(texts, keep, strict=True) if k]
            return out

        return step

    out = common.map_batches(docs, task, _ddl(schema))
    if "n_chars" in names and isinstance(schema["n_chars"].dataType, LongType):
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
