"""Periodic runs of words within each document, by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal),
of at least ``min_length`` words and ``times`` periods, that no neighbouring word extends. Words are
taken in order; an earlier occurrence ``q`` words back adds one to the match length of the
diagonal of lag ``q``; a diagonal that is not carried on ends there and then, and a long enough one
emits its run.

Taking every earlier occurrence of a frequent word would be quadratic. A run of period ``q`` and
three or more repetitions holds, from its second period on, blocks of ``K`` words (``K`` the power
of two above ``q``) that occurred ``q`` words before; and as ``K >= q``, ``q`` is the least distance at
which such a block recurs (else its period would have a smaller one). So of all earlier
occurrences of a word only one for each ``K`` is taken: the latest that agrees on the ``K`` words from
there, if it lies ``K / 2`` to ``K - 1`` words back. Blocks are named exactly, by doubling, not hashed.
The same argument says that each diagonal so followed is a whole one, with its smallest period. Work is
``n log n``; memory is that of a slice of texts, or of one text if it is longer.

Defined cases: null and empty texts have no words and no runs; a null ``doc_id`` stays null;
repeated rows are answered each; runs that overlap are all reported; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
#: Words looked through at a time.
SLICE_WORDS = 1 << 18


def earlier(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For ``K`` = 2, 4, ...: positions, and the distances of ``K / 2`` to ``K - 1`` words to the latest
    earlier occurrence of the ``K`` words from there. ``longest`` bounds the periods asked for."""
    name, size = words, 1
    at = np.arange(len(words))
    while len(at):
        order = np.argsort(name, kind="stable")
        value, place = name[order], at[order]
        same = value[1:] == value[:-1]
        lag = place[1:][same] - place[:-1][same]
        wanted = (lag >= size // 2) & (lag < size)
        if size > 1:
            yield place[1:][same][wanted], lag[wanted]
        size *= 2
        if size // 2 > longest:
            return
        # only blocks that occur again can be halves of larger ones that do
        again = np.append(same, False) | np.insert(same, 0, False)
        number = np.cumsum(np.insert(~same, 0, False))[again]
        names = np.full(len(words), -1)
        names[place[again]] = number
        at = np.flatnonzero((names[: -(size // 2)] >= 0) & (names[size // 2 :] >= 0))
        name = names[at] * (int(number[-1]) + 1 if len(number) else 1) + names[at + size // 2]


def diagonals(found: Iterable[tuple[int, int]], min_length: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of ``(position, lag)`` pairs in order of position."""
    active: dict[int, int] = {}  # lag -> position at which its diagonal began
    carried: dict[int, int] = {}
    at = -1

    def ended(lags: Iterable[int], last: int) -> Iterator[tuple[int, int, int]]:
        for q in lags:
            start, end = active[q] - q, last + (1 << q.bit_length())
            if end - start >= max(min_length, times * q):
                yield start, end - start, q

    for i, q in found:
        if i != at:
            yield from ended(active.keys() - carried.keys(), at - 1)
            active, carried = carried, {}
            if i != at + 1:
                yield from ended(active, at)
                active = {}
            at = i
        carried[q] = active.get(q, i)
    yield from ended(active.keys() - carried.keys(), at - 1)
    active = carried
    yield from ended(active, at)


def runs_of(texts: list[list[bytes]], min_length: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start and period."""
    ids: dict[bytes, int] = {}
    words = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], np.int64)
    sizes = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = list(earlier(text * max(len(ids), 1) + words, int(sizes.max(initial=0)) // times))
    if not found:
        return out
    at, lag = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((lag, at))
    starts = np.cumsum(sizes) - sizes
    for start, length, q in diagonals(zip(at[order].tolist(), lag[order].tolist(), strict=True), min_length, times):
        t = int(text[start])
        out[t].append((start - int(starts[t]), length, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds beyond its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def find(docs: DataFrame, min_length: int = 6, times: int = 4) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start and period, and the ``collapsed`` text of each row of
    ``docs(doc_id, text)``. ``times`` is 3 or more (see the module text)."""
    if times < 3 or min_length < 3:
        raise ValueError("runs have at least three periods and three words")

    def step(batch: pa.RecordBatch) -> dict:
        words = [common.space_words(t, lower=False) for t in common.binary_list(batch.column(1))]
        runs: list[list[tuple[int, int, int]]] = []
        lo = held = 0
        for hi, w in enumerate(words):
            held += len(w)
            if held >= SLICE_WORDS or hi + 1 == len(words):
                runs += runs_of(words[lo : hi + 1], min_length, times)
                lo, held = hi + 1, 0
        return {
            "doc_id": batch.column(0),
            "n_words": [len(w) for w in words],
            "runs": [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs],
            "collapsed": [collapse(w, r).decode() for w, r in zip(words, runs, strict=True)],
        }

    return common.map_batches(docs.select("doc_id", "text"), lambda: step, SCHEMA)
