"""Removal of repeated passages by recompression.

Words are renamed in rounds: runs of one symbol become a symbol, then pairs of a left and a right symbol do,
sides being a bit of the symbol's name. A name is a 64-bit hash of what it stands for, so all
tasks give equal substrings equal names without a table of names. With each symbol goes the stretch of
words that its bounds depend on; a symbol whose stretch lies within a window is the same wherever the window's words
stand. Among those, a window's anchor is the one of least rank.

A first Spark round totals anchors over the corpus: a window can only repeat if its anchor stands in
two places (or it has none, as in very long runs). A second round verifies the windows that are left by a hash of all
their words. Words of a window that starts in two places are removed. Both rounds send a name
once per block of documents (``exchange``), so passages in very many documents are no hot keys.

Defined cases: null or empty texts have no words; a text shorter than a window keeps all; windows are judged on
the input; a repeated row repeats all its windows; a null ``doc_id`` is kept as null; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_scope

from . import common, exchange

ROUNDS = 3
ANCHOR, WINDOW = 0, 1
_SIDES = [np.uint64(0xA24BAED4963EE407 + 2 * i) for i in range(ROUNDS + 1)]  # one for each round, the last for ranks


class Parse:
    """Symbols of a block's documents: names, first and last word, and the stretch of words that each depends on."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        n = len(words)
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        self.name = words
        self.doc = doc
        at = np.arange(n)
        self.low, self.high = at, at  # the stretch
        self.before, self.after = (ends - sizes - 1), ends  # beyond each document
        for side in _SIDES[:ROUNDS]:
            self._runs()
            self._pairs(side)

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The stretch's lower bound with the symbol to the left, its upper bound with that to the right."""
        same = self.doc[1:] == self.doc[:-1]
        left, right = self.before[self.doc], self.after[self.doc]
        left[1:] = np.where(same, self.low[:-1], left[1:])
        right[:-1] = np.where(same, self.high[1:], right[:-1])
        return left, right

    def _runs(self) -> None:
        n = len(self.name)
        if not n:
            return
        left, right = self._neighbours()
        first = np.flatnonzero(np.r_[True, (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])])
        last = np.r_[first[1:], n] - 1
        length = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        self.name = np.where(length > 1, common.mix(name, length), name)
        self.low, self.high, self.doc = left[first], right[last], self.doc[first]

    def _pairs(self, side: np.uint64) -> None:
        n = len(self.name)
        if not n:
            return
        left, right = self._neighbours()
        is_right = (common.mix(self.name, np.full(n, side)) & np.uint64(1)).astype(bool)
        joined = np.zeros(n, bool)  # the first of a pair
        joined[:-1] = ~is_right[:-1] & is_right[1:] & (self.doc[1:] == self.doc[:-1])
        second = np.r_[False, joined[:-1]]
        low = np.where(is_right & ~second, left, self.low)
        high = np.where(~is_right & ~joined, right, self.high)
        keep = np.flatnonzero(~second)
        paired = joined[keep]
        to = np.minimum(keep + 1, n - 1)
        self.name = np.where(paired, common.mix(self.name[keep], self.name[to]), self.name[keep])
        self.low = low[keep]
        self.high = np.where(paired, high[to], high[keep])
        self.doc = self.doc[keep]

    def anchors(self, starts: np.ndarray, size: int, n: int) -> np.ndarray:
        """For each window start the number of its anchor, or -1."""
        out = np.full(len(starts), -1)
        if not len(starts) or not len(self.name):
            return out
        # the stretches' bounds never fall from one symbol to the next
        first = np.cumsum(np.bincount(self.low + 2, minlength=n + 3))[starts + 1]
        last = np.cumsum(np.bincount(self.high, minlength=n + size + 1))[starts + size - 1] - 1
        some = np.flatnonzero(last >= first)
        first, last = first[some], last[some]
        rank = common.mix(self.name, np.full(len(self.name), _SIDES[ROUNDS]))
        span = np.floor(np.log2(last - first + 1)).astype(np.int64)
        least = np.arange(len(rank))
        for level in range(int(span.max(initial=-1)) + 1):
            own = np.flatnonzero(span == level)
            a, b = least[first[own]], least[last[own] - (1 << level) + 1]
            out[some[own]] = np.where(rank[a] <= rank[b], a, b)
            step = 1 << level
            if len(least) > step:
                x, y = least[:-step], least[step:]
                least = np.where(rank[x] <= rank[y], x, y)
        return out


class Words:
    """A block's words and windows."""

    def __init__(self, row: dict, hashes: common.WordHashes, size: int, keep: bool = False) -> None:
        self.size = size
        self.split = [common.space_words(t, lower=False) for t in exchange.texts_of(row)]
        self.sizes = np.array([len(x) for x in self.split], np.int64)
        self.words = np.concatenate([np.empty(0, np.uint64), *(hashes.of(x) for x in self.split)])
        if not keep:
            self.split = []
        ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        self.starts = np.flatnonzero(np.arange(len(self.words)) + size <= ends)
        parse = Parse(self.words, self.sizes)
        anchor = parse.anchors(self.starts, size, len(self.words))
        self.free = anchor < 0
        used, self.anchor = np.unique(anchor[~self.free], return_inverse=True)
        self.names, self.name_of = np.unique(parse.name[used], return_inverse=True)
        self.places = np.bincount(self.name_of, minlength=len(self.names))

    def wanted(self, replies: pa.Table) -> np.ndarray:
        """Starts of windows whose anchor stands in two places, or that have none."""
        (total,) = exchange.replies_of(replies, ANCHOR, 1)
        wanted = self.free.copy()
        wanted[~self.free] = (total > 1)[self.name_of][self.anchor]
        return self.starts[wanted]

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct window hashes, and each start's number among them."""
        h = common.windows(self.words, self.size)
        return np.unique(h[starts], return_inverse=True)


def _names(size: int, shards: int):
    def task():
        hashes = common.WordHashes()

        def step(row):
            words = Words(row, hashes, size)
            yield from exchange.request_rows(row["block"], ANCHOR, words.names, [np.minimum(words.places, 2)], shards)

        return step

    return task


def repeated(docs: DataFrame, size: int = 50, texts: bool = True) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined by a space, and these (``kept``)
    where ``texts``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.lit(0).alias("flag"), F.lit(0).alias("part"))
    with scratch_scope(spark):
        blocks = exchange.write_blocks(rows, "substring-blocks")
        shards = blocks.shards
        names = exchange.totals(exchange.requests(blocks.table, _names(size, max(1, shards // 8))), 1)
        names = materialize(names, "substring-names")

        def ask(row: dict, own: pa.Table) -> pa.Table:
            words = Words(row, common.WordHashes(), size)
            keys, inverse = words.windows(words.wanted(own))
            counts = np.minimum(np.bincount(inverse, minlength=len(keys)), 2)
            return exchange.table_of(exchange.request_rows(row["block"], WINDOW, keys, [counts], shards))

        asked = exchange.with_replies(blocks.table, names, ask, exchange._REQUEST)
        verified = materialize(exchange.totals(asked, 1), "substring-windows")

        def remove(row: dict, own: pa.Table) -> pa.Table:
            words = Words(row, common.WordHashes(), size, keep=True)
            starts = words.wanted(own)
            _, inverse = words.windows(starts)
            (total,) = exchange.replies_of(own, WINDOW, 1)
            again = starts[(total > 1)[inverse]]
            edge = np.zeros(len(words.words) + 1, np.int64)
            np.add.at(edge, again, 1)
            np.add.at(edge, again + size, -1)
            gone = np.cumsum(edge[:-1]) > 0
            at, out = 0, {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept")}
            for own_words in words.split:
                part = gone[at : at + len(own_words)]
                at += len(own_words)
                n = int(part.sum())
                left = own_words if not n else [w for w, x in zip(own_words, part.tolist(), strict=True) if not x]
                kept = b" ".join(left)
                out["n_words"].append(len(own_words))
                out["n_removed"].append(n)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode() if texts else None)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = {k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)}
            return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64())} | columns)

        schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
        out = exchange.with_replies(blocks.table, names.unionByName(verified), remove, schema)
        return materialize(out, "substring-result", keep=True)
