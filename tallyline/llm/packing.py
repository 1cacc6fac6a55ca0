"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

A document costs ``linear * n + quadratic * n**2`` (attention inside its own piece). Each task
packs its documents in pools of a bounded number of tokens: whole sequences are cut off long
documents, then the rest is assigned in descending order to the cheapest open sequence that
still holds it. What fits nowhere is cut over the cheapest sequences with room, so a pool pads
less than one sequence. There is no shuffle, and a task holds one pool at a time.

Defined cases: null text is an empty document (its end id alone); a null ``doc_id`` is kept as
null; repeated rows are packed once per row; equal costs are settled by position; an empty
table gives no rows. Other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long, sequence_cost double"
)
#: Chunks of text whose ids a worker remembers, text looked up together, tokens and texts packed together.
CACHED_CHUNKS = 1 << 20
SLICE_BYTES = 1 << 23
POOL_TOKENS = 1 << 21
POOL_TEXTS = 1 << 17
#: Marks that may follow a word; a run of them is one pre-token.
MARKS = ".,;:!?%*$&#"
#: Lower-case Latin words.
PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u012f]+$"


class Tokens:
    """Ids of whole texts by a tokenizer whose pre-tokenizer never crosses ASCII white space.

    A text's ids are those of its white-space separated chunks in a row; special tokens hold no white
    space, so they too lie within one chunk. Arrow splits a slice of texts, makes its chunks distinct and
    parts plain Latin words from the run of marks after them, each a pre-token of its own. The
    tokenizer itself encodes each distinct one, plain words many at a time (the last id of each is one that
    ends a word), and remembers it while there is room; the ids of all words are gathered by position.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.learned = common.Learned(CACHED_CHUNKS)

    def _one(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of any chunks, and how many each has."""
        for w in words:
            ids = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4")
            yield ids, np.array([len(ids)])

    def _plain(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same of plain words."""
        for lo in range(0, len(words), 512):
            part = words[lo : lo + 512]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            assert len(ends) == len(part) and (not len(ends) or ends[-1] == len(ids))
            yield ids, np.diff(ends, prepend=0)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks in a row, and how many each has."""
        trimmed = pc.utf8_rtrim(chunks, MARKS)
        plain = pc.match_substring_regex(trimmed, PLAIN)
        core = pc.if_else(plain, trimmed, chunks)
        mark = pc.if_else(plain, pc.replace_substring_regex(chunks, PLAIN[:-1], ""), "")
        coded = pa.chunked_array([core, mark]).combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy()
        is_plain = np.zeros(len(coded.dictionary), bool)
        is_plain[code[: len(chunks)][plain.to_numpy(zero_copy_only=False)]] = True
        place = self.learned.places(coded.dictionary, [(is_plain, self._plain), (~is_plain, self._one)])[code].reshape(2, -1)
        ids, end = common.gather(self.learned.ids, self.learned.size, place.T.ravel())
        return ids, np.diff(end[1::2], prepend=0)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        lowered = [(t if b"<|" in t else t.lower()) if t else b"" for t in common.binary_list(texts)]
        slices = np.flatnonzero(np.diff(np.cumsum(list(map(len, lowered))) // SLICE_BYTES, prepend=-1))
        for lo, hi in pairwise([*slices.tolist(), len(lowered)]):
            words = pc.ascii_split_whitespace(pa.array(lowered[lo:hi], pa.large_binary()).view(pa.large_string()))
            coded = words.flatten().dictionary_encode()
            ids, end = common.gather(*self._chunks(coded.dictionary), coded.indices.to_numpy())
            borders = np.append(0, end)[words.offsets.to_numpy()]
            yield from (ids[i:j] for i, j in pairwise(borders.tolist()))


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Pieces ``(document, start, length, sequence)`` in the order in which they lie in their
    sequences; ``lengths`` counts every document's tokens."""
    pieces: list[tuple[int, int, int, int]] = []
    sequence = 0
    tails = []
    for doc, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence))
            sequence += 1
        if n % capacity:
            tails.append((n % capacity, doc, n - n % capacity))
    tails.sort(key=lambda t: (-t[0], t[1]))
    n_open = -(-sum(t[0] for t in tails) // capacity)
    free, cost = np.full(n_open, capacity), np.zeros(n_open)
    for n, doc, start in tails:
        while n:
            room = free >= n
            fits = bool(room.any())
            at = int(np.argmin(np.where(room if fits else free > 0, cost, np.inf)))
            part = n if fits else min(n, int(free[at]))
            pieces.append((doc, start, part, sequence + at))
            cost[at] += linear * part + quadratic * part * part
            free[at] -= part
            start, n = start + part, n - part
    return pieces


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece of each document of ``docs(doc_id, text)``; see the module text.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's, and
    ``ids_crc32`` is over the piece's ids as little-endian 32-bit numbers. A sequence with
    fewer than ``capacity`` tokens is meant to be padded by its reader.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    end = np.array([end_id], "<u4")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = Tokens(tokenizer_path)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal first, held
            pieces = assign([len(x) for x in ids], capacity, linear, quadratic)
            count = max((p[3] for p in pieces), default=-1) + 1
            used, cost = np.zeros(count, np.int64), np.zeros(count)
            rows = []
            for doc, start, n, at in pieces:
                crc = zlib.crc32(ids[doc][start : start + n].tobytes())
                rows.append((keys[doc], start, n, crc, len(ids[doc]), first + at, int(used[at])))
                used[at] += n
                cost[at] += linear * n + quadratic * n * n
            own = [p[3] for p in pieces]
            columns = [list(c) for c in zip(*rows, strict=True)] + [used[own], cost[own]]
            first += count
            held = 0
            keys.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.float64() if k == "sequence_cost" else pa.int64()) for k, c in zip(names, columns, strict=True)],
                names=names,
            )

        for batch in batches:
            for key, got in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1)), strict=True):
                keys.append(key)
                ids.append(np.concatenate([got, end]))
                held += len(got) + 1
                if held >= pool_tokens or len(keys) >= POOL_TEXTS:
                    yield flush()
        if keys:
            yield flush()
        del tokens
        pa.default_memory_pool().release_unused()

    common.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
