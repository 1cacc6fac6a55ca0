"""Merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

A text's encoding is the one sequence of pieces that merging yields, and a sequence is that one
exactly if merging the text of each two neighbours gives these two again. So no merge queue over
the text is needed: Aho-Corasick finds the longest piece at each position, a piece that does not
go with its left neighbour gives way to the next shorter one, and a position from which nothing
goes on is marked in a bitfield and never tried again. That is linear work in the length of a
text, long words and texts without a space included.

The library normalises texts and decodes ids. Texts are cut before each run of the space mark,
across which no piece of such a vocabulary reaches (a vocabulary with other pieces is found out,
and its texts are not cut). A worker remembers a bounded number of words and pairs.

Defined cases: null and empty text have no ids and decode to an empty text; a null ``doc_id`` stays
null; repeated rows are encoded each; an empty table gives no rows; other columns are ignored.
Characters outside the vocabulary become their bytes' pieces, or, without such pieces, one
unknown id for each run of them. Models with user-defined or unused pieces are refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common

SPACE = "▁"
#: Marks that often follow words; they are looked up apart where no piece joins them to the word.
MARKS = ".,;:!?%*$&#"
#: Words, and pairs of pieces, that a worker remembers (a full memory is emptied); text looked up together, and texts
#: passed on together.
CACHED_WORDS = 3 << 18
CACHED_PAIRS = 1 << 18
SLICE_BYTES = 1 << 22
SLICE_TEXTS = 1 << 10


class Encoder:
    """Ids of texts under one model."""

    def __init__(self, path: str) -> None:
        self.library = library(path)
        ids = range(len(self.library))
        special = [i for i in ids if self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)]
        if any(map(self.library.is_unused, ids)):
            raise ValueError("models with unused pieces are not supported")
        self.bytes = {int(self.library.id_to_piece(i)[3:5], 16): i for i in special if self.library.is_byte(i)}
        self.unknown = self.library.unk_id()
        self.pieces = {self.library.id_to_piece(i): i for i in set(ids).difference(special)}
        self.rank = {p: -self.library.get_score(i) for p, i in self.pieces.items()}
        self.alphabet = {p for p in self.pieces if len(p) == 1}
        #: Neighbouring characters that some piece holds: nowhere else can a merge cross.
        self.joined = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        #: Of each piece that merging reaches, its first and its last part after each merge, with the merge's rank.
        self.first: dict[str, list[tuple[float, str]]] = {}
        self.last: dict[str, list[tuple[float, str]]] = {}
        for p in self.pieces:
            parts, first, last = self.merged(p)
            if parts == [p]:
                self.first[p], self.last[p] = first, last
            elif self.pieces[p] in self.library.encode(p):
                raise ValueError(f"piece {p!r} is not reached by merges")
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.first), None) for p in self.first}
        self.automaton = ahocorasick.Automaton()
        for p in self.first:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.learned = common.Learned(CACHED_WORDS)

    def merged(self, text: str) -> tuple[list[str], list[tuple[float, str]], list[tuple[float, str]]]:
        """Plain merging: the best-scored, then leftmost neighbours join until none can. The first and the last
        part are listed after each merge."""
        parts = list(text)
        first, last = [(0.0, parts[0])], [(0.0, parts[-1])]
        while True:
            best = min(
                ((r, i) for i in range(len(parts) - 1) if (r := self.rank.get(parts[i] + parts[i + 1])) is not None),
                default=None,
            )
            if best is None:
                return parts, first, last
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            first.append((best[0], parts[0]))
            last.append((best[0], parts[-1]))

    def together(self, left: str, right: str) -> bool:
        """Whether merging leaves these two neighbours as they are: both are merged anew, in the order of
        their text, until a merge across the border is the best one left or none is left."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        crossed = left[-1] + right[0] in self.joined
        known = self.pairs[left, right] = not crossed or self._remerged(self.last[left], self.first[right])
        return known

    def _remerged(self, left: list[tuple[float, str]], right: list[tuple[float, str]]) -> bool:
        i = j = 0
        none = float("inf")
        while True:
            a = left[i + 1][0] if i + 1 < len(left) else none
            b = right[j + 1][0] if j + 1 < len(right) else none
            across = self.rank.get(left[i][1] + right[j][1], none)
            # of equal ranks the leftmost goes first: left, across, right
            if across < a and across <= b:
                return False
            if a == b == none:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def split(self, text: str) -> list[str]:
        """The pieces of a text whose characters are all pieces."""
        if not text or text in self.first:
            return [text] if text else []
        pairs, longest = self.pairs, self.automaton.iter_long
        dead = None  # a bitfield; bit i: no way on from position i
        out: list[str] = []
        at, size, left = 0, len(text), ""
        matches, following = longest(text, 0), 0  # longest matches, the next one from there
        piece: str | None = None
        while at < size:
            if piece is None:
                if at != following:
                    matches = longest(text, at)
                end, piece = next(matches)
                following = end + 1
            while piece is not None:
                end = at + len(piece)
                if dead is None or not dead[end >> 3] >> (end & 7) & 1:
                    good = not left or pairs.get((left, piece))
                    if good or (good is None and self.together(left, piece)):
                        break
                piece = self.shorter[piece]
            if piece is not None:
                out.append(piece)
                at, left, piece = end, piece, None
            else:
                if dead is None:
                    dead = bytearray(size // 8 + 1)
                dead[at >> 3] |= 1 << (at & 7)
                piece = out.pop()  # gives way to a shorter one
                at -= len(piece)
                left = out[-1] if out else ""
        return out

    def word(self, text: str) -> list[int]:
        """Ids of one word; characters that are no piece part it and stand alone."""
        number = self.pieces.__getitem__
        if self.alphabet.issuperset(text):
            return list(map(number, self.split(text)))
        out: list[int] = []
        start = 0
        for at in [*(i for i, c in enumerate(text) if c not in self.alphabet), len(text)]:
            out += map(number, self.split(text[start:at]))
            if at < len(text):
                out += map(self.bytes.__getitem__, text[at].encode()) if self.bytes else [self.unknown]
            start = at + 1
        return out

    def _words(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo in range(0, len(words), 4096):
            got = [self.word(w) for w in words[lo : lo + 4096]]
            yield np.fromiter(chain.from_iterable(got), "<u4"), np.array(list(map(len, got)), np.int64)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks in a row, and how many each has."""
        core = pc.utf8_rtrim(chunks, MARKS)
        tail = pc.utf8_slice_codeunits(pc.replace_substring_regex(chunks, f"^(?s:.*?)([{MARKS}]*)$", "\\1"), 0, 1)
        border = pc.binary_join_element_wise(pc.utf8_slice_codeunits(core, -1), tail, pa.scalar("", pa.large_string()))
        free = pc.and_(pc.greater(pc.utf8_length(border), 1), pc.invert(pc.is_in(border, pa.array(sorted(self.joined), pa.large_string()))))
        mark = pc.if_else(free, pc.replace_substring_regex(chunks, f"^(?s:.*?)([{MARKS}]*)$", "\\1"), "")
        coded = pa.chunked_array([pc.if_else(free, core, chunks), mark]).combine_chunks().dictionary_encode()
        every = np.ones(len(coded.dictionary), bool)
        place = self.learned.places(coded.dictionary, [(every, self._words)])[coded.indices.to_numpy()].reshape(2, -1)
        ids, end = common.gather(self.learned.ids, self.learned.size, place.T.ravel())
        return ids, np.diff(end[1::2], prepend=0)

    def _split(self, texts: list[str]) -> pa.Array:
        """Each text's words, cut before each run of the space mark."""
        whole = pa.array(texts, pa.large_string())
        if not self.cuts:
            return pa.LargeListArray.from_arrays(np.arange(len(texts) + 1), whole)
        unused = next(c for c in map(chr, range(0x10000)) if c != SPACE and not pc.any(pc.match_substring(whole, c)).as_py())
        if "\n" not in self.alphabet:  # stands alone
            whole = pc.replace_substring(whole, "\n", f"{unused}\n{unused}")
        return pc.split_pattern(pc.replace_substring_regex(whole, f"([^{SPACE}]){SPACE}", f"\\1{unused}{SPACE}"), unused)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts of a slice in a row, and how many each has."""
        normal = list(map(self.library.normalize, texts))
        slices = np.flatnonzero(np.diff(np.cumsum(list(map(len, normal))) // SLICE_BYTES, prepend=-1))
        for lo, hi in pairwise([*slices.tolist(), len(normal)]):
            words = self._split(normal[lo:hi])
            coded = words.flatten().dictionary_encode()
            ids, end = common.gather(*self._chunks(coded.dictionary), coded.indices.to_numpy())
            size = np.diff(np.append(0, end)[words.offsets.to_numpy()])
            if not self.bytes:  # a run of unknown characters is one id
                text = np.repeat(np.arange(len(size)), size)
                keep = np.ones(len(ids), bool)
                keep[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown) | (text[1:] != text[:-1])
                ids, size = ids[keep], np.bincount(text[keep], minlength=len(size))
            yield ids, size


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """A worker's encoder, kept between its tasks."""
    return Encoder(path)


@lru_cache(1)
def library(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each row of ``docs(doc_id, text)`` under the model at ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_TEXTS):
                some = batch.slice(lo, SLICE_TEXTS)
                ids, size = zip(*model.encode([t or "" for t in some.column(1).to_pylist()]), strict=True)
                offsets = pa.array(np.cumsum(np.concatenate([[0], *size])), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).view(np.int32)))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``ids`` (null: none) replaced by the ``text`` they stand for."""
    kept = [f for f in tokens.schema.fields if f.name not in ("ids", "text")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "text string"])

    def start():
        text_of = library(path).decode

        def step(batch: pa.RecordBatch) -> dict:
            out = {f.name: batch.column(f.name) for f in kept}
            ids = batch.column("ids")
            size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
            ends, flat = np.cumsum(size), ids.flatten().to_numpy(zero_copy_only=False)
            return out | {"text": [text_of(flat[e - n : e].tolist()) for e, n in zip(ends, size, strict=True)]}

        return step

    return common.map_batches(tokens.select(*(f.name for f in kept), "ids"), start, schema)
