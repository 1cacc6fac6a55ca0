"""Corpus-wide totals of 64-bit keys, asked for by blocks of documents.

Documents are written once as blocks: one row holds the texts of some megabytes of documents,
compressed. A block asks for the totals of its distinct keys: the sorted keys are cut at fixed
bounds into shards, each slice one row with the block's own counts. A shard's slices meet in one
task, are summed, and every slice gets its totals back in its own order: as 32-bit numbers, with
the few larger ones in a list of exact 64-bit numbers beside them. So a key costs one
entry per block, however often a block holds it, and a task holds one shard or one block.

Sizes are parameters: ``BLOCK_BYTES`` of text and ``SHARD_KEYS`` keys. There is one row per block and shard, as
in a shuffle one segment per map and reduce task; larger executors take larger blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

from . import common

BLOCK_BYTES = 8 << 20
SHARD_KEYS = 1 << 20
_BLOCK = "block long, part int, doc_ids array<long>, flags array<int>, sizes array<int>, bytes long, texts binary"
_REQUEST = "kind int, shard int, block long, n int, keys binary, counts binary"
_REPLY = "kind int, shard int, block long, totals binary, large binary, distinct long, total long"
_MOST = 2**32 - 1  # of a 32-bit total; a larger one is in the list


class Blocks:
    """A written table of blocks and what is known of its size."""

    def __init__(self, table: DataFrame, text_bytes: int) -> None:
        self.table = table
        # a word and its separator take two bytes at least, six or more in most texts
        self.shards = max(1, -(-text_bytes // (6 * SHARD_KEYS)))


def write_blocks(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Blocks of ``docs(doc_id, text, flag, part)``; documents of one ``part`` (a small number) share blocks."""

    def run(batches):
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=1)
        first = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def flush(part: int) -> pa.RecordBatch:
            nonlocal first
            ids, flags, texts, size = held.pop(part)
            row = [[first], [part], [ids], [flags], [[-1 if t is None else len(t) for t in texts]], [size], [pack.compress(b"".join(t or b"" for t in texts))]]
            first += 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        schema = pa.schema([
            ("block", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("flags", pa.list_(pa.int32())),
            ("sizes", pa.list_(pa.int32())), ("bytes", pa.int64()), ("texts", pa.binary()),
        ])
        for batch in batches:
            ids, flags, parts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for key, text, flag, part in zip(ids, common.binary_list(batch.column(1)), flags, parts, strict=True):
                own = held.setdefault(part, [[], [], [], 0])
                own[0].append(key)
                own[1].append(flag)
                own[2].append(text)
                own[3] += len(text or b"") + 8
                if own[3] >= block_bytes:
                    yield flush(part)
        for part in sorted(held):
            yield flush(part)

    table = docs.select("doc_id", "text", "flag", "part").mapInArrow(run, _BLOCK)
    table, seen = materialize(table, name, observe=[F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")])
    return Blocks(table, seen["bytes"])


def texts_of(row: dict) -> Iterator[bytes]:
    """A block row's texts, null as empty."""
    raw = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["bytes"] else b""
    at = 0
    for n in row["sizes"]:
        yield raw[at : at + max(n, 0)]
        at += max(n, 0)


def _planes(values: np.ndarray) -> bytes:
    """First all first bytes, then all second ones: sorted or small numbers compress so."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _unplanes(raw: bytes, dtype: np.dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _bounds(shards: int) -> np.ndarray:
    """First key of each shard but the first."""
    return np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)


def request_rows(block: int, kind: int, keys: np.ndarray, counts: list[np.ndarray], shards: int) -> Iterator[tuple]:
    """Rows of ``_REQUEST`` for sorted distinct keys and 32-bit counts of theirs."""
    cuts = [0, *np.searchsorted(keys, _bounds(shards)).tolist(), len(keys)]
    for shard in range(shards):
        lo, hi = cuts[shard], cuts[shard + 1]
        if hi > lo:
            yield kind, shard, block, hi - lo, _planes(keys[lo:hi]), b"".join(_planes(c[lo:hi].astype("<u4")) for c in counts)


def table_of(rows: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _REQUEST.split(", ")]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


def requests(blocks: DataFrame, fn: Callable[[], Callable[[dict], Iterator[tuple]]]) -> DataFrame:
    """``fn()`` is built once per task and gives the request rows of a block row."""

    def run(batches):
        step = fn()
        for batch in batches:
            for row in batch.to_pylist():
                yield from table_of(step(row)).to_batches()

    return blocks.mapInArrow(run, _REQUEST)


def _large(sums: np.ndarray, own: np.ndarray, count: int) -> bytes:
    """``(count, place, total)`` of a slice's totals over 32 bits."""
    if sums.max(initial=0) <= _MOST:
        return b""
    at = np.flatnonzero(sums[own] > _MOST)
    return np.column_stack([np.full(len(at), count), at, sums[own[at]]]).astype("<i8").tobytes()


def totals(asked: DataFrame, n_counts: int) -> DataFrame:
    """The replies: each request's totals of every count, and once per shard and kind the number of
    distinct keys whose first count is not zero, and that count's total."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = np.concatenate([_unplanes(r["keys"], np.uint64) for r in rows])
        sizes = [r["n"] for r in rows]
        distinct, inverse = np.unique(keys, return_inverse=True)
        sums = []
        for c in range(n_counts):
            own = np.concatenate([_unplanes(r["counts"][c * 4 * r["n"] : (c + 1) * 4 * r["n"]], "<u4") for r in rows])
            sums.append(np.bincount(inverse, own, len(distinct)).astype("<i8"))  # exact up to 2**53
        back = [np.minimum(s, _MOST).astype("<u4")[inverse] for s in sums]
        ends = np.cumsum(sizes)
        raw = [b"".join(_planes(b[hi - n : hi]) for b in back) for n, hi in zip(sizes, ends, strict=True)]
        large = [b"".join(_large(s, inverse[hi - n : hi], c) for c, s in enumerate(sums)) for n, hi in zip(sizes, ends, strict=True)]
        zero = [0] * (len(rows) - 1)
        return pa.table({
            "kind": table.column("kind"), "shard": table.column("shard"), "block": table.column("block"),
            "totals": pa.array(raw, pa.binary()), "large": pa.array(large, pa.binary()),
            "distinct": pa.array([int((sums[0] > 0).sum()), *zero], pa.int64()),
            "total": pa.array([int(sums[0].sum()), *zero], pa.int64()),
        })

    return asked.groupBy("kind", "shard").applyInArrow(run, _REPLY)


def replies_of(replies: pa.Table, kind: int, n_counts: int) -> list[np.ndarray]:
    """Totals in the order of the block's sorted keys, one array per count."""
    rows = sorted((r for r in replies.to_pylist() if r["kind"] == kind), key=lambda r: r["shard"])
    out: list[list[np.ndarray]] = [[np.empty(0, "<i8")] for _ in range(n_counts)]
    for r in rows:
        n = len(r["totals"]) // (4 * n_counts)
        for c in range(n_counts):
            out[c].append(_unplanes(r["totals"][c * 4 * n : (c + 1) * 4 * n], "<u4").astype("<i8"))
        for c, at, total in np.frombuffer(r["large"], "<i8").reshape(-1, 3):
            out[c][-1][at] = total
    return [np.concatenate(x) for x in out]


def with_replies(blocks: DataFrame, replies: DataFrame, fn: Callable[[dict, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` of each block row and its replies; one block is in memory at a time."""
    replies = replies.join(blocks.select("block"), "block", "left_semi")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.to_pylist()[0], right)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
