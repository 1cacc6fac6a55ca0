"""Helpers shared by the text operators: word splitting, hashing, columnar task output."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words a worker keeps hashed; the cache is emptied when it is full.
CACHED_WORDS = 1 << 18
#: Rows passed to Python at a time, at most.
BATCH_ROWS = 4000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_S29, _S32, _S31 = np.uint64(29), np.uint64(32), np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: bytes | None, lower: bool = True) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes; ``bytes.split`` and ``bytes.lower``
    know exactly these six separators and the letters A-Z."""
    if not text:
        return []
    return (text.lower() if lower else text).split()


#: Maps A-Z to a-z and every ASCII byte that is no letter or digit to a space.
ALNUM = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20) for b in range(256)
)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes."""
    return text.translate(ALNUM).split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembering a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ordered pairs of 64-bit values."""
    x = a * _M1 + ((b << _S31) | (b >> np.uint64(33))) * _M2
    x ^= x >> _S29
    x *= _M3
    x ^= x >> _S32
    return x


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values (one array entry per start)."""
    if len(h) < size:
        return h[:0]
    span, out = 1, h
    while span * 2 <= size:
        out = mix(out[:-span], out[span:])
        span *= 2
    if span < size:
        rest = size - span
        out = mix(out[:-rest], out[rest:])
    return mix(out, np.full(len(out), size, np.uint64))


def binary_list(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column's UTF-8 bytes, one object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.string()).cast(pa.binary()).to_pylist()


def small_batches(spark: SparkSession) -> None:
    """Let the session pass rows to Python ``BATCH_ROWS`` at a time, if it passes more: texts are long, and a
    worker holds several copies of a batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def map_batches(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task function: ``fn()`` builds it once per task, each
    batch gives a dict of columns in the order of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            if batch.num_rows and (out := step(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
                del out
        del step
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def gather(table: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``code`` of a table of consecutive runs of ``size``, one after another, and their ends."""
    length = size[code]
    end = np.cumsum(length)
    shift = (np.cumsum(size) - size)[code] - (end - length)
    return table[np.repeat(shift, length) + np.arange(int(end[-1]) if len(end) else 0)], end


class Learned:
    """Distinct words a worker has met, their ids in a row, and how many each has; all is forgotten when
    there are more than ``room``."""

    def __init__(self, room: int) -> None:
        self.room = room
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def places(self, distinct: pa.Array, encoders: list[tuple[np.ndarray, Callable]]) -> np.ndarray:
        """Where distinct words stand, after the new ones were learned. Each encoder has a mask of its words, takes
        a list of them and yields arrays of ids and of numbers of ids."""
        if len(self.words) > self.room:
            self.forget()
        place = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy().astype(np.int64)
        for those, encode in encoders:
            at = np.flatnonzero(those & (place < 0))
            some = distinct.take(pa.array(at))
            place[at] = len(self.words) + np.arange(len(at))
            got = list(encode(some.to_pylist()))
            self.words = pa.concat_arrays([self.words, some])
            self.ids = np.concatenate([self.ids, *(g[0] for g in got)])
            self.size = np.concatenate([self.size, *(g[1] for g in got)])
        return place
