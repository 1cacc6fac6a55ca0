"""Interaction audit of quality filters: what each removes, in every order of application.

With ``n`` filters (at most five) a document survives a subset of them if it fails none in it. Its
truth table over all subsets is a word of ``2**n`` bits, so the number of survivors of every
subset is a positional popcount: the sum of each bit over all words. Tasks add words up with
carry-save adders (three words of one weight become one of that weight and one of twice it, for
all bits, and for the groups of a batch, at once), and emit one row of counts per part and
batch; Spark adds these. From the counts of 32 subsets all 120 orders follow, without a further look at
the documents.

Defined cases: null text is an empty text and null ``source`` the empty part; a row without
``doc_id`` is nobody's copy and has no labels; a row that stands several times counts as often, and is
not a copy of itself; a document with several label rows has a label if one of them says so; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

from . import common

FILTERS = "ABCDE"
LABELS = ("good", "toxic")

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point
_SYMBOLS = b"#$%&*|"


def text_failures(text: bytes | None) -> int:
    """Bits 0 to 3: under 200 words; under half of the words distinct; over 2 % capitals; a symbol."""
    text = text or b""
    words = text.split()
    chars = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 2 * chars) << 2
        | (symbols > 0) << 3
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``fails`` (bit i: filter i of ABCDE), ``good``, ``toxic`` and ``n``, the number of such rows.

    Filter E fails texts that equal one of a smaller ``doc_id``, by their SHA-256. Equal rows are one before
    anything is joined, and the first of a group of copies is found by an equality join on
    text and id, so a large group is in no task's hands.
    """

    def step(batch: pa.RecordBatch) -> dict:
        texts = common.binary_list(batch.column(2))
        return {
            "doc_id": batch.column(0), "part": batch.column(1),
            "text_key": [hashlib.sha256(t or b"").digest() for t in texts], "fails": [text_failures(t) for t in texts],
        }

    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    judged = common.map_batches(rows, lambda: step, "doc_id long, part string, text_key binary, fails int")
    judged = materialize(judged.groupBy(*judged.columns).agg(F.count("*").alias("n")), "audit-judged")
    first = judged.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    told = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic"))
    return (
        judged.join(first.withColumn("is_first", F.lit(True)), ["text_key", "doc_id"], "left")
        .select("doc_id", "part", (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("fails"), "n")
        .join(told, "doc_id", "left")
        .select("part", "fails", *(F.coalesce(c, F.lit(False)).alias(c) for c in LABELS), "n")
    )


def truth_words(filters: int) -> np.ndarray:
    """For each set of failed filters the word whose bit ``s`` says that subset ``s`` lets it live."""
    subsets = np.arange(1 << filters)
    alive = (subsets[:, None] & subsets[None, :]) == 0
    return (alive * (np.uint64(1) << subsets.astype(np.uint64))).sum(axis=1).astype(np.uint32)


def positional_popcount(words: np.ndarray, times: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """How often each of 32 bits is set in the words of each group, a word counting ``times``."""
    counts = np.zeros((groups, 32), np.int64)
    bits = int(times.max(initial=0)).bit_length()
    levels = [[(words[m], group[m])] for m in ((times >> k & 1).astype(bool) for k in range(bits))]
    k = 0
    while k < len(levels):
        w, g = (np.concatenate(x) for x in zip(*levels[k], strict=True))
        carries = []
        while len(w):
            order = np.argsort(g, kind="stable")
            w, g = w[order], g[order]
            size = np.bincount(g, minlength=groups)
            rank = np.arange(len(g)) - (np.cumsum(size) - size)[g]
            third = rank // 3 * 3 + 2 < size[g]  # belongs to a whole triple of its group
            if not third.any():
                break
            a, b, c = w[third].reshape(-1, 3).T
            own = g[third][::3]
            carries.append(((a & b) | ((a ^ b) & c), own))
            w, g = np.concatenate([a ^ b ^ c, w[~third]]), np.concatenate([own, g[~third]])
        np.add.at(counts, g, (w[:, None] >> np.arange(32, dtype=np.uint32) & 1).astype(np.int64) << k)
        if carries:
            if k + 1 == len(levels):
                levels.append([])
            levels[k + 1] += carries
        k += 1
    return counts


def survivors(judged: DataFrame, filters: int = 5, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """``part`` and, for all rows and those of each label, the survivors of every subset of filters:
    ``everyone`` and one column per label, arrays indexed by the subset's bits."""
    table = truth_words(filters)
    names = ["everyone", *labels]

    def step(batch: pa.RecordBatch) -> dict:
        parts = batch.column(0).dictionary_encode()
        part = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = table[batch.column(1).to_numpy(zero_copy_only=False)]
        times = batch.column(2).to_numpy(zero_copy_only=False)
        kinds = [np.ones(len(part), bool), *(batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(labels)))]
        where = [np.flatnonzero(x) for x in kinds]
        group = np.concatenate([part[i] * len(kinds) + k for k, i in enumerate(where)])
        rows = np.concatenate(where)
        counts = positional_popcount(words[rows], times[rows], group, len(parts.dictionary) * len(kinds))
        return {"part": parts.dictionary} | {n: list(counts[k :: len(kinds)]) for k, n in enumerate(names)}

    schema = ", ".join(["part string", *(f"{n} array<long>" for n in names)])
    counted = common.map_batches(judged.select("part", "fails", "n", *labels), lambda: step, schema)
    subsets = range(1 << filters)
    return counted.groupBy("part").agg(*(F.array(*(F.sum(F.col(n)[s]) for s in subsets)).alias(n) for n in names))


def _shapley(j: int, filters: int) -> Column:
    """Filter ``j``'s removed rows, summed over all orders: those in which just ``s`` came before it."""
    total = F.lit(0).cast("long")
    for s in range(1 << filters):
        if not s >> j & 1:
            orders = factorial(s.bit_count()) * factorial(filters - 1 - s.bit_count())
            total = total + orders * (F.col("everyone")[s] - F.col("everyone")[s | 1 << j])
    return total


def interactions(judged: DataFrame, names: str = FILTERS, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """One row per part, order of the filters (named by one letter each) and step, zeros included."""
    n = len(names)
    if not 0 < n <= 5:
        raise ValueError("one to five filters")
    counts = survivors(judged, n, labels).withColumn("by_filter", F.array(*(_shapley(j, n) for j in range(n))))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(names)))
    index = [F.expr(f"locate(substring(filter_order, {k + 1}, 1), '{names}') - 1") for k in range(n)]
    bits = [F.expr(f"shiftleft(1, locate(substring(filter_order, {k + 1}, 1), '{names}') - 1)") for k in range(n)]
    none = F.lit(0)
    steps = F.array(
        *(
            F.struct(
                F.lit(k + 1).alias("step"), index[k].alias("j"), bits[k].alias("bit"),
                sum(bits[:k], none).alias("before"), sum(bits[: k + 1], none).alias("after"),
            )
            for k in range(n)
        )
    )
    lost = lambda name: F.col(name)[F.col("s.before")] - F.col(name)[F.col("s.after")]
    alone = F.col("everyone")[(1 << n) - 1 - F.col("s.bit")] - F.col("everyone")[(1 << n) - 1]
    return (
        counts.withColumn("filter_order", F.explode(orders))
        .withColumn("s", F.explode(steps))
        .select(
            "part", "filter_order", "s.step", F.col("everyone")[F.col("s.after")].alias("kept"), lost("everyone").alias("removed"),
            (F.col("everyone")[0] - F.col("everyone")[F.col("s.bit")] - lost("everyone")).alias("redundant"),
            alone.alias("unique_fails"), *(lost(c).alias(f"{c}_lost") for c in labels), F.col("by_filter")[F.col("s.j")].alias("shapley"),
        )
    )
