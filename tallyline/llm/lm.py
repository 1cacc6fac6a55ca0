"""Language-model scores by deleted interpolation.

A word's probability after another mixes the bigram's maximum-likelihood estimate with a smoothed
unigram estimate. The weight depends on how often the context was seen (one bucket per power of two)
and is learned by expectation-maximisation on a part of the training documents that is
left out of the counts meanwhile; the scores then use the counts of all training documents.

Counts are kept by 64-bit hashes and looked up by blocks of documents (``exchange``), so the model is never in one
place; only the histogram that the weights are learned from, of fixed size, reaches the driver.

Defined cases: null or empty texts are an end token alone; a null ``train`` is no training; repeated rows
count as often as they stand there; without training documents every estimate is the
smoothed one over no counts; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_scope

from . import common, exchange

#: One in so many training documents teaches the weights.
PARTS = 8
BUCKETS = 40
#: Histogram bins per factor two of the ratio of estimates.
FINE = 16
_LIMIT = 64 * FINE
_END, _BEGIN, _ONE = (np.uint64(x) for x in (0x5EED0E4D00000001, 0x5EED0E4D00000002, 0x5EED0E4D00000003))
_TEXT, _PART = 1, 1  # the flag of a training document, the part that is left out
UNIGRAM, BIGRAM = 0, 1


class Grams:
    """A block's tokens: ``first`` marks each document's start in ``words`` and ``sizes`` its tokens."""

    def __init__(self, row: dict, hashes: common.WordHashes) -> None:
        found = [hashes.of(common.space_words(t)) for t in exchange.texts_of(row)]
        self.sizes = np.array([len(x) + 1 for x in found], np.int64)
        end = np.array([_END], np.uint64)
        self.words = np.concatenate([x for h in found for x in (h, end)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[self.starts] = _BEGIN
        self.before = before
        self.train = np.repeat(np.array(row["flags"]) == _TEXT, self.sizes)
        self.unigrams = common.mix(self.words, np.full(len(self.words), _ONE))
        self.bigrams = common.mix(before, self.words)

    def keys(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and every token's number among them."""
        return np.unique(self.unigrams if kind == UNIGRAM else self.bigrams, return_inverse=True)


def _ask(shards: int):
    def task():
        hashes = common.WordHashes()

        def step(row):
            grams = Grams(row, hashes)
            for kind in (UNIGRAM, BIGRAM):
                keys, inverse = grams.keys(kind)
                own = np.bincount(inverse[grams.train], minlength=len(keys))
                none = np.zeros(len(keys), np.int64)
                counts = [own, own if row["part"] == _PART else none]  # of all, and of the part left out
                yield from exchange.request_rows(row["block"], kind, keys, counts, shards)

        return step

    return task


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 0) + 1).astype(np.int64), BUCKETS - 1)


def _token_counts(grams: Grams, replies: pa.Table, left_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token the counts of its word, its context and both together."""
    per_kind = []
    for kind in (UNIGRAM, BIGRAM):
        every, apart = exchange.replies_of(replies, kind, 2)
        counts = every.astype(np.int64) - (apart if left_out else 0)
        _, inverse = grams.keys(kind)
        per_kind.append(counts[inverse])
    word, both = per_kind
    context = np.empty_like(word)
    context[1:] = word[:-1]
    # each document has one begin and one end
    ends = grams.starts + grams.sizes - 1
    context[grams.starts] = word[ends]
    return word, context, both


def _histogram(blocks: DataFrame, replies: DataFrame, n: int, v: int) -> DataFrame:
    def run(row: dict, own: pa.Table) -> pa.Table:
        grams = Grams(row, common.WordHashes())
        word, context, both = _token_counts(grams, own, True)
        smooth = (word + 1) / (n + v + 1)
        seen = context > 0
        ratio = np.full(len(word), -_LIMIT)
        hit = both > 0
        ratio[hit] = np.clip(np.floor(FINE * np.log2(both[hit] / context[hit] / smooth[hit])), 1 - _LIMIT, _LIMIT)
        cells, times = np.unique(_bucket(context[seen]) * 4 * _LIMIT + ratio[seen] + _LIMIT, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(times, pa.int64())})

    return exchange.with_replies(blocks, replies, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cells: list[tuple[int, int]], rounds: int = 100) -> np.ndarray:
    """A weight per bucket by expectation-maximisation over ``(cell, tokens)``."""
    weights = np.full(BUCKETS, 0.0)
    if not cells:
        return weights
    cell, n = np.array(cells, np.int64).T
    bucket, ratio = cell // (4 * _LIMIT), cell % (4 * _LIMIT) - _LIMIT
    odds = np.where(ratio == -_LIMIT, 0.0, 2.0 ** ((ratio + 0.5) / FINE))
    for b in np.unique(bucket):
        r, m, w = odds[bucket == b], n[bucket == b].astype(float), 0.5
        for _ in range(rounds):
            w = float((m * (w * r / (w * r + 1 - w))).sum() / m.sum())
            w = min(max(w, 1e-6), 1 - 1e-6)
        weights[b] = w
    return weights


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: tokens, base and model scores; the model learns where ``train`` holds."""
    spark = docs.sparkSession
    flag = F.coalesce(train, F.lit(False))
    part = F.when(flag & (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(PARTS)) == 0), _PART).otherwise(0)
    rows = docs.select("doc_id", "text", flag.cast("int").alias("flag"), part.cast("int").alias("part"))
    with scratch_scope(spark):
        blocks = exchange.write_blocks(rows, "lm-blocks")
        replies = materialize(exchange.totals(exchange.requests(blocks.table, _ask(blocks.shards)), 2), "lm-replies")
        size = replies.where(F.col("kind") == UNIGRAM).agg(F.sum("total"), F.sum("distinct")).first()
        n, v = size[0] or 0, size[1] or 0
        apart = blocks.table.where(F.col("part") == _PART)
        weights = learn_weights([tuple(r) for r in _histogram(apart, replies, n, v).collect()])

        def run(row: dict, own: pa.Table) -> pa.Table:
            grams = Grams(row, common.WordHashes())
            word, context, both = _token_counts(grams, own, False)
            smooth = (word + 1) / (n + v + 1)
            w = np.where(context > 0, weights[_bucket(context)], 0.0)
            mixed = w * both / np.maximum(context, 1) + (1 - w) * smooth
            add = lambda x: np.add.reduceat(x, grams.starts)
            return pa.table({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": pa.array(grams.sizes, pa.int64()),
                "n_known": pa.array(add((word > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(len(grams.sizes), n), pa.int64()),
                "base_score": pa.array(add(np.log10(smooth)), pa.float64()),
                "score": pa.array(add(np.log10(mixed)), pa.float64()),
            })

        schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return materialize(exchange.with_replies(blocks.table, replies, run, schema), "lm-scores", keep=True)
