"""Document quality by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document's counts. All documents' vote
patterns are counted by Spark (at most ``3 ** len(rules())`` of them), a two-class model of
each rule's vote rates is fitted to these counts by expectation-maximisation, and every
pattern's posterior probability of being good is joined back. The counts per document are
written once to the checkpoint folder, so that texts are read once.

Defined cases: null or empty texts have no words and count zero everywhere; a line is compared
unchanged; repeated rows are judged one by one; an empty table gives no rows; other input
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

from . import common

_SPACE = b" \t\n\x0b\x0c\r"
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))  # separators, and bytes that continue a code point
_SYMBOLS = b"#*$%&|<>"
_DIGITS = b"0123456789"
_ENDS = (b".", b"!", b"?", b'"', b":", b";")

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_digits", "n_ended_lines",
    "n_marked_words",
)


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column


def rules() -> list[Rule]:
    words, repeats = F.col("n_words"), _ratio("n_repeat_words", "n_words")
    shares, marked = _ratio("n_symbols", "word_chars"), _ratio("n_marked_words", "n_words")
    symbols, copies = _ratio("n_symbols", "n_words"), _ratio("n_dup_lines", "n_lines")
    length, variety = _ratio("word_chars", "n_words"), _ratio("n_distinct_words", "n_words")
    digits, ended = _ratio("n_digits", "word_chars"), _ratio("n_ended_lines", "n_lines")
    return [
        Rule("long_enough", words < 30, words >= 60),
        Rule("repeated_words", repeats > 0.3, repeats < 0.1),
        Rule("symbols", symbols > 0.2, symbols < 0.05),
        Rule("symbol_share", shares > 0.04, shares < 0.01),
        Rule("marked_words", marked > 0.1, marked < 0.03),
        Rule("repeated_lines", (copies > 0.3) & (F.col("n_dup_lines") >= 3), copies < 0.1),
        Rule("word_length", (length < 2) | (length > 12), (length >= 3) & (length <= 10)),
        Rule("variety", variety < 0.1, variety > 0.25),
        Rule("digits", digits > 0.2, F.lit(False)),
        Rule("ended_lines", ended < 0.1, ended > 0.6),
    ]


def counts_of(text: bytes | None, hashes: common.WordHashes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    h = hashes.of(words)
    n_repeat = 0
    if len(h) >= 4:
        h3 = common.windows(h, 3)
        _, inverse, times = np.unique(h3, return_inverse=True, return_counts=True)
        if len(times) < len(h3):
            again = times[inverse] > 1
            cover = np.zeros(len(h), bool)
            for k in range(3):
                cover[k : k + len(again)] |= again
            n_repeat = int(cover.sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_chars = len(text.translate(None, _NOT_COUNTED))
    n_symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return (
        len(words),
        n_chars,
        n_symbols,
        len(lines) - len(set(lines)),
        n_repeat,
        len(lines),
        len(set(words)),
        len(text) - len(text.translate(None, _DIGITS)),
        sum(x.rstrip().endswith(_ENDS) for x in lines),
        sum(len(w.translate(None, _SYMBOLS)) < len(w) for w in words) if n_symbols else 0,
    )


def counts(docs: DataFrame) -> DataFrame:
    def task():
        hashes = common.WordHashes()

        def step(batch):
            got = [counts_of(t, hashes) for t in common.binary_list(batch.column(1))]
            return {"doc_id": batch.column(0), **dict(zip(COUNTS, zip(*got, strict=True), strict=True))}

        return step

    return common.map_batches(docs.select("doc_id", "text"), task, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Posterior probability of good per vote pattern, and each rule's vote rates.

    ``patterns`` are (votes, number of documents). Rates are ``[class, rule, vote + 1]`` with
    class 1 good; they start from rules that are right more often than not, which fixes
    which class is which, and are smoothed by one count per vote.
    """
    if not patterns:
        return {}, np.zeros((2, 0, 3))
    votes = np.array([p for p, _ in patterns]) + 1
    weight = np.array([n for _, n in patterns], float)
    n_rules = votes.shape[1]
    share = np.stack([(weight[:, None] * (votes == v)).sum(0) / weight.sum() for v in range(3)], 1) + 1e-3
    rates = np.stack([share * [3, 1, 1 / 3], share * [1 / 3, 1, 3]])
    rates /= rates.sum(2, keepdims=True)
    prior = 0.7
    post = np.zeros(len(weight))
    for _ in range(rounds):
        log = np.log(rates[:, np.arange(n_rules), votes]).sum(2)
        odds = log[1] - log[0] + np.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
        prior = float(np.clip((weight * post).sum() / weight.sum(), 0.01, 0.99))
        for c, w in ((0, weight * (1 - post)), (1, weight * post)):
            n = np.stack([(w[:, None] * (votes == v)).sum(0) for v in range(3)], 1) + 1
            rates[c] = n / n.sum(1, keepdims=True)
    return {p: float(x) for (p, _), x in zip(patterns, post, strict=True)}, rates


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: its counts, ``posterior`` and ``good``."""
    spark = docs.sparkSession
    own = rules()
    pattern = F.array(*[F.when(r.bad, -1).when(r.good, 1).otherwise(0).cast("byte") for r in own])
    held = materialize(counts(docs).withColumn("votes", pattern), "quality-counts")
    seen = [(tuple(r["votes"]), r["n"]) for r in held.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    posterior, _ = fit(sorted(seen))
    # at most 3 ** len(rules()) rows
    table = spark.createDataFrame([(list(p), x) for p, x in posterior.items()], "votes array<byte>, posterior double")
    return held.join(F.broadcast(table), "votes").withColumn("good", F.col("posterior") >= threshold)
