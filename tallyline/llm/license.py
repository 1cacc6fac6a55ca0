"""Licence scan by a positional index of rare words, with DataFrame functions only.

The index is built from fixed notices. A word's inverse notice frequency says how rare it
is; each notice is posted under its rarest words, with their positions. In a file only words
of the index are looked up: an occurrence minus a posting's position places the notice
in the file. Words around that place are compared, and a placed notice counts only where
its mandatory phrase stands word for word. One pass over the texts, no shuffle.

Defined cases: null text is empty; a file without a verified notice has no labels, score 0 and
null positions; overlapping places all count; repeated rows are judged one by one; an empty
table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base phrases and their labels.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Wording of public licence notices as (label, words, mandatory phrase).
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("public-domain", "free and unencumbered software released into the public domain", "public domain"),
)

#: How many of a notice's rarest words it is posted under, at least one of them in its phrase.
POSTED = 3
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def index(base=BASE, notices=NOTICES) -> tuple[list[dict], dict[str, list[tuple[int, int]]]]:
    """The notices with their words' weights, and word -> (notice, position in it)."""
    entries = [{"label": label, "words": phrase.split(), "phrase": phrase, "base": True} for phrase, label in base]
    entries += [{"label": label, "words": words.split(), "phrase": phrase, "base": False} for label, words, phrase in notices]
    df: dict[str, int] = {}
    for e in entries:
        for w in set(e["words"]):
            df[w] = df.get(w, 0) + 1
    postings: dict[str, list[tuple[int, int]]] = {}
    for n, e in enumerate(entries):
        e["weights"] = [math.log(1 + len(entries) / df[w]) for w in e["words"]]
        phrase = e["phrase"].split()
        e["at"] = next(i for i in range(len(e["words"])) if e["words"][i : i + len(phrase)] == phrase)
        inside = range(e["at"], e["at"] + len(phrase))
        by_rarity = sorted(range(len(e["words"])), key=lambda i: (-e["weights"][i], i))  # noqa: B023
        # a phrase's own rarest word finds every place of the phrase
        chosen = {next(i for i in by_rarity if i in inside)}
        if not e["base"]:
            chosen |= set(by_rarity[:POSTED])
        for i in sorted(chosen):
            postings.setdefault(e["words"][i], []).append((n, i))
    return entries, postings


def _literal(entries: list[dict], postings: dict[str, list[tuple[int, int]]]) -> tuple[Column, Column]:
    notices = F.array(
        *[
            F.struct(
                F.lit(e["label"]).alias("label"),
                F.lit(e["base"]).alias("base"),
                F.lit(e["phrase"]).alias("phrase"),
                F.lit(len(e["phrase"].split())).alias("phrase_words"),
                F.lit(e["at"]).alias("at"),
                F.array(*map(F.lit, e["words"])).alias("words"),
                F.array(*map(F.lit, e["weights"])).alias("weights"),
                F.lit(sum(e["weights"])).alias("total"),
            )
            for e in entries
        ]
    )
    pairs = []
    for word, places in sorted(postings.items()):
        pairs += [F.lit(word), F.array(*[F.struct(F.lit(n).alias("notice"), F.lit(i).alias("at")) for n, i in places])]
    return notices, F.create_map(*pairs)


def scan(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_words`` and ``found``, the verified notices as an array of
    ``struct<label,base,start,score>``, ``start`` being the phrase's first word and ``score`` the
    share of the notice's weight that stands in place."""
    entries, postings = index(base, notices)
    table, lookup = _literal(entries, postings)
    rare = F.array(*map(F.lit, sorted(postings)))
    likely = F.col("text").rlike(r"(?i)(?<![0-9A-Za-z])(?:" + "|".join(sorted(postings)) + r")(?![0-9A-Za-z])")
    lowered = F.translate("text", _UPPER, _LOWER)
    words = F.split(F.trim(F.regexp_replace(lowered, _NOT_WORD, " ")), " ")

    placed = F.array_distinct(
        F.flatten(
            F.transform(
                F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda o: F.array_contains(rare, o["word"])),
                lambda o: F.transform(F.element_at(lookup, o["word"]), lambda p: F.struct(p["notice"].alias("notice"), (o["i"] - p["at"]).alias("start"))),
            )
        )
    )

    def verified(p: Column) -> Column:
        notice = F.element_at(table, p["notice"] + 1)
        first = p["start"] + notice["at"]
        there = F.array_join(F.slice("words", F.greatest(first, F.lit(0)) + 1, notice["phrase_words"]), " ")
        return (first >= 0) & (there == notice["phrase"])

    def scored(p: Column) -> Column:
        notice = F.element_at(table, p["notice"] + 1)
        there = lambda w, i: F.coalesce(F.get("words", p["start"] + i) == w, F.lit(False))
        shares = F.transform(notice["words"], lambda w, i: F.when(there(w, i), F.get(notice["weights"], i)).otherwise(0.0))
        return F.struct(
            notice["label"].alias("label"),
            notice["base"].alias("base"),
            (p["start"] + notice["at"]).cast("long").alias("start"),
            F.least(F.lit(1.0), F.aggregate(shares, F.lit(0.0), lambda a, x: a + x) / notice["total"]).alias("score"),
        )

    none = F.array().cast("array<struct<label:string,base:boolean,start:bigint,score:double>>")
    found = F.when(F.col("words").isNull(), none).otherwise(F.transform(F.filter(placed, verified), scored))
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select(
            "doc_id",
            F.regexp_count("text", F.lit(_ANY_WORD)).cast("long").alias("n_words"),
            F.when(likely, words).alias("words"),
        )
        .select("doc_id", "n_words", found.alias("found"))
    )
