"""Personal data by anchor expansion.

An Aho-Corasick automaton over a fixed set of anchors (at-signs, ``://``, plus and digit pairs,
identifier cues) is run once over each text. At an anchor a deterministic parser of that kind
expands to the left and right, validates the candidate and consumes it; nothing is retried.
Narrow per-row work: no shuffle.

Kinds: ``email``, ``ip``, ``card`` (16 to 19 digits, Luhn), ``phone`` (``+``, 8 to 15 digits); the
method adds ``login`` (``scheme://user:password@host``) and ``account`` (the value after a cue such
as ``password=`` or ``iban:``; 8 characters or more, with a digit).

Defined cases: null text is empty; spans of one kind never overlap, those of different kinds
may; positions count code points, the end exclusive; a text may hold any number of spans;
repeated rows are judged one by one; other columns are ignored (``redact`` passes them through).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import common
from .decontam import _ddl

KINDS = ("email", "ip", "card", "phone", "account", "login")
BASE = KINDS[:4]
#: Words that announce an identifier; the value follows a colon, an equals sign or "is".
CUES = ("password", "passwd", "pwd", "secret", "token", "api key", "api_key", "apikey", "iban", "ssn", "account", "passport")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_VALUE = re.compile(r"[ \t]?(?:number|no\.?)?[ \t]*(?:[:=]|is[ \t])[ \t]*[\"']?([A-Za-z0-9][A-Za-z0-9_\-+/]{7,})")
_LOGIN = re.compile(r"[^\s:/@]+:[^\s/@]+@[A-Za-z0-9.-]+")
_DIGITS = "0123456789"


def anchors():
    """The automaton; values are ``(kind, length)``."""
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("://", ("login", 3))
    for d in _DIGITS:
        a.add_word(f"+{d}", ("phone", 2))
        a.add_word(f"{d}.", ("ip", 2))
        for e in _DIGITS:
            for between in ("", " ", "-"):
                a.add_word(d + between + e, ("card", 2 + len(between)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            a.add_word(form, ("account", len(form)))
    a.make_automaton()
    return a


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _email(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    host = _HOST.match(text, end)
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return (start, host.end(), True) if host and start < at else None


def _ip(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    start = at
    while start > floor and text[start - 1] in _DIGITS:
        start -= 1
    m = _IP.match(text, start)
    if not m:
        return None
    parts = [p.lstrip("0") for p in m.group().split(".")]
    return start, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    m = _CARD.match(text, at)
    digits = m.group().replace(" ", "").replace("-", "")
    return at, m.end(), 16 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    m = _PHONE.match(text, at)
    return (at, m.end(), 8 <= sum(c in _DIGITS for c in m.group()) <= 15) if m else None


def _account(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    m = _VALUE.match(text, end)
    return (*m.span(1), any(c in _DIGITS for c in m.group(1))) if m else None


def _login(text: str, at: int, end: int, floor: int) -> tuple[int, int, bool] | None:
    start = at
    while start > floor and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    m = _LOGIN.match(text, end)
    return (start, m.end(), True) if m and start < at else None


#: parser(text, anchor start, anchor end, end of the last candidate) -> (start, end, valid) or None
PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "account": _account, "login": _login}


def spans_of(automaton, text: str | None) -> list[tuple[str, int, int]]:
    """Valid spans, by kind as listed and then by start."""
    if not text:
        return []
    floor = dict.fromkeys(KINDS, 0)
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    for last, (kind, n) in automaton.iter(text):
        at = last + 1 - n
        if at < floor[kind]:
            continue
        got = PARSERS[kind](text, at, last + 1, floor[kind])
        if got:
            start, end, valid = got
            floor[kind] = end
            if valid:
                found[kind].append((kind, start, end))
    return [s for k in KINDS for s in found[k]]


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` its spans as ``array<struct<kind,start,end>>``."""

    def task():
        automaton = anchors()

        def step(batch):
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(automaton, t)] for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0), "spans": spans}

        return step

    return common.map_batches(docs.select("doc_id", "text"), task, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""

    def task():
        automaton = anchors()

        def step(batch):
            found = [spans_of(automaton, t) for t in batch.column(1).to_pylist()]
            out = {"doc_id": batch.column(0)}
            for k in KINDS:
                out[f"n_{k}"] = [sum(s[0] == k for s in x) for x in found]
            base = [joined([s for s in x if s[0] in BASE]) for x in found]
            out["base_sha256"] = [hashlib.sha256(x.encode()).hexdigest() for x in base]
            out["spans"] = [joined(x) for x in found]
            return out

        return step

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return common.map_batches(docs.select("doc_id", "text"), task, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each stretch of spans replaced by its first span's kind in brackets."""
    names = docs.columns
    at = names.index("text")

    def task():
        automaton = anchors()

        def one(text):
            if text is None:
                return None
            kept, done = [], 0
            for kind, a, b in sorted(spans_of(automaton, text), key=lambda s: (s[1], -s[2])):
                if a >= done:
                    kept.append(f"{text[done:a]}[{kind.upper()}]")
                done = max(done, b)
            return "".join(kept) + text[done:]

        def step(batch):
            out = {n: batch.column(i) for i, n in enumerate(names)}
            out["text"] = [one(t) for t in batch.column(at).to_pylist()]
            return out

        return step

    out = common.map_batches(docs, task, _ddl(docs.schema))
    if "n_chars" in names and isinstance(docs.schema["n_chars"].dataType, LongType):
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out
