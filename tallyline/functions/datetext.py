"""Free-format timestamps as one native expression (pure ``Column -> Column``).

A text is split into a clock (``15:15:00.5``, ``3:15 pm``, ``3 PM``, with an optional zone) and
what is left, the date, whose tokens are numbers and month names in any order:

- With a month name, the four-digit number is the year; of two short ones the first is the day, unless it is over 31, and
  before a name at the end the first is the year, unless the second is over 31.
- Three numbers: year first if the first has four digits or is over 31, day first if it is over 12, else month, day, year.
- One number of 8 digits is ``yyyymmdd``, of 12 or 14 with the time; 8 digits may be followed by 4 or 6 of time.

Years of two digits lie in the hundred years from ``S.TWO_DIGIT_YEARS_FROM`` on. Weekday names, ordinal endings and
joining words carry nothing. An offset counts from UTC; right after the words UTC or GMT its sign is turned
round, as POSIX zones have it. NULL for everything else: an unknown word, a date without day, month
or year (nothing is filled from the day of the run), two clocks, a day or hour that does not exist, blank and NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import schemas as S

_CLOCK = (
    r"(?<![\d.:])(?:(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,9}))?)?(?:\s*([ap])\.?m\b\.?)?|(\d{1,2})\s*([ap])\.?m\b\.?)"
    r"\s*(z\b|utc\b|gmt\b)?\s*(?:([+-])(?:(\d{1,2}):(\d{2})|(\d{2})(\d{2})|(\d{1,2})))?(?![\d:.])"
)
_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m != "september" else "sep(?:t|tember)?" for m in S.MONTH_NAMES)
_WEEKDAY = "|".join(f"{d[:3]}(?:{d[3:]})?" for d in S.WEEKDAY_NAMES)
# what a date part is made of, one after another: numbers with ordinal endings, names, joining words, marks
_DATE_PIECE = rf"\G(?:\d+(?:st|nd|rd|th)?(?![a-z])|\d+(?={_MONTH}|t(?![a-z]))|(?:{_MONTH}|{_WEEKDAY}|at|on|of|and|t)(?![a-z])|[\s,./;-])"
_TOKEN = r"\d+|" + "|".join(m[:3] for m in S.MONTH_NAMES)
_NUMBER = r"^\d+$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, whatever ``body`` repeats."""
    return F.transform(F.array(value), body).getItem(0)


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _clock(text: Column) -> Column:
    """``struct(h, mi, s, offset)`` of the text's clock; seconds with fraction, offset in minutes."""
    g = lambda i: F.regexp_extract(text, _CLOCK, i)
    half = F.concat(g(5), g(7))
    raw = _int(F.concat(g(1), g(6)))
    hour = F.when(half == "", raw).when(raw.between(0, 12), raw % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.when(g(3) == "", F.lit("0")).otherwise(F.concat(g(3), F.lit("."), F.substring(F.rpad(g(4), 6, "0"), 1, 6)))
    minutes = _int(F.concat(F.lit("0"), g(10), g(12), g(14))) * 60 + _int(F.concat(F.lit("0"), g(11), g(13)))
    turned = g(8).isin("utc", "gmt")
    sign = F.when((g(9) == "-") != turned, -1).otherwise(1)
    return F.struct(
        hour.alias("h"),
        F.coalesce(_int(g(2)), F.lit(0)).alias("mi"),
        second.try_cast("decimal(16,6)").alias("s"),
        F.when(minutes < 24 * 60, sign * minutes).alias("offset"),
    )


def _year(text: Column) -> Column:
    """Two digits by the window of a hundred years, four as they are; NULL otherwise."""
    n, start = _int(text), S.TWO_DIGIT_YEARS_FROM
    near = n + start // 100 * 100 + F.when(n < start % 100, 100).otherwise(0)
    return F.when(F.length(text) <= 2, near).when(F.length(text) == 4, n)


def _ymd(tokens: Column) -> Column:
    """Three date tokens as ``struct(y, m, d)`` of texts, the month's name as its number."""
    month = F.coalesce(*[F.when(F.array_contains(tokens, m[:3]), F.lit(str(i + 1))) for i, m in enumerate(S.MONTH_NAMES)])
    at = lambda a, i: F.get(a, F.lit(i))
    slots = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
    is_year = lambda t: (F.length(t) == 4) | (_int(t) > 31)
    a, b, c = at(tokens, 0), at(tokens, 1), at(tokens, 2)

    def named(numbers: Column) -> Column:
        n, p = at(numbers, 0), at(numbers, 1)
        # the name last: year, day unless the second is over 31; else day, year unless the first is
        year_first = F.when(F.length(n) == 4, True).when(F.length(p) == 4, False)
        year_first = year_first.when(a.rlike(_NUMBER) & b.rlike(_NUMBER), _int(p) <= 31).otherwise(_int(n) > 31)
        return F.when(F.size(numbers) == 2, F.when(year_first, slots(n, month, p)).otherwise(slots(p, month, n)))

    numeric = F.when(is_year(a), slots(a, b, c)).when(_int(a) > 12, slots(c, b, a)).otherwise(slots(c, a, b))
    return F.when(month.isNotNull(), _let(F.filter(tokens, lambda t: t.rlike(_NUMBER)), named)).otherwise(numeric)


def _compact(digits: Column) -> Column:
    """``yyyymmddhhmmss`` digits, padded with zeros, as ISO text."""
    part = lambda start, n: F.substring(digits, start, n)
    return F.concat(
        part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2)
    )


def parse_free_timestamp(c: Column) -> Column:
    """Timestamp of a free-format text by the grammar above (UTC); NULL if it does not fit."""
    text = F.lower(F.trim(c.cast("string")))
    clocks = F.regexp_count(text, F.lit(_CLOCK))
    rest = F.when(clocks <= 1, F.trim(F.regexp_replace(text, _CLOCK, " ")))
    tokens = F.when(F.regexp_replace(rest, _DATE_PIECE, "") == "", F.regexp_extract_all(rest, F.lit(_TOKEN), F.lit(0)))
    parts = F.struct(tokens.alias("tokens"), F.when(clocks == 1, _clock(text)).alias("clock"))

    def whole(p: Column) -> Column:
        tokens, clock = p["tokens"], p["clock"]
        digits = F.array_join(tokens, "")
        lengths = F.transform(tokens, F.length)
        with_time = clock.isNull() & lengths.isin(*[F.array(*map(F.lit, x)) for x in ([12], [14], [8, 4], [8, 6])])
        day_only = lengths == F.array(F.lit(8))

        def dated(d: Column) -> Column:
            zero = F.lit(0)
            second = F.coalesce(clock["s"], F.lit(0).cast("decimal(16,6)"))
            ok = clock.isNull() | (clock["h"].between(0, 23) & clock["mi"].between(0, 59) & (second < 60) & clock["offset"].isNotNull())
            ts = F.try_make_timestamp(_year(d["y"]), _short(d["m"]), _short(d["d"]), F.coalesce(clock["h"], zero), F.coalesce(clock["mi"], zero), second)
            return F.when(ok, F.timestamp_micros(F.unix_micros(ts) - F.coalesce(clock["offset"], zero).cast("long") * 60_000_000))

        def fixed() -> Column:
            day = F.struct(F.substring(digits, 1, 4).alias("y"), F.substring(digits, 5, 2).alias("m"), F.substring(digits, 7, 2).alias("d"))
            return F.when(day_only, day).when(F.size(tokens) == 3, _ymd(tokens))

        iso = F.when(with_time & digits.rlike(_NUMBER), F.try_to_timestamp(_compact(F.rpad(digits, 14, "0"))))
        return F.coalesce(iso, _let(fixed(), dated))

    return _let(parts, whole)


def _short(text: Column) -> Column:
    """A day or month of one or two digits; NULL otherwise."""
    return F.when(F.length(text) <= 2, _int(text))
