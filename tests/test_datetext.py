"""The free-format timestamp grammar against the date parser of dateutil, which it follows for whole dates."""

import datetime as dt
import itertools

import pytest
from dateutil import parser
from pyspark.sql import functions as F

from tallyline.functions.datetext import parse_free_timestamp
from tallyline.functions.timefns import parse_timestamp

DATES = [
    "5 Mar 2024", "Mar 5 2024", "March 5, 2024", "2024 Mar 5", "2024 5 Mar", "05-Mar-24", "24 Mar 99", "99 Mar 24", "Mar 99 24", "Mar 5 24",
    "01 99 Jan", "99 01 Jan", "10 11 Jan", "5.3.2024", "13.3.2024", "5.3.24", "3/5/24", "24.3.5", "2024.3.5", "2024-03-05", "20240305",
    "Tue, 5 Mar 2024", "Tuesday 5th of March 2024", "Sept 1st, 2024", "29 Feb 2024", "29 Feb 2023", "31.12.1999", "5mar2024", "13.13.2024",
    "2024/13/05", "45/3/12", "32.1.5", "1 2 3",
]
CLOCKS = [
    "", " 15:15", " 3:15 PM", " at 3 pm", " 12:00 am", " 12:30 p.m.", " 13:00 pm", " 0:30 am", " 15:15:30.25", " 15:15:30,123456789", " 24:00", " 10:60",
    " 15:15 +0200", " 15:15:00 -05:30", " 10:00Z", " 10:00 UTC", " 10:00 UTC+3", " 10:00 GMT-2", " 10:00 +5", " 15:15:60",
]
OTHERS = [
    "20240305T101530", "20240305T1015", "20240305101530", "202403051015", "20240305 10:15", "10:15 5.3.2024", "3 PM on March 5, 2024",
    "Tue, 05 Mar 2024 15:15:00 GMT", "x", "5 Foo 2024 10:00", "5 Mar Apr 2024", "1.2.3.4", "2024-03-05T10:15:00+05:30", "5 Mar 2024 hello",
]
# The run's date would fill these in, or there is nothing to read: NULL by definition.
NO_DATE = ["", "  ", "10:15", "3 pm", "Mar 2024", "5 Mar", "Tuesday", "2024", "10:15 11:15 5 Mar 2024", "٣ Mar 2024", "5" * 5000, "5 Mar 2024 " * 500, None]


def expected(text):
    try:
        t = parser.parse(text)
    except (ValueError, OverflowError):
        return None
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def parsed(spark, texts, parse):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = rows.select("i", F.unix_micros(parse(F.col("text"))).alias("us"))
    return [r["us"] for r in sorted(got.collect())]


def test_grammar_agrees_with_dateutil(spark):
    texts = [d + c for d, c in itertools.product(DATES, CLOCKS)] + OTHERS
    got = parsed(spark, texts, parse_free_timestamp)
    wrong = [(t, g, expected(t)) for t, g in zip(texts, got, strict=True) if g != expected(t)]
    assert not wrong, (len(wrong), wrong[:20])


@pytest.mark.parametrize("parse", [parse_free_timestamp, parse_timestamp])
def test_a_date_is_never_filled_in(spark, parse):
    got = parsed(spark, NO_DATE, parse)
    assert [t for t, g in zip(NO_DATE, got, strict=True) if g is not None] == []


def test_cleaning_reads_free_formats(spark):
    got = parsed(spark, ["5 Mar 2024 3:15 PM", " 5.3.2024 ", "2024-03-05 15:15:00", "3/5/2024 15:15"], parse_timestamp)
    assert got == [expected(t) for t in ("2024-03-05 15:15", "2024-05-03", "2024-03-05 15:15", "2024-03-05 15:15")]
