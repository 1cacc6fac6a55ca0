"""Quoted CSV records out of files that are read in parallel, a byte range to a task.

A record may hold line breaks inside quotes, so a range alone does not tell where its first
record begins. But what a line does is a function of two states, outside and inside a quoted
field: most lines keep the state, some set it, some swap it, and such functions can be
composed in any grouping. So

1. each byte range reports the composition of its lines, and whether its bytes are UTF-8
   (two light scans: what is shuffled are codes of lines that hold quotes, and a row per range);
2. a running composition over the ranges of a file gives the state in which each starts;
3. in ranges without a quoted line break every line is a record, read where it lies. Only
   ranges with one are dealt out whole, their lines put together by a running state, and the pieces of
   records that go over a border joined by record.

A quote opens a field only as the field's first character, is doubled inside, and after the closing
quote all is text up to the next comma, as in the usual readers. A file is UTF-8 if all its bytes are,
else ISO-8859-1. Line breaks are LF, CR LF or CR; inside quotes they become LF. Blank lines between
records are no records. A quote that never closes makes the rest of its file one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.operators.joins import hinted, row_bytes
from tallyline.session import materialize

RANGE = ["path", "block"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the start of its byte range, and a number that rises within the range. The bytes
    stay as they are in the file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"),
    )


def unquoted_text(text: Column) -> Column:
    """A record without its quoted fields."""
    return F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), '(^|,)"[^"]*"', "$1")


def _opens(text: Column) -> Column:
    """Whether a line that starts outside quotes ends inside."""
    return unquoted_text(text).rlike('(^|,)"')


def coded(df: DataFrame) -> DataFrame:
    """``df(line)`` with what its lines do: set the state ``to`` inside (true) or outside, ``flip`` it, or neither."""
    single = F.replace("line", F.lit('""'), F.lit(""))
    rest = F.concat(F.lit("x"), F.substring("single", F.length(F.substring_index("single", '"', 1)) + 2, F.length("single")))
    has = F.contains("line", F.lit('"'))
    # a line without quotes keeps its state; one that held only doubled ones too
    quoted = has & F.contains("single", F.lit('"'))
    df = df.withColumn("single", F.when(has, single)).withColumn("rest", F.when(quoted, rest))
    df = df.withColumn("outside", F.when(quoted, _opens(F.col("single")))).withColumn("inside", F.when(quoted, _opens(F.col("rest"))))
    to = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    flip = F.coalesce((F.col("outside") & ~F.col("inside")).cast("int"), F.lit(0))
    return df.withColumns({"to": to, "flip": flip}).drop("single", "rest", "outside", "inside")


def composed(df: DataFrame, window) -> DataFrame:
    """``settled`` (the last state set, null if none) and ``odd`` (it, or else the first state, is swapped) of the
    lines or ranges in ``window``."""
    df = df.withColumn("_flips", F.sum("flip").over(window))
    df = df.withColumn("settled", F.last("to", True).over(window))
    # flips up to and with the last line that set a state
    own = Window.partitionBy(*RANGE[: 1 if "first_id" in df.columns else 2]).orderBy("block", "id" if "id" in df.columns else "first_id")
    df = df.withColumn("_all", F.sum("flip").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("_set", F.last(F.when(F.col("to").isNotNull(), F.col("_all")), True).over(window))
    odd = (F.coalesce("_flips", F.lit(0)) - F.coalesce("_set", F.lit(0))) % 2 == 1
    return df.withColumn("odd", odd).drop("_flips", "_all", "_set")


def state(start: Column) -> Column:
    """Whether one is inside quotes after what ``composed`` summed up, from a first state."""
    return F.coalesce("settled", start) != F.col("odd")


def ranges(found: DataFrame) -> DataFrame:
    """Per byte range of ``lines``: ``start`` (inside quotes or not), ``broken`` (a record in it has a line break or
    goes over a border), the number of its first line that is not blank, its file's first such (``head``), and
    whether the file is UTF-8."""
    every = found.groupBy(*RANGE).agg(
        F.min(F.when(F.trim("line") != "", F.col("id"))).alias("first_id"), F.min(F.is_valid_utf8("line")).alias("utf8")
    )
    marks = coded(found.where(F.contains("line", F.lit('"')))).drop("line").where("to is not null or flip = 1")
    up_to = Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = composed(marks, up_to)
    ended = done.groupBy(*RANGE).agg(
        F.max_by(F.struct("settled", "odd"), "id").alias("end"),
        F.max(state(F.lit(False))).alias("from_outside"), F.max(state(F.lit(True))).alias("from_inside"),
    )
    whole = every.join(ended, RANGE, "left").select(
        *RANGE, "first_id", "utf8", "from_outside",
        (F.col("end.settled") != F.col("end.odd")).alias("to"),
        F.when(F.col("end.settled").isNull() & F.col("end.odd"), 1).otherwise(0).alias("flip"),
    )
    before = Window.partitionBy("path").orderBy("block", "first_id").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("path")
    out = composed(whole, before).withColumn("start", state(F.lit(False)))
    return out.select(
        *RANGE, "start", (F.col("start") | F.coalesce("from_outside", F.lit(False))).alias("broken"),
        F.min(F.when(F.col("first_id").isNotNull(), F.struct("block", "first_id"))).over(file)["first_id"].alias("head"),
        F.min("utf8").over(file).alias("utf8"),
    )


def _assembled(broken: DataFrame) -> DataFrame:
    """The records of the broken ranges' lines. A range is dealt to one task, as it is read by one."""
    upto = Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    told = composed(coded(broken), before).withColumn("within", state(F.col("start")))
    told = told.where(F.col("within") | (F.trim("line") != ""))
    told = told.withColumn("record", F.sum((~F.col("within")).cast("int")).over(upto))
    parts = told.groupBy(*RANGE, "record", "head", "utf8").agg(
        F.min("id").alias("id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), "\n").alias("line")
    )
    # piece 0 of a range goes on with the last record of the one before
    last = F.max("record").over(Window.partitionBy(*RANGE))
    parts = parts.withColumn("border", (F.col("record") == 0) | (F.col("record") == last))
    whole = parts.where(~F.col("border")).select("path", "id", "head", "utf8", "line")
    in_file = Window.partitionBy("path").orderBy("block", "record")
    edges = parts.where("border").withColumn("owner", F.sum((F.col("record") > 0).cast("int")).over(in_file))
    joined = edges.groupBy("path", "owner", "head", "utf8").agg(
        F.min_by("id", F.struct("block", "record")).alias("id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "record", "line"))), lambda x: x["line"]), "\n").alias("line"),
    )
    return whole.unionByName(joined.drop("owner"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every record of the CSV files at ``path``, and whether it is its file's first (``head``)."""
    found = lines(spark, path)
    told = ranges(found)
    size = F.coalesce(F.sum(row_bytes(told)), F.lit(0)).alias("bytes")
    told, seen = materialize(told, "csv-ranges", observe=[size, F.coalesce(F.sum(F.col("broken").cast("int")), F.lit(0)).alias("broken")])
    placed = found.join(hinted(told, seen["bytes"]), RANGE)
    out = placed.where(~F.col("broken") & (F.trim("line") != "")).select("path", "id", "head", "utf8", "line")
    if seen["broken"]:
        out = out.unionByName(_assembled(placed.where("broken")))
    text = F.when(F.col("utf8"), F.col("line")).otherwise(F.decode(F.col("line").cast("binary"), "ISO-8859-1"))
    return out.select(text.alias("text"), (F.col("id") == F.col("head")).alias("head"))
