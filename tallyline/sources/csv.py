"""Tolerant CSV scan and sink, required-column check, training-table loader.

Scan rules: header row; every column read as text (typing is done by the
cleaning expressions); quotes doubled inside quoted fields, which may hold
commas and line breaks; the usual missing-value tokens are NULL; short rows
padded with NULL; rows with more fields than the header dropped. The files of a
folder must have one header.

Files are read a byte range to a task, line breaks in quotes or not, and each is
decoded as UTF-8 if all its bytes are valid, else as ISO-8859-1 (``records``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tallyline import schemas as S
from tallyline.sources.records import records, unquoted_text

CORRUPT = "_corrupt_record"
_QUOTES = {"quote": '"', "escape": '"'}
_BYTES = "ISO-8859-1"

# Tokens that data-frame CSV readers take for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of the first file at ``path``."""
    raw = spark.read.options(header=True, inferSchema=False, multiLine=True, encoding=_BYTES, **_QUOTES).csv(path).columns
    out = []
    for name in raw:
        try:
            out.append(name.encode("latin-1").decode("utf-8"))
        except UnicodeError:
            out.append(name)
    return out


def read_csv_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """All-text DataFrame of a CSV file or folder (see module rules)."""
    names = header(spark, path)
    if not names:
        raise ValueError(f"{path}: no header row")
    return parsed(records(spark, path), names)


def parsed(found: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` of ``found(text, head)``."""
    columns = [f"_c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in [*columns, CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} | _QUOTES
    rows = found.select("head", F.from_csv("text", schema, options).alias("r")).select("head", "r.*")
    # A malformed row is kept when it has at most n-1 separators outside quotes
    # (short row, padded); a row with more fields than the header is dropped.
    unquoted = unquoted_text(F.col(CORRUPT))
    separators = F.length(unquoted) - F.length(F.regexp_replace(unquoted, ",", ""))
    keep = F.col(CORRUPT).isNull() | (separators <= len(columns) - 1)
    same = F.lit(True)
    for i, (c, name) in enumerate(zip(columns, names, strict=True)):
        # Spark names an empty field by its place, and adds the place to a repeated one
        own = F.coalesce(F.col(c), F.lit(""))
        same = same & ((own == name) | (F.concat(own, F.lit(str(i))) == name) | ((own == "") & (F.lit(name) == f"_c{i}")))
    other = F.raise_error(F.lit("files of one folder have different headers")).cast("boolean")
    keep = F.when(F.col("head"), F.when(same, F.lit(False)).otherwise(other)).otherwise(keep)
    values = [F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in columns]
    return rows.where(keep).select(*[v.alias(name) for v, name in zip(values, names, strict=True)])


def write_csv(df: DataFrame, path: str, single_file: bool = False, encoding: str = "UTF-8") -> None:
    """CSV with a header, no index, overwriting ``path`` (a folder of parts)."""
    out = df.coalesce(1) if single_file else df
    options = {"header": True, "encoding": encoding, "quote": '"', "escape": '"'}
    out.write.mode("overwrite").options(**options).csv(path)


def validate_columns(df: DataFrame, required: list[str], name: str = "DataFrame") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} missing required columns: {missing}")


def read_or_empty(spark: SparkSession, path: str | None, columns: list[str]) -> DataFrame:
    """The tolerant scan, or an empty frame with the declared columns when the file is missing."""
    if path is None:
        return spark.createDataFrame([], S.string_schema(columns))
    try:
        return read_csv_tolerant(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], S.string_schema(columns))


def load_training_tables(spark: SparkSession, bookings_path: str | None, tasks_path: str | None, staffing_path: str | None):
    """Read, clean and join the three training tables.

    Returns ``(bookings merged with tasks, cleaned staffing, tasks)``; a missing
    file degrades to an empty table with its declared columns.
    """
    from tallyline.operators import cleaning, joins

    bookings = cleaning.clean_bookings(read_or_empty(spark, bookings_path, S.BOOKINGS_COLUMNS))
    tasks = read_or_empty(spark, tasks_path, S.TASKS_COLUMNS)
    staffing = cleaning.clean_staffing(read_or_empty(spark, staffing_path, S.STAFFING_COLUMNS))
    merged = joins.merge_with_dimension(bookings, tasks, "task_id")
    return merged, staffing, tasks
