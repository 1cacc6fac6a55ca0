"""Joins: dimension lookups with a measured broadcast, unmatched-key reports.

A dimension is written once, its size in bytes measured during the write. It is
broadcast only if that fits the session's broadcast threshold; otherwise the
join is left to the planner (sort-merge, whose skewed partitions AQE splits).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.session import materialize

_DEFAULT_THRESHOLD = 10 * 1024 * 1024
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _field_bytes(name: str, dt: T.DataType):
    """Bytes of one value: its word, and the payload of text or of nested values."""
    c = F.col(f"`{name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(32) + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(8)


def row_bytes(df: DataFrame):
    """A row's size as an expression."""
    total = F.lit(24)
    for f in df.schema.fields:
        total = total + _field_bytes(f.name, f.dataType)
    return total.cast("long")


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; 0 where broadcasts are off."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    if raw is None:
        return _DEFAULT_THRESHOLD
    m = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)i?b?", str(raw).strip().lower())
    if not m:
        raise ValueError(f"spark.sql.autoBroadcastJoinThreshold: {raw}")
    return max(0, int(m[1]) * _UNITS[m[2]])


def sized(df: DataFrame, name: str = "dimension") -> DataFrame:
    """``df`` written once and read back; with a broadcast hint if its measured bytes fit."""
    out, seen = materialize(df, name, observe=[F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")], keep=True)
    return hinted(out, seen["bytes"])


def hinted(df: DataFrame, measured: int) -> DataFrame:
    """``df`` with a broadcast hint if ``measured`` bytes fit the threshold."""
    return F.broadcast(df) if measured <= broadcast_threshold(df.sparkSession) else df


def one_row_per_key(dim: DataFrame, key: str) -> DataFrame:
    """Dimension reduced to one row per key: the smallest row by its other columns.

    An aggregation (partial per task, then merged), so duplicate-heavy keys are
    combined before the shuffle.
    """
    others = [c for c in dim.columns if c != key]
    if not others:
        return dim.where(F.col(key).isNotNull()).distinct()
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_best")
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in others])


def merge_with_dimension(fact: DataFrame, dim: DataFrame | None, key: str = "task_id") -> DataFrame:
    """Left join fact -> dimension on ``key``; all fact rows kept.

    Duplicate dimension keys fan out (as a plain left join does). No-op when
    either side lacks the key or the dimension is absent.
    """
    if dim is None or key not in fact.columns or key not in dim.columns:
        return fact
    extra = [c for c in dim.columns if c != key and c not in fact.columns]
    right = dim.select(key, *extra)
    return fact.join(sized(right), on=key, how="left")


def merge_counts(fact: DataFrame, dim: DataFrame, key: str = "task_id", name: str = "task_name") -> DataFrame:
    """One row on ``merge_with_dimension``: fact rows, merged rows, rows added by duplicate keys,
    rows without a dimension row and rows that have no ``name`` after the merge."""
    keys = dim.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_copies"), F.count_if(F.col(name).isNull()).alias("_nameless")
    )
    copies, nameless = F.coalesce("_copies", F.lit(1)), F.coalesce("_nameless", F.lit(1))
    joined = fact.select(key).join(sized(keys), key, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(copies), F.lit(0)).alias("merged_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("fan_out"),
        F.count_if(F.col("_copies").isNull()).alias("unmatched_rows"),
        F.coalesce(F.sum(nameless), F.lit(0)).alias("rows_without_name"),
    )


def unmatched_keys(fact: DataFrame, dim: DataFrame, key: str = "task_id") -> DataFrame:
    """Distinct fact keys with no dimension row (NULL keys excluded), with row counts."""
    keys = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    dim_keys = dim.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(sized(dim_keys), on=key, how="left_anti")


def lookup_features(fact: DataFrame, dim: DataFrame, key: str = "task_id") -> DataFrame:
    """Dimension attributes as features plus ``has_*`` flags (dimension deduplicated)."""
    one = one_row_per_key(dim, key)
    cols = [c for c in ("section_id", "task_name", "section_name") if c in one.columns]
    right = one.select(key, *cols)
    joined = fact.join(sized(right), on=key, how="left")
    for c in ("task_name", "section_name"):
        if c in cols:
            joined = joined.withColumn(f"has_{c}", F.col(c).isNotNull())
    return joined


def lookup_with_default(fact: DataFrame, dim: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Point lookup as a batch: the dimension's values for the key, or the
    literal defaults when the key has no dimension row (a matched NULL stays NULL)."""
    one = one_row_per_key(dim, key)
    cols = [c for c in defaults if c in one.columns and c != key]
    right = one.select(key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_d_{c}") for c in cols])
    joined = fact.join(sized(right), on=key, how="left")
    for c in cols:
        joined = joined.withColumn(c, F.when(F.col("_matched"), F.col(f"_d_{c}")).otherwise(F.lit(defaults[c]))).drop(f"_d_{c}")
    return joined.drop("_matched")
