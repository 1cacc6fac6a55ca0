"""Exact running medians: for each key and day, the median of all values of strictly earlier days.

1. **Histogram** - ``(key, day, value) -> count``, combined before its shuffle, range-partitioned by
   ``(key, value, day)`` and written with its partition number, so a hot key spans many partitions,
   each a range of its values.
2. **Prefix merge** - counts per ``(key, partition, day)`` are summed up over the days, then over a key's
   partitions in value order. That grid has one row for each partition a key touches and each of its days, however
   many rows there are, and tells which partition holds a day's middle ranks, and at what rank within it.
3. **Pick** - each ``(key, partition)`` meets its wanted ranks once. Its rows are added day after day to counts
   in blocks of values; a rank is found by the blocks' sums, then within a block. A group is part of one range
   partition, so its size follows the partitions', not the key's.

Nothing of a later day, or of the same day, reaches a row, so the medians can be features of training rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators import joins
from tallyline.operators.median import COUNT
from tallyline.session import materialize


def _ranks_by_day(days: np.ndarray, values: np.ndarray, counts: np.ndarray, asked: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For each asked day the value at a 0-based rank among the rows of earlier days; NaN for rank -1."""
    levels, at = np.unique(values, return_inverse=True)
    width = max(1, int(np.sqrt(len(levels))))
    single = np.zeros(-(-len(levels) // width) * width, dtype=np.int64)
    blocks = np.zeros(len(single) // width, dtype=np.int64)
    by_day = np.argsort(days, kind="stable")
    days, at, counts = days[by_day], at[by_day], counts[by_day]
    out = np.full(ranks.shape, np.nan)
    done = 0
    for q in np.argsort(asked, kind="stable"):
        upto = int(np.searchsorted(days, asked[q], side="left"))
        if upto > done:
            np.add.at(single, at[done:upto], counts[done:upto])
            np.add.at(blocks, at[done:upto] // width, counts[done:upto])
            done = upto
        ends = np.cumsum(blocks)
        for j, rank in enumerate(ranks[q]):
            if rank >= 0:
                b = int(np.searchsorted(ends, rank, side="right"))
                inner = np.cumsum(single[b * width : (b + 1) * width])
                out[q, j] = levels[b * width + int(np.searchsorted(inner, rank - (ends[b] - blocks[b]), side="right"))]
    return out


def _pick(rows: pa.Table, wanted: pa.Table) -> pa.Table:
    """The values of one partition's wanted ranks, with key and day."""
    column = lambda t, name: t.column(name).to_numpy()
    ranks = np.stack([column(wanted, "_lo"), column(wanted, "_hi")], axis=1)
    if not len(rows):  # wanted ranks come from the rows' counts, so there are none
        ranks = ranks[:0]
    got = _ranks_by_day(column(rows, "_day"), column(rows, "_value"), column(rows, COUNT), column(wanted, "_day")[: len(ranks)], ranks)
    out = wanted.slice(0, len(ranks)).select([0, 2])
    return out.append_column("_a", pa.array(got[:, 0])).append_column("_b", pa.array(got[:, 1]))


def past_medians(history: DataFrame, key: str, day: str, value: str, asof: DataFrame | None = None) -> DataFrame:
    """``(key, day, median, n)`` for every key and day of ``asof`` (``history`` itself by default) with earlier values.

    ``median`` is that of ``history``'s values on days strictly before, the mean of the middle two for an even ``n``.
    Values that are NULL or NaN, and rows without key or day, are no history. A key or day without any
    earlier value has no row; an empty history gives none. ``asof`` needs ``key`` and ``day`` (a date).
    """
    number = F.unix_date(F.col(day).cast("date")).alias("_day")
    v = F.col(value).cast("double")
    known = F.col(key).isNotNull() & F.col(day).isNotNull()
    valid = history.where(known & v.isNotNull() & ~F.isnan(v)).select(key, number, v.alias("_value"))
    hist = valid.groupBy(key, "_day", "_value").agg(F.count(F.lit(1)).alias(COUNT))
    ranged = materialize(hist.repartitionByRange(key, "_value", "_day").withColumn("_part", F.spark_partition_id()), "day-histogram")

    per_day = ranged.groupBy(key, "_part", "_day").agg(F.sum(COUNT).alias("_n"))
    # each of a key's days, asked for or with values, in each of its partitions
    asked = (history if asof is None else asof).where(known).select(key, number).distinct().withColumn("_asked", F.lit(True))
    days = asked.unionByName(ranged.select(key, "_day").distinct().withColumn("_asked", F.lit(False)))
    days = days.groupBy(key, "_day").agg(F.max("_asked").alias("_asked"))
    grid = days.join(per_day.select(key, "_part").distinct(), key).join(per_day, [key, "_part", "_day"], "left")
    earlier = Window.partitionBy(key, "_part").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where("_asked")
    whole = Window.partitionBy(key, "_day")
    lower = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select(
        key, "_part", "_day", "_before", F.sum("_before").over(whole).alias("n"), F.coalesce(F.sum("_before").over(lower), F.lit(0)).alias("_off")
    )

    def local(rank):
        inside = (rank >= F.col("_off")) & (rank < F.col("_off") + F.col("_before"))
        return F.when(inside, rank - F.col("_off")).otherwise(F.lit(-1)).cast("long")

    ranks = grid.where("n > 0").withColumns({"_lo": local(F.floor((F.col("n") - 1) / 2)), "_hi": local(F.floor(F.col("n") / 2))})
    wanted = materialize(ranks.where("_lo >= 0 or _hi >= 0").select(key, "_part", "_day", "_lo", "_hi", "n"), "wanted-ranks")

    dtype = history.schema[key].dataType.simpleString()
    left = ranged.select(key, "_part", "_day", "_value", COUNT).groupBy(key, "_part")
    picked = left.cogroup(wanted.groupBy(key, "_part")).applyInArrow(_pick, f"`{key}` {dtype}, _day int, _a double, _b double")
    # NaN: the rank lies in another partition
    a, b = (F.max(F.when(~F.isnan(c), F.col(c))) for c in ("_a", "_b"))
    medians = picked.groupBy(key, "_day").agg(((a + b) / 2).alias("median"))
    sizes = wanted.groupBy(key, "_day").agg(F.max("n").alias("n"))
    return medians.join(sizes, [key, "_day"]).select(key, F.date_from_unix_date("_day").alias(day), "median", "n")


def with_past_median(rows: DataFrame, history: DataFrame, key: str, day: str, value: str, out_col: str) -> DataFrame:
    """``rows`` with the median of their key's values in ``history`` on days before their own day
    (``day``: a date column of both); NULL where there is none. The medians are a written table, broadcast if its bytes fit."""
    medians = past_medians(history, key, day, value, rows).select(key, day, F.col("median").alias(out_col))
    return rows.join(joins.sized(medians, "past-medians"), [key, day], "left")
