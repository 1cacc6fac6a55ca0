"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize


def _marks() -> list[Column]:
    """What tells two sets of edges apart: their number and two independent hashes, 96 bits."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)).alias("sum"),
        F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("xor"),
    ]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; the component is its smallest id.

    Each round links every vertex's larger neighbours to its smallest one, then its smaller
    neighbours to the smallest; edges never grow in number and a path's length falls by a factor, so
    rounds are logarithmic. Every round's edges are written to the checkpoint folder. A
    vertex's neighbours meet only in a minimum, which is combined before the shuffle.
    """
    now, seen = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        name,
        observe=_marks(),
    )
    while seen["n"]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: larger neighbours to the smallest vertex around
        large = both.where("b > a").join(low, "a").select(F.col("low").alias("a"), "b").distinct()
        # small star: a vertex and its smaller neighbours to the smallest of them
        down = large.select(F.col("b").alias("v"), F.col("a").alias("u"))
        least = down.groupBy("v").agg(F.min("u").alias("low"))
        small = (
            down.join(least, "v")
            .select(F.explode(F.array(F.struct("low", F.col("u").alias("b")), F.struct("low", F.col("v").alias("b")))).alias("e"))
            .select(F.col("e.low").alias("a"), F.col("e.b").alias("b"))
            .where("a <> b")
            .distinct()
        )
        before = seen
        now, seen = materialize(small, name, observe=_marks())
        if seen == before:
            break
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
