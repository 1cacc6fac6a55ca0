"""Scalar cleaning expressions (pure ``Column -> Column``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S

_INF = float("inf")


def is_finite(c: Column) -> Column:
    """TRUE for a finite number, FALSE for NaN/±inf, NULL for NULL."""
    return ~F.isnan(c) & (F.abs(c) != F.lit(_INF))


def to_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """Lenient numeric: text that is not a number becomes NULL; NaN becomes NULL.

    Spark keeps NaN and orders it above +inf (so ``NaN > 480`` is true); the
    rows it stands for are missing values, so NaN is turned into NULL here.
    """
    if isinstance(dtype, T.BooleanType):
        v = c.cast("double")
    elif isinstance(dtype, T.NumericType):
        v = c.cast("double")
    else:
        v = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_boolean(c: Column, dtype: T.DataType | None = None) -> Column:
    """Case-sensitive boolean map; everything else becomes NULL."""
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.NumericType):
        return F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))
    text = c.cast("string")
    mapping = {**S.BOOLEAN_MAP, **S.BOOLEAN_NUMERIC_TEXT}
    true_tokens = [k for k, v in mapping.items() if v]
    false_tokens = [k for k, v in mapping.items() if not v]
    return F.when(text.isin(true_tokens), F.lit(True)).when(text.isin(false_tokens), F.lit(False))


def null_outside(c: Column, lo: float, hi: float) -> Column:
    """Keep values in ``[lo, hi]`` (inclusive); others become NULL, row kept."""
    return F.when(c.between(lo, hi), c)


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with float semantics on zero: ±inf for x/0, NULL for 0/0."""
    return (
        F.when(den != 0, num / den)
        .when((den == 0) & (num > 0), F.lit(_INF))
        .when((den == 0) & (num < 0), F.lit(-_INF))
    )


def sanitize(c: Column, lo: float = 0.0, hi: float | None = None) -> Column:
    """Prediction sanitiser: non-finite or NULL -> ``lo``, clip, round half-even."""
    v = F.when(c.isNull() | ~is_finite(c), F.lit(float(lo))).otherwise(c)
    v = F.greatest(v, F.lit(float(lo)))
    if hi is not None:
        v = F.least(v, F.lit(float(hi)))
    return F.bround(v, 0).cast("int")


def clamp_round(c: Column, lo: float, hi: float) -> Column:
    """Post-map clamp to ``[lo, hi]`` and round half-even to int (NULL stays NULL)."""
    v = F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi)))
    return F.bround(v, 0).cast("int")


def section_default(section: Column) -> Column:
    """Reproducible per-section default staffing: ``max(1, 3 + h % 5)``.

    ``h`` is the first 32 bits of the md5 of the text, so every engine and run
    gives the same value; NULL section -> 3.
    """
    h = F.conv(F.substring(F.md5(section.cast("string")), 1, 8), 16, 10).cast("long")
    return F.when(section.isNull(), F.lit(S.TASK2_DEFAULT_PREDICTION)).otherwise(
        F.greatest(F.lit(1), (F.lit(S.TASK2_DEFAULT_PREDICTION) + F.pmod(h, F.lit(5))).cast("int"))
    )
