"""Column-name and value casts.

Narrowing casts use ``try_cast`` so that values that do not fit (bigint
overflow, NaN, unparsable text) become null instead of wrapping or failing
the job; the cleaning filters then drop those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name in one projection.

    Raises when two names collide after lower-casing, instead of silently
    keeping an ambiguous frame.
    """
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dupes = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"column names collide when lower-cased: {dupes}")
    if lowered == df.columns:
        return df
    return df.toDF(*lowered)


def to_int(c: Column | str) -> Column:
    """Integer cast that truncates fractions and nulls what does not fit."""
    return F.col(c).try_cast(T.IntegerType()) if isinstance(c, str) else c.try_cast(T.IntegerType())


def to_float(c: Column | str) -> Column:
    """Double to single precision (C6); values keep their sign, tiny ones become 0."""
    return F.col(c).try_cast(T.FloatType()) if isinstance(c, str) else c.try_cast(T.FloatType())


def to_double(c: Column | str) -> Column:
    return F.col(c).try_cast(T.DoubleType()) if isinstance(c, str) else c.try_cast(T.DoubleType())


def lower_values(c: Column | str) -> Column:
    """Lower-case string values."""
    return F.lower(F.col(c) if isinstance(c, str) else c)
