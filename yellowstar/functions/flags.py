"""Row flags and conditional expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY_COLUMNS


def fare_sign_flag(fare: Column | str = "fare_amount") -> Column:
    """'y' when the fare is negative, else 'n'; a null fare gives 'n' (C9)."""
    col = F.col(fare) if isinstance(fare, str) else fare
    return F.when(col < 0, F.lit("y")).otherwise(F.lit("n"))


def all_non_negative(columns: Iterable[str]) -> Column:
    """Conjunction of ``c >= 0``; null when any operand is null and none false."""
    return reduce(and_, [F.col(c) >= 0 for c in columns])


def quality_flag(columns: Iterable[str] = MONEY_COLUMNS) -> Column:
    """'n' only when every money column is >= 0; a null anywhere gives 'y' (C10)."""
    return F.when(all_non_negative(columns), F.lit("n")).otherwise(F.lit("y"))


def indicator(cond: Column) -> Column:
    """1 when the condition holds, else 0 (null counts as false) (C11)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def invalid_location(c: Column | str) -> Column:
    """Location id below 1 or missing."""
    col = F.col(c) if isinstance(c, str) else c
    return (col < 1) | col.isNull()
