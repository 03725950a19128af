"""Declarative cleaning of raw trips.

The rules are data: an ordered list of stages, each casting some columns
and keeping the rows that satisfy a predicate over the cast values. The
same list drives the row-by-row cleaned frame, the per-stage frames and
the one-pass funnel, so the three can never disagree.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import lower_names, lower_values, to_double, to_float, to_int
from ..functions.flags import fare_sign_flag, quality_flag
from ..schemas import MONEY_COLUMNS

INT_MAX = 2147483647
Accessor = Callable[[str], Column]


@dataclass(frozen=True)
class Stage:
    """One cleaning step: cast columns, then keep rows where ``keep`` holds."""

    name: str
    casts: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    keep: Callable[[Accessor], Column] | None = None
    # (column, rule) giving a predicate on the *raw* column that every kept
    # row satisfies; it reaches the parquet scan where the cast one cannot.
    implied: tuple[str, Callable[[Column, T.DataType], Column | None]] | None = None


def _in_range(lo: int, hi: int) -> Callable[[Column, T.DataType], Column | None]:
    """Raw-value range implied by ``lo <= try_cast(raw AS INT) <= hi``."""

    def rule(raw: Column, dtype: T.DataType) -> Column | None:
        if isinstance(dtype, T.IntegralType):
            return raw.between(lo, hi)
        if isinstance(dtype, (T.FractionalType, T.DecimalType)):
            # truncation toward zero keeps x in [lo, hi] iff lo <= x < hi + 1
            return (raw >= lo) & (raw < hi + 1)
        return None

    return rule


def _positive(raw: Column, dtype: T.DataType) -> Column | None:
    if isinstance(dtype, T.NumericType):
        return raw > 0
    return None


def _present(raw: Column, dtype: T.DataType) -> Column | None:
    return raw.isNotNull()


def _any_present(*cols: str) -> Callable[[Accessor], Column]:
    """``dropna(how='all', subset=cols)`` as a predicate."""
    return lambda c: reduce(or_, [c(x).isNotNull() for x in cols])


STAGES: list[Stage] = [
    Stage(
        "vendor",
        casts={"vendorid": to_int},
        keep=lambda c: c("vendorid").isin(1, 2),
        implied=("vendorid", _in_range(1, 2)),
    ),
    Stage(
        "passenger_present",
        casts={"passenger_count": to_int},
        keep=_any_present("passenger_count"),
        implied=("passenger_count", _present),
    ),
    Stage(
        "passenger_positive",
        keep=lambda c: c("passenger_count") > 0,
        implied=("passenger_count", _in_range(1, INT_MAX)),
    ),
    Stage(
        "distance",
        casts={"trip_distance": to_float},
        keep=lambda c: c("trip_distance") > 0,
        implied=("trip_distance", _positive),
    ),
    Stage(
        "ratecode",
        casts={"pulocationid": to_int, "dolocationid": to_int, "ratecodeid": to_int},
        keep=lambda c: c("ratecodeid").isin(1, 2, 3, 4, 5, 6),
        implied=("ratecodeid", _in_range(1, 6)),
    ),
]
STAGE_NAMES = ["raw"] + [s.name for s in STAGES]


def _apply(df: DataFrame, stage: Stage) -> DataFrame:
    if stage.casts:
        df = df.withColumns({name: cast(F.col(name)) for name, cast in stage.casts.items()})
    if stage.keep is not None:
        df = df.filter(stage.keep(F.col))
    return df


def implied_prefilter(df: DataFrame, stages: list[Stage] = STAGES) -> Column | None:
    """Conjunction of raw-column predicates implied by the stage filters."""
    types = {f.name: f.dataType for f in df.schema.fields}
    preds = []
    for stage in stages:
        if stage.implied is None:
            continue
        name, rule = stage.implied
        if name in types:
            pred = rule(F.col(name), types[name])
            if pred is not None:
                preds.append(pred)
    return reduce(and_, preds) if preds else None


def stage_frames(raw: DataFrame) -> dict[str, DataFrame]:
    """Frame after each stage, cumulative, keyed by stage name."""
    df = lower_names(raw)
    frames = {"raw": df}
    for stage in STAGES:
        df = _apply(df, stage)
        frames[stage.name] = df
    return frames


def filter_stages(raw: DataFrame, pushdown: bool = True) -> DataFrame:
    """Apply every casting/filter stage; with ``pushdown`` also the implied raw predicates."""
    df = lower_names(raw)
    if pushdown:
        pre = implied_prefilter(df)
        if pre is not None:
            df = df.filter(pre)
    for stage in STAGES:
        df = _apply(df, stage)
    return df


def add_flags(df: DataFrame, with_fare_sign: bool = False) -> DataFrame:
    """Final projection: lower-case flag values, double fare, quality flag."""
    cols = {"store_and_fwd_flag": lower_values("store_and_fwd_flag")}
    if with_fare_sign:
        cols["fare_sign"] = fare_sign_flag("fare_amount")
    cols["fare_amount"] = to_double("fare_amount")
    cols["errordata"] = quality_flag(MONEY_COLUMNS)
    return df.withColumns(cols)


def clean_trips(raw: DataFrame, pushdown: bool = True, with_fare_sign: bool = False) -> DataFrame:
    """Raw trips -> cleaned trips with ``errordata`` (K2).

    Rows failing a stage are removed; rows with a negative or missing money
    value are kept and flagged ``errordata = 'y'``. All columns are kept,
    lower-cased, in input order, ``errordata`` last.
    """
    return add_flags(filter_stages(raw, pushdown), with_fare_sign)


def _cast_accessor(df: DataFrame) -> Accessor:
    casts: dict[str, Callable[[Column], Column]] = {}
    for stage in STAGES:
        casts.update(stage.casts)
    return lambda name: casts[name](F.col(name)) if name in casts else F.col(name)


def funnel_counts(raw: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The lower-cased frame and, per stage, the aggregate that counts the rows left after it."""
    df = lower_names(raw)
    c = _cast_accessor(df)
    counts = {"raw": F.count(F.lit(1))}
    cumulative = None
    for stage in STAGES:
        if stage.keep is None:
            continue
        cond = stage.keep(c)
        cumulative = cond if cumulative is None else cumulative & cond
        counts[stage.name] = F.count_if(cumulative)
    return df, counts


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """Rows left after each stage, in one scan and one tiny aggregate.

    Output ``(step, stage, rows)``: step 0 is the raw count, then one row
    per stage with cumulative predicates, all counted by ``count_if`` in a
    single global aggregate (partial counts per task, no data shuffle).
    """
    df, measures = funnel_counts(raw)
    counts = df.agg(*[c.alias(name) for name, c in measures.items()])
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("rows"))
        for i, name in enumerate(STAGE_NAMES)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
