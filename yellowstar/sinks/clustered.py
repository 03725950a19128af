"""Raw trips written so that later cleaning skips most of what it would drop.

Each cleaning rule implies a range of the raw column. Within every file the
rows are ordered by the first rule they break (none first), so whole pages and
row groups break one and the same rule: their least and greatest values in
the file's own index prove it, and a reader with that predicate doesn't open
them. The order costs a sort inside each task and no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import lower_names
from ..operators.cleaning import STAGES, implied_prefilter

RULE = "_ys_rule"


def first_broken_rule(raw: DataFrame) -> Column:
    """0 for rows that break none, else the 1-based number of the first rule whose implied range they leave."""
    out: Column = F.lit(0)
    for i, stage in reversed(list(enumerate(STAGES, 1))):
        kept = implied_prefilter(raw, [stage])
        if kept is not None:
            out = F.when(F.coalesce(kept, F.lit(False)), out).otherwise(F.lit(i))
    return out


def write_clustered(raw: DataFrame, path: str, page_rows: int = 20_000, mode: str = "overwrite") -> None:
    """Write raw trips (names lower-cased) ordered for cleaning; ``page_rows`` bounds the unit that is skipped."""
    lowered = lower_names(raw)
    ordered = lowered.withColumn(RULE, first_broken_rule(lowered)).sortWithinPartitions(RULE)
    ordered.drop(RULE).write.mode(mode).option("parquet.page.row.count.limit", str(page_rows)).parquet(path)
