"""Code -> label lookups (J1-J3) as map-literal expressions.

The lookup stays inside whole-stage codegen: no Python worker is involved.
Unknown and null codes give a null label; ``strict=True`` fails the task on
an unknown non-null code instead.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PAYMENT_TYPES, RATE_CODES, VENDOR_NAMES


def code_label(code: Column | str, table: dict[int, str], strict: bool = False) -> Column:
    col = F.col(code) if isinstance(code, str) else code
    mapping = F.create_map(
        *chain.from_iterable((F.lit(k).cast("long"), F.lit(v)) for k, v in sorted(table.items()))
    )
    label = F.try_element_at(mapping, col.cast("long"))
    if not strict:
        return label
    message = F.concat(F.lit("unknown code: "), col.cast("string"))
    return F.when(col.isNotNull() & label.isNull(), F.raise_error(message)).otherwise(label)


def vendor_name(code: Column | str, strict: bool = False) -> Column:
    return code_label(code, VENDOR_NAMES, strict)


def payment_description(code: Column | str, strict: bool = False) -> Column:
    return code_label(code, PAYMENT_TYPES, strict)


def ratecode_description(code: Column | str, strict: bool = False) -> Column:
    return code_label(code, RATE_CODES, strict)
