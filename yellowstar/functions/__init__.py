"""Scalar column functions: casts, flags and code labels."""

from .casts import lower_names, lower_values, to_double, to_float, to_int
from .codes import code_label, payment_description, ratecode_description, vendor_name
from .flags import all_non_negative, fare_sign_flag, indicator, invalid_location, quality_flag

__all__ = [
    "all_non_negative",
    "code_label",
    "fare_sign_flag",
    "indicator",
    "invalid_location",
    "lower_names",
    "lower_values",
    "payment_description",
    "quality_flag",
    "ratecode_description",
    "to_double",
    "to_float",
    "to_int",
    "vendor_name",
]
