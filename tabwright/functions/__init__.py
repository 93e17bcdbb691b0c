"""Column expressions: everything here is a native Spark expression, nothing runs a job."""

from tabwright.functions.columns import (
    average_rates,
    blank_to_null,
    clamp,
    list_slice,
    log_abs,
    nan_to_null,
    number_in,
    outside,
    present,
    scale_by_ratio,
    text_slice,
    to_double,
)
from tabwright.functions.keyed import hash01, keyed_md5

__all__ = [
    "average_rates", "blank_to_null", "clamp", "hash01", "keyed_md5", "list_slice",
    "log_abs", "nan_to_null", "number_in", "outside", "present", "scale_by_ratio", "text_slice", "to_double",
]
