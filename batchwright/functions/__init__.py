from .predicates import tuple_differs, tuple_equal
from .stamps import (
    BatchNameError,
    batch_date_col,
    batch_token,
    date_lit,
    is_newer,
    parse_batch_date,
    with_batch_stamp,
    with_scd_columns,
)

__all__ = [
    "BatchNameError",
    "batch_date_col",
    "batch_token",
    "date_lit",
    "is_newer",
    "parse_batch_date",
    "tuple_differs",
    "tuple_equal",
    "with_batch_stamp",
    "with_scd_columns",
]
