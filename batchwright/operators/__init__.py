from .control import any_present, high_water_mark, high_water_mark_frame, is_new_batch, tables_present
from .loads import LoadResult, append_load, first_load, full_load, incremental_load, scd_load, truncate_load
from .scd2 import (
    COMPAT,
    STRICT,
    changed_rows,
    scd2_compat,
    scd2_merge,
    scd2_strict,
    scd2_strict_changes,
    unchanged_keys,
)

__all__ = [
    "COMPAT",
    "STRICT",
    "LoadResult",
    "any_present",
    "append_load",
    "changed_rows",
    "first_load",
    "full_load",
    "high_water_mark",
    "high_water_mark_frame",
    "incremental_load",
    "is_new_batch",
    "scd2_compat",
    "scd2_merge",
    "scd2_strict",
    "scd2_strict_changes",
    "scd_load",
    "tables_present",
    "truncate_load",
    "unchanged_keys",
]
