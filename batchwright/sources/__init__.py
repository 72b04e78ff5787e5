from .delimited import CORRUPT, PART_GLOB, read_delimited, read_named_file, record_check, write_delimited
from .jdbc import jdbc_bounds, read_jdbc, read_jdbc_query
from .manifest import BatchEntry, batch_entries, entries_for, list_batches, manifest, manifest_frame

__all__ = [
    "CORRUPT",
    "PART_GLOB",
    "BatchEntry",
    "batch_entries",
    "entries_for",
    "jdbc_bounds",
    "list_batches",
    "manifest",
    "manifest_frame",
    "read_delimited",
    "read_jdbc",
    "read_jdbc_query",
    "read_named_file",
    "record_check",
    "write_delimited",
]
