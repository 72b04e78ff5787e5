from .pipeline import BatchReport, bootstrap, load_once, replay, run_batch
from .registry import (
    DRIVER_FACT_TABLE,
    REFERENCE_FACT_TABLE,
    driver_basic_registry,
    driver_registry,
    reference_basic_registry,
    reference_batch_registry,
)

__all__ = [
    "DRIVER_FACT_TABLE",
    "REFERENCE_FACT_TABLE",
    "BatchReport",
    "bootstrap",
    "driver_basic_registry",
    "driver_registry",
    "load_once",
    "reference_basic_registry",
    "reference_batch_registry",
    "replay",
    "run_batch",
]
