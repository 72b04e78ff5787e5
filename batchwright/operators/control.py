"""Decisions of the batch loop: is a table there, is a batch new."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stamps import is_newer, parse_batch_date
from ..specs import BATCHED_AT


def tables_present(store, names: Iterable[str]) -> dict[str, bool]:
    """Which of ``names`` have at least one published version."""
    return {n: store.exists(n) for n in names}


def any_present(store, names: Iterable[str]) -> bool:
    """True when any of the batch's own tables exists (first load if not)."""
    return any(tables_present(store, names).values())


def high_water_mark(store, fact_table: str) -> dt.date | None:
    """Newest batch date committed to the fact table (metadata, no scan)."""
    return store.batch_mark(fact_table) if store.exists(fact_table) else None


def high_water_mark_frame(df: DataFrame, column: str = BATCHED_AT) -> DataFrame:
    """Same mark computed from the rows: a one-row ``max`` aggregate."""
    return df.agg(F.max(F.col(column)).alias("high_water_mark"))


def is_new_batch(store, batch: str | dt.date, fact_table: str) -> bool:
    """A batch is new when its date is after the fact table's mark, or there
    is no mark yet.  Dates are compared as dates, never as text."""
    return is_newer(parse_batch_date(batch), high_water_mark(store, fact_table))
