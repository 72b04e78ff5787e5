"""Batch dates and the columns the loads stamp onto rows.

Batch folders are named ``batch_<date>[<suffix>]``; the batch date is the
second ``_``-separated token.  Only a ``yyyy-mm-dd`` prefix is accepted, with an
optional time part after ``T`` or a space.  Anything else is an error rather than
a silently wrong date.

Rows are stamped with the date.  A batch is known by its date and whatever follows
it in the name (:class:`BatchDate`), in the order of that text, so several batches
of one day load one after the other.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import BATCHED_AT, END_DATE, START_DATE

BATCH_PREFIX = "batch"
_DATE = re.compile(r"^(\d{4})-(\d{2})-(\d{2})(?:[T ].*)?$", re.DOTALL)


class BatchNameError(ValueError):
    """A batch folder name does not carry a readable date."""


class BatchDate(dt.date):
    """The date of a batch, which also knows the batch: ``token`` is the folder's
    name after ``batch_``, such as ``2022-11-01T120000``.  Equal to any equal date."""

    token: str

    def __new__(cls, year: int, month: int, day: int, token: str | None = None):
        self = super().__new__(cls, year, month, day)
        self.token = token or self.isoformat()
        return self

    def __reduce__(self):
        return BatchDate, (self.year, self.month, self.day, self.token)


def token_of(batch_date: dt.date) -> str:
    """What a batch is known by; it orders batches by date, time and name."""
    return getattr(batch_date, "token", batch_date.isoformat())


def batch_token(batch: str) -> str:
    parts = batch.split("_")
    if len(parts) < 2 or not parts[0].startswith(BATCH_PREFIX):
        raise BatchNameError(f"{batch!r} is not a batch folder name (batch_<yyyy-mm-dd>)")
    return parts[1]


def parse_batch_date(batch: str | dt.date) -> dt.date:
    """Batch date of a folder name (or a date passed through)."""
    if isinstance(batch, dt.datetime):
        return batch.date()
    if isinstance(batch, dt.date):
        return batch
    token = batch_token(batch) if batch.startswith(BATCH_PREFIX) else batch.split("_")[0]
    m = _DATE.match(token)
    if not m:
        raise BatchNameError(f"{batch!r}: {token!r} is not a yyyy-mm-dd date")
    try:
        return BatchDate(int(m[1]), int(m[2]), int(m[3]), batch.split("_", 1)[1] if batch.startswith(BATCH_PREFIX) else batch)
    except ValueError as exc:
        raise BatchNameError(f"{batch!r}: {exc}") from None


def batch_date_col(name_col: Column | str) -> Column:
    """Spark-side batch date of a folder-name column; NULL when unreadable."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    token = F.get(F.split(c, "_"), 1)
    return F.when(token.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_date(F.substring(token, 1, 10), "yyyy-MM-dd"))


def date_lit(batch: str | dt.date) -> Column:
    return F.lit(parse_batch_date(batch))


def with_batch_stamp(df: DataFrame, batch: str | dt.date) -> DataFrame:
    """Add ``batched_at`` (date) to every row."""
    return df.withColumn(BATCHED_AT, date_lit(batch))


def with_scd_columns(df: DataFrame, batch: str | dt.date) -> DataFrame:
    """Open a version: ``start_date`` = batch date, ``end_date`` = NULL."""
    return df.withColumns({START_DATE: date_lit(batch), END_DATE: F.lit(None).cast("date")})


def is_newer(batch: str | dt.date, mark: dt.date | None) -> bool:
    """True when the batch is after the high-water mark (no mark: new).

    A mark that knows its batch is compared as one (date, time, name); a plain
    date as a date, so then a time suffix does not make a batch of that day new.
    """
    if mark is None or not isinstance(mark, BatchDate):
        return mark is None or parse_batch_date(batch) > mark
    return token_of(parse_batch_date(batch)) > mark.token
