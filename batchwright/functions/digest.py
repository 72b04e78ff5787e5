"""A digest of a row's columns, equal exactly where the columns are ``<=>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.StringType, T.CharType, T.VarcharType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampNTZType)


def _text(name: str, kind: T.DataType) -> Column:
    c = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c).cast("string")  # -0.0 <=> 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # its text depends on the session's time zone
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, _PLAIN):
        return c.cast("string")
    raise TypeError(f"column {name!r}: no digest of type {kind.simpleString()}")


def row_digest(schema: T.StructType, columns: Sequence[str]) -> Column:
    """SHA-256 (binary) of ``columns``: each ``-`` when NULL, else its length, ``:`` and its text."""
    parts = []
    for name in columns:
        text = _text(name, schema[name].dataType)
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))
