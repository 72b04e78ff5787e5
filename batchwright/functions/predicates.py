"""Predicates over change columns and keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def tuple_equal(left: DataFrame, right: DataFrame, columns: Sequence[str], null_safe: bool) -> Column:
    """Conjunction ``left.c = right.c`` over ``columns``.

    With ``null_safe`` two NULLs are equal (``<=>``); without it any NULL
    makes the pair unequal, which is plain SQL ``=``.
    """
    terms = [left[c].eqNullSafe(right[c]) if null_safe else (left[c] == right[c]) for c in columns]
    return reduce(lambda a, b: a & b, terms)


def tuple_differs(left_cols: Sequence[Column], right_cols: Sequence[Column]) -> Column:
    """True when any pair differs, NULLs compared as values (``NOT <=>``)."""
    terms = [~a.eqNullSafe(b) for a, b in zip(left_cols, right_cols)]
    return reduce(lambda a, b: a | b, terms)
