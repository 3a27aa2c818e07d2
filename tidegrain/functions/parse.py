"""Typed readings of source text that never raise: what isn't plainly of a type is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def count_of(c: Column) -> Column:
    """A non-negative int of digits only. Java's $ would let a last newline pass, hence \\z."""
    return F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("int"))


def decimal_of(c: Column, kind: str = "decimal(10,7)") -> Column:
    return F.when(c.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?\z"), c.try_cast(kind))


def instant_of(c: Column) -> Column:
    """An instant whose text carries a zone; text without one is null."""
    return F.when(c.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})\z"), F.try_to_timestamp(c))
