"""Column helpers shared by all matching steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(c: Column) -> Column:
    """Upper case without outer spaces (tabs stay)."""
    return F.upper(F.trim(c))


def key(c: Column) -> Column:
    """Normalised value of an incoming record; a missing one counts as blank."""
    return F.coalesce(norm(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def quality_code(c: Column) -> Column:
    """Address quality code from the first character of the error table."""
    first = F.substring(c, 1, 1)
    return F.when(first == "G", "GA").when(first == "C", "CH").otherwise("BA")


def first_match(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first true case."""
    out = default
    for test, value in reversed(list(cases)):
        out = F.when(test, value).otherwise(out)
    return out
