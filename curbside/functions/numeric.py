"""Sums and means that do not depend on the order in which tasks add."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal sums are exact in any order; six digits keep money and distances as they are.
EXACT = "decimal(28,6)"


def exact(col: Column | str) -> Column:
    """A number for exact sums; NULL where it is not finite."""
    return (F.col(col) if isinstance(col, str) else col).try_cast(EXACT)


def exact_sum(col: Column | str) -> Column:
    """A decimal sum, to be added up further."""
    return F.sum(exact(col))


def total(col: Column | str) -> Column:
    return exact_sum(col).cast("double")


def total_of(sums: str) -> Column:
    """The total of partial decimal sums."""
    return F.sum(sums).cast("double")


def mean(col: Column | str) -> Column:
    return F.try_divide(total(col), F.count(col))


def mean_of(sums: str, counts: str) -> Column:
    """Mean from partial decimal sums and counts."""
    return F.try_divide(total_of(sums), F.sum(counts))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / max(whole, 1); NULL part stays NULL, NULL whole counts as 1."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return part / F.greatest(whole, F.lit(1))


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.round(ratio(part, whole) * 100, 2)
