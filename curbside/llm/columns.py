"""Arrays of words and hashes as column expressions, without Python in the tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
MARKS = r"[^\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column, separators: str = SPACES) -> Column:
    """A 64-bit hash for each word of a text in lower case; none for NULL."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), separators)
    return F.transform(F.array_remove(words, ""), lambda x: F.xxhash64(x))


def picked(hashes: Column, offsets: list[int], seed: int) -> Column:
    """For each place at which all offsets lie within the array, one hash of the values there."""
    last = F.size(hashes) - 1 - max(offsets)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.lit(seed), *(F.get(hashes, i + x) for x in offsets)))).otherwise(
            F.array().cast("array<bigint>"))
