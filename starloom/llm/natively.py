"""Column expressions over arrays and texts that several native operators use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters between words, for translate(): space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_PATTERN), "")


def count_of(text: Column, characters: str) -> Column:
    """How many of these characters stand in ``text``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value computed once."""
    return F.transform(F.array(value), then)[0]


def running(values: Column, combine: Callable[[Column, Column], Column], neutral: int = 0) -> Column:
    """Inclusive running sums, or maxima, of an array of longs: each round combines with 1, 2, 4, ... places before."""

    def round_(sums: Column, k: Column) -> Column:
        shifted = F.slice(F.concat(F.array_repeat(F.lit(neutral).cast("long"), F.call_function("shiftleft", F.lit(1), k)), sums), F.lit(1), F.size(sums))
        return F.zip_with(sums, shifted, combine)

    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    return F.when(F.size(values) < 2, values).otherwise(F.aggregate(F.sequence(F.lit(0), rounds - 1), values, round_))


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, lambda a, b: F.greatest(a, b))


def pairs(values: Column, then: Callable[[Column, Column], Column]) -> Column:
    """``then`` of each two neighbours of an array."""
    short = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), short), F.slice(values, F.lit(2), short), then)
