"""Matches of a pattern with the text between them, as arrays, natively."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def found(text: str, pattern: str | Column) -> Column:
    """All matches, leftmost and without overlap."""
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))


def between(text: str, pattern: str | Column) -> Column:
    """The pieces before, between and after the matches: one more than there are matches."""
    return F.split(text, pattern, -1)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it or lambdas inside repeat it."""
    return F.get(F.transform(F.array(value), use), 0)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def starts_of(lengths: Column) -> Column:
    """For each of ``lengths`` the sum of those before it.

    By blocks of the square root of their number: what lies before a block is added up once for the block."""

    def by_blocks(n: Column, size: Column) -> Column:
        numbers = lambda count: F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        part = lambda b, many: F.slice(lengths, (b * size + 1).cast("int"), many.cast("int"))
        blocks = F.transform(numbers(F.ceil(n / size).cast("int")), lambda b: _sum(part(b, size)))

        def inside(sums: Column) -> Column:
            before = F.transform(numbers(F.size(sums)), lambda b: _sum(F.slice(sums, F.lit(1), b)))
            one = lambda at: F.transform(
                numbers(n), lambda i: F.get(at, F.floor(i / size).cast("int")) + _sum(part(F.floor(i / size), i % size))
            )
            return bound(before, one)

        return bound(blocks, inside)

    return bound(F.size(lengths), lambda n: bound(F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1)), lambda size: by_blocks(n, size)))


def located(matches: str, pieces: str) -> Column:
    """``text``, ``start`` and ``end`` (code points, end exclusive) of every match.  The work grows with the power 1.5 of
    the number of matches."""
    match = F.col(matches)
    # from the begin of a match to the begin of the next one
    step = F.transform(match, lambda m, i: F.length(m) + F.length(F.get(F.col(pieces), i + 1)))
    first = F.length(F.get(F.col(pieces), F.lit(0)))

    def placed(starts: Column) -> Column:
        return F.transform(
            match,
            lambda m, i: F.struct(m.alias("text"), (first + F.get(starts, i)).alias("start"), (first + F.get(starts, i) + F.length(m)).alias("end")),
        )

    return bound(bound(step, starts_of), placed)
