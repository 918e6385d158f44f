"""Array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Strings = "array<string>"


def empty_strings() -> Column:
    return F.array().cast(Strings)


def or_empty(tokens: Column) -> Column:
    """Null in, empty array out."""
    return F.coalesce(tokens, empty_strings())


def unfolded(tokens: Column | str) -> Column:
    """An array column on its way into ``explode``.

    Given a bare column, the optimizer adds a not-empty filter and pushes it below the
    projection that computes the array, which then runs up to three times per row. Any
    expression around the column prevents that.
    """
    return F.flatten(F.array(tokens))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Inside a lambda Spark re-evaluates an outer expression for every element, so a
    sorted or split array must be bound to a lambda variable first.
    """
    return F.transform(F.array(value), body)[0]


def run_lengths(tokens: Column) -> Column:
    """``array<struct<token, n>>``: each distinct token with its count, by token.

    Sorting inside the row keeps the count map-only: no shuffle on (document, token).
    """

    def lengths(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda begin, k: F.struct(
                    F.get(ordered, begin - 1).alias("token"),
                    (F.coalesce(F.get(s, k + 1), F.size(ordered) + 1) - begin).alias("n"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), lengths)).otherwise(
        F.array().cast("array<struct<token:string,n:int>>")
    )


def replace_each(tokens: Column, values: list[str], result: Callable[[Column], Column]) -> Column:
    """Apply ``result`` to elements that are not in ``values``."""
    if not values:
        return F.transform(tokens, result)
    return F.transform(tokens, lambda x: F.when(x.isin(values), x).otherwise(result(x)))
