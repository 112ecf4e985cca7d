"""Rounding, tolerant casts and guarded ratios, as SQL expression text.

One parsed expression costs one call into the JVM, where the same expression
built operator by operator in Python costs dozens.
"""

from __future__ import annotations


def number(x: str) -> str:
    """Double, or null where the text is not a number."""
    return f"try_cast({x} AS DOUBLE)"


def whole(x: str, type_name: str) -> str:
    """Narrow to an integer type, halves to even, null where it does not fit."""
    return f"try_cast(rint({number(x)}) AS {type_name})"


def round2(x: str) -> str:
    """Two decimals in binary arithmetic: 0.285 gives 0.28, 1.005 gives 1.0.

    For use on every row: halves go away from zero without the decimal object
    that the built-in `round` allocates per value.
    """
    hundredths = f"(({x}) * 100D)"
    return (
        f"CASE WHEN abs({hundredths} - rint({hundredths})) = 0.5D"
        f" THEN {hundredths} + signum({hundredths}) * 0.5D"
        f" ELSE rint({hundredths}) END / 100D"
    )


def round2_agg(x: str) -> str:
    """`round2` for quotients of exact sums, and for extremes and deviations.

    A quotient that lies on a half cent may miss it by its last bit, depending
    on how it is computed; snapping to 1e-7 first puts it back there. Sums do
    not need it: see `exact_sum`.
    """
    return f"round(round(({x}) * 1e7D) / 1e7D * 100D) / 100D"


def _whole(x: str) -> str:
    """The whole part as a long; null for what no long holds: NaN, infinity, 9.3e18 and beyond."""
    return f"try_cast(CAST({x} AS DOUBLE) AS BIGINT)"


def _fraction(x: str) -> str:
    """What is left of the whole part, in units of 1e-8."""
    return f"CAST(rint((CAST({x} AS DOUBLE) - {_whole(x)}) * 1e8D) AS BIGINT)"


def exact_sum(x: str) -> str:
    """Sum of numbers to eight decimals, as a decimal: exact, so independent of
    how Spark splits and merges the rows.

    Its state is two longs, the whole parts and the fractions, which are put
    together at the end; decimals of more than 18 digits would be an object per
    row. Values that no long holds are left out here and by `average`; a sum of
    whole parts beyond 9.2e18 is an error, never a wrong number.
    """
    fractions = f"CAST(sum({_fraction(x)}) AS DECIMAL(19, 0)) * CAST(0.00000001 AS DECIMAL(9, 8))"
    return f"(CAST(sum({_whole(x)}) AS DECIMAL(27, 8)) + {fractions})"


def sum2(x: str) -> str:
    """`exact_sum` to the cent, as a double."""
    return f"CAST(round({exact_sum(x)}, 2) AS DOUBLE)"


def average(x: str) -> str:
    """Mean of the values that `exact_sum` adds, from that sum."""
    return ratio(exact_sum(x), f"count({_whole(x)})")


def ratio(numerator: str, denominator: str) -> str:
    """Quotient of two aggregates in double, null when the denominator is zero."""
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D)"


def count_where(condition: str) -> str:
    """Rows for which a condition holds. Unlike `count_if`, it is not planned
    with a column of its own below the aggregate."""
    return f"count(CASE WHEN {condition} THEN 1 END)"
