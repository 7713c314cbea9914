"""Number coercion and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, digits with an optional point, optional exponent. Java's own parser would also take
# `1.5d`, `NaN` and `Infinity`, none of which is a price.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Sign and digits before the point of a number without an exponent.
WHOLE_PART = r"^\s*[+-]?\d++(?=(\.\d*+)?\s*$)"


def to_number(text: Column) -> Column:
    """Text to double; whatever is not a finite plain number becomes NULL."""
    number = text.try_cast("double")
    return F.when(text.rlike(PLAIN_NUMBER) & (F.abs(number) < F.lit(float("inf"))), number)


def to_strict_bigint(text: Column, name: str) -> Column:
    """Text to bigint; a fraction is cut off, a missing or unreadable value fails the job.

    Digits before the point are taken as they stand, so ids above 2^53 keep every digit; only what has an exponent, or
    no such digits, needs a number to shift. Nearly all cells meet one pattern, once. The patterns come
    first because a cast that fails costs an exception per row.
    """
    digits = F.regexp_substr(text, F.lit(WHOLE_PART)).cast("bigint")
    shifted = text.cast("decimal(38,18)").cast("bigint")
    problem = F.concat(F.lit(f"column {name} needs a whole number, found: "),
                       F.coalesce(text, F.lit("nothing")))
    return F.coalesce(digits, F.when(text.rlike(PLAIN_NUMBER), shifted).otherwise(F.raise_error(problem).cast("bigint")))


def exact_mean(value: Column) -> Column:
    """Mean of an integer or two-decimal column as decimal(34,16), rounded once.

    `avg` over decimal(10,2) keeps six decimals, so casting its result to two would round
    twice. Values are widened before they are summed; the quotient below has 16 decimals and
    holds 10^13 rows and a sum of 10^18 per group.
    """
    return F.sum(value.cast("decimal(20,2)")).cast("decimal(20,2)") / F.count(value).cast("decimal(13,0)")


def nan_to_null(value: Column) -> Column:
    """Spark orders NaN above every number, so it must not reach `max`."""
    return F.when(~F.isnan(value), value)


def half_even_int(value: Column) -> Column:
    """Double to int, ties to even; a plain cast would cut the fraction off."""
    return F.rint(value).cast("int")
