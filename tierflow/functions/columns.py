"""Column -> Column helpers. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierflow import fixed_values as fx


def squeeze_spaces(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, r"\s+", " ")


def parse_timestamp(text: Column, fmt: str) -> Column:
    """NULL instead of an error for text that does not match; padding in the text is ignored."""
    return F.try_to_timestamp(squeeze_spaces(F.trim(text)), F.lit(fmt))


def truncated_timestamp(text: Column) -> Column:
    """The first 19 characters as ``yyyy-MM-dd HH:mm:ss``; NULL where they are none."""
    return F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """First format that matches, else NULL."""
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def first_word(text: Column) -> Column:
    return F.split(F.trim(text), " ").getItem(0)


def birth_date(text: Column) -> Column:
    """Date part of a birth date text; the sentinel date when it cannot be read."""
    return F.coalesce(
        F.try_to_date(first_word(text), fx.BIRTH_DATE_FORMAT),
        F.lit(fx.UNKNOWN_BIRTH_DATE).cast("date"),
    )


def age_in_years(born: Column, as_of: Column) -> Column:
    """Difference of the calendar years; NULL for the sentinel date."""
    sentinel = F.lit(fx.UNKNOWN_BIRTH_DATE).cast("date")
    return F.when(born != sentinel, F.year(as_of) - F.year(born))


def age_group(age: Column) -> Column:
    return (
        F.when(age >= fx.GERIATRIC_FROM, fx.GERIATRIC)
        .when(age >= fx.ADULT_FROM, fx.ADULT)
        .when(age.isNotNull(), fx.PEDIATRIC)
        .otherwise(fx.UNKNOWN_AGE)
    )


def value_segment(balance: Column) -> Column:
    """A missing balance counts as low value."""
    return (
        F.when(balance >= fx.HIGH_VALUE_FROM, fx.HIGH_VALUE)
        .when(balance >= fx.MEDIUM_VALUE_FROM, fx.MEDIUM_VALUE)
        .otherwise(fx.LOW_VALUE)
    )


def stay_days(admitted: Column, discharged: Column) -> Column:
    """Calendar days; a same-day stay counts one day, open and negative stays are kept as they are."""
    days = F.datediff(discharged, admitted)
    return F.when(days == 0, 1).otherwise(days)


def count_if(condition: Column) -> Column:
    """0 for an all-false group and NULL for no rows, like a sum over 1 and 0."""
    return F.sum(F.when(condition, 1).otherwise(0))


def year_month(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def money(amount: Column) -> Column:
    """Exact decimal, so sums do not depend on the order in which tasks finish."""
    return amount.cast("decimal(18,2)")
