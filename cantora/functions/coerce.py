"""Tolerant conversions: bad input becomes NULL or a stated default, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cantora.functions.text import let, strip


def to_date_lenient(x: Column) -> Column:
    """``yyyy-MM-dd``, ``yyyy-MM`` or ``yyyy`` to a date; anything else to NULL."""
    return let(
        strip(x),
        lambda s: F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date"))
        .when(s.rlike(r"^\d{4}-\d{2}$"), F.concat(s, F.lit("-01")).try_cast("date"))
        .when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit("-01-01")).try_cast("date")),
    )


def iso_date_text(x: Column) -> Column:
    """Lenient date written back as ``yyyy-MM-dd`` text."""
    return F.date_format(to_date_lenient(x), "yyyy-MM-dd")


def to_int_or_zero(x: Column) -> Column:
    """Number text to a whole number (through double, so ``12.0`` works); bad to 0."""
    number = strip(x.cast("string")).try_cast("double")
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def to_bool(x: Column) -> Column:
    """True/False text to boolean. Missing stays NULL and ``False`` stays false."""
    return strip(x.cast("string")).try_cast("boolean")
