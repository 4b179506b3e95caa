"""Column expressions shared by the operators; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact, so a sum does not depend on how rows are spread over partitions.
MONEY = "decimal(18,4)"

_CURRENCY_MARKS = "[,£]"


def _text(c: Column | str) -> Column:
    return F.regexp_replace(c, _CURRENCY_MARKS, "")


def clean_money(c: Column | str) -> Column:
    """`£1,234.50` to an exact amount of up to four decimals.

    Text that is no number fails the job, and so does an amount with more decimals, which would be rounded.
    """
    exact = _text(c).cast("decimal(38,16)")
    rounded = exact.cast(MONEY)
    return F.when(exact == rounded, rounded).when(exact.isNotNull(), F.raise_error(F.lit("amount with more than four decimals")).cast(MONEY))


def clean_count(c: Column | str) -> Column:
    """As `clean_money`, for counts, which may carry fractions."""
    return _text(c).cast("double")


def lenient_number(c: Column | str, strip_marks: bool = True) -> Column:
    """Number text to double; text that is no number becomes null."""
    return (_text(c) if strip_marks else F.col(c) if isinstance(c, str) else c).try_cast("double")


def zero_pad(c: Column | str, width: int) -> Column:
    """Pad a code with leading zeros up to `width`; longer codes keep all their characters."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def has_code(c: Column | str, pattern: str) -> Column:
    """True where `pattern` occurs anywhere in the text."""
    return F.rlike(c, F.lit(pattern))


def null_if_zero(c: Column | str) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(0))


def pct_change(current: Column | str, base: Column | str) -> Column:
    """Change from base to current in percent; null where the base is zero or null."""
    current = F.col(current) if isinstance(current, str) else current
    base = F.col(base) if isinstance(base, str) else base
    return F.try_divide(current - base, base) * 100


def rolled_forward(previous: Column, change_pct: Column) -> Column:
    """The value after `previous` has moved by a percentage."""
    return previous + previous * change_pct / 100


def real_change(value: Column, previous: Column, deflator_pct: Column) -> Column:
    """Change on the previous value once that has been raised by the deflator, in percent."""
    return pct_change(value, rolled_forward(previous, deflator_pct))
