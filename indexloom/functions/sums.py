"""A sum of doubles that does not depend on the order of rows or on how they are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of a bin: 24 bits. A bin's sum is a long, which holds 2**39 rows.
_BIN = float(1 << 24)
# From here on a number does not fit the first bin.
_LARGEST = float(1 << 80)


def stable_sum(value: Column | str) -> Column:
    """Sum of a double column that is the same to the last bit whatever the partitions; null without a value.

    Each number is cut at fixed places into four whole numbers: multiples of 2**24, of 1, of 2**-24 and of 2**-48. Whole numbers
    are summed exactly, in any order, by hashing and before the shuffle; only the four totals are added as doubles, once. What is
    below 2**-48 of a number is cut off. With a number that is not finite or beyond 2**80 the sum is an ordinary one.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    odd = F.isnan(x) | (F.abs(x) >= _LARGEST)
    rest = F.when(~odd, x) / _BIN
    total = F.lit(0.0)
    for unit in (_BIN, 1.0, 1 / _BIN, 1 / _BIN**2):
        # A cast cuts towards zero, so what is left is exact and keeps its sign.
        whole = rest.cast("long")
        total = total + F.sum(whole).cast("double") * unit
        rest = (rest - whole) * _BIN
    return F.when(F.bool_or(odd), F.sum(x)).otherwise(total)
