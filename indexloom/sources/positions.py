"""Where a row stands in its files, as one number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, BLOCK, SEQ = "file", "block", "seq"
# Line numbers stay below this, so two of them fit into one decimal number.
_LINES = 10**18


def place_in_files() -> list[Column]:
    """Columns that order the rows of a file scan: the file, where its split begins, and a number within the split.

    They belong into the scan itself, before any filter, and the scan must be written before `line_numbers`.
    """
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SEQ),
    ]


def line_numbers(written: DataFrame, target: str = "line") -> DataFrame:
    """One long per row, in the order of file names and of lines within a file, in place of its place in the files.

    A task numbers what it reads as it likes, and large files come first. The numbers of a split are next to each other, though, so a prefix
    sum over the splits puts them in order: every split has the span of its own numbers, files add
    up the spans of their splits, and the totals of the files before are added on top. What is summed and
    sent to all rows is one row per split, and no row of `written` moves. Rows that were filtered away leave gaps.

    `written` is a table, not a scan of the files: read again with other settings, the files could
    be split in another way. The same table always gives the same numbers.
    """
    spans = written.groupBy(FILE, BLOCK).agg(F.min(SEQ).alias("__first"), (F.max(SEQ) - F.min(SEQ) + 1).alias("__span"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = F.sum("__span").over(Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    splits = spans.select(FILE, BLOCK, "__first", F.coalesce(within, F.lit(0)).alias("__within"))
    # One row per file.
    files = spans.groupBy(FILE).agg(F.sum("__span").alias("__lines"))
    files = files.select(FILE, F.coalesce(F.sum("__lines").over(before.orderBy(FILE)), F.lit(0)).alias("__before"))
    base = splits.join(files, FILE).select(FILE, BLOCK, (F.col("__before") + F.col("__within") - F.col("__first")).alias("__base"))
    rest = [c for c in written.columns if c not in (FILE, BLOCK, SEQ)]
    return written.join(F.broadcast(base), [FILE, BLOCK]).select(*rest, (F.col("__base") + F.col(SEQ)).alias(target))


def first_then(first: str, second: str) -> Column:
    """Two line numbers as one decimal number that is ordered by the first and then by the second."""
    return (F.col(first).cast("decimal(19,0)") * F.lit(_LINES).cast("decimal(19,0)") + F.col(second)).cast("decimal(38,0)")
