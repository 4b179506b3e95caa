"""Code mapping, the ordered status rules, and lookups against tables of codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.operators.joins import key_join, sparse_join

MISSING = "Missing"


def code_label(source: str, mapping: Mapping[str, str]) -> Column:
    """Label of a code, null where the code is not in the mapping.

    One set test per label: no join, so nothing to shuffle or broadcast.
    """
    by_label: dict[str, list[str]] = {}
    for code, label in mapping.items():
        by_label.setdefault(label, []).append(code)
    branches = [F.when(F.col(source).isin(codes), F.lit(label)) for label, codes in by_label.items()]
    return F.coalesce(*branches)


def map_codes(df: DataFrame, mapping: Mapping[str, str], source: str, target: str, default: str = MISSING) -> DataFrame:
    return df.withColumn(target, F.coalesce(code_label(source, mapping), F.lit(default)))


def missing_rows(df: DataFrame, target: str) -> DataFrame:
    """Rows whose lookup found nothing."""
    return df.where(F.col(target) == MISSING)


def missing_counts(df: DataFrame, targets: Sequence[str], rows: str | None = None) -> DataFrame:
    """One row with the number of missing values of each lookup. `rows` says how many rows one of a summed frame stands for."""
    each = F.lit(1) if rows is None else F.col(rows)
    return df.agg(*[F.coalesce(F.sum(F.when(F.col(t) == MISSING, each)), F.lit(0)).cast("long").alias(f"missing_{t}") for t in targets])


@dataclass(frozen=True)
class StatusRule:
    """One step of the cascade: codes of a column that set a label."""

    step: str
    source: str
    codes: tuple[str, ...]
    label: str


def status_cascade(
    df: DataFrame,
    rules: Sequence[StatusRule],
    collapse: Mapping[str, str],
    start: str,
    target: str = "status",
) -> DataFrame:
    """Apply rules from weakest to strongest; a later match replaces the label set before.

    Every step leaves its label in `<target>_<step>` for audit, and the last label is collapsed
    to the published one.
    """
    current = F.lit(start)
    steps = {f"{target}_start": current}
    for rule in rules:
        current = F.when(F.col(rule.source).isin(list(rule.codes)), F.lit(rule.label)).otherwise(current)
        steps[f"{target}_{rule.step}"] = current
    audited = df.withColumns(steps)
    last = f"{target}_{rules[-1].step}" if rules else f"{target}_start"
    return audited.withColumn(target, F.coalesce(code_label(last, collapse), F.col(last)))


def audit_columns(rules: Sequence[StatusRule], target: str = "status") -> list[str]:
    return [f"{target}_start", *[f"{target}_{rule.step}" for rule in rules]]


def regulated_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str], take: Sequence[str], salt: Column | str | None = None) -> DataFrame:
    """Left lookup on several keys. A key listed twice in the lookup doubles its rows; see `duplicate_keys`.

    Most sales are in no such lookup, so those that cannot match are told from a bitmap of its keys and not shuffled.
    """
    return sparse_join(df, lookup.select(*on, *take), on, salt)


def duplicate_keys(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys listed more than once, which would multiply the rows that match them."""
    return lookup.groupBy(*on).agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")


def category_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str], target: str = "category", salt: Column | str | None = None) -> DataFrame:
    """Add the lower-cased category of a key, or Missing."""
    lookup = lookup.select(*on, F.lower(target).alias(target))
    return key_join(df, lookup, on, "left", salt).withColumn(target, F.coalesce(target, F.lit(MISSING)))


def unmatched_keys(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of `df` without an entry in the lookup."""
    return key_join(df.select(*on).distinct(), lookup, on, "left_anti")


def only_in(lookup: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of one lookup version whose key is not in the other version."""
    return key_join(lookup, other, on, "left_anti")
