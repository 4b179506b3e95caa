"""Tables written in buckets of one key, so that joins on it shuffle nothing."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row

from indexloom.operators.joins import copied, hot_keys, in_pieces
from indexloom.session import shared_folder

PIECE = "_piece"


@dataclass(frozen=True)
class Layout:
    """How tables are laid out to meet: their key, the number of buckets, and the hot keys of the large table with their pieces."""

    keys: tuple[str, ...]
    buckets: int
    hot: tuple[Row, ...]

    @property
    def on(self) -> list[str]:
        return [*self.keys, PIECE]


def layout(large: DataFrame, keys: Sequence[str], buckets: int | None = None) -> Layout:
    """The layout for a large table. A key that outgrows an average bucket is cut into pieces, which go to buckets of their own."""
    buckets = buckets or int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Layout(tuple(keys), buckets, tuple(hot_keys(large, keys)))


def _written(df: DataFrame, to: Layout, name: str | None) -> DataFrame:
    spark = df.sparkSession
    name = name or f"colocated_{uuid.uuid4().hex}"
    writer = df.repartition(to.buckets, *to.on).write.bucketBy(to.buckets, *to.on).sortBy(*to.on)
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def write_large(large: DataFrame, to: Layout, salt: Column | str | None = None, name: str | None = None) -> DataFrame:
    """The large table in buckets, as a table of the catalog; `salt` as for `key_join`. It is shuffled once, here, for all joins to come."""
    return _written(in_pieces(large, to.keys, to.hot, salt, PIECE), to, name)


def write_entries(entries: DataFrame, to: Layout, name: str | None = None) -> DataFrame:
    """A table of entries per key in the same buckets; entries of a hot key stand in the bucket of each of its pieces."""
    return _written(copied(entries, to.keys, to.hot, PIECE), to, name)


def attach(large: DataFrame, entries: DataFrame, to: Layout, how: str = "left") -> DataFrame:
    """Joins tables of one layout, bucket by bucket. The large side keeps its piece, so further tables can be attached."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"the pieces of a hot key cannot be put together by a {how!r} join")
    return large.join(entries, to.on, how)
