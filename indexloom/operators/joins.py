"""Equi-join that stays balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.session import stage


def fits_broadcast(df: DataFrame) -> bool:
    """True if the optimizer's size estimate is within the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= limit


def is_scan(df: DataFrame) -> bool:
    """True if the frame reads files without joining or grouping them, so that file sizes tell its size."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName().startswith("Relation") or plan.nodeName() == "LogicalRelation"


# Keys are counted by so many hashes before they are counted one by one.
HASHES = 1 << 16


def hot_keys(df: DataFrame, on: Sequence[str]) -> list[Row]:
    """Keys that alone outgrow an average shuffle partition, with the number of pieces to cut them into.

    Whatever the size of the input, at most one key per shuffle partition qualifies, and the pieces
    add up to at most twice the number of partitions.

    Rows are first counted by a hash of their key, which moves a bounded number of sums. Only keys whose hash has enough rows
    are counted themselves; mostly there are none, and a table of as many keys as rows is not shuffled to find that out.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.pmod(F.xxhash64(*on), F.lit(HASHES))
    seen = Observation()
    placed = df.select(place.alias("__place")).observe(seen, F.count(F.lit(1)).alias("total"))
    # The total is counted on the way; the largest are as many as could qualify.
    fullest = placed.groupBy("__place").agg(F.count(F.lit(1)).alias("__rows")).orderBy(F.desc("__rows")).limit(partitions).collect()
    if not fullest:
        return []
    total = seen.get["total"]
    full = [r["__place"] for r in fullest if r["__rows"] * partitions > total]
    if not full:
        return []
    counts = df.select(*on).where(place.isin(full)).groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    largest = counts.orderBy(F.desc("__rows")).limit(partitions).collect()
    return [Row(**{k: r[k] for k in on}, __pieces=-(-r["__rows"] * partitions // total)) for r in largest if r["__rows"] * partitions > total]


def key_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt: Column | str | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join `right` to `left` on equal keys (left, inner, left_semi or left_anti).

    A right side whose size is known to be small is left to Spark to broadcast. One whose size is not known, as it
    comes from an aggregate or a join, is written out first and so measured. Otherwise both sides are
    shuffled. The keys of the left side are counted first, and the rows of a hot key, null included,
    are cut into pieces that go to different partitions, each meeting its own copy of the matching
    right rows.

    `salt` must give the same number for a row each time it is computed, or a re-run task could
    send rows to other pieces than the first run did; a row position in a file does. The default is
    a hash of the row, which keeps exact copies of a row together. `keys_from` is a cheaper frame to
    count the keys on, where the left side is the result of other joins.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"key_join cannot spread a {how!r} join")
    on = list(on)
    if how in ("left_semi", "left_anti"):
        # Only asks whether there is a match, so entries listed many times need not travel.
        right = right.select(*on).distinct()
    if not fits_broadcast(right) and not is_scan(right):
        right = stage(right)
    if fits_broadcast(right):
        # No hint: Spark broadcasts by the same estimate, and adaptive execution may still decide otherwise.
        return left.join(right, on, how)

    found = hot_keys(left if keys_from is None else keys_from, on)
    if not found:
        return left.join(right, on, how)

    spread = in_pieces(left, on, found, salt, "__piece")
    return spread.join(copied(right, on, found, "__piece"), [*on, "__piece"], how).drop("__piece")


def _pieces_of(like: DataFrame, on: Sequence[str], found: Sequence[Row]) -> DataFrame:
    """Hot keys and their pieces. As few rows as shuffle partitions, so safe to broadcast."""
    schema = T.StructType([*like.select(*on).schema, T.StructField("__pieces", T.IntegerType())])
    return F.broadcast(like.sparkSession.createDataFrame([r for r in found if all(r[k] is not None for k in on)], schema))


def in_pieces(left: DataFrame, on: Sequence[str], found: Sequence[Row], salt: Column | str | None, piece: str) -> DataFrame:
    """Adds the piece of its key that each row belongs to: 0 unless the key is among the hot ones `found`, null keys included."""
    row = F.xxhash64(*left.columns) if salt is None else F.col(salt) if isinstance(salt, str) else salt
    no_key = [r["__pieces"] for r in found if any(r[k] is None for k in on)]
    any_null = F.lit(False)
    for key in on:
        any_null = any_null | F.col(key).isNull()
    return (
        left.withColumns({"__salt": row, "__null": any_null})
        .join(_pieces_of(left, on, found), list(on), "left")
        .withColumn("__cut", F.when(F.col("__null"), F.lit(max(no_key, default=1))).otherwise(F.coalesce("__pieces", F.lit(1))))
        # Hashed, as the places of a hot key's rows may be regular.
        .withColumn(piece, F.pmod(F.xxhash64("__salt"), "__cut").cast("int"))
        .drop("__salt", "__null", "__cut", "__pieces")
    )


def copied(right: DataFrame, on: Sequence[str], found: Sequence[Row], piece: str) -> DataFrame:
    """Entries of hot keys once for each piece, all others once for piece 0."""
    return (
        right.join(_pieces_of(right, on, found), list(on), "left")
        .withColumn(piece, F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)))
        .drop("__pieces")
    )


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on equal keys.

    Spark cannot split a skewed key of a full outer join. Its parts it can: the matches, an inner join,
    on either side, and the rows of each side that match nothing on that side. Both inputs are read three
    times, so one that is not a table is written first.
    """
    left, right = (df if is_scan(df) else stage(df) for df in (left, right))
    found = key_join(left, right, on, "inner")
    for one, other in ((left, right), (right, left)):
        found = found.unionByName(key_join(one, other, on, "left_anti"), allowMissingColumns=True)
    return found


# Bits that keys are hashed to: 8 MB as bitmaps, whatever the tables hold.
KEY_BITS = 1 << 26
_BITMAP = 1 << 15


def key_bitmaps(df: DataFrame, on: Sequence[str], bits: int = KEY_BITS) -> DataFrame:
    """Which hashes the keys of a table have: bitmaps of 4 KB, at most bits / 32768 rows. Full keys only."""
    place = _hashed_place(on, bits)
    full = df.where(F.concat(*[F.col(k).cast("string") for k in on]).isNotNull())
    return full.groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bitmap"))


def _hashed_place(on: Sequence[str], bits: int) -> Column:
    """From 1 on, as buckets are numbered."""
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1


def with_possible_match(df: DataFrame, bitmaps: DataFrame, on: Sequence[str], bits: int = KEY_BITS) -> DataFrame:
    """Adds `__may`: false for rows whose key is not among those of `key_bitmaps`, or not whole; true for all others and a few more."""
    place = _hashed_place(on, bits)
    within = F.bitmap_bit_position(place)
    # The bitmaps are bounded by `bits`, whatever the table they were made of.
    placed = df.withColumn("__bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmaps), "__bucket", "left")
    byte = F.conv(F.hex(F.substring("__bitmap", (F.floor(within / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    whole = F.concat(*[F.col(k).cast("string") for k in on]).isNotNull()
    may = whole & (F.bit_get(byte, (within % 8).cast("int")) == 1)
    return placed.withColumn("__may", F.coalesce(may, F.lit(False))).drop("__bucket", "__bitmap")


def sparse_join(left: DataFrame, right: DataFrame, on: Sequence[str], salt: Column | str | None = None) -> DataFrame:
    """Left join of a large table to one that lists few of its keys; the same rows as `key_join`.

    Where the right side is too large to broadcast, its keys are still small as a bitmap of their hashes. Left rows that
    the bitmap rules out get nulls and are not shuffled; only the others meet the right side. The left side is read
    twice for that, so a frame that is not a table is written first. Where the bitmap rules out less than half of the rows, which
    one look at the keys tells, reading twice costs more than it saves, and all rows are joined.
    """
    on = list(on)
    if not fits_broadcast(right) and not is_scan(right):
        right = stage(right)
    if fits_broadcast(right):
        return left.join(right, on, "left")
    left = left if is_scan(left) else stage(left)
    bitmaps = stage(key_bitmaps(right, on))
    possible = with_possible_match(left.select(*on), bitmaps, on).agg(F.avg(F.col("__may").cast("int"))).first()[0]
    if possible is None or possible > 0.5:
        return key_join(left, right, on, "left", salt)
    told = with_possible_match(left, bitmaps, on)
    found = key_join(told.where("__may").drop("__may"), right, on, "left", salt)
    types = {f.name: f.dataType for f in found.schema}
    nothing = told.where(~F.col("__may")).select(*[F.col(c) if c in left.columns else F.lit(None).cast(types[c]).alias(c) for c in found.columns])
    return found.unionByName(nothing)
