"""Mix sources to target weights: threshold histograms over document hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Hexadecimal digits of a document's hash, and how many of them each histogram adds.
KEY_DIGITS, DIGITS_PER_LEVEL = 15, 3


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Target of each source: columns source, source_size, target, repeats, rest.

    The sources, ordered by code point with null last, take the weights in turn and share the total
    size. A target stops at `max_repeats` times its source; the excess goes to the others by weight.
    With the sources in the order of cap over weight, the level that the uncapped ones reach is the
    largest of the levels that arise from capping the first 0, 1, 2... of them. `repeats` is how often
    the whole source fits into the target, `rest` what is then left to take.

    The windows run over one row per source, after the sum.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.lit(list(weights))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("level", (F.sum("source_size").over(everything) - before) / left)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .select("source", "source_size", "target", "repeats", (F.col("target") - F.col("repeats") * F.col("source_size")).alias("rest"))
    )


def _refine(sized: DataFrame, bounds: DataFrame, digits: int) -> DataFrame:
    """Follows each source's threshold `digits` deeper into the bucket it fell in.

    Only rows of that bucket are summed. The window orders the buckets of one histogram, of which
    there are at most 16 ** DIGITS_PER_LEVEL.
    """
    bucket = F.substring("key", 1, digits)
    order = Window.partitionBy("source").orderBy("bucket")
    sums = (
        sized.join(bounds.select(F.col("source").alias("s"), "bound"), F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("key").startswith(F.col("bound")))
        .groupBy("source", bucket.alias("bucket"))
        .agg(F.sum("size").alias("held"))
        .withColumn("upto", F.sum("held").over(order))
    )
    crossing = (
        bounds.alias("b")
        .join(sums.alias("h"), F.col("b.source").eqNullSafe(F.col("h.source")) & (F.col("b.below") + F.col("h.upto") > F.col("b.rest")))
        .groupBy(F.col("b.source").alias("source"))
        .agg(F.min(F.struct("h.bucket", "h.upto", "h.held")).alias("x"))
        .select(F.col("source").alias("s"), "x.*")
    )
    return bounds.drop("bound", "held").join(crossing, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", "repeats", "rest",
        F.col("bucket").alias("bound"), (F.col("below") + F.col("upto") - F.col("held")).alias("below"), "held",
    )


def _hash(of: Column) -> Column:
    return F.substring(F.md5(F.coalesce(of.cast("string"), F.lit("")).cast("binary")), 1, KEY_DIGITS)


def _thresholds(sized: DataFrame, weights: Sequence[int], max_repeats: int, key_digits: int) -> DataFrame:
    """Per source: s, source_size, target, whole (how often all of it enters), bound and with_bound of the threshold."""
    targets = stage(source_targets(sized, weights, max_repeats))
    bounds = targets.withColumns({"bound": F.lit(""), "below": F.lit(0).cast("long"), "held": F.lit(0).cast("long")})
    for digits in range(DIGITS_PER_LEVEL, key_digits + 1, DIGITS_PER_LEVEL):
        bounds = stage(_refine(sized, bounds, digits))
    threshold = bounds.select(
        F.col("source").alias("s"), "bound",
        (F.col("below") + F.col("held") - F.col("rest") < F.col("rest") - F.col("below")).alias("with_bound"),
    )
    return stage(
        targets.join(threshold, F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("source").alias("s"), "source_size", "target", F.col("repeats").alias("whole"), "bound", "with_bound"
        )
    )


def _repeats(key: Column, of: str = "") -> Column:
    """How often a document enters; `of` names the side of a join that the threshold is on."""
    bound, with_bound, whole = (F.col(of + c) for c in ("bound", "with_bound", "whole"))
    once_more = (key < bound) | ((key == bound) & with_bound)
    return whole + F.coalesce(once_more, F.lit(False)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """How often each document enters the mix: doc_id, source, size, source_size, target, repeats, taken.

    Every document of a source is taken `repeats` times, and once more if its hash is below the
    source's threshold. The threshold is found without sorting documents: a histogram of sizes by hash
    bucket says in which bucket the rest of the target runs out, and only that bucket is refined, down
    to single hashes. What has the hash on the threshold is taken if that comes nearer to the target, so a
    source misses it by at most half the size of that hash's rows: half a document where ids are unique,
    half of all rows without an id where they are on the threshold. A smaller budget takes a subset of
    what a larger one takes.

    Null text has size 0, and so has a text of white space; such documents follow the hash rule and add
    nothing. A null source is a source of its own, a null doc_id hashes like an empty string, rows with
    the same doc_id share a decision, and an empty table gives no rows. Other columns are not looked at.
    """
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash(F.col("doc_id")).alias("key")))
    by_source = _thresholds(sized, weights, max_repeats, KEY_DIGITS)
    return (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("repeats", _repeats(F.col("key")))
        .select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: each document as often as it enters, with the columns it came with.

    Where ids are unique it is what `mix` says. The text's hash comes after the id's, so different texts
    of one id, or without one, are decided apart, and a source misses its target by at most half the
    size of the rows that are equal in id and text. A source without any word has no target; its
    documents, empty ones, enter as they are.
    """
    key = F.concat(_hash(F.col("doc_id")), _hash(F.col("text")))
    sized = stage(docs.select("source", word_count(F.col("text")).alias("size"), key.alias("key")))
    by_source = _thresholds(sized, weights, max_repeats, 2 * KEY_DIGITS).alias("t")
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns])
    key = F.concat(_hash(F.col("d.doc_id")), _hash(F.col("d.text")))
    copies = F.when(F.col("t.source_size") == 0, F.lit(1)).otherwise(_repeats(key, "t.")).cast("int")
    entered = docs.alias("d").join(by_source, F.col("d.source").eqNullSafe(F.col("t.s")))
    return entered.select(F.explode(F.array_repeat(row, copies)).alias("row")).select("row.*")


SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         source_size * 3 AS cap
  FROM sources
), levels AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), keyed AS (
  SELECT source, key, sum(size) AS held FROM sized GROUP BY source, key
), running AS (
  SELECT *, sum(held) OVER (PARTITION BY source ORDER BY key) AS upto FROM keyed
), extra AS (
  SELECT r.source, r.key FROM running r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source
  WHERE b.source_size > 0
    AND (r.upto <= b.target - b.whole * b.source_size
     OR (r.upto - r.held <= b.target - b.whole * b.source_size
         AND r.upto - (b.target - b.whole * b.source_size) < (b.target - b.whole * b.source_size) - (r.upto - r.held)))
)
SELECT s.doc_id, s.source, s.size, b.source_size, b.target, (b.whole + (e.key IS NOT NULL)::BIGINT) AS repeats,
       (s.size * (b.whole + (e.key IS NOT NULL)::BIGINT))::BIGINT AS taken
FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN extra e ON e.source IS NOT DISTINCT FROM s.source AND e.key = s.key
"""
