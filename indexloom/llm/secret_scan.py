"""Secrets in texts: a ledger of scanned contents, so that only new contents and new rules are scanned."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.session import shared_folder, stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern`, leftmost and without overlap, whose `group` has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        """Changes with all that decides what the rule finds."""
        told = f"{self.pattern}\0{self.group}\0{self.least}"
        return f"{self.kind}:{hashlib.sha256(told.encode()).hexdigest()[:16]}"


# The kinds every scan reports. Where a match that is too short cannot hide a longer one, the length
# is part of the pattern: a run of hexadecimal digits, or of capitals and digits, is found whole or not at all.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
LEDGER_SCHEMA = "blob binary, versions array<string>, found array<struct<version: string, start: int, end: int>>"


def blob_of(text: Column) -> Column:
    """The address of a content: SHA-256 of its UTF-8 bytes; null is the empty content."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _matches(text: Column, rule: Rule) -> Column:
    """All matches in order: version, number, and the lengths of what lies before it, of the match and of its group."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else whole
    zipped = F.filter(F.arrays_zip(between.alias("between"), whole.alias("whole"), value.alias("value")), lambda m: m["whole"].isNotNull())
    return F.transform(
        zipped,
        lambda m, i: F.struct(F.lit(rule.version).alias("version"), i.alias("i"), m["between"], m["whole"], m["value"]),
    )


_MATCH = "array<struct<version: string, i: int, between: int, whole: int, value: int>>"


def read_ledger(spark, path: str) -> DataFrame:
    """All entries: blob, versions (rules it was scanned by), found (version, start, end). Empty where none was written."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def unseen(texts: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Different contents of `texts` (column text) with rules that the ledger has not scanned them by: blob, text, versions."""
    # Copies are dropped within each task first, so a content travels once per task and not once per row.
    blobs = texts.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    seen = ledger.select("blob", F.explode("versions").alias("version")).groupBy("blob").agg(F.collect_set("version").alias("seen"))
    every = F.array(*(F.lit(r.version) for r in rules))
    return blobs.join(seen, "blob", "left").select("blob", "text", F.array_except(every, F.coalesce("seen", F.expr("cast(array() as array<string>)"))).alias("versions")).where(F.size("versions") > 0)


def scan(contents: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger entries of `unseen` contents: each is searched by the rules in its `versions`.

    Built-in functions give the texts of matches and what lies between them; a running sum of their lengths over
    the matches of a content gives the places. A text with very many matches costs as many small rows.
    """
    text = F.col("text")
    none = F.expr(f"cast(array() as {_MATCH})")
    searched = [
        F.when(F.array_contains("versions", r.version) & text.rlike(r.pattern), _matches(text, r).cast(_MATCH)).otherwise(none) for r in rules
    ]
    matches = contents.select("blob", "versions", F.explode_outer(F.concat(*searched)).alias("m")).select("blob", "versions", "m.*")
    upto = F.sum(F.col("between") + F.col("whole")).over(Window.partitionBy("blob", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    least = F.create_map(*(F.lit(x) for r in rules for x in (r.version, r.least)))
    placed = matches.withColumn("end", upto.cast("int"))
    span = F.struct("version", (F.col("end") - F.col("whole")).alias("start"), "end")
    valid = F.when(F.col("value") >= F.try_element_at(least, F.col("version")), span)
    return placed.groupBy("blob", "versions").agg(F.collect_list(valid).alias("found")).select("blob", "versions", "found")


def update_ledger(texts: DataFrame, ledger: str, rules: Sequence[Rule]) -> None:
    """Scan what is new in `texts` and add it to the ledger, in one write that fails or succeeds as a whole."""
    scan(unseen(texts, read_ledger(texts.sparkSession, ledger), rules), rules).write.mode("append").parquet(ledger)


def secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, ledger: str | None = None, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets at every path: (path column), blob, spans (start, end, kind), by start and then by the order of the rules.

    Each row of `docs` is a version of what stands at its path. Contents are addressed by SHA-256; contents that
    the `ledger` (a folder; a new one in the shared folder, if not given) has no entry of, or none of some rule's
    present version, are scanned once, whatever the number of their paths, and entered. Findings then go
    back to all paths. So a second call over the same and some new versions reads only the new ones with regular
    expressions, and a changed rule is the only one that is searched again.

    Places are code points from 0, `end` is exclusive. Within a kind, matches are leftmost and do not overlap; one
    that is too short counts for what follows it, and is then dropped. A null text is the empty one, without
    spans. Repeated rows and ids are kept each, a null id too, no rows give no rows, other columns are not looked at.
    All of it is DataFrame functions. Two calls at once may scan a content twice; it is still told once.
    """
    ledger = ledger or f"{shared_folder(docs.sparkSession)}/ledger-{uuid.uuid4().hex}"
    versions = docs.select(F.col(path), F.col(text).alias("text"))
    update_ledger(versions, ledger, rules)
    kind = F.create_map(*(F.lit(x) for r in rules for x in (r.version, r.kind)))
    rank = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.version, i)))
    told = (
        read_ledger(docs.sparkSession, ledger).select("blob", F.explode("found").alias("f")).select("blob", "f.*")
        .where(F.col("version").isin([r.version for r in rules]))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", F.try_element_at(rank, F.col("version")).alias("rank"), "end", F.try_element_at(kind, F.col("version")).alias("kind")))).alias("spans"))
        .select(F.col("blob").alias("of"), F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("spans"))
    )
    addressed = versions.select(F.col(path), blob_of(F.col("text")).alias("blob"))
    # Written, so that the join has nothing but its own exchanges and a content that very many paths share can be split.
    told = stage(told)
    nothing = F.expr("cast(array() as array<struct<start: int, end: int, kind: string>>)")
    return addressed.join(told, F.col("blob") == F.col("of"), "left").select(F.col(path), "blob", F.coalesce("spans", nothing).alias("spans"))


def _sql() -> str:
    """The same rows by searching every text by itself; the base kinds as stated, short matches dropped afterwards."""
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    base = (
        Rule("assign", r"""(%s)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % words, 2, 12),
        Rule("access", "AKIA[A-Z0-9]+", 0, 18),
        Rule("hex", "[0-9a-f]+", 0, 16),
    )
    found = []
    for i, r in enumerate(base + MORE):
        pattern = r.pattern.replace("'", "''")
        found.append(f"""
  SELECT k, {i} AS rank, '{r.kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}', 0)) AS whole, unnest(regexp_extract_all(text, '{pattern}', {r.group})) AS value,
         unnest(string_split_regex(text, '{pattern}')[:-2]) AS between, unnest(range(len(regexp_extract_all(text, '{pattern}', 0)))) AS i, {r.least} AS least
  FROM numbered WHERE regexp_matches(text, '{pattern}')""")
    return f"""
WITH numbered AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
matches AS MATERIALIZED ({" UNION ALL ".join(found)}),
placed AS (
  SELECT k, rank, kind, value, least, length(whole) AS n, sum(length(between) + length(whole)) OVER (PARTITION BY k, kind ORDER BY i) AS upto FROM matches
), spans AS (
  SELECT k, rank, kind, upto - n AS start, kind || ':' || (upto - n) || ':' || upto AS told FROM placed WHERE length(value) >= least
), summed AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(told, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(told, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM numbered LEFT JOIN summed USING (k)
"""


SQL = _sql()
