"""URL block and allow rules, carried over to the aliases of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm.components import components
from indexloom.session import stage

# (action, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
# A whole tag, whose quoted values may hold a >; and the value of an attribute, wherever in the tag it stands.
_TAG = r"""(?is)<(?:link|meta)(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""(?is)[\s"'/]%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH_TARGET = r"""(?is)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*["']?\s*([^"']*)"""
# Characters of URLs and how HTML may write them; the ampersand comes last, so nothing is read twice.
_ENTITIES = (
    ('"', r"(?i)&(?:quot|#0*34|#x0*22);"), ("'", r"(?i)&(?:apos|#0*39|#x0*27);"), ("<", r"(?i)&(?:lt|#0*60|#x0*3c);"), (">", r"(?i)&(?:gt|#0*62|#x0*3e);"),
    ("/", r"(?i)&(?:sol|#0*47|#x0*2f);"), (":", r"(?i)&(?:colon|#0*58|#x0*3a);"), ("?", r"(?i)&(?:quest|#0*63|#x0*3f);"), ("=", r"(?i)&(?:equals|#0*61|#x0*3d);"),
    ("&", r"(?i)&(?:amp|#0*38|#x0*26);"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? or #, with A-Z lower-cased; empty without ://."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return _part(url, 2)


def without_dots(path: Column) -> Column:
    """A path with its `.` and `..` steps taken, as a browser does; `..` at the top is the top."""

    def step(held: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(1)))).when(part == ".", held).otherwise(F.concat(held, F.array(part)))

    parts = F.split(path, "/")
    taken = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.array_join(taken, "/"), folder)).otherwise(path)


def resource_of(url: Column) -> Column:
    """What a URL names: host, path without dot steps, and query. Scheme and fragment do not count; null without a host."""
    path = path_of(url)
    named = F.concat(host_of(url), F.when(path == "", "/").otherwise(without_dots(path)), _part(url, 3))
    return F.when(host_of(url) != "", named)


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, quoted or not, with entities read; empty if the tag has none."""
    pattern = _ATTRIBUTE % name
    value = F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))
    for character, written in _ENTITIES:
        value = F.regexp_replace(value, written, character)
    return F.trim(value)


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def page_links(pages: DataFrame) -> DataFrame:
    """Redirects by meta refresh and canonical links of pages: columns from_url, to_url.

    Every such tag of a page is an edge, the second refresh and the second canonical link too. Attributes may
    stand in any order, quoted or not; `rel` may list other words besides `canonical`. Entities that URLs use
    are read, and a target is resolved against the page's URL: `//host`, `/path`, `?query`, `#fragment` (the page
    itself) and relative paths. A `base` tag is not looked at.
    """
    marked = F.lower("html").contains("canonical") | F.lower("html").contains("refresh")
    tags = pages.where(marked).select(F.col("url").alias("from_url"), F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0))).alias("tag"))
    tag = F.col("tag")
    canonical = F.lower(tag).startswith("<link") & F.array_contains(F.split(F.lower(attribute(tag, "rel")), r"\s+"), "canonical")
    refresh = F.lower(tag).startswith("<meta") & (F.lower(attribute(tag, "http-equiv")) == "refresh")
    target = F.when(canonical, attribute(tag, "href")).when(refresh, F.trim(F.regexp_extract(attribute(tag, "content"), _REFRESH_TARGET, 1)))
    found = tags.select("from_url", target.alias("to")).where("`to` <> ''")
    scheme, origin = F.regexp_extract("from_url", "(?s)^(.*?:)//", 1), F.regexp_extract("from_url", r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract("from_url", r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.regexp_extract("from_url", r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    absolute = (
        F.when(F.col("to").startswith("//"), F.concat(scheme, "to"))
        .when(F.col("to").startswith("/"), F.concat(origin, "to"))
        .when(F.col("to").startswith("?"), F.concat(page, "to"))
        .when(F.col("to").startswith("#"), F.col("from_url"))
        .when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("to"))
        .otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), "to"))
    )
    return found.select("from_url", absolute.alias("to_url"))


def judge(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule of each distinct (host, path) of `places` that has one: host, path, rule, action.

    A host is looked up under itself and each parent domain, a path under the lengths at which rules
    of that domain end, so both lookups are equi-joins and a domain with many rules multiplies nothing.
    The rule with the longest text wins, allow before block among equals.
    """
    rules = rules.select("action", "rule_host", "rule_path").distinct()
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    candidates = (
        places.select("host", "path").distinct().where("host <> ''")
        .withColumn("rule_host", F.explode(parents))
        .join(lengths, "rule_host")
        .withColumn("length", F.explode("lengths"))
        .withColumn("rule_path", F.substring(F.col("path"), F.lit(1), F.col("length")))
    )
    fits = candidates.join(rules, ["rule_host", "rule_path"]).withColumn("rule", F.concat("rule_host", "rule_path"))
    best = F.max(F.struct(F.length("rule"), F.col("action") == "allow", "rule", "action")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.action")


def filter_urls(pages: DataFrame, rules: DataFrame, links: DataFrame) -> DataFrame:
    """Judges every row of `pages` (page_id, url): page_id, host, path, rule, verdict, reason.

    A page with a rule gets the rule's verdict. The others get that of their aliases: pages and link
    ends (`links`: from_url, to_url) that redirects and canonical links connect, in either direction
    and over any number of steps, are one class. A class with an explicitly allowed member is allowed;
    else one with a blocked member is blocked; all else is allowed. Reason is rule, alias or default.

    A null url or one without :// has an empty host and path, fits no rule and is allowed. Repeated
    rows and ids are judged each. Without links only rules count; empty tables give no rows. Other
    columns are not looked at. Classes are found by distributed components; nothing is collected.
    """
    ends = links.select(resource_of(F.col("from_url")).alias("a"), resource_of(F.col("to_url")).alias("b"))
    member = components(ends)
    url = F.concat(F.lit("x://"), F.col("node"))
    members = stage(member.select("node", "component", host_of(url).alias("host"), path_of(url).alias("path")))
    # A page that names no path ends at its host, also for the rules; a link end is read the same way.
    told = members.join(judge(members, rules), ["host", "path"])
    classes = told.groupBy("component").agg(
        F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked")
    )
    inherited = members.join(classes, "component").select(
        F.col("node").alias("resource"), F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("inherited")
    )
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), resource_of(F.col("url")).alias("resource"))
    return (
        parts.join(judge(parts, rules), ["host", "path"], "left")
        .join(inherited, "resource", "left")
        .select(
            "page_id", "host", "path", "rule", F.coalesce("action", "inherited", F.lit("allow")).alias("verdict"),
            F.when(F.col("rule").isNotNull(), "rule").when(F.col("inherited").isNotNull(), "alias").otherwise("default").alias("reason"),
        )
    )


SQL = r"""
WITH RECURSIVE rules(action, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), parts AS (
  SELECT page_id, url, html, translate(split_part(split_part(split_part(rest, '/', 1), '?', 1), '#', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         split_part(split_part(rest, '#', 1), '?', 1) AS named, named[instr(named || '/', '/'):] AS path, split_part(rest, '#', 1)[length(named) + 1:] AS query
  FROM (SELECT *, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages)
), tags AS (
  SELECT url, host, path, query, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)[\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM parts WHERE host <> ''
), attributes AS (
  SELECT *, list_transform(regexp_extract_all(tag, '(?is)[\s"''/][a-z-]+\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)'),
         lambda a: struct_pack(k := lower(regexp_replace(split_part(a[2:], '=', 1), '\s', '', 'g')), v := trim(regexp_replace(a[instr(a, '=') + 1:], '^\s*', ''), '"'''))) AS given
  FROM tags
), told AS (
  SELECT url, host, path, query, lower(tag[2:5]) AS name, list_filter(given, lambda g: g.k = 'rel')[1].v AS rel, list_filter(given, lambda g: g.k = 'href')[1].v AS href,
         list_filter(given, lambda g: g.k = 'http-equiv')[1].v AS equiv, list_filter(given, lambda g: g.k = 'content')[1].v AS content
  FROM attributes
), written AS (
  SELECT url, host, path, query,
         CASE WHEN name = 'link' AND list_contains(string_split_regex(lower(trim(rel)), '\s+'), 'canonical') THEN href
              WHEN name = 'meta' AND lower(trim(equiv)) = 'refresh' THEN regexp_extract(content, '(?is)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*["'']?\s*([^"'']*)', 1) END AS target
  FROM told
), targets AS (
  SELECT host, path, query, trim(replace(replace(replace(replace(target, '&#x2F;', '/'), '&#47;', '/'), '&#38;', '&'), '&amp;', '&')) AS target FROM written WHERE target <> ''
), absolute AS (
  SELECT row_number() OVER () AS k, host, path, query,
         CASE WHEN target LIKE '//%' THEN target[3:]
              WHEN target LIKE '/%' THEN host || target
              WHEN target LIKE '?%' THEN host || path || target
              WHEN target LIKE '#%' THEN host || path || query
              WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target[instr(target, '://') + 3:]
              WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN ''
              ELSE host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || target END AS rest
  FROM targets
), ends AS (
  SELECT k, 'a' AS side, host, path, query FROM absolute
  UNION ALL
  SELECT k, 'b', translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) FROM absolute
), page_ends AS (
  SELECT k, side, host, path, query FROM ends WHERE host <> ''
  UNION ALL SELECT DISTINCT NULL::BIGINT, 'p', host, path, query FROM parts WHERE host <> ''
), plain AS (
  SELECT k, side, host, path AS raw_path, query,
         host || CASE WHEN path = '' THEN '/'
              WHEN NOT regexp_matches(path, '/\.\.?(/|$)') THEN path
              ELSE array_to_string(list_reduce(list_prepend([''], list_transform(string_split(path, '/')[2:], lambda p: [p])),
                     lambda held, p: CASE p[1] WHEN '.' THEN held WHEN '..' THEN held[:greatest(len(held) - 1, 1)] ELSE list_concat(held, p) END), '/')
                   || CASE WHEN regexp_matches(path, '/\.\.?$') THEN '/' ELSE '' END END || query AS node
  FROM page_ends
), linked AS (
  SELECT x.node AS a, y.node AS b FROM plain x JOIN plain y ON x.k = y.k AND x.side = 'a' AND y.side = 'b'
), edges AS (
  SELECT a, b FROM linked WHERE a <> b UNION SELECT b, a FROM linked WHERE a <> b
), reach(node, other) AS (
  SELECT DISTINCT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
), places AS (
  SELECT host, path FROM parts
  UNION SELECT regexp_extract(node, '(?s)^([^/?#]*)([^?#]*)', 1), regexp_extract(node, '(?s)^([^/?#]*)([^?#]*)', 2) FROM reach
), ranked AS (
  SELECT p.host, p.path, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(rule_host || rule_path) DESC, action, rule_host || rule_path DESC) AS r
  FROM places p JOIN rules ON (p.host = rule_host OR p.host LIKE '%.' || rule_host) AND starts_with(p.path, rule_path)
), judged AS (
  SELECT host, path, rule, action FROM ranked WHERE r = 1
), inherited AS (
  SELECT node, CASE WHEN bool_or(action = 'allow') THEN 'allow' ELSE 'block' END AS verdict
  FROM reach JOIN judged ON host = regexp_extract(other, '(?s)^([^/?#]*)([^?#]*)', 1) AND path = regexp_extract(other, '(?s)^([^/?#]*)([^?#]*)', 2)
  GROUP BY node
)
SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.action, i.verdict, 'allow') AS verdict,
       CASE WHEN j.rule IS NOT NULL THEN 'rule' WHEN i.verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM parts p LEFT JOIN judged j ON p.host = j.host AND p.path = j.path
LEFT JOIN plain n ON n.side = 'p' AND n.host = p.host AND n.raw_path = p.path AND n.query = p.query
LEFT JOIN inherited i ON i.node = n.node
"""
