"""Plain SQL for every query, written against the supplied tables only."""

from __future__ import annotations

# Common table expressions, each built on those before it. A query names the last one it needs.
_LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_returnflag, l_discount, l_shipdate,
         lpad(CASE WHEN l_linenumber = 7 THEN 'Q7' ELSE CAST(l_linenumber AS VARCHAR) END, 4, '0') AS destination,
         lpad(l_returnflag, 5, '0') AS route,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS weight,
         l_quantity AS journeys,
         CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem
)"""
_PRODUCTS = """
products AS (
  SELECT p_partkey, p_type, substr(CAST(p_size AS VARCHAR), 1, 1) || upper(substr(p_type, 1, 3)) AS product,
         p_brand AS product_group
  FROM part
)"""
_CARRIERS = """
carriers AS (
  SELECT l_suppkey AS s_suppkey, coalesce(n_name, 'Missing') AS carrier, coalesce(r_name, 'Missing') AS region,
         coalesce(lpad(CAST(s_nationkey AS VARCHAR), 4, '0'), 'Missing') AS origin
  FROM (SELECT DISTINCT l_suppkey FROM lineitem) LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""
_SALES = """
sales AS (
  SELECT l.*, c.carrier, c.region, c.origin, coalesce(p.product, 'Missing') AS product,
         coalesce(p.product_group, 'Missing') AS product_group, p.p_type
  FROM lines l JOIN carriers c ON l.l_suppkey IS NOT DISTINCT FROM c.s_suppkey LEFT JOIN products p ON l.l_partkey = p.p_partkey
)"""
_WIDE_SALES = """
sales AS (
  SELECT l.* EXCLUDE (destination), coalesce(CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 4 THEN lpad(CAST(l_suppkey AS VARCHAR), 4, '0')
                                                 ELSE CAST(l_suppkey AS VARCHAR) END, 'Missing') AS origin,
         coalesce(CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 4 THEN lpad(CAST(o_custkey AS VARCHAR), 4, '0')
                       ELSE CAST(o_custkey AS VARCHAR) END, 'Missing') AS destination,
         coalesce(CAST(l_partkey AS VARCHAR), 'Missing') AS product
  FROM lines l LEFT JOIN orders ON l_orderkey = o_orderkey
)"""
_CLASSIFIED = """
classified AS (
  SELECT *,
         CASE WHEN region IN ('AFRICA', 'AMERICA') THEN 'Lon SE' WHEN region = 'ASIA' THEN 'Regional'
              WHEN region = 'EUROPE' THEN 'Long D' ELSE 'Missing' END AS sector,
         CASE WHEN product_group IN ('Brand#1', 'Brand#5') THEN 'Full'
              WHEN product_group IN ('Brand#2', 'Brand#3', 'Brand#6', 'Brand#7') THEN 'Reduced'
              WHEN product_group IN ('Brand#4', 'Brand#8') THEN 'Season' ELSE 'Other' END AS ticket_type,
         CASE WHEN substr(product, 1, 1) = '1' THEN '1' ELSE '2' END AS class
  FROM sales
)"""
_CATEGORIES = """
categories AS (
  SELECT DISTINCT product, product_group,
         CASE p_type WHEN 'PROMO' THEN 'advance' WHEN 'LARGE' THEN 'season' WHEN 'STANDARD' THEN 'anytime'
                     WHEN 'ECONOMY' THEN 'offpeak' WHEN 'MEDIUM' THEN 'other' END AS category
  FROM products WHERE p_type IN ('PROMO', 'LARGE', 'STANDARD', 'ECONOMY', 'MEDIUM')
)"""
_REGULATED = """
regulated AS (
  SELECT origin, destination, route, product, max(l_linestatus) AS flag2
  FROM sales WHERE l_discount = 0 GROUP BY origin, destination, route, product
)"""
_AUDITED = """
audited AS (
  SELECT x.*,
         CASE WHEN region = 'EUROPE' THEN 'Unregulated_by_PCC' ELSE status_class END AS status_pcc
  FROM (SELECT x.*, CASE WHEN class = '1' THEN 'Unregulated_by_Class' ELSE status_exceptions END AS status_class
  FROM (SELECT x.*, CASE WHEN product IN ('3MED', '4SMA') THEN 'Unregulated_by_Product' ELSE status_products END AS status_exceptions
  FROM (SELECT x.*, CASE WHEN product IN ('2STA', '2LAR', '3STA', '3ECO', '4LAR', '4MED', '2PRO', '5SMA')
                         THEN 'Regulated_by_Product' ELSE status_toc END AS status_products
  FROM (SELECT c.*, r.flag2, 'Not Assigned' AS status_start,
               CASE WHEN r.flag2 = 'O' THEN 'Regulated_by_TOC' ELSE 'Not Assigned' END AS status_toc
        FROM classified c LEFT JOIN regulated r
          ON c.origin = r.origin AND c.destination = r.destination AND c.route = r.route AND c.product = r.product
  ) x) x) x) x
)"""
_FACT = """
fact AS (
  SELECT a.*, CASE WHEN status_pcc IN ('Regulated_by_TOC', 'Regulated_by_Product') THEN 'Regulated' ELSE 'Unregulated' END AS status,
         coalesce(k.category, 'Missing') AS category
  FROM audited a LEFT JOIN categories k ON a.product = k.product AND a.product_group = k.product_group
)"""
_PRICES = """
prices AS (
  SELECT origin, destination, route, product,
         100 * CAST(sum(weight) FILTER (WHERE l_linestatus = 'F' AND year <= 1997 AND l_discount > 0) AS DOUBLE) AS lb,
         sum(journeys) FILTER (WHERE l_linestatus = 'F' AND year <= 1997) AS lbn,
         100 * CAST(sum(weight) FILTER (WHERE l_linestatus = 'F' AND year > 1997 AND l_discount > 0) AS DOUBLE) AS lc,
         sum(journeys) FILTER (WHERE l_linestatus = 'F' AND year > 1997) AS lcn,
         100 * CAST(sum(weight) FILTER (WHERE year <= 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year <= 1997) AS derived_base,
         100 * CAST(sum(weight) FILTER (WHERE year > 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year > 1997) AS derived_current,
         CASE WHEN lbn > 0 THEN coalesce(lb, 0) / lbn END AS list_base,
         CASE WHEN lcn > 0 THEN coalesce(lc, 0) / lcn END AS list_current
  FROM sales GROUP BY origin, destination, route, product
)"""
_CLASS_PRICES = """
class_prices AS (
  SELECT origin, destination, route, class,
         100 * CAST(sum(weight) FILTER (WHERE year <= 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year <= 1997) AS price_base,
         100 * CAST(sum(weight) FILTER (WHERE year > 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year > 1997) AS price_current
  FROM classified GROUP BY origin, destination, route, class
)"""
_FILLED = """
filled AS (
  SELECT f.*, coalesce(p.list_base, p.derived_base) AS price_base, coalesce(p.list_current, p.derived_current) AS price_current
  FROM fact f LEFT JOIN prices p
    ON f.origin = p.origin AND f.destination = p.destination AND f.route = p.route AND f.product = p.product
  WHERE f.category <> 'advance'
)"""
_DETAIL = """
detail AS (
  SELECT *, (price_current - price_base) / price_base * 100 AS change
  FROM filled WHERE price_base <> 0 AND price_current <> 0
)"""
_ADVANCE = """
advance AS (
  SELECT a.*, p.price_base, p.price_current, (p.price_current - p.price_base) / p.price_base * 100 AS change
  FROM (SELECT carrier, origin, destination, route, product, product_group, class, sector,
               sum(weight) AS weight, sum(journeys) AS journeys
        FROM fact WHERE category = 'advance'
        GROUP BY carrier, origin, destination, route, product, product_group, class, sector) a
  JOIN class_prices p
    ON a.origin = p.origin AND a.destination = p.destination AND a.route = p.route AND a.class = p.class
  WHERE p.price_base <> 0 AND p.price_current <> 0
)"""
_UNITED = """
united AS (
  SELECT origin, destination, product, sector, class, 'advance' AS category, 'Unregulated' AS status, weight, change FROM advance
  UNION ALL
  SELECT origin, destination, product, sector, class, category, status, weight, change
  FROM (SELECT carrier, origin, destination, route, product, product_group, sector, class, category, status,
               sum(weight) AS weight, max(change) AS change
        FROM detail GROUP BY carrier, origin, destination, route, product, product_group, sector, class, category, status)
)"""
_GRID = """
grid AS (
  SELECT coalesce(p.sector, w.sector) AS sector, coalesce(p.class, w.class) AS class,
         coalesce(p.category, w.category) AS category, coalesce(p.status, w.status) AS status,
         priced_weight, total_weight, weighted_change, weighted_change * CAST(total_weight AS DOUBLE) AS contribution
  FROM (SELECT sector, class, category, status, sum(weight) AS priced_weight,
               sum(CAST(weight AS DOUBLE) * change) / CAST(sum(weight) AS DOUBLE) AS weighted_change
        FROM united
        WHERE regexp_matches(origin, '[0-9]{4}') AND regexp_matches(destination, '[0-9]{4}')
          AND product NOT IN ('2MED', '4STA') AND change > -20 AND change < 20
        GROUP BY sector, class, category, status) p
  FULL OUTER JOIN (SELECT sector, class, category, status, sum(weight) AS total_weight FROM fact
                   GROUP BY sector, class, category, status) w
    ON p.sector = w.sector AND p.class = w.class AND p.category = w.category AND p.status = w.status
  WHERE total_weight IS NULL OR total_weight <> 0
)"""


def _cut_sum(value: str) -> str:
    """A sum of doubles by whole numbers of four sizes, 24 bits apart, each summed exactly."""
    rest, parts = f"(({value}) / 16777216.0::DOUBLE)", []
    for unit in ("16777216.0::DOUBLE", "1.0::DOUBLE", "(1 / 16777216.0::DOUBLE)", "(1 / 281474976710656.0::DOUBLE)"):
        parts.append(f"CAST(sum(CAST(trunc({rest}) AS BIGINT)) AS DOUBLE) * {unit}")
        rest = f"(({rest} - trunc({rest})) * 16777216.0::DOUBLE)"
    return f"((({parts[0]} + {parts[1]}) + {parts[2]}) + {parts[3]})"


_EXACT_GRID = _GRID.replace("sum(CAST(weight AS DOUBLE) * change)", _cut_sum("CAST(weight AS DOUBLE) * change"))
_FLOWS = """
flows AS (
  SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS flow_id, lpad(CAST(o_custkey AS VARCHAR), 4, '0') AS origin,
         lpad(o_orderstatus, 4, '0') AS destination, lpad(substr(o_orderpriority, 1, 1), 5, '0') AS route,
         CASE WHEN year(o_orderdate) = 2001 THEN '31122999' ELSE '3112' || CAST(year(o_orderdate) AS VARCHAR) END AS valid_until,
         CASE WHEN year(o_orderdate) = 2001 THEN 2100 ELSE year(o_orderdate) END AS until_year,
         strftime(o_orderdate, '%d%m%Y') AS valid_from
  FROM orders
)"""
_FARES = """
fares AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 7, '0') AS flow_id, 'T' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS ticket_code,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS INTEGER) AS fare
  FROM lineitem
)"""
_LATEST = """
latest AS (
  SELECT flow_id, origin, destination, route, valid_until
  FROM (SELECT *, max(until_year) OVER (PARTITION BY origin, destination, route) AS last_year FROM flows)
  WHERE until_year = last_year
)"""
_TICKETS = """
tickets AS (
  SELECT DISTINCT 'T' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS ticket_code, '2SS' || l_returnflag AS product FROM lineitem
)"""
_FEED = """
feed AS (
  SELECT l.origin, l.destination, l.route, f.flow_id, f.ticket_code, f.fare, t.product
  FROM fares f JOIN latest l ON f.flow_id = l.flow_id LEFT JOIN tickets t ON f.ticket_code = t.ticket_code
)"""
_KEPT = """
kept AS (
  SELECT origin, destination, route, flow_id, ticket_code, fare, product
  FROM (SELECT *, row_number() OVER (PARTITION BY origin, destination, route, ticket_code, fare ORDER BY flow_id, product) AS place FROM feed)
  WHERE place = 1
)"""
_QUARTERS = """
quarters AS (
  SELECT CASE WHEN month(l_shipdate) >= 4 THEN year(l_shipdate) + 10 ELSE year(l_shipdate) + 9 END AS fy,
         CAST(fy AS VARCHAR) || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0') || ' Quarter '
           || CAST(CASE WHEN month(l_shipdate) >= 4 THEN (month(l_shipdate) - 4) // 3 + 1 ELSE 4 END AS VARCHAR) AS year_and_quarter,
         region, weight, journeys, l_linenumber, l_returnflag
  FROM lines JOIN carriers ON l_suppkey IS NOT DISTINCT FROM s_suppkey
),
usage_wide AS (
  SELECT CAST(fy AS INTEGER) AS financial_year_key, year_and_quarter,
         CAST(sum(weight) FILTER (WHERE region = 'EUROPE') AS DOUBLE) AS rl,
         CAST(sum(weight) FILTER (WHERE region IN ('AFRICA', 'AMERICA')) AS DOUBLE) AS rs,
         CAST(sum(weight) FILTER (WHERE region = 'ASIA') AS DOUBLE) AS rr,
         CAST(sum(weight) FILTER (WHERE region = 'MIDDLE EAST') AS DOUBLE) AS rn,
         sum(journeys) FILTER (WHERE region = 'EUROPE') AS jl,
         sum(journeys) FILTER (WHERE region IN ('AFRICA', 'AMERICA')) AS js,
         sum(journeys) FILTER (WHERE region = 'ASIA') AS jr,
         sum(journeys) FILTER (WHERE region = 'MIDDLE EAST') AS jn
  FROM quarters
  WHERE l_linenumber <> 7 AND l_returnflag IN ('A', 'R') AND year_and_quarter >= '2005-06 Quarter 2'
  GROUP BY ALL
)"""
_USAGE = """
usage_rows AS (
  SELECT financial_year_key, year_and_quarter, 'Long-distance' AS sector, rl AS revenue, jl AS journeys FROM usage_wide
  UNION ALL SELECT financial_year_key, year_and_quarter, 'London and South East', rs, js FROM usage_wide
  UNION ALL SELECT financial_year_key, year_and_quarter, 'Regional', rr, jr FROM usage_wide
  UNION ALL SELECT financial_year_key, year_and_quarter, 'Non-franchised', rn, jn FROM usage_wide
  UNION ALL SELECT financial_year_key, year_and_quarter, 'All operators', rl + rs + rr, jl + js + jr FROM usage_wide
)"""
_TRAILING = """
trailing_year AS (
  SELECT financial_year_key, year_and_quarter, sector,
         CASE WHEN count(revenue) OVER w = 4 THEN sum(revenue) OVER w END AS revenue,
         CASE WHEN count(journeys) OVER w = 4 THEN sum(journeys) OVER w END AS journeys
  FROM usage_rows
  WINDOW w AS (PARTITION BY sector ORDER BY financial_year_key, year_and_quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
)"""
_CHANGES = """
known AS (
  SELECT *, last_value(revenue / nullif(journeys, 0) IGNORE NULLS) OVER (
           PARTITION BY sector ORDER BY financial_year_key ROWS UNBOUNDED PRECEDING) AS ratio
  FROM trailing_year WHERE year_and_quarter LIKE '%Quarter 3%' AND sector <> 'Non-franchised'
),
changes AS (
  SELECT 'January 20' || substr(year_and_quarter, 6, 2) AS label,
         CASE sector WHEN 'Long-distance' THEN 'Long distance' ELSE sector END AS sector, value
  FROM (SELECT *, count(value) OVER (PARTITION BY year_and_quarter) AS complete
        FROM (SELECT *, (ratio / lag(ratio) OVER (PARTITION BY sector ORDER BY financial_year_key) - 1) * 100 AS value FROM known))
  WHERE complete = 4
)"""
_SUMS = """
sums AS (
  SELECT CASE region WHEN 'AFRICA' THEN 'London and South East' WHEN 'EUROPE' THEN 'Long distance' WHEN 'ASIA' THEN 'Regional'
                     ELSE region END AS sector, year, sum(weight) AS weight, sum(journeys) AS journeys
  FROM lines JOIN carriers ON l_suppkey IS NOT DISTINCT FROM s_suppkey GROUP BY 1, 2
),
levels AS (
  SELECT sector, 'All tickets' AS ticket_category, 1 AS category_order, year, CAST(weight AS DOUBLE) / journeys AS value FROM sums
  UNION ALL SELECT 'All operators', 'All tickets', 2, year, CAST(sum(weight) AS DOUBLE) / sum(journeys) FROM sums GROUP BY year
  UNION ALL SELECT 'RPI', 'All items index', 3, year, CAST(sum(weight) AS DOUBLE) / sum(journeys) FROM sums GROUP BY year
)"""
_FILLED_SERIES = """
report AS (
  SELECT sector, CAST(sum(weight) AS DOUBLE) AS total_weight,
         (CAST(sum(weight) FILTER (WHERE year > 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year > 1997)
          / (CAST(sum(weight) FILTER (WHERE year <= 1997) AS DOUBLE) / sum(journeys) FILTER (WHERE year <= 1997)) - 1) * 100 AS average_change,
         CAST(sum(weight) AS DOUBLE) / (SELECT CAST(sum(weight) AS DOUBLE) FROM sums) AS share
  FROM sums GROUP BY sector
),
total_change AS (
  SELECT sum(average_change * total_weight) / sum(total_weight) AS value FROM report
  WHERE sector IN ('London and South East', 'Long distance', 'Regional')
),
blocks AS (
  SELECT l.sector, l.ticket_category, l.category_order, l.value AS previous,
         CASE l.sector WHEN 'RPI' THEN 2.5 WHEN 'All operators' THEN (SELECT value FROM total_change) ELSE r.average_change END AS change,
         CASE l.sector WHEN 'All operators' THEN 100.0 ELSE r.share * 100 END AS share
  FROM levels l LEFT JOIN report r ON l.sector = r.sector WHERE l.year = (SELECT max(year) FROM levels)
),
newest AS (
  SELECT *, previous + previous * change / 100 AS value,
         (SELECT previous * 1.025 FROM blocks WHERE sector = 'RPI') AS deflated
  FROM blocks
),
filled_series AS (
  SELECT 8 AS load_id, 'Approved' AS publication_status, sector, ticket_category, category_order,
         'January ' || CAST(year AS VARCHAR) AS label, year - 1990 AS label_order, value FROM levels
  UNION ALL
  SELECT 8, 'Approved', sector, ticket_category, category_order, 'January ' || CAST((SELECT max(year) + 1 FROM levels) AS VARCHAR),
         (SELECT max(year) + 1 FROM levels) - 1990, value FROM newest
  UNION ALL
  SELECT 8, 'Approved', sector, ticket_category, category_order, 'Average change in price (%)',
         (SELECT max(year) + 2 FROM levels) - 1990, change FROM newest
  UNION ALL
  SELECT 8, 'Approved', sector, ticket_category, category_order, 'Expenditure weights (%) total',
         (SELECT max(year) + 3 FROM levels) - 1990, share FROM newest
  UNION ALL
  SELECT 8, 'Approved', sector, ticket_category, category_order, 'Real terms change in average price year on year',
         (SELECT max(year) + 4 FROM levels) - 1990, (value - previous * 1.025) / (previous * 1.025) * 100 FROM newest
  UNION ALL
  SELECT 8, 'Approved', sector, ticket_category, category_order, 'Real terms change in average price year on 2004',
         (SELECT max(year) + 5 FROM levels) - 1990, (value - deflated) / deflated * 100 FROM newest
)"""

# The other series: its block names, and the years in its statistic labels.
_TICKET_TYPE_NAMES = [
    ("'London and South East'", "'London and SE operators'"),
    ("'Long distance'", "'Long-distance operators'"),
    ("'Regional'", "'Regional operators'"),
    ("'All operators'", "'All tickets'"),
    ("'All items index'", "'RPI (all items)'"),
    ("'RPI'", "'RPI (all items)'"),
    (
        "'Real terms change in average price year on year'",
        "(SELECT 'Real terms change in average price ' || CAST(max(year) + 1 AS VARCHAR) || ' on ' || CAST(max(year) AS VARCHAR) FROM levels)",
    ),
    (
        "'Real terms change in average price year on 2004'",
        "(SELECT 'Real terms change in average price ' || CAST(max(year) + 1 AS VARCHAR) || ' on 1995' FROM levels)",
    ),
]


def _as_ticket_type(sql: str) -> str:
    for name, other in _TICKET_TYPE_NAMES:
        sql = sql.replace(name, other)
    return sql


_TO_SALES = [_LINES, _PRODUCTS, _CARRIERS, _SALES]
_TO_FACT = [*_TO_SALES, _CLASSIFIED, _CATEGORIES, _REGULATED, _AUDITED, _FACT]
_TO_DETAIL = [*_TO_FACT, _PRICES, _FILLED, _DETAIL]
_TO_GRID = [*_TO_DETAIL, _CLASS_PRICES, _ADVANCE, _UNITED, _GRID]
_TO_FEED = [_FLOWS, _FARES, _LATEST, _TICKETS, _FEED]
_TO_CHANGES = [_LINES, _CARRIERS, _QUARTERS, _USAGE, _TRAILING, _CHANGES]
_TO_SERIES = [_LINES, _CARRIERS, _SUMS, _FILLED_SERIES]


def _with(parts: list[str], select: str) -> str:
    return "WITH" + ",".join(parts) + "\n" + select.strip()


def _tally(parts: list[str], source: str, keys: str) -> str:
    return _with(parts, f"SELECT {keys}, count(*) AS n, CAST(sum(weight) AS DOUBLE) AS weight FROM {source} GROUP BY {keys}")


def _sum(parts: list[str], source: str, keys: str, journeys: bool = False) -> str:
    extra = ", sum(journeys) AS journeys" if journeys else ""
    return _with(parts, f"SELECT {keys}, CAST(sum(weight) AS DOUBLE) AS weight{extra} FROM {source} GROUP BY {keys}")


_KEY = "origin, destination, route, product"
_CELL = "sector, class, category, status"
_FACT_ROW = f"carrier, origin, destination, route, product, product_group, {_CELL}"


def _per_key(parts: list[str], source: str, names: list[str]) -> str:
    values = ", ".join(f"round(max({c}), 4) AS {c}" for c in names)
    return _with(parts, f"SELECT {_KEY}, count(*) AS n, CAST(sum(weight) AS DOUBLE) AS weight, {values} FROM {source} GROUP BY {_KEY}")


def _price_join(which: str, sales: list[str] = _TO_SALES) -> str:
    joined = f"(SELECT s.*, p.{which}_base, p.{which}_current FROM sales s LEFT JOIN prices p USING ({_KEY}))"
    return _per_key([*sales, _PRICES], joined, [f"{which}_base", f"{which}_current"])


def _detail_rows(where: str) -> str:
    return _with(_TO_DETAIL, f"""
SELECT {_FACT_ROW}, journeys, CAST(weight AS DOUBLE) AS weight, round(price_base, 4) AS price_base,
       round(price_current, 4) AS price_current, round(change, 4) AS change
FROM detail WHERE {where}""")


def _parts_sold(period: str, other: str) -> str:
    keys = "l_partkey, l_suppkey, l_linenumber, l_returnflag"
    same = " AND ".join(f"o.{k} = s.{k}" for k in keys.split(", "))
    return f"""
SELECT DISTINCT {keys} FROM lineitem s WHERE year(l_shipdate) {period}
  AND NOT EXISTS (SELECT 1 FROM lineitem o WHERE year(o.l_shipdate) {other} AND {same})""".strip()


_SPLITS = [
    ("sector1", ["sector"]), ("sector2", ["sector"]), ("class", ["class"]), ("sector and class", ["sector", "class"]),
    ("regulation", ["status"]), ("category", ["category"]), ("sector and category", ["sector", "category"]),
    ("sector, class and regulation", ["sector", "class", "status"]), ("class and regulation", ["class", "status"]),
]


def _split(name: str, keys: list[str], columns: list[str]) -> str:
    part = keys[0] if len(keys) == 1 else "'(''' || " + " || ''', ''' || ".join(keys) + " || ''')'"
    shown = ", ".join(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in columns)
    return f"""SELECT '{name}' AS split, {part} AS part, {shown},
  round(coalesce(sum(contribution), 0) / CAST(sum(total_weight) AS DOUBLE), 4) AS average_change,
  CAST(sum(total_weight) AS DOUBLE) AS total_weight,
  round(CAST(sum(total_weight) AS DOUBLE) / (SELECT CAST(sum(total_weight) AS DOUBLE) FROM grid), 6) AS share
FROM grid GROUP BY {", ".join(keys)}"""


_CELL_LIST = ["sector", "class", "category", "status"]
_AUDIT = "status_start, status_toc, status_products, status_exceptions, status_class, status_pcc"
_SERIES_ROW = "load_id, publication_status, sector, ticket_category, category_order, label, label_order"


_EXTENDED = f"""
SELECT {_SERIES_ROW},
       CASE WHEN label LIKE 'January%' AND label <> 'January ' || CAST((SELECT max(year) + 1 FROM levels) AS VARCHAR) THEN round(value, 4) END AS value
FROM filled_series"""


def _series_rows(where: str) -> str:
    return _with(_TO_SERIES, f"SELECT sector, ticket_category, label, round(value, 4) AS value FROM filled_series WHERE {where}")


def oracle_sql() -> dict[str, str]:
    return {
        "clean_currency": """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(replace(replace('£' || format('{:,.2f}', l_extendedprice), ',', ''), '£', '') AS DECIMAL(18,4)) AS DOUBLE) AS amount
FROM lineitem""",
        "clean_currency_lenient": """
SELECT l_orderkey, l_linenumber,
       TRY_CAST(replace(replace('£' || format('{:,.2f}', l_extendedprice), ',', ''), '£', '') AS DOUBLE) AS receipts,
       TRY_CAST(CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
                                  WHEN 'N' THEN '1,' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 3, '0')
                                  ELSE ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' ' END AS DOUBLE) AS issues
FROM lineitem""",
        "zero_pad": """
SELECT o_orderkey,
       CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 4 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS code4,
       CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 5 THEN lpad(CAST(o_orderkey AS VARCHAR), 5, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS code5
FROM orders""",
        "regex_filter": _tally(
            _TO_SALES,
            "(SELECT * FROM sales WHERE regexp_matches(product, '1[A-Z]{3}|2[A-Z]{3}') AND regexp_matches(origin, '[0-9]{4}') AND regexp_matches(destination, '[0-9]{4}'))",
            "origin, destination, product",
        ),
        "not_in_filter": _tally(_TO_SALES, "(SELECT * FROM sales WHERE product NOT IN ('2MED', '4STA'))", "product"),
        "split_by_category": _tally(
            [_LINES, _PRODUCTS, _CATEGORIES],
            """(SELECT weight, coalesce(k.category, 'Missing') AS category,
       CASE WHEN k.category = 'advance' THEN 'advance' ELSE 'non-advance' END AS branch
FROM lines LEFT JOIN products p ON l_partkey = p_partkey
LEFT JOIN categories k ON p.product = k.product AND p.product_group = k.product_group)""",
            "branch, category",
        ),
        "fixed_width_parse": _with([_FLOWS], """
SELECT flow_id, origin, destination, route, '000' AS status_code, 'A' AS usage_code, 'S' AS direction, 'ATO' AS carrier,
       valid_until, valid_from, CAST(until_year AS VARCHAR) || '-12-31' AS valid_until_date FROM flows"""),
        "fixed_width_fares": _with([_FARES], "SELECT flow_id, ticket_code, fare FROM fares"),
        "map_sector": _tally(_TO_SALES + [_CLASSIFIED], "classified", "carrier, sector"),
        "map_ticket_type": _tally(_TO_SALES + [_CLASSIFIED], "classified", "product_group, ticket_type"),
        "map_class": _tally(_TO_SALES + [_CLASSIFIED], "(SELECT substr(product, 1, 1) AS digit, class, weight FROM classified)", "digit, class"),
        "missing_lookup": _with(_TO_FACT, """
SELECT count(*) FILTER (WHERE sector = 'Missing') AS missing_sector, count(*) FILTER (WHERE ticket_type = 'Missing') AS missing_ticket_type,
       count(*) FILTER (WHERE class = 'Missing') AS missing_class, count(*) FILTER (WHERE category = 'Missing') AS missing_category FROM fact"""),
        "missing_sector_rows": _with(_TO_SALES + [_CLASSIFIED], """
SELECT l_orderkey, l_linenumber, carrier, region, CAST(weight AS DOUBLE) AS weight FROM classified WHERE sector = 'Missing'"""),
        "status_cascade": _tally(_TO_FACT, "fact", "carrier, product, status"),
        "status_audit": _tally(_TO_FACT, "fact", f"{_AUDIT}, status"),
        "status_distinct": _with(_TO_FACT, "SELECT DISTINCT product, product_group, status FROM fact"),
        "left_lookup_4key": _tally(
            [*_TO_SALES, _REGULATED], f"(SELECT s.*, r.flag2 FROM sales s LEFT JOIN regulated r USING ({_KEY}))", f"{_KEY}, flag2"
        ),
        "colocated_lookups": _with([*_TO_SALES, _REGULATED, _PRICES], f"""
SELECT {_KEY}, flag2, count(*) AS n, CAST(sum(weight) AS DOUBLE) AS weight,
       round(max(list_base), 4) AS list_base, round(max(list_current), 4) AS list_current,
       round(max(derived_base), 4) AS derived_base, round(max(derived_current), 4) AS derived_current
FROM sales LEFT JOIN regulated USING ({_KEY}) LEFT JOIN prices USING ({_KEY}) GROUP BY {_KEY}, flag2"""),
        "lookup_duplicate_keys": _with(_TO_SALES, f"""
SELECT {_KEY}, count(*) AS entries FROM (SELECT DISTINCT {_KEY}, l_linestatus FROM sales WHERE l_discount = 0)
GROUP BY {_KEY} HAVING count(*) > 1"""),
        "category_lookup": _tally(
            [_LINES, _PRODUCTS, _CATEGORIES],
            """(SELECT weight, coalesce(p.product, 'Missing') AS product, coalesce(p.product_group, 'Missing') AS product_group, coalesce(k.category, 'Missing') AS category
FROM lines LEFT JOIN products p ON l_partkey = p_partkey
LEFT JOIN categories k ON p.product = k.product AND p.product_group = k.product_group)""",
            "product, product_group, category",
        ),
        "category_unmatched": _with([_LINES, _PRODUCTS, _CATEGORIES], """
SELECT DISTINCT coalesce(p.product, 'Missing') AS product, coalesce(p.product_group, 'Missing') AS product_group FROM lines LEFT JOIN products p ON l_partkey = p_partkey
WHERE NOT EXISTS (SELECT 1 FROM categories k WHERE k.product = p.product AND k.product_group = p.product_group)"""),
        "lookup_only_new": _parts_sold("> 1997", "<= 1997"),
        "lookup_only_old": _parts_sold("<= 1997", "> 1997"),
        "control_totals": _sum(_TO_SALES, "sales", "carrier", journeys=True),
        "advance_rollup": _sum(
            _TO_FACT, "(SELECT * FROM fact WHERE category = 'advance')",
            "carrier, origin, destination, route, product, product_group, class, sector", journeys=True,
        ),
        "revenue_by_product": _sum(_TO_FACT, "fact", "carrier, product, status"),
        "revenue_by_segment": _sum(_TO_FACT, "fact", f"carrier, {_CELL}"),
        "weight_rollup": _sum(_TO_FACT, "fact", f"product, product_group, {_CELL}"),
        "season_rollup": _sum(_TO_FACT, "(SELECT * FROM fact WHERE category = 'season')", "category, product, sector, class, status"),
        "season_unregulated": _with(_TO_FACT, f"""
SELECT {_FACT_ROW}, CAST(weight AS DOUBLE) AS weight, journeys FROM fact WHERE category = 'season' AND status = 'Unregulated'"""),
        "season_by_sector_product": _sum(_TO_FACT, "(SELECT * FROM fact WHERE category = 'season')", "sector, product"),
        "product_od_sum": _sum(
            _TO_FACT, "(SELECT * FROM fact WHERE product IN ('2STA', '2LAR', '3STA') AND status = 'Regulated')", "product, origin, destination"
        ),
        "latest_validity": _with([_FLOWS, _LATEST], "SELECT flow_id, origin, destination, route, valid_until FROM latest"),
        "flow_fare_join": _with(_TO_FEED, """
SELECT destination, route, ticket_code, product, count(*) AS n, CAST(sum(fare) AS BIGINT) AS fare FROM feed
GROUP BY destination, route, ticket_code, product"""),
        "dedupe_keep_first": _with([*_TO_FEED, _KEPT], "SELECT origin, destination, route, flow_id, ticket_code, fare, product FROM kept"),
        "conflicting_duplicates": _with([*_TO_FEED, _KEPT], """
SELECT origin, destination, route, flow_id, ticket_code, fare, product
FROM (SELECT *, count(*) OVER (PARTITION BY origin, destination, route, ticket_code) AS n FROM kept) WHERE n > 1"""),
        "derived_price": """
SELECT l_orderkey, l_linenumber,
       round(CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(format('{:.2f}', l_extendedprice) AS DOUBLE) * 100 / l_quantity END, 4) AS price
FROM lineitem""",
        "price_table": _with([*_TO_SALES, _PRICES], f"""
SELECT {_KEY}, round(list_base, 4) AS list_base, round(list_current, 4) AS list_current,
       round(derived_base, 4) AS derived_base, round(derived_current, 4) AS derived_current FROM prices"""),
        "list_price_join": _price_join("list"),
        "derived_price_join": _price_join("derived"),
        "list_price_join_wide": _price_join("list", [_LINES, _WIDE_SALES]),
        "derived_price_join_wide": _price_join("derived", [_LINES, _WIDE_SALES]),
        "derived_price_join_class": _with([*_TO_FACT, _CLASS_PRICES, _ADVANCE], """
SELECT carrier, origin, destination, route, product, product_group, class, sector, CAST(weight AS DOUBLE) AS weight, journeys,
       round(price_base, 4) AS price_base, round(price_current, 4) AS price_current, round(change, 4) AS change FROM advance"""),
        "price_gap_fill": _per_key([*_TO_FACT, _PRICES, _FILLED], "filled", ["price_base", "price_current"]),
        "drop_zero_null_prices": _per_key(_TO_DETAIL, "detail", ["price_base", "price_current", "change"]),
        "big_change": _detail_rows("change > 20 AND weight < 50000"),
        "little_change": _detail_rows("change < -20 AND weight < 50000"),
        "big_earners": _with([*_TO_FACT, _PRICES, _FILLED], f"""
SELECT {_FACT_ROW}, journeys, CAST(weight AS DOUBLE) AS weight, round(price_base, 4) AS price_base, round(price_current, 4) AS price_current
FROM filled WHERE weight > 50000"""),
        "outlier_trim": _tally(_TO_DETAIL, "(SELECT * FROM detail WHERE change > -20 AND change < 20)", _FACT_ROW),
        "union_by_name": _tally([*_TO_DETAIL, _CLASS_PRICES, _ADVANCE, _UNITED], "united", f"product, {_CELL}"),
        "cell_grid": _with(_TO_GRID, f"""
SELECT {_CELL}, CAST(priced_weight AS DOUBLE) AS priced_weight, CAST(total_weight AS DOUBLE) AS total_weight,
       round(weighted_change, 4) AS weighted_change, round(contribution, 0) AS contribution FROM grid"""),
        "split_report": _with(_TO_GRID, "\nUNION ALL\n".join(_split(name, keys, _CELL_LIST) for name, keys in _SPLITS)),
        "cell_grid_exact": _with([*_TO_GRID[:-1], _EXACT_GRID], f"SELECT {_CELL}, weighted_change, contribution FROM grid"),
        "cell_grid_rows": _with(_TO_GRID, f"""
SELECT {_CELL}, CAST(priced_weight AS DOUBLE) AS priced_weight, CAST(total_weight AS DOUBLE) AS total_weight,
       round(weighted_change, 4) AS weighted_change, round(contribution, 0) AS contribution FROM grid"""),
        "split_report_rows": _with(_TO_GRID, "\nUNION ALL\n".join(_split(name, keys, _CELL_LIST) for name, keys in _SPLITS)),
        "split_sector": _with(_TO_GRID, _split("sector1", ["sector"], ["sector"])),
        "split_class": _with(_TO_GRID, _split("class", ["class"], ["class"])),
        "split_status": _with(_TO_GRID, _split("regulation", ["status"], ["status"])),
        "split_category": _with(_TO_GRID, _split("category", ["category"], ["category"])),
        "weight_share": _with(_TO_SALES, """
SELECT region, carrier, round(CAST(sum(weight) AS DOUBLE) / sum(CAST(sum(weight) AS DOUBLE)) OVER (PARTITION BY region), 6) AS share
FROM sales GROUP BY region, carrier"""),
        "usage_rollup": _with([_LINES, _CARRIERS, _QUARTERS], """
SELECT financial_year_key, year_and_quarter, rl AS revenue_long_distance, rs AS revenue_london_and_south_east, rr AS revenue_regional,
       rn AS revenue_non_franchised, jl AS journeys_long_distance, js AS journeys_london_and_south_east, jr AS journeys_regional,
       jn AS journeys_non_franchised FROM usage_wide"""),
        "usage_unpivot": _with([_LINES, _CARRIERS, _QUARTERS, _USAGE], """
SELECT financial_year_key, year_and_quarter, sector, round(revenue, 2) AS revenue, journeys FROM usage_rows"""),
        "rolling_4q_sum": _with(_TO_CHANGES[:-1], """
SELECT financial_year_key, year_and_quarter, sector, round(revenue, 2) AS trailing_revenue FROM trailing_year"""),
        "rolling_pct_change": _with(_TO_CHANGES, "SELECT label, sector, round(value, 4) AS value FROM changes"),
        "chained_index": _with(_TO_CHANGES, """
SELECT label, sector, round(value, 4) AS value,
       round(product((100 + value) / 100) OVER (PARTITION BY sector ORDER BY label ROWS UNBOUNDED PRECEDING) * 100, 4) AS index_value
FROM changes"""),
        "index_variance": _with(_TO_CHANGES, """
SELECT sector, label, round(index_value, 4) AS value, round(value + 100 - index_value, 4) AS variance
FROM (SELECT *, product((100 + value) / 100) OVER (PARTITION BY sector ORDER BY label ROWS UNBOUNDED PRECEDING) * 100 AS index_value FROM changes)
UNION ALL
SELECT sector, 'Average change in price (%)', round(max_by(value, label), 4), CAST(NULL AS DOUBLE) FROM changes GROUP BY sector"""),
        "series_extend": _with(_TO_SERIES, _EXTENDED),
        "series_fill": _with(_TO_SERIES, f"SELECT {_SERIES_ROW}, round(value, 4) AS value FROM filled_series"),
        "series_extend_ticket_type": _as_ticket_type(_with(_TO_SERIES, _EXTENDED)),
        "series_fill_ticket_type": _as_ticket_type(_with(_TO_SERIES, f"SELECT {_SERIES_ROW}, round(value, 4) AS value FROM filled_series")),
        "index_roll_forward": _series_rows("sector <> 'RPI' AND label = 'January ' || CAST((SELECT max(year) + 1 FROM levels) AS VARCHAR)"),
        "deflator_roll_forward": _series_rows("sector = 'RPI' AND label LIKE 'January%'"),
        "real_terms_yoy": _series_rows("label = 'Real terms change in average price year on year'"),
        "real_terms_since_start": _series_rows("label = 'Real terms change in average price year on 2004'"),
        "all_sector_change": _with(_TO_SERIES, "SELECT round(value, 4) AS average_change FROM total_change"),
        "latest_value": _with([_LINES, _CARRIERS, _SUMS], """
SELECT sector, ticket_category, round(max_by(value, year), 4) AS value FROM levels GROUP BY sector, ticket_category"""),
        "warehouse_round_trip": _with(_TO_SERIES, f"SELECT {_SERIES_ROW}, round(value, 4) AS value FROM filled_series"),
        "newest_run": _sum(_TO_SALES, "sales", "carrier", journeys=True),
        "report_for_series": _with(_TO_SERIES, """
SELECT sector, 'All tickets' AS ticket_category, round(average_change, 4) AS average_change, total_weight, round(share, 6) AS share
FROM report WHERE sector IN ('London and South East', 'Long distance', 'Regional')"""),
        "sales_extracts": _with([_LINES], """
SELECT l_linestatus AS carrier, CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 4 THEN lpad(CAST(l_suppkey AS VARCHAR), 4, '0')
                                     ELSE CAST(l_suppkey AS VARCHAR) END AS origin,
       lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS destination, route, CAST(l_partkey AS VARCHAR) AS product, l_returnflag AS product_group,
       count(*) AS n, CAST(sum(weight) AS DOUBLE) AS weight, sum(journeys) AS journeys
FROM lines GROUP BY ALL"""),
        "feed_file_prices": _with([*_TO_FEED, _KEPT], "SELECT origin, destination, route, product, CAST(fare AS DOUBLE) AS fare FROM kept"),
        "regulated_lookup_file": _with([*_TO_SALES, _REGULATED], "SELECT origin, destination, route, product, flag2 FROM regulated"),
        "corrected_extract": """
SELECT l_linestatus AS carrier, '2AB' || l_returnflag AS product, l_returnflag AS product_group,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS weight, sum(l_quantity) AS journeys, count(*) AS n
FROM lineitem WHERE l_orderkey % 5 <> 2 OR l_linenumber > 1 GROUP BY ALL""",
        "ticket_lookup_files": """
SELECT CAST(l_partkey AS VARCHAR) AS ticket_code, l_orderkey || '-' || l_linenumber AS product
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey % 10 <> 0, l_orderkey, l_linenumber) = 1""",
        "category_lookup_file": _with([_PRODUCTS, _CATEGORIES], "SELECT product, product_group, category FROM categories"),
        "price_file": _with([_LINES], """
SELECT l_orderkey AS product, lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS origin,
       round(CAST(weight AS DOUBLE) * 100 / nullif(journeys, 0), 4) AS price FROM lines""").replace("l_orderkey AS product", "CAST(l_orderkey AS VARCHAR) AS product"),
        "max_load_id": "SELECT CAST(max(year(l_shipdate)) AS INTEGER) AS load_id FROM lineitem",
        "snapshot_by_load_id": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS load_id, l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS weight,
       l_quantity AS journeys
FROM lineitem WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)""",
    }
