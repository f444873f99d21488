"""SQL that DuckDB runs on the same tables, one statement for each registered query."""

from __future__ import annotations

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

EVENTS = (
    "(SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS part, nullif(event_type, 'error') AS event_type, "
    "nullif(user_id, 1) AS user_id, value, props FROM events)"
)
FLAGS = "(SELECT *, l_returnflag AS part FROM lineitem)"
MONTHS = "(SELECT *, strftime(l_shipdate, '%Y-%m') AS part FROM lineitem)"
STATUS = "(SELECT *, o_orderstatus AS part FROM orders)"
DAYS = "(SELECT *, strftime(ts, '%Y-%m-%d') AS part FROM events)"

# Events by the run they come in. A row is late if the watermark has passed its window after the runs before; the
# window is over if the watermark has passed it after all runs.
ARRIVING = (
    "(SELECT event_type, user_id, if(event_id % 101 != 0, ts, NULL) AS came, CASE WHEN event_id % 7 = 3 THEN "
    "if(user_id % 2 = 0, 2, 3) WHEN day(ts) < 15 THEN 1 ELSE 2 END AS run FROM events)"
)
MARKED = (
    f"(SELECT *, strftime(start, '%Y-%m-%d %H') AS part, start + INTERVAL 6 HOUR <= mark AS late, "
    f"start + INTERVAL 6 HOUR <= (SELECT max(came) - INTERVAL 3 HOUR FROM {ARRIVING} x) AS done FROM ("
    f"SELECT a.*, time_bucket(INTERVAL 6 HOUR, came, TIMESTAMP '2000-01-01') AS start, m.mark FROM {ARRIVING} a JOIN ("
    f"SELECT r.run, max(b.came) - INTERVAL 3 HOUR AS mark FROM (VALUES (1), (2), (3)) r(run) "
    f"LEFT JOIN {ARRIVING} b ON b.run < r.run GROUP BY r.run) m ON a.run = m.run) w)"
)
IN_TIME = f"(SELECT * FROM {MARKED} k WHERE done AND NOT coalesce(late, false))"


def union(statements) -> str:
    return "\nUNION ALL\n".join(f"({s})" for s in statements)


class Source:
    """Metric rows as SQL over one relation, in one group or by its ``part`` column."""

    def __init__(self, relation: str, by: bool = True, digits: int = 6, extra: str = ""):
        self.relation, self.digits = relation, digits
        self.part = "part, " if by else ""
        self.group = " GROUP BY part" if by else ""
        self.partition = "PARTITION BY part" if by else ""
        self.extra = f", {extra}" if extra else ""

    def row(self, entity: str, instance: str, name: str, value: str, relation: str) -> str:
        quoted = instance.replace("'", "''")
        return (
            f"SELECT * FROM (SELECT {self.part}'{entity}' AS entity, '{quoted}' AS instance, "
            f"'{name}' AS name, round(CAST({value} AS DOUBLE), {self.digits}) AS value{self.extra} "
            f"FROM {relation} t{self.group}) r WHERE value IS NOT NULL"
        )

    def scan(self, entity: str, instance: str, name: str, value: str) -> list[str]:
        return [self.row(entity, instance, name, value, self.relation)]

    def size(self) -> list[str]:
        return self.scan("Dataset", "*", "Size", "count(*)")

    def each(self, name: str, columns: str, value: str) -> list[str]:
        return [
            s
            for c in columns.split(",")
            for s in self.scan("Column", c, name, value.replace("$", c))
        ]

    def completeness(self, columns: str) -> list[str]:
        return self.each("Completeness", columns, "count($) / count(*)::DOUBLE")

    def share(self, name: str, instance: str, predicate: str) -> list[str]:
        value = f"count(*) FILTER (WHERE {predicate}) / count(*)::DOUBLE"
        return self.scan("Column", instance, name, value)

    def correlation(self, a: str, b: str) -> list[str]:
        value = f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END"
        return self.scan("Multicolumn", f"{a},{b}", "Correlation", value)

    def frequency(self, name: str, columns: str) -> list[str]:
        value = {
            "CountDistinct": "count(x)",
            "Distinctness": "count(x) / max(n)",
            "Uniqueness": "count(x) FILTER (WHERE c = 1) / max(n)",
            "UniqueValueRatio": "count(x) FILTER (WHERE c = 1) / count(x)::DOUBLE",
            "Entropy": "-sum(c / n * ln(c / n)) FILTER (WHERE x IS NOT NULL)",
        }[name]
        over = f"OVER ({self.partition})"
        out = []
        for column in columns.split(","):
            counted = (
                f"(SELECT *, sum(c) {over}::DOUBLE AS n FROM (SELECT {self.part}{column} AS x, "
                f"count(*) AS c FROM {self.relation} s GROUP BY ALL) f)"
            )
            out.append(self.row("Column", column, name, value, counted))
        return out

    def datatype(self, column: str) -> list[str]:
        classes = {
            "Unknown": "{0} IS NULL",
            "Fractional": r"regexp_matches({0}, '^[-+]?(\d+\.\d*|\.\d+)\z')",
            "Integral": r"regexp_matches({0}, '^[-+]?\d+\z')",
            "Boolean": r"regexp_matches({0}, '^(true|false)\z')",
        }
        known = " OR ".join(f"coalesce({c.format(column)}, false)" for c in classes.values())
        classes["String"] = f"NOT ({known})"
        out = self.scan("Column", column, "Histogram.bins", "5")
        out[0] = out[0].replace("CAST(5 AS", "CAST(max(5) AS")
        for name, test in classes.items():
            test = test.format(column)
            out += self.scan("Column", column, f"Histogram.abs.{name}", f"count(*) FILTER (WHERE {test})")
            out += self.share(f"Histogram.ratio.{name}", column, test)
        return out

    def mutual_information(self, a: str, b: str) -> list[str]:
        keys = self.part
        joint = f"(SELECT {keys}{a} AS a, {b} AS b, count(*) AS c FROM {self.relation} s GROUP BY ALL)"
        by = f"{keys}" if keys else ""
        marginal = (
            f"(SELECT *, sum(c) OVER (PARTITION BY {by}a)::DOUBLE AS na, "
            f"sum(c) OVER (PARTITION BY {by}b)::DOUBLE AS nb, "
            f"sum(c) OVER ({self.partition})::DOUBLE AS n FROM {joint} j)"
        )
        value = "sum(c / n * ln((c / n) / (na / n * nb / n))) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)"
        return [self.row("Multicolumn", f"{a},{b}", "MutualInformation", value, marginal)]


def on_tables(build) -> str:
    """``build(source)`` for each of the frequency queries' tables, with the table's name."""
    parts = {
        "orders": ("orders", "o_custkey,o_totalprice,o_orderdate"),
        "lineitem": ("lineitem", "l_orderkey,l_quantity"),
        "documents": ("documents", "text,lang"),
        "events": (EVENTS, "event_type,user_id"),
    }
    out = []
    for name, (relation, columns) in parts.items():
        out += build(Source(relation, by=False, digits=9, extra=f"'{name}' AS table_name"), columns)
    return union(out)


def lineitem_scan() -> list[str]:
    s = Source(MONTHS)
    return (
        s.size()
        + s.completeness("l_quantity,l_returnflag")
        + s.each("Mean", "l_quantity,l_suppkey", "avg($)")
        + s.each("Minimum", "l_quantity,l_extendedprice", "min($)")
        + s.each("Maximum", "l_quantity,l_extendedprice", "max($)")
        + s.each("Sum", "l_quantity,l_linenumber", "sum($)")
        + s.datatype("l_linestatus")
        + s.share("Compliance", "large", "l_quantity >= 25")
        + s.correlation("l_quantity", "l_extendedprice")
        + s.share("PatternMatch", "l_returnflag", "regexp_matches(l_returnflag, '^[AR]$')")
    )


def orders_profile(s: Source) -> list[str]:
    return (
        s.size()
        + s.completeness("o_custkey,o_orderpriority")
        + s.each("Mean", "o_orderkey", "avg($)")
        + s.share("Compliance", "urgent", "o_orderpriority IN ('1-URGENT','2-HIGH')")
        + s.correlation("o_custkey", "o_totalprice")
        + s.frequency("CountDistinct", "o_custkey,o_orderpriority,o_totalprice")
        + s.frequency("Distinctness", "o_custkey")
        + s.frequency("Entropy", "o_custkey,o_orderpriority")
        + s.each("Maximum", "o_totalprice", "max($)")
        + s.each("Minimum", "o_totalprice", "min($)")
        + s.mutual_information("o_custkey", "o_orderpriority")
        + s.each("Sum", "o_custkey", "sum($)")
        + s.frequency("UniqueValueRatio", "o_custkey")
        + s.frequency("Uniqueness", "o_custkey,o_totalprice")
    )


def state_metrics() -> list[str]:
    s = Source(FLAGS)
    return (
        s.size()
        + s.completeness("l_quantity")
        + s.each("Mean", "l_partkey", "avg($)")
        + s.each("Sum", "l_quantity", "sum($)")
        + s.each("Minimum", "l_extendedprice", "min($)")
        + s.each("Maximum", "l_extendedprice", "max($)")
        + s.share("Compliance", "large", "l_quantity >= 25")
        + s.correlation("l_quantity", "l_extendedprice")
        + s.frequency("CountDistinct", "l_orderkey,l_partkey")
        + s.frequency("Entropy", "l_partkey")
        + s.frequency("Uniqueness", "l_orderkey")
        + s.mutual_information("l_partkey", "l_suppkey")
    )


def spec_expand() -> list[str]:
    s = Source("orders", by=False)
    return (
        s.size()
        + s.completeness("o_custkey,o_orderpriority")
        + s.each("Mean", "o_orderkey", "avg($)")
        + s.share("Compliance", "urgent", "o_orderpriority IN ('1-URGENT','2-HIGH')")
        + s.share("Compliance", "pricey", "o_totalprice >= 100000")
        + s.share("Compliance", "either", "coalesce(o_custkey, abs(o_totalprice)) > 100")
        + s.correlation("o_custkey", "o_totalprice")
        + s.mutual_information("o_custkey", "o_orderpriority")
        + s.frequency("Uniqueness", "o_custkey,o_totalprice")
        + s.share("PatternMatch", "o_orderpriority", "regexp_matches(o_orderpriority, '^[12]-')")
    )


FAILURES = """
WITH g AS (
  SELECT l_orderkey AS part,
         min(l_quantity) < max(l_quantity) AND min(l_extendedprice) < max(l_extendedprice) AS varies
  FROM lineitem GROUP BY ALL)
SELECT part, 'Column' AS entity, 'l_returnflag' AS instance, 'Maximum' AS name,
       'column l_returnflag is string, not numeric' AS reason FROM g
UNION ALL
SELECT part, 'Column', 'l_nothing', 'Completeness', 'unknown column l_nothing' FROM g
UNION ALL
SELECT part, 'Column', 'odd', 'Compliance', 'predicate refused: UNRESOLVED_COLUMN.WITH_SUGGESTION' FROM g
UNION ALL
SELECT part, 'Column', 'first', 'Compliance', 'predicate looks beyond its row' FROM g
UNION ALL
SELECT part, 'Column', 'l_returnflag', 'PatternMatch', 'pattern refused: INVALID_PARAMETER_VALUE.PATTERN' FROM g
UNION ALL
SELECT part, 'Multicolumn', 'l_quantity,l_extendedprice', 'Correlation',
       'needs two rows and two varying columns' FROM g WHERE NOT varies
"""

def job_files() -> list[str]:
    s = Source(STATUS)
    return (
        s.size()
        + s.completeness("o_custkey")
        + s.each("Mean", "o_orderkey", "avg($)")
        + s.each("Sum", "o_custkey", "sum($)")
        + s.frequency("CountDistinct", "o_custkey,o_orderpriority")
        + s.frequency("Entropy", "o_orderpriority")
        + s.frequency("Uniqueness", "o_custkey")
        + s.scan("Column", "o_orderpriority", "Histogram.bins", "5")
        + [
            row
            for c in ("Unknown", "Fractional", "Integral", "Boolean", "String")
            for row in s.scan("Column", "o_orderpriority", f"Histogram.ratio.{c}", "1" if c == "String" else "0")
        ]
        + s.share("Compliance", "pricey", "o_totalprice >= 100000")
        + s.mutual_information("o_custkey", "o_orderpriority")
    )


UNLIKE = """
WITH e AS (SELECT CASE event_type WHEN 'view' THEN 'with' ELSE 'without' END AS part, count(*)::DOUBLE AS n
           FROM events GROUP BY 1),
f AS (SELECT unnest(['json', 'parquet']) AS file_format)
SELECT part, '*' AS instance, 'Size' AS name, n AS total, NULL::DOUBLE AS least, NULL AS reason, file_format FROM e, f
UNION ALL SELECT part, 'user_id', 'Completeness', NULL, 1.0, NULL, file_format FROM e, f
UNION ALL SELECT part, 'value', 'Completeness', NULL, CASE part WHEN 'with' THEN 1.0 END,
                 CASE part WHEN 'without' THEN 'unknown column value' END, file_format FROM e, f
"""

TWO_STREAMS = """
WITH r AS (
  SELECT 'events' AS part, count(*)::DOUBLE AS n, sum(event_id)::DOUBLE AS total FROM events
  UNION ALL SELECT 'orders', count(*)::DOUBLE, sum(o_orderkey)::DOUBLE FROM orders),
s AS (SELECT unnest(['metrics', 'states']) AS stored)
SELECT part, '*' AS instance, 'Size' AS name, n AS value, stored FROM r, s
UNION ALL SELECT part, 'id', 'Sum', total, stored FROM r, s
"""

GROUPS = """
WITH e AS (
  SELECT nullif(event_type, 'error') AS part, nullif(user_id, 1) AS user_id FROM events
  UNION ALL SELECT 'no such type', NULL),
g AS (
  SELECT part, count(*) FILTER (WHERE part IS DISTINCT FROM 'no such type')::DOUBLE AS rows,
         count(DISTINCT user_id)::DOUBLE AS users FROM e GROUP BY part)
SELECT part, 'Dataset' AS entity, '*' AS instance, 'Size' AS name, rows AS value FROM g
UNION ALL SELECT part, 'Column', 'user_id', 'CountDistinct', users FROM g
"""

KNOWN = """
known AS (
  SELECT source AS bucket_name, CAST(d.doc_id AS VARCHAR) AS file_name,
         CASE WHEN quality = 1 THEN 'Y' ELSE 'N' END AS processed
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

REGISTERED = """
SELECT d.source AS bucket_name, CAST(d.doc_id AS VARCHAR) AS file_name,
       CASE WHEN l.quality = 1 THEN 'Y' ELSE 'N' END AS processed
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

UPSERT = """
WITH v AS (
  SELECT CAST(o_custkey AS VARCHAR) AS file_name, 1 AS version, count(*)::DOUBLE AS rows,
         avg(o_orderkey) AS mean, count(DISTINCT o_orderpriority)::DOUBLE AS kinds
  FROM orders GROUP BY ALL
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), 2, count(*)::DOUBLE, avg(o_orderkey),
         count(DISTINCT o_orderpriority)::DOUBLE
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
m AS (
  SELECT file_name, version, 'Dataset' AS entity, '*' AS instance, 'Size' AS name, rows AS value FROM v
  UNION ALL SELECT file_name, version, 'Column', 'o_orderkey', 'Mean', mean FROM v
  UNION ALL SELECT file_name, version, 'Column', 'o_orderpriority', 'CountDistinct', kinds FROM v),
r AS (
  SELECT *, row_number() OVER (PARTITION BY file_name, instance, name ORDER BY version DESC) AS k FROM m)
SELECT entity, instance, name, round(value, 6) AS value, 'customers-' || file_name AS bucket_file_name,
       instance || '-' || name AS "col_metricName", 'customers' AS bucket_name, file_name
FROM r WHERE k = 1
"""

CHECKS = """
WITH m AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS part, count(*)::DOUBLE AS rows, avg(l_quantity) AS mean,
         count(*) FILTER (WHERE l_quantity >= 25) / count(*)::DOUBLE AS large,
         count(DISTINCT l_returnflag)::DOUBLE AS flags
  FROM lineitem GROUP BY ALL),
c AS (
  SELECT part, '*' AS instance, 'Size' AS name, rows AS value, rows >= 1 AS met, 'Error' AS level FROM m
  UNION ALL SELECT part, 'l_quantity', 'Mean', mean, mean BETWEEN 25.4 AND 25.8, 'Warning' FROM m
  UNION ALL SELECT part, 'large', 'Compliance', large, large >= 0.5, 'Error' FROM m
  UNION ALL SELECT part, 'l_returnflag', 'CountDistinct', flags, flags <= 2, 'Warning' FROM m
  UNION ALL SELECT part, 'l_returnflag', 'Mean', NULL, false, 'Error' FROM m)"""

VERIFY = f"""{CHECKS}
SELECT part, instance, name, round(value, 6) AS value,
       CASE WHEN met THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN met THEN 'Success' ELSE level END AS status,
       CASE WHEN value IS NULL THEN 'column l_returnflag is string, not numeric'
            WHEN NOT met THEN 'value out of bounds' END AS message
FROM c
"""

CHECK_STATUS = f"""{CHECKS}
SELECT part,
       CASE WHEN bool_or(NOT met AND level = 'Error') THEN 'Error'
            WHEN bool_or(NOT met) THEN 'Warning' ELSE 'Success' END AS status,
       count(*) FILTER (WHERE NOT met) AS failed, count(*) AS constraints
FROM c GROUP BY part
"""

HISTORY = """
WITH m AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS part, count(*)::DOUBLE AS rows, avg(l_quantity) AS mean,
         count(DISTINCT l_partkey)::DOUBLE AS parts
  FROM lineitem GROUP BY ALL),
r AS (
  SELECT part, '*' AS instance, 'Size' AS name, rows AS value FROM m
  UNION ALL SELECT part, 'l_quantity', 'Mean', mean FROM m
  UNION ALL SELECT part, 'l_partkey', 'CountDistinct', parts FROM m),
p AS (SELECT *, lag(value) OVER (PARTITION BY instance, name ORDER BY part) AS previous FROM r)
SELECT part, instance, name, round(value, 6) AS value, round(previous, 6) AS previous,
       round(value - previous, 6) AS change, round(value / previous, 6) AS ratio
FROM p
"""

TAGGED = """
WITH o AS (
  SELECT t.part, year(o_orderdate)::INTEGER AS run, count(*)::DOUBLE AS rows, avg(o_custkey) AS mean
  FROM orders JOIN (VALUES ('all', [1995, 1996, 1998, 1999, 2000]), ('closed', [1995, 1997, 1998, 2001])) t(part, years)
    ON list_contains(t.years, year(o_orderdate)) AND (t.part = 'all' OR o_orderstatus = 'F')
  GROUP BY ALL),
r AS (
  SELECT part, run, make_date(run, 12, 31) AS d, '*' AS instance, 'Size' AS name, rows AS value FROM o
  UNION ALL SELECT part, run, make_date(run, 12, 31), 'o_custkey', 'Mean', mean FROM o),
b AS (
  SELECT 'own' AS against, r.*, x.value AS found, x.run AS found_run, datediff('day', x.d, r.d) <= 400 AS near
  FROM r ASOF LEFT JOIN r x ON r.part = x.part AND r.instance = x.instance AND r.name = x.name AND r.d > x.d
  UNION ALL
  SELECT 'closed', a.*, x.value, x.run, true
  FROM (SELECT * FROM r WHERE part = 'all') a
  ASOF LEFT JOIN (SELECT * FROM r WHERE part = 'closed') x ON a.instance = x.instance AND a.name = x.name AND a.d >= x.d)
SELECT against, part, run, instance, name, round(value, 6) AS value, round(if(near, found, NULL), 6) AS baseline,
       round(value / if(near, found, NULL), 6) AS ratio, if(near, found_run, NULL) AS baseline_run,
       dense_rank() OVER (PARTITION BY part ORDER BY run DESC) <= 3 AS kept
FROM b
"""

# A row per run and way of learning, with the state after it: seen, mean and variance of the differences.
LEARNED = """
WITH RECURSIVE m AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS part, count(*)::DOUBLE AS rows, avg(l_quantity) AS mean,
         count(DISTINCT l_partkey)::DOUBLE AS parts
  FROM lineitem GROUP BY ALL),
r AS (
  SELECT part, '*' AS instance, 'Size' AS name, rows AS value FROM m
  UNION ALL SELECT part, 'l_quantity', 'Mean', mean FROM m
  UNION ALL SELECT part, 'l_partkey', 'CountDistinct', parts FROM m),
w AS (SELECT * FROM (VALUES ('plain', 2.0::DOUBLE), ('season', 1.0::DOUBLE)) v(learning, spread)),
n AS (
  SELECT learning, spread, part, instance, name, value,
         row_number() OVER (PARTITION BY learning, instance, name ORDER BY part) AS i,
         CASE WHEN learning = 'plain' THEN 0.0::DOUBLE
              ELSE lag(value, 12) OVER (PARTITION BY learning, instance, name ORDER BY part) END AS base
  FROM r CROSS JOIN w),
s AS (
  SELECT learning, instance, name, 0::BIGINT AS i, 0::BIGINT AS seen, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS variance
  FROM n WHERE i = 1
  UNION ALL
  SELECT s.learning, s.instance, s.name, n.i,
         CASE WHEN n.base IS NULL THEN s.seen ELSE s.seen + 1 END,
         CASE WHEN n.base IS NULL THEN s.mean WHEN s.seen = 0 THEN n.value - n.base
              ELSE s.mean + 0.3::DOUBLE * (n.value - n.base - s.mean) END,
         CASE WHEN n.base IS NULL OR s.seen = 0 THEN s.variance
              ELSE 0.7::DOUBLE * (s.variance + 0.3::DOUBLE * (n.value - n.base - s.mean) * (n.value - n.base - s.mean)) END
  FROM s JOIN n ON n.learning = s.learning AND n.instance = s.instance AND n.name = s.name AND n.i = s.i + 1),
b AS (
  SELECT n.*, CASE WHEN s.seen >= 5 THEN n.base + s.mean END AS expected,
         n.spread * sqrt(s.variance) + 1e-9::DOUBLE * abs(n.base + s.mean) AS width
  FROM n JOIN s ON n.learning = s.learning AND n.instance = s.instance AND n.name = s.name AND n.i = s.i + 1)
SELECT learning, part, instance, name, round(value, 5) AS value, round(expected, 5) AS expected,
       round(expected - width, 5) AS low, round(expected + width, 5) AS high,
       value < expected - width OR value > expected + width AS broken
FROM b
"""

RUNS = """
WITH o AS (
  SELECT '2024-01-01' AS run_date, * FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT '2024-01-02', * FROM orders),
u AS (SELECT run_date, o_custkey, count(*) AS c FROM o GROUP BY ALL),
r AS (
  SELECT run_date, '*' AS instance, 'Size' AS name, count(*)::DOUBLE AS value FROM o GROUP BY run_date
  UNION ALL SELECT run_date, 'o_orderkey', 'Mean', avg(o_orderkey) FROM o GROUP BY run_date
  UNION ALL SELECT run_date, 'o_custkey', 'Uniqueness', count(*) FILTER (WHERE c = 1) / sum(c)::DOUBLE
            FROM u GROUP BY run_date)
SELECT run_date, instance, name, round(value, 6) AS value,
       round(lag(value) OVER (PARTITION BY instance, name ORDER BY run_date), 6) AS previous
FROM r
"""

JOB = """
SELECT o_orderstatus AS part, count(*)::DOUBLE AS orders,
       round(count(o_custkey) / count(*)::DOUBLE, 6) AS completeness,
       sum(o_custkey)::DOUBLE AS total, max(o_totalprice) AS largest,
       round(count(*) FILTER (WHERE o_totalprice >= 100000) / count(*)::DOUBLE, 6) AS pricey
FROM orders GROUP BY ALL
"""


FINAL_FILES = """(SELECT *, CAST(ts AS DATE) AS d, min(CAST(ts AS DATE)) OVER () AS first, max(CAST(ts AS DATE)) OVER () AS last
FROM (SELECT ts, nullif(event_type, 'error') AS event_type, nullif(user_id, 1) AS user_id FROM events) e)"""
KEPT_FILES = f"""(SELECT 'all' AS part, * FROM {FINAL_FILES} a WHERE d < last AND (day(d) % 3 <> 1 OR user_id % 2 = 0)
UNION ALL SELECT 'days 4-17' AS part, * FROM {FINAL_FILES} b
WHERE d < last AND (day(d) % 3 <> 1 OR user_id % 2 = 0) AND d BETWEEN first + 4 AND first + 17)"""
BAD_ROWS = union(
    f"SELECT '{part}' AS part, name, CAST(value AS DOUBLE) AS value FROM (SELECT count(*) FILTER (WHERE NOT bad) AS \"Size\", "
    'count(*) FILTER (WHERE bad) AS "BadRows", count(*) FILTER (WHERE bad) AS "KeptAside", sum(user_id) FILTER (WHERE NOT bad) AS "Sum" '
    f"FROM (SELECT *, event_id % {n} = 0 AS bad FROM events) e) UNPIVOT (value FOR name IN (\"Size\", \"BadRows\", \"KeptAside\", \"Sum\"))"
    for part, n in (("json", 7), ("csv", 5))
)
RULES = {"large": "value >= 50", "known": "user_id IS NOT NULL", "no click": "event_type <> 'click'"}
VERDICTS = union(
    [
        "SELECT event_id, instance, 'broken' AS name, CAST(NULL AS DOUBLE) AS value FROM (SELECT event_id, concat_ws(',', "
        + ", ".join(f"CASE WHEN coalesce({rule}, false) THEN NULL ELSE '{name}' END" for name, rule in RULES.items())
        + f") AS instance FROM {EVENTS} e) b WHERE instance <> ''",
        *(
            f"SELECT CAST(NULL AS BIGINT) AS event_id, '{name}' AS instance, 'Compliance' AS name, "
            f"round(count(*) FILTER (WHERE {rule}) / count(*)::DOUBLE, 9) AS value FROM {EVENTS} e"
            for name, rule in RULES.items()
        ),
    ]
)


def statements() -> dict[str, str]:
    flags, status, days, files = Source(FLAGS), Source(STATUS), Source(DAYS), Source(KEPT_FILES)
    in_time = Source(IN_TIME)
    daily = Source("(SELECT *, part AS file_name FROM " + EVENTS + " e)", digits=6)
    daily_rows = union(
        daily.size()
        + daily.completeness("event_type")
        + daily.each("Mean", "user_id", "avg($)")
        + daily.frequency("CountDistinct", "user_id")
    )
    mixed = (
        "(SELECT *, CASE event_type WHEN 'error' THEN NULL "
        "WHEN 'view' THEN regexp_extract(props, '\"k\": *([0-9]+)', 1) "
        "WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) "
        "WHEN 'signup' THEN 'true' ELSE event_type END AS mixed FROM events)"
    )
    typed = Source("events", by=False, digits=9)
    datatypes = Source(mixed, by=False, digits=9).datatype("mixed")
    for column, own in (("value", "Fractional"), ("user_id", "Integral"), ("ts", "String")):
        datatypes += [s.replace("CAST(5 AS", "CAST(max(5) AS") for s in typed.scan("Column", column, "Histogram.bins", "5")]
        for c in ("Unknown", "Fractional", "Integral", "Boolean", "String"):
            hit = "true"
            if column == "value":
                plain = "(value = 0 OR abs(value) BETWEEN 1e-3 AND 9999999.999999)"
                hit = plain if c == "Fractional" else f"NOT {plain}" if c == "String" else "false"
            elif c != own:
                hit = "false"
            datatypes += typed.scan("Column", column, f"Histogram.abs.{c}", f"count(*) FILTER (WHERE {hit})")
            datatypes += typed.share(f"Histogram.ratio.{c}", column, hit)
    by_order = Source("(SELECT *, l_orderkey AS part FROM lineitem)")
    keyed = union(orders_profile(status))
    return {
        "size": union(
            s for t in TABLES for s in Source(t, by=False, extra=f"'{t}' AS table_name").size()
        ),
        "completeness": union(Source(EVENTS, digits=9).completeness("event_type,user_id,value")),
        "mean": union(flags.each("Mean", "l_quantity,l_linenumber,l_partkey", "avg($)")),
        "sum": union(flags.each("Sum", "l_quantity,l_orderkey,l_linenumber", "sum($)")),
        "minimum": union(flags.each("Minimum", "l_quantity,l_extendedprice,l_discount", "min($)")),
        "maximum": union(flags.each("Maximum", "l_quantity,l_extendedprice,l_orderkey", "max($)")),
        "approx_count_distinct": union(
            f"SELECT l_returnflag AS part, '{c}' AS instance, count(DISTINCT {c})::DOUBLE AS exact, "
            "true AS within_tolerance FROM lineitem GROUP BY ALL"
            for c in ("l_partkey", "l_orderkey", "l_extendedprice")
        ),
        "count_distinct": on_tables(lambda s, c: s.frequency("CountDistinct", c)),
        "distinctness": on_tables(lambda s, c: s.frequency("Distinctness", c)),
        "uniqueness": on_tables(lambda s, c: s.frequency("Uniqueness", c)),
        "unique_value_ratio": on_tables(lambda s, c: s.frequency("UniqueValueRatio", c)),
        "entropy": on_tables(lambda s, c: s.frequency("Entropy", c)),
        "datatype": union(datatypes),
        "compliance": union(
            Source(FLAGS, digits=9, extra="'lineitem' AS table_name").share(
                "Compliance", "large", "l_quantity >= 25"
            )
            + Source(FLAGS, digits=9, extra="'lineitem' AS table_name").share(
                "Compliance", "discounted", "l_discount > 0.05 AND l_tax < 0.04"
            )
            + Source(STATUS, digits=9, extra="'orders' AS table_name").share(
                "Compliance", "urgent", "o_orderpriority IN ('1-URGENT','2-HIGH')"
            )
        ),
        "correlation": union(
            Source(FLAGS, digits=9).correlation("l_quantity", "l_extendedprice")
            + Source(FLAGS, digits=9).correlation("l_discount", "l_partkey")
        ),
        "mutual_information": union(
            s
            for t, relation, couples in (
                ("lineitem", "lineitem", (("l_partkey", "l_suppkey"), ("l_quantity", "l_returnflag"))),
                ("documents", "documents", (("lang", "source"),)),
                ("events", EVENTS, (("event_type", "user_id"),)),
            )
            for a, b in couples
            for s in Source(relation, False, 9, f"'{t}' AS table_name").mutual_information(a, b)
        ),
        "pattern_match": union(
            Source(STATUS, digits=9).share(
                "PatternMatch", "o_orderpriority", "regexp_matches(o_orderpriority, '^[12]-')"
            )
        ),
        "approx_quantile": union(
            f"SELECT DISTINCT l_returnflag AS part, 'ApproxQuantile-{q}' AS name, "
            "true AS within_tolerance FROM lineitem"
            for q in ("0.5", "0.95")
        ),
        "profile_scan": union(lineitem_scan()),
        "profile_full": keyed,
        "metrics_keyed": (
            "SELECT entity, instance, name, value, 'orders-' || part AS bucket_file_name, "
            "instance || '-' || name AS \"col_metricName\", 'orders' AS bucket_name, "
            f"part AS file_name FROM ({keyed}) k"
        ),
        "spec_expand": union(spec_expand()),
        "metrics_success": union(
            by_order.size()
            + by_order.each("Maximum", "l_quantity", "max($)")
            + by_order.completeness("l_tax")
            + by_order.correlation("l_quantity", "l_extendedprice")
        ),
        "metrics_failures": FAILURES,
        "manifest_register": REGISTERED,
        "manifest_pending": f"SELECT * FROM ({REGISTERED}) r WHERE processed = 'N'",
        "manifest_mark_processed": (
            f"WITH {KNOWN} SELECT k.bucket_name, k.file_name, "
            "CASE WHEN d.lang = 'en' THEN 'Y' ELSE k.processed END AS processed "
            "FROM known k JOIN documents d ON k.file_name = CAST(d.doc_id AS VARCHAR)"
        ),
        "manifest_lifecycle": (
            "SELECT source AS bucket_name, CAST(doc_id AS VARCHAR) AS file_name, "
            "CASE WHEN lang = 'en' THEN 'Y' ELSE 'N' END AS processed FROM documents"
        ),
        "metrics_upsert": UPSERT,
        "metrics_export": (
            f"SELECT 'events' AS bucket_name, part AS file_name, entity, instance, name, value FROM ({daily_rows}) d"
        ),
        "file_manifest": (
            "SELECT 'orders' AS bucket_name, o_orderstatus AS part, 'N' AS processed, count(*) AS orders, "
            "true AS has_bytes FROM orders GROUP BY o_orderstatus"
        ),
        "manifest_changed": (
            "SELECT source AS bucket_name, CAST(doc_id AS VARCHAR) AS file_name, "
            "CASE WHEN lang = 'en' AND source <> 'src1' THEN 'Y' ELSE 'N' END AS processed FROM documents"
        ),
        "metrics_compacted": UPSERT,
        "run_job_files": f"SELECT *, 'Y' AS processed FROM ({union(job_files())}) j",
        "unlike_files": UNLIKE,
        "two_streams_one_table": TWO_STREAMS,
        "state_merge": union(state_metrics()),
        "state_merge_sketches": union(
            f"SELECT DISTINCT l_returnflag AS part, '{c}' AS instance, '{n}' AS name, "
            "true AS within_tolerance FROM lineitem"
            for c, n in (
                ("l_orderkey", "ApproxCountDistinct"),
                ("l_extendedprice", "ApproxCountDistinct"),
                ("l_extendedprice", "ApproxQuantile-0.5"),
            )
        ),
        "estimates_agree": union(
            f"SELECT DISTINCT l_returnflag AS part, '{c}' AS instance, '{n}' AS name, true AS same FROM lineitem"
            for c, n in (
                ("l_partkey", "ApproxCountDistinct"),
                ("l_suppkey", "ApproxCountDistinct"),
                ("l_quantity", "ApproxQuantile-0.5"),
            )
        ),
        "event_windows": union(
            in_time.size()
            + in_time.each("Mean", "user_id", "avg($)")
            + in_time.frequency("CountDistinct", "user_id")
            + in_time.frequency("Entropy", "event_type")
            + in_time.mutual_information("event_type", "user_id")
            + Source(f"(SELECT * FROM {MARKED} k WHERE done)").scan("Dataset", "*", "Late", "count(*) FILTER (WHERE late)")
            + Source(f"(SELECT * FROM {MARKED} k WHERE came IS NULL)").scan("Dataset", "*", "Untimed", "count(*)")
        ),
        "sampled_distinct": "SELECT part, instance, name, value AS exact, true AS within_bounds, true AS same_merged FROM ("
        + union(
            s
            for kind in ("CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio")
            for s in Source(FLAGS, digits=9).frequency(kind, "l_partkey,l_orderkey,l_extendedprice,l_quantity")
        )
        + ") x",
        "file_states": union(
            files.size()
            + files.each("Mean", "user_id", "avg($)")
            + files.frequency("CountDistinct", "user_id")
            + files.frequency("Entropy", "event_type")
            + files.mutual_information("event_type", "user_id")
        ),
        "bad_rows": BAD_ROWS,
        "row_verdicts": VERDICTS,
        "profile_groups": GROUPS,
        "verify_checks": VERIFY,
        "check_status": CHECK_STATUS,
        "metric_history": HISTORY,
        "learned_checks": LEARNED,
        "tagged_runs": TAGGED,
        "run_history": RUNS,
        "run_job": JOB,
        "ingest_files": (
            "SELECT count(*)::DOUBLE AS events, sum(user_id)::DOUBLE AS total, "
            "round(count(event_type) / count(*)::DOUBLE, 6) AS completeness FROM events"
        ),
        "incremental_ingest": union(
            days.size()
            + days.each("Mean", "user_id", "avg($)")
            + days.frequency("CountDistinct", "user_id")
            + days.frequency("Entropy", "event_type")
            + days.mutual_information("event_type", "user_id")
        ),
    }
