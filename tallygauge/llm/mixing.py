"""Mixing sources to target weights by weighted fair queueing.

Every source has a target, its share of the budget. Its documents stand in a shuffled queue (the order
of a hash of ``doc_id``), which may be gone through ``MOST_VISITS`` times. A visit's virtual
finish time is the words of the source up to and with it, divided by the source's target. All visits are
sorted by finish time over the whole cluster and cut where the words reach the budget, so at any
point of the mix the sources stand in the proportion of their targets.

No sum runs through one task: rows are range-partitioned, every partition is summed up, and running
totals start from the sum of the partitions before (one row per partition). The share-out is a few
aggregates over one row per source.

Defined results: null texts have size 0; a null source is a source, ordered last; documents of size 0
take 0 words; a source of size 0 has target 0; rows with equal ``doc_id`` each count; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygauge.llm.quality import words_of
from tallygauge.llm.storage import saved

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_VISITS = 2


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with running totals (the row itself included) over the given order, as new columns."""
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = saved(ranged, "ranged")
    parts = ranged.groupBy("__part").agg(*(F.sum(v).alias(f"__{n}") for n, v in sums.items()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", *(F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums))
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {n: F.sum(v).over(within) + F.col(f"__{n}") for n, v in sums.items()}
    return ranged.join(starts, "__part").withColumns(totals).drop("__part", *(f"__{n}" for n in sums))


def source_targets(sized: DataFrame) -> DataFrame:
    """``of`` (the source), ``source_size``, ``before`` (words of the sources before it), ``rank`` and ``target``."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("bigint"))
    ordered = running(sizes, [F.asc_nulls_last("source")], {"place": "one", "upto": "source_size"})
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources = saved(
        ordered.select(
            F.col("source").alias("of"),
            "source_size",
            (F.col("upto") - F.col("source_size")).alias("before"),
            F.col("place").alias("rank"),
            weight.cast("double").alias("weight"),
            (F.col("source_size") * float(MOST_VISITS)).alias("most"),
        ),
        "sources",
    )
    budget = BUDGET * (sources.agg(F.sum("source_size")).first()[0] or 0)
    rest, weights, full, count = budget, 0.0, F.lit(False), -1
    while True:
        free = F.when(~full, F.col("weight"))
        spent = F.when(full, F.col("most"))
        taken, weights, n = sources.agg(F.sum(spent), F.sum(free), F.count(spent)).first()
        if n == count:
            break
        rest, weights, count = budget - (taken or 0.0), weights or 0.0, n
        full = F.col("most") * weights <= rest * F.col("weight")
    share = F.lit(rest) * F.col("weight") / (weights or 1.0)
    return sources.withColumn("target", F.when(full, F.col("most")).otherwise(share)).drop("weight", "most")


def visits(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``uid`` and ``n_visits`` of the rows (``uid``, ``doc_id``, ``source``, ``size``) the mix takes."""
    key = F.md5(F.col("doc_id").cast("string").cast("binary"))
    queued = rows.withColumn("key", key).where("size > 0")
    queued = running(queued, [F.asc_nulls_last("source"), F.col("key"), F.col("uid")], {"upto": "size"})
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("of"))).where("target > 0")
    each = F.explode(F.sequence(F.lit(0), F.lit(MOST_VISITS - 1))).alias("visit")
    queued = queued.select("uid", "key", "size", "target", "rank", "source_size", (F.col("upto") - F.col("before")).alias("at"), each)
    finish = (F.col("at") + F.col("visit") * F.col("source_size")).cast("double") / F.col("target")
    queue = queued.select("uid", "key", "size", "rank", "visit", finish.alias("finish"))
    order = [F.col(c) for c in ("finish", "rank", "visit", "key", "uid")]
    budget = BUDGET * (rows.agg(F.sum("size")).first()[0] or 0)
    taken = running(queue, order, {"mixed": "size"}).where(F.col("mixed") <= budget)
    return taken.groupBy("uid").agg(F.count("*").alias("n_visits"))


def sized(docs: DataFrame) -> DataFrame:
    """``uid``, ``doc_id``, ``source`` and ``size``, kept so that ``uid`` stays the row's own."""
    size = F.size(words_of(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("bigint")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))
    return saved(rows.withColumn("uid", F.monotonically_increasing_id()), "sized")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, a row per row."""
    rows = sized(docs)
    targets = source_targets(rows)
    found = rows.join(visits(rows, targets), "uid", "left").join(targets, F.col("source").eqNullSafe(F.col("of")))
    taken = F.coalesce("n_visits", F.lit(0)) * F.col("size")
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` the mix takes, each as often as it is visited."""
    held = saved(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*docs.columns).alias("row")), "to-mix")
    size = F.size(words_of(F.coalesce(F.col("row.text").cast("string"), F.lit("")))).cast("bigint")
    source = F.col("row.source").cast("string").alias("source")
    rows = saved(held.select("uid", F.col("row.doc_id").alias("doc_id"), source, size.alias("size")), "sized")
    again = F.explode(F.sequence(F.lit(1), F.col("n_visits"))).alias("visit")
    return held.join(visits(rows, source_targets(rows)), "uid").select("row", again).select(*(F.col("row")[c].alias(c) for c in docs.columns))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, (CASE (rank - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS most, {BUDGET}::DOUBLE * sum(source_size) OVER () AS budget
  FROM sources
), ordered AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed
), first_free AS (
  SELECT budget - spent AS rest, weights FROM ordered WHERE most * weights > (budget - spent) * weight
  ORDER BY most / weight, rank LIMIT 1
), targets AS (
  SELECT o.source, source_size, rank, budget,
         CASE WHEN f.rest IS NULL OR most * f.weights <= f.rest * weight THEN most ELSE f.rest * weight / f.weights END AS target
  FROM ordered o LEFT JOIN first_free f ON true
), queued AS (
  SELECT d.doc_id, d.key, d.size, t.source_size, t.rank, t.target, t.budget,
         sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.key ROWS UNBOUNDED PRECEDING) AS place
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), queue AS (
  SELECT doc_id, key, size, rank, visit, budget, (place + visit * source_size)::DOUBLE / target AS finish
  FROM queued, (VALUES (0), (1)) v(visit) WHERE size > 0 AND target > 0
), mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, visit, key ROWS UNBOUNDED PRECEDING) AS upto FROM queue
), visited AS (
  SELECT doc_id, count(*) AS n FROM mixed WHERE upto <= budget GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(v.n, 0) * q.size AS BIGINT) AS taken
FROM queued q LEFT JOIN visited v USING (doc_id)
"""
