"""Mixing sources to target weights with hash-threshold histograms. DataFrame functions only.

Each row has a fixed 60-bit hash. A source whose target is ``r`` whole passes
and a remainder takes every row ``r`` times and once more those rows whose hash
is at most the source's threshold. Thresholds of growing budgets are nested: a
larger budget keeps every row of a smaller one. To find a threshold, sizes are
summed by source and by the next 12 bits of the hash; only the bucket that
crosses the budget is refined with the following bits. No rows are sorted and
none meet in one task: what leaves a task is a sum for each source and bucket.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; a null doc_id hashes as the empty string; rows with equal doc_id and equal
text are copies of one row, share a hash and are taken or left together; the group of
rows at the threshold itself is taken if that comes nearer to the target; an empty table gives an empty result;
other columns are ignored. A source whose size is 0 has target 0. The table of
sources (one row each) is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notice_engine.llm.names import apart
from notice_engine.llm.words import WORD
from notice_engine.session import table, written

WEIGHTS, CAP = (1, 2, 3), 3
HASH_BITS, STEP_BITS = 60, 12
#: Per-source tables are broadcast up to this many sources, and joined by shuffle beyond.
BROADCAST_SOURCES = 100_000


def row_hash(doc_id: Column, text: Column) -> Column:
    """Of id and text, so that rows that share one of them are dealt apart."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def row_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> also weight, target, repeats and the remainder wanted.

    Sources are filled in order of cap to weight; those whose cap lies below the
    level of the rest are capped, and the others share what is left by weight.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    t = sources.withColumn("weight", F.get(cycle, (F.row_number().over(ordered) - 1) % len(weights)))
    t = t.withColumn("most", F.col("source_size") * cap)
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = t.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "spent": F.coalesce(F.sum("most").over(before), F.lit(0)),
            "rest": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    t = t.withColumn("capped", F.col("most") * F.col("rest") <= F.col("weight") * (F.col("total") - F.col("spent")))
    free = F.when(~F.col("capped"), F.col("weight"))
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(everything), F.lit(0))
    share = (F.col("weight") * left).cast("double") / F.sum(free).over(everything).cast("double")
    t = t.withColumn("target", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(share))
    size = F.col("source_size")
    t = t.withColumn("repeats", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
    return t.withColumn("wanted", F.col("target") - F.col("repeats") * size).select("source", "source_size", "weight", "target", "repeats", "wanted")


def _by_source(rows: DataFrame, small: DataFrame, few: bool, how: str = "inner", name: str = "_source") -> DataFrame:
    """Join a per-source table to rows; sources may be null. ``name``: a column that rows do not have."""
    small = small.withColumnRenamed("source", name)
    return rows.join(F.broadcast(small) if few else small, rows["source"].eqNullSafe(small[name]), how).drop(name)


def thresholds(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> tuple[DataFrame, bool]:
    """(source, size, h) -> per source: source_size, target, repeats and the threshold; and whether there are few sources."""
    by_source = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    few = by_source.count() <= BROADCAST_SOURCES
    plan = written(targets(by_source, weights, cap), "mix-targets")
    open_ = plan.select("source", F.lit(0).cast("long").alias("prefix"), F.col("wanted").alias("need"), (F.col("wanted") > 0).alias("open"), F.lit(-1).cast("long").alias("threshold"))
    for used in range(0, HASH_BITS, STEP_BITS):
        shift = HASH_BITS - used - STEP_BITS
        inside = _by_source(sized, open_.where("open"), few)
        if used:
            inside = inside.where(F.shiftright("h", shift + STEP_BITS) == F.col("prefix"))
        hist = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"), F.first("need").alias("need"))
        order = Window.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        # the first bucket that reaches the budget, or the last one if rounding keeps all below it
        edge = hist.groupBy("source").agg(F.coalesce(F.min(F.when(F.col("upto") >= F.col("need"), F.struct("bucket", "upto", "size", "low", "high"))), F.max(F.struct("bucket", "upto", "size", "low", "high"))).alias("e"))
        step = _by_source(open_, edge.withColumn("seen", F.lit(True)), few, "left")
        need = F.col("need") - (F.col("e.upto") - F.col("e.size"))
        done = F.col("e.low") == F.col("e.high")
        at = F.when(need * 2 >= F.col("e.size"), F.col("e.low")).otherwise(F.col("e.low") - 1)
        hit = F.col("open") & F.col("seen").isNotNull()
        step = step.select(
            "source",
            F.when(hit, F.col("e.bucket")).otherwise(F.col("prefix")).alias("prefix"),
            F.when(hit, need).otherwise(F.col("need")).alias("need"),
            (hit & ~done).alias("open"),
            F.when(hit & done, at).otherwise(F.col("threshold")).alias("threshold"),
        )
        open_ = written(step, "mix-edge")
        if open_.where("open").isEmpty():
            break
    plan = _by_source(plan, open_.select("source", "threshold"), few)
    return written(plan, "mix-plan"), few


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies and taken (words the mix takes, repeats counted)."""
    sized = written(docs.select("doc_id", "source", row_size(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    plan, few = thresholds(sized.select("source", "size", "h"), weights, cap)
    copies = F.col("repeats") + (F.col("h") <= F.col("threshold")).cast("long")
    return _by_source(sized, plan, few).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept."""
    names = docs.columns
    repeats, threshold, copies, copy, source = apart(names, "repeats", "threshold", "copies", "copy", "_source")
    sized = written(docs.select("source", row_size(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    plan, few = thresholds(sized, weights, cap)
    plan = plan.select("source", F.col("repeats").alias(repeats), F.col("threshold").alias(threshold))
    times = F.col(repeats) + (row_hash(F.col("doc_id"), F.col("text")) <= F.col(threshold)).cast("long")
    out = _by_source(docs, plan, few, name=source).withColumn(copies, times).where(F.col(copies) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*names)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS most FROM s),
f AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(most) OVER (ORDER BY most / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM w),
c AS (SELECT *, most * rest <= weight * (total - spent) AS capped FROM f),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE)
    ELSE CAST(weight * (total - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0)) AS DOUBLE) / CAST(sum(CASE WHEN NOT capped THEN weight END) OVER () AS DOUBLE) END AS target
  FROM c),
r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM t),
n AS (SELECT *, target - repeats * source_size AS wanted FROM r),
g AS (SELECT source, h, sum(size) AS size FROM sized GROUP BY source, h),
u AS (SELECT g.*, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
e AS (
  SELECT n.source, any_value(n.wanted) AS wanted, coalesce(min(CASE WHEN upto >= wanted THEN h END), max(h)) AS edge
  FROM u JOIN n ON u.source IS NOT DISTINCT FROM n.source GROUP BY n.source),
x AS (
  SELECT e.source, CASE WHEN e.wanted <= 0 THEN -1 WHEN (e.wanted - (u.upto - u.size)) * 2 >= u.size THEN e.edge ELSE e.edge - 1 END AS threshold
  FROM e JOIN u ON u.source IS NOT DISTINCT FROM e.source AND u.h = e.edge)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CAST(d.size * (n.repeats + CASE WHEN d.h <= x.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN n ON d.source IS NOT DISTINCT FROM n.source JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""
