"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Documents of a source are shuffled by the MD5 of their id. A document's virtual finish time is the
running size of its source divided by the source's target; the mix is all documents in order of
virtual finish time, cut where the total budget is spent. A source whose target exceeds its size is
queued again (a second epoch), so that a document is taken at most twice.

Edge cases: null texts and texts without words have size 0 and are never taken; a null source is a
source of its own, last in order; null ids hash as the empty string; repeated rows are separate
documents; an empty table gives an empty result. Other columns of the input, whatever their names,
pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from twinspark.shared import scratch, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  #: budget as a share of all sizes
EPOCHS = 2  #: most times that a document is taken
SLICES = 4096  #: buckets of a prefix sum, for each unit of virtual time


def _targets(by_source: DataFrame, weights: tuple[float, ...], share: float) -> DataFrame:
    """(k, source_size) to (k, source_size, target): weights filled up to the caps, the excess shared anew.

    Sorted by cap over weight, a source is capped if its cap is below its part of what the sources
    before it leave; the first that isn't gives the level for all that follow. One row a source.
    """
    order, level = W.orderBy("k"), W.orderBy("ratio", "k")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = by_source.withColumn("w", weight).withColumn("cap", (EPOCHS * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    t = t.withColumn("left", share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("level", F.col("left") / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    t = t.withColumn("capped", F.col("ratio") <= F.col("level"))
    t = t.withColumn("common", F.max(F.when(~F.col("capped"), F.col("level"))).over(every))
    return t.select("k", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("common")).alias("target"))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("id"), F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("k"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"), *more,
    ).withColumn("slice", F.substring("h", 1, 3))


def _timed(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` with ``cum``, and size and target of the source; rows and offsets meet by slice, nothing is broadcast."""
    inside = F.sum("size").over(W.partitionBy("k", "slice").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("cum", inside).join(offsets.hint("merge"), ["k", "slice"]).withColumn("cum", F.col("cum") + F.col("base")).drop("base")


def _vft(epoch: int) -> Column:
    return (F.col("cum") + epoch * F.col("source_size")) / F.col("target")


def _up_to(served: DataFrame, bucket: Column, budget: float) -> tuple[int | None, int]:
    """The bucket in which running sizes pass the budget (None: they don't), and the sum of those before it; a few thousand buckets, however many rows."""
    sums = served.groupBy(bucket.alias("bucket")).agg(F.sum("size").alias("n")).withColumn("end", F.sum("n").over(W.orderBy("bucket")))
    row = sums.where(F.col("end") > budget).agg(F.min("bucket"), F.min(F.struct("bucket", (F.col("end") - F.col("n")).alias("before")))).first()
    return row[0], (row[1][1] if row[1] else 0)


def _plan(docs: DataFrame, weights: tuple[float, ...], share: float) -> tuple[DataFrame, DataFrame, Column]:
    """Keys of the rows, offsets of the slices, and how often a row with ``cum`` is taken.

    Running sizes are summed in slices of the hash order, each slice a task's work at most, plus the
    totals of the slices before it, so that a source with a third of all rows is no single task. The
    place where the budget ends is found the same way, from sums over buckets of virtual time and then
    over buckets of the one in which it ends; only the rows of that last one, a few in 16 million, are put in order.
    """
    keys = table(_sized(docs), "sizes")
    parts = keys.groupBy("k", "slice").agg(F.sum("size").alias("n"))
    targets = _targets(parts.groupBy("k").agg(F.sum("n").alias("source_size")), weights, share)
    base = F.coalesce(F.sum("n").over(W.partitionBy("k").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = table(parts.withColumn("base", base).join(targets.hint("merge"), "k").select("k", "slice", "base", "source_size", "target"), "offsets")
    served = _timed(keys, offsets).where("size > 0").withColumn("e", F.explode(F.array(*[F.lit(e) for e in range(EPOCHS)]))).withColumn("vft", _vft(F.col("e")))
    served = table(served.select("vft", "h", "id", "e", "size"), "served")
    budget = float(share) * (keys.agg(F.sum("size")).first()[0] or 0)
    span = F.when(F.col("vft") < 2, F.floor(F.col("vft") * SLICES)).otherwise(2 * SLICES + F.floor(F.log2("vft") * 64))
    last, before = _up_to(served, span, budget)
    if last is None:
        return keys, offsets, F.when(F.col("size") > 0, EPOCHS).otherwise(0)
    edge = served.where(span == last)
    low, high = edge.agg(F.min("vft"), F.max("vft")).first()
    part = F.floor((F.col("vft") - low) / max(high - low, 1e-300) * SLICES)
    sub, within = _up_to(edge, part, budget - before)
    tail = edge.where(part == sub).withColumn("run", F.sum("size").over(W.orderBy("vft", "h", "id", "e").rowsBetween(W.unboundedPreceding, 0)))
    key = F.max(F.struct("vft", "h"))
    cut = tail.where(F.col("run") <= budget - before - within).agg(key).first()[0] or served.where((span < last) | ((span == last) & (part < sub))).agg(key).first()[0]
    if cut is None:
        return keys, offsets, F.lit(0)
    inside = lambda e: F.struct(_vft(e), F.col("h")) <= F.struct(F.lit(cut[0]).cast("double"), F.lit(cut[1]))
    return keys, offsets, sum((F.when((F.col("size") > 0) & inside(F.lit(e)), 1).otherwise(0) for e in range(EPOCHS)), F.lit(0))


def schedule(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(id, k, h, size, source_size, target, cum, times) of every row of ``docs``; times: how often it is taken. Texts stay where they are."""
    keys, offsets, times = _plan(docs, weights, share)
    return _timed(keys, offsets).withColumn("times", times)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix: the rows of ``docs`` that are taken, once for each time, globally sorted by virtual finish time.

    Lazy but for the offsets of the slices, the one table that stays.
    """
    with scratch(docs.sparkSession) as outer:
        _, offsets, times = _plan(docs, weights, share)
        offsets = table(offsets, "offsets", outer)
    s = _timed(_sized(docs, F.struct("*").alias("doc")), offsets).withColumn("times", times).where("times > 0")
    s = s.withColumn("e", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).withColumn("vft", _vft(F.col("e")))
    return s.orderBy("vft", "h", "id", "e").select("doc.*")


def op1(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    taken = (F.col("times") * F.col("size")).cast("long").alias("taken")
    return schedule(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY k),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, cap / w AS ratio,
             (1.5::DOUBLE * (SELECT CAST(sum(source_size) AS DOUBLE) FROM s)
               - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w),
t AS (SELECT k, source_size, CASE WHEN ratio <= level THEN cap
             ELSE w * (SELECT max(level) FROM l WHERE ratio > level) END AS target FROM l),
c AS (SELECT d.*, source_size, target,
             CAST(sum(size) OVER (PARTITION BY d.k ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
      FROM d JOIN t ON d.k = t.k),
e AS (SELECT c.*, e, CAST(cum + e * source_size AS DOUBLE) / target AS vft FROM c, (VALUES (0), (1)) x(e) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY vft, h, doc_id, e ROWS UNBOUNDED PRECEDING) AS run FROM e),
g AS (SELECT doc_id, k, cum, CAST(sum(size) AS BIGINT) AS taken FROM r
      WHERE run <= 1.5 * (SELECT sum(source_size) FROM s) GROUP BY doc_id, k, cum)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(g.taken, 0) AS taken
FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.k = g.k AND c.cum = g.cum AND c.size > 0
"""
