"""What becomes of the records of containers: labels by place, limits on successes, outcomes and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinspark.operators.order import numbered, running


def with_labels(records: DataFrame, listed: DataFrame, by: str) -> DataFrame:
    """Records (by, label of the header, ...) with ``position``, their place in the order ``by`` (a key), and as ``label`` the listed one (position, label) of that place if there is one."""
    placed = numbered(records, [by], "position")
    told = listed.select("position", F.col("label").alias("_listed"))
    return placed.join(told, "position", "left").withColumn("label", F.coalesce("_listed", "label")).drop("_listed")


def first_successes(records: DataFrame, by: str, ok: Column, limit: int = 0) -> DataFrame:
    """Records in the order ``by`` (a key) up to the ``limit``-th success (0: all), with ``sequence``: the number of a success, null for others."""
    rows = running(records.withColumn("_ok", ok), [by], F.col("_ok").cast("int"), "sequence")
    if limit:
        rows = rows.where(F.col("sequence") - F.col("_ok").cast("int") < limit)
    return rows.withColumn("sequence", F.when(F.col("_ok"), F.col("sequence"))).drop("_ok")


def image_outcomes(images: DataFrame, key: str = "dataset") -> DataFrame:
    """Images (key, image, md5) with ``outcome``: failed without a hash, written if first of its hash in its set, else intra_bin_dupe."""
    first = images.where("md5 is not null").groupBy(key, "md5").agg(F.min("image").alias("_first"))
    out = images.join(first, [key, "md5"], "left")
    said = F.when(F.col("md5").isNull(), "failed").when(F.col("image") == F.col("_first"), "written").otherwise("intra_bin_dupe")
    return out.withColumn("outcome", said).drop("_first")


def kept_pairs(outcomes: DataFrame, key: str = "dataset") -> DataFrame:
    """(key, pair, kept): pairs (2i, 2i + 1) of images, and whether both were written; a pair of which an image isn't there isn't kept."""
    pair = F.floor(F.col("image") / 2).alias("pair")
    return outcomes.groupBy(key, pair).agg((F.count_if(F.col("outcome") == "written") == 2).alias("kept"))


def counters(outcomes: DataFrame, key: str = "dataset") -> DataFrame:
    """(key, written, intra_bin_dupes, failed, pairs_dropped) of each set, and of all (null)."""
    count = lambda what: F.count_if(F.col("outcome") == what)
    each = outcomes.groupBy(key).agg(count("written").alias("written"), count("intra_bin_dupe").alias("intra_bin_dupes"), count("failed").alias("failed"))
    each = each.join(kept_pairs(outcomes, key).groupBy(key).agg(F.count_if(~F.col("kept")).alias("pairs_dropped")), key)
    cols = ["written", "intra_bin_dupes", "failed", "pairs_dropped"]
    whole = each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    return each.unionByName(whole.withColumn(key, F.lit(None).cast(each.schema[key].dataType)))
