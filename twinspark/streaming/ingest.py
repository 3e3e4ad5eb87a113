"""Micro-batch ingest: files that land in a folder are searchable after their batch, and never twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from twinspark.operators import collection
from twinspark.shared import scratch, table
from twinspark.sources import paths


def _started(spark: SparkSession, landing: str, schema: str, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_stream(spark: SparkSession, landing: str, schema: str, store: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> StreamingQuery:
    """Append rows of Parquet files in ``landing`` whose image_path is not in ``store`` yet, once each; ``prepare`` sees these only.

    A batch meets the paths of the store only, a column that Parquet reads by itself.
    """

    def batch(rows: DataFrame, _: int) -> None:
        new = rows.dropDuplicates(["image_path"])
        if paths.exists(spark, store):
            new = new.join(spark.read.schema("image_path string").parquet(store), "image_path", "left_anti")
        prepare(new).write.mode("append").parquet(store)

    return _started(spark, landing, schema, checkpoint, batch)


def ingest_batch(spark: SparkSession, rows: DataFrame, number: int, path: str, embed: Callable[[DataFrame], DataFrame], writer: str = "stream") -> DataFrame:
    """One batch of an ingest into a collection, and what became of each of its rows: (image_path, outcome, reason).

    Paths that the collection has are skipped before ``embed`` sees any row; ``embed`` adds ``embedding`` and, for rows
    that it can't embed, ``reason``. It sees a new path once. The outcomes and the batch's number are committed with the rows, so a
    batch that comes again after its commit changes nothing and embeds nothing; one that broke off before is done anew as a whole.
    """
    done = collection.current(spark, path).get("done", {}).get(writer, [-1])[0]
    if done >= number:
        return collection.append(spark, path, rows, marker=(writer, number)).select("image_path", "outcome", "reason")
    with scratch(spark):
        have = collection.load(spark, path).select("image_path")
        one = rows.dropDuplicates(["image_path"])
        made = embed(one.join(have, "image_path", "left_anti"))
        made = made if "reason" in made.columns else made.selectExpr("*", "cast(null as string) as reason")
        made = table(made, "embedded")
        told = collection.append(spark, path, made.where("reason is null").drop("reason"), marker=(writer, number)).select("image_path", "outcome", "reason")
        skipped = one.join(have, "image_path", "left_semi").selectExpr("image_path", "'skipped' as outcome", "cast(null as string) as reason")
        failed = made.where("reason is not null").selectExpr("image_path", "'failed' as outcome", "reason")
        ledger = f"{path}/ledger/{writer}/{number}"
        told.unionByName(skipped.join(told.select("image_path"), "image_path", "left_anti")).unionByName(failed).write.mode("overwrite").parquet(ledger)
    return spark.read.parquet(ledger)


def ingest_collection(spark: SparkSession, landing: str, schema: str, path: str, checkpoint: str, embed: Callable[[DataFrame], DataFrame], dim: int, writer: str = "stream") -> StreamingQuery:
    """Files that land in a folder into a collection, exactly once: see ``ingest_batch``."""
    collection.create(spark, path, dim)
    return _started(spark, landing, schema, checkpoint, lambda rows, number: ingest_batch(spark, rows, number, path, embed, writer) and None)
