"""Helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base = "_" + base
    return base


def crc_mod(doc_id: str, n: int):
    """crc32 of the id as text, modulo ``n``; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n
