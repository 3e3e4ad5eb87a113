"""A corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a lazy DataFrame, which the caller writes, so that texts are
written once a stage. All but the last return the columns of ``documents``, ``n_chars`` kept true. What a stage leaves
beside it is the table of its decisions (the quality stage: its scored rows); it deletes what else it wrote, and nothing
of others. ``run`` writes each stage's result in a folder of its own, which goes when the last one is written, and with
each result goes what its stage left. Results belong to the caller: no later call touches them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinspark.llm import decontaminate, lines, mixing, quality, simhash
from twinspark.llm.common import free_name, read
from twinspark.shared import scratch, settled, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(f: Stage) -> Stage:
    """The stage, with this package sent to the workers."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return f(ship(spark), docs, sf_dir)

    return run


def _counted(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` of the text as it now is."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below 0.3."""
    return quality.filter_quality(docs, read(spark, sf_dir, "labels"))


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines; every document stays, if need be with an empty text."""
    return _counted(lines.line_dedup(docs, into=free_name(docs, "lines")), docs)


@_stage
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.near_duplicates(docs)


@_stage
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out of the texts; texts without any stay byte for byte."""
    return _counted(decontaminate.scan(docs, read(spark, sf_dir, "benchmark"), clean=True, into=free_name(docs, "found")), docs)


@_stage
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights; documents taken twice come twice."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mix_stage),
]

#: The quality classifier, the fingerprints and the FM-index have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(ship(spark)) as outer:
        docs = read(spark, sf_dir, "documents")
        for _, stage in STAGES[:-1]:
            docs = settled(spark, stage.__name__, lambda: stage(spark, docs, sf_dir))  # noqa: B023
        return table(STAGES[-1][1](spark, docs, sf_dir), "pipeline", outer)
