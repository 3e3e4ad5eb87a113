"""Sinks: CSV tables of fixed columns, failure logs, verbatim files, hash and vector caches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinspark.sources import paths

# fixed values: the columns of the tables, and what they are sorted by
TABLES = {
    "duplicates": (["md5", "path", "dataset_folder", "kept", "group_spans_multiple_datasets"], ["md5", "path"]),
    "pairs": (["pair_index", "image_a", "image_b", "issame"], ["pair_index"]),
    "one_train": (["identity", "source_prefix", "total_images", "train_image", "test_images"], ["identity"]),
    "results": (["query_file", "query_dataset", "expected_cluster", "top1_cluster", "top1_score", "best_correct_score", "hit@1", "hit@5", "has_train_row"], ["query_file"]),
    "identity_results": (["query_file", "expected_identity", "top1_identity", "top1_score", "best_correct_score", "hit@1", "hit@5", "error"], ["query_file"]),
}


def cells(rows: DataFrame, kind: str) -> DataFrame:
    """The columns of a table as text, nulls as ''."""
    return rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in TABLES[kind][0]])


def write_table(rows: DataFrame, kind: str, path: str) -> None:
    """A CSV folder with a header, globally sorted."""
    order = [F.col(f"`{c}`") for c in TABLES[kind][1]]
    cells(rows.orderBy(*order), kind).write.csv(path, header=True, emptyValue="")


def write_wide(hits: DataFrame, k: int, path: str) -> None:
    """Rows (query_file, error, rank1_person, rank1_score, rank1_dataset, ...) as CSV; scores with six digits."""
    cols = ["query_file", "error", *(f"rank{r}_{c}" for r in range(1, k + 1) for c in ("person", "score", "dataset"))]
    shown = [F.format_string("%.6f", F.col(c)) if c.endswith("_score") else F.col(c).cast("string") for c in cols]
    hits.select(*[F.coalesce(F.when(F.col(c).isNotNull(), x), F.lit("")).alias(c) for c, x in zip(cols, shown, strict=True)]).orderBy("query_file").write.csv(path, header=True, emptyValue="")


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """Rows (md5, path, dataset, rank) of groups of two and more, with the one of least rank and then first path as kept; null hashes count for nothing."""
    best = F.min(F.struct("rank", "path"))
    groups = rows.where("md5 is not null").groupBy("md5").agg(F.count("*").alias("copies"), F.countDistinct("dataset").alias("datasets"), best.alias("best")).where("copies > 1")
    out = rows.join(groups, "md5").withColumn("kept", F.col("path") == F.col("best.path"))
    return out.select("md5", "path", F.col("dataset").alias("dataset_folder"), "kept", (F.col("datasets") > 1).alias("group_spans_multiple_datasets"))


def write_failures(failures: DataFrame, path: str) -> bool:
    """(path, reason) as lines with a tab; nothing is written, and False comes back, if there is none."""
    if failures.isEmpty():
        return False
    failures.orderBy("path", "reason").select(F.concat_ws("\t", "path", "reason")).write.text(path)
    return True


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """(dest, content binary) to files below ``root``, byte for byte: (dest, n_bytes, error). Tasks write their rows; a task that runs again writes the same files.

    ``root`` is one that pyarrow's file systems open (a local path or a URI that all executors reach).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root)
        made = set()
        for b in batches:
            out = []
            for dest, content in zip(b["dest"], b["content"], strict=True):
                folder, name = f"{top}/{dest}".rsplit("/", 1)
                try:
                    if ".." in dest.split("/") or not name:
                        raise OSError("not a name below the root")
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    with store.open_output_stream(f"{folder}/{name}") as f:
                        f.write(bytes(content))
                    out.append((dest, len(content), None))
                except OSError as e:
                    out.append((dest, 0, str(e)))
            yield pd.DataFrame(out, columns=["dest", "n_bytes", "error"])

    return rows.select("dest", "content").mapInPandas(run, "dest string, n_bytes long, error string")


def materialise(rows: DataFrame, root: str) -> DataFrame:
    """Rows (split, dest_name, content) of train and test as files; (split, copied, failed)."""
    copied = rows.where(F.col("split").isin("train", "test")).withColumnRenamed("dest_name", "dest")
    done = write_files(copied, root)
    split = F.split("dest", "/")[0].alias("split")
    return done.groupBy(split).agg(F.count_if(F.col("error").isNull()).alias("copied"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def export(files: DataFrame, gone: DataFrame, root: str) -> DataFrame:
    """Files (path, dest, content) that aren't ``gone`` (path), below ``root``."""
    return write_files(files.join(gone.select("path"), "path", "left_anti"), root)


def save_cache(rows: DataFrame, path: str) -> None:
    """A cache of hashes or vectors, appended to; each entry with the time ``at`` that says which of a key counts."""
    rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def load_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The cache in a folder, or an empty one: where it is missing all is computed."""
    full = f"{schema}, at timestamp"
    return spark.read.schema(full).parquet(path) if paths.exists(spark, path) else spark.createDataFrame([], full)
