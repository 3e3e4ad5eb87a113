"""File sources: image folders, RecordIO containers, verification pickles, index and list files, manifests."""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinspark.functions.names import file_name, is_image, relative, stem, top_folder
from twinspark.operators.order import following, numbered
from twinspark.sources import paths

MANIFEST = "dataset_source string, name string, path string, md5 string, cluster_id string, split string, dest_name string"
# fixed values of the container formats
VGG_HEADER, CASIA_HEADER = 32, 24
LEAST_JPEG = 100


def folder(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """Image files with their bytes, by lower-cased extension, or by a case-sensitive ``glob`` such as ``*.jpg``; order is up to the reader of the rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return files.option("pathGlobFilter", glob).load(path) if glob else files.load(path).where(is_image(F.col("path")))


def datasets(files: DataFrame, root: str) -> DataFrame:
    """Top folders below ``root`` that hold an image."""
    return files.select(top_folder(F.col("path"), root).alias("dataset")).distinct()


def known(found: DataFrame, names: list[str]) -> DataFrame:
    """(position, dataset) of the ``names`` that are among the datasets ``found``; others don't count."""
    order = found.sparkSession.createDataFrame(list(enumerate(names)), "position int, dataset string")
    return order.join(found.select("dataset"), "dataset", "left_semi").select("position", "dataset")


def person_folders(files: DataFrame, root: str, first: int | None = None) -> DataFrame:
    """(person, name, path) of the images right in the folders below ``root``; of the ``first`` persons by name, if given (0: all)."""
    part = F.split(relative(F.col("path"), root), "/")
    rows = files.where(is_image(F.col("path"))).select(F.get(part, F.lit(0)).alias("person"), F.get(part, F.lit(1)).alias("name"), "path", F.size(part).alias("depth"))
    rows = rows.where("depth = 2").drop("depth")
    return rows.join(rows.select("person").distinct().orderBy("person").limit(first), "person", "left_semi") if first else rows


def uploads(files: DataFrame) -> DataFrame:
    """(path, content) with ``stored``, a name that no other upload has."""
    return files.withColumn("stored", F.concat_ws("_", F.uuid(), file_name(F.col("path"))))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest CSV, all text, blanks as nulls; ValueError if it has no rows."""
    rows = spark.read.csv(path, header=True, schema=MANIFEST, enforceSchema=False, nullValue="")
    if rows.isEmpty():
        raise ValueError(f"manifest without rows: {path}")
    return rows


def manifest_keys(rows: DataFrame) -> DataFrame:
    """(dataset_source, name) of the rows in which neither is blank."""
    return rows.select("dataset_source", "name").where("trim(dataset_source) <> '' and trim(name) <> ''")


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (x.split(" ")[0] for x in MANIFEST.split(", "))]).orderBy("dataset_source", "name").write.csv(path, header=True, emptyValue="")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line) of a text file, read in splits: lines are ordered by their split and their place in it."""
    rows = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    return numbered(rows, ["split", "place"], "n").select("n", "line")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(idx, offset) of an index file; bad lines are skipped, a repeated idx keeps its last line; ValueError if none is good."""
    parts = _lines(spark, path).select("n", F.split("line", "\t").alias("p")).where(F.size("p") >= 2)
    number = lambda i: F.trim(F.get("p", F.lit(i))).try_cast("long")
    rows = parts.select("n", number(0).alias("idx"), number(1).alias("offset")).where("idx is not null and offset is not null")
    rows = rows.groupBy("idx").agg(F.max_by("offset", "n").alias("offset"))
    if rows.isEmpty():
        raise ValueError(f"no usable line in {path}")
    return rows


def labels(spark: SparkSession, path: str) -> DataFrame:
    """(position, label) of a list file: idx, path, label by tabs; label 0 gives way to the path's second-last part. Lines without a whole number are dropped and don't count."""
    parts = _lines(spark, path).select("n", F.split("line", "\t").alias("p")).where(F.size("p") >= 3)
    whole = lambda c: F.when(F.trim(c).rlike(r"^[+-]?[0-9]+$"), F.trim(c).try_cast("long"))
    where = F.split(F.regexp_replace(F.get("p", F.lit(1)), "/+$", ""), "/")
    own, slash = whole(F.get("p", F.lit(2))), F.get("p", F.lit(1)).contains("/")
    rows = parts.select("n", F.when((own == 0) & slash & (F.size(where) > 1), whole(F.get(where, F.size(where) - 2))).otherwise(own).alias("label")).where("label is not null")
    return numbered(rows, ["n"], "position").select("position", "label")


def regions(offsets: DataFrame, path: str, size: int) -> DataFrame:
    """(idx, offset) of a container of ``size`` bytes to (offset, region): the bytes up to the next offset or the end.

    Tasks hold neighbouring offsets and read just their ranges, so no task loads the file; ``path`` is one that
    pyarrow's file systems open (a local path or a URI that all executors reach).
    """
    ends = following(offsets.select("offset").distinct(), "offset", F.lit(size).cast("long"), "next")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_file(name) as f:
            for b in batches:
                for a, z in zip(b["offset"].tolist(), b["next"].tolist(), strict=True):
                    yield pd.DataFrame({"offset": [a], "region": [f.read_at(z - a, a)]})

    return ends.repartitionByRange("offset").sortWithinPartitions("offset").mapInPandas(run, "offset long, region binary")


def jpeg(region: bytes) -> bytes | None:
    """The first JPEG stream of a record, if it is long enough."""
    a = region.find(b"\xff\xd8")
    b = region.find(b"\xff\xd9", a + 2) if a >= 0 else -1
    return region[a : b + 2] if b >= 0 and b + 2 - a > LEAST_JPEG else None


def header(region: bytes, vgg: bool) -> tuple[int, int] | None:
    """(label, id) from a record's header."""
    if len(region) < (VGG_HEADER if vgg else CASIA_HEADER):
        return None
    if vgg:
        return int.from_bytes(region[4:6], "little"), int.from_bytes(region[16:20], "little")
    import struct

    return int(struct.unpack_from("<f", region, 4)[0]), int.from_bytes(region[8:16], "little")


def records(regions: DataFrame, vgg: bool) -> DataFrame:
    """(offset, region binary) to (offset, label, record_id, jpeg); null where a part can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            heads = [header(bytes(r), vgg) or (None, None) for r in b["region"]]
            yield pd.DataFrame({"offset": b["offset"], "label": pd.array([h[0] for h in heads], "Int64"), "record_id": pd.array([h[1] for h in heads], "Int64"), "jpeg": [jpeg(bytes(r)) for r in b["region"]]})

    return regions.select("offset", "region").mapInPandas(run, "offset long, label long, record_id long, jpeg binary")


class _Plain(pickle.Unpickler):
    """Lists, numbers, bytes and booleans only."""

    def find_class(self, module: str, name: str):
        raise pickle.UnpicklingError(f"{module}.{name} is not allowed")


def read_bin(data: bytes) -> tuple[list[bytes], list[bool]]:
    try:
        bins, same = _Plain(io.BytesIO(data), encoding="bytes").load()
    except (UnicodeDecodeError, ValueError):
        bins, same = _Plain(io.BytesIO(data)).load()
    return [bytes(x) for x in bins], [bool(x) for x in same]


def verification(files: DataFrame) -> DataFrame:
    """(path, content) of pickled verification sets to a row an image: path, image, pair_index, pairs (of the set), issame, jpeg."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                bins, same = read_bin(bytes(content))
                n = range(len(bins))
                yield pd.DataFrame({"path": path, "image": list(n), "pair_index": [i // 2 for i in n], "pairs": len(same), "issame": [same[i // 2] if i // 2 < len(same) else None for i in n], "jpeg": bins})

    return files.select("path", "content").mapInPandas(run, "path string, image int, pair_index int, pairs int, issame boolean, jpeg binary")


def check_bins(images: DataFrame) -> DataFrame:
    """(path, images, pairs, complete) of ``verification``: whether a set has two images for each pair."""
    return images.groupBy("path").agg(F.count("*").alias("images"), F.max("pairs").alias("pairs"), (F.count("*") == 2 * F.max("pairs")).alias("complete"))


def verification_sets(spark: SparkSession, root: str, known: dict[str, str]) -> DataFrame:
    """Images of the ``.bin`` files below ``root`` whose stem ``known`` maps to a dataset, with ``dataset``; others are skipped.

    FileNotFoundError if there is none.
    """
    sets = spark.createDataFrame(list(known.items()), "stem string, dataset string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(root)
    named = files.select("path", stem(F.col("path")).alias("stem")).join(F.broadcast(sets), "stem").select("path", "dataset")
    if named.isEmpty():
        raise FileNotFoundError(f"no known .bin files in {root}")
    return verification(files.join(F.broadcast(named.select("path")), "path", "left_semi")).join(F.broadcast(named), "path")


def vector_cache(spark: SparkSession, folder: str) -> DataFrame | None:
    """(dataset_source, name, v, at) of a cache of vectors: an npy matrix with a JSON list of keys, one for each row. None if it is missing or broken.

    Tasks read ranges of rows; the path is one that pyarrow's file systems open. Zero rows are vectors that are missing.
    """
    from pyarrow import fs

    matrix, listed = f"{folder}/embeddings.npy", f"{folder}/embed_meta.json"
    if not (paths.exists(spark, matrix) and paths.exists(spark, listed)):
        return None
    meta = spark.read.json(listed, multiLine=True, schema="keys array<array<string>>")
    keys = meta.select(F.posexplode("keys").alias("row", "key")).select("row", F.get("key", F.lit(0)).alias("dataset_source"), F.get("key", F.lit(1)).alias("name"))
    try:
        store, name = fs.FileSystem.from_uri(matrix)
        with store.open_input_file(name) as f:
            version = np.lib.format.read_magic(f)
            shape, by_columns, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
            begin, size = f.tell(), f.size()
    except (ValueError, OSError):
        return None
    if len(shape) != 2 or by_columns or kind != np.float32 or shape[1] < 1 or shape[0] != keys.count() or size < begin + shape[0] * shape[1] * 4:
        return None
    wide, rows = shape[1] * 4, shape[0]
    step = max(1, (4 << 20) // wide)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(matrix)
        with store.open_input_file(name) as f:
            for b in batches:
                for first in b["id"].tolist():
                    n = min(step, rows - first)
                    v = np.frombuffer(f.read_at(n * wide, begin + first * wide), np.float32).reshape(n, -1)
                    yield pd.DataFrame({"row": np.arange(first, first + n), "v": list(v)})

    parts = spark.range(0, rows, step).mapInPandas(run, "row long, v array<float>")
    return keys.join(parts, "row").select("dataset_source", "name", "v", F.lit(0).alias("at"))
