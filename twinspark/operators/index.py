"""A stored index of vectors for approximate nearest neighbours by cosine: coarse cells, product-quantised codes, exact re-ranking.

    model/cells, model/codes   centres of the cells; for each part of a vector its code book
    data/<name>                Parquet of one batch: id, cell, code, v; sorted by cell
    deleted/<name>             ids of a deletion, each with the number of batches that it concerns
    versions/<n>               as of ``collection``: the batches and deletions that count

Cells and code books are learned from at most ``SAMPLE`` rows, chosen by a hash of the id; every row is indexed. A code
says where a unit vector lies from the centre of its cell, a byte for ``WIDTH`` numbers. A search reads cells and
codes of the cells that are probed (``effort``: the share of cells, nearest first), ranks by what the codes say
and compares the best ``keep`` of each query exactly. Cells are cut into blocks of bounded size, and so are the queries of a
cell, so that a cell with any share of the rows is many tasks.

Edge cases: null vectors, those of another dimension, with nulls or NaN and of no length are not indexed and, as queries, find nothing; rows that
repeat an id are each found; equal scores go by id; an empty sample makes an index of one cell; other columns don't matter.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinspark.functions.vectors import cosine, valid
from twinspark.operators import collection
from twinspark.operators.similar import ranked
from twinspark.shared import table

SAMPLE = 16384  #: most rows that cells and code books are learned from
CELLS = 1024  #: most cells
WIDTH = 4  #: numbers of a vector that share a byte of the code
ROWS = 8192  #: codes of a block
QUERIES = 1024  #: queries of a block
ROUNDS = 10  #: of k-means
TILE = 256  #: vectors that are coded at once


def means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of at most ``k`` groups of the rows of ``x`` by k-means; one of zeros if there are no rows."""
    x = x.astype(np.float32)
    if not len(x):
        return np.zeros((1, x.shape[1]), np.float32)
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        starts = np.r_[0, np.cumsum(n)[:-1]]
        full = n > 0
        c[full] = np.add.reduceat(x[order], starts[full], axis=0) / n[full, None]
    return c


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _stacked(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, dim))


def _parts(v: np.ndarray) -> np.ndarray:
    """(rows, parts, WIDTH), the last part filled up with zeros."""
    return np.pad(v, ((0, 0), (0, -v.shape[1] % WIDTH))).reshape(len(v), math.ceil(v.shape[1] / WIDTH), WIDTH)


def encode(rest: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The nearest entry of each part's code book."""
    out = [np.zeros((0, len(books)), np.uint8)]
    size = (books * books).sum(axis=2)
    for a in range(0, len(rest), TILE):
        part = _parts(rest[a : a + TILE])
        out.append((size - 2 * np.einsum("npw,pcw->npc", part, books, optimize=True)).argmin(axis=2).astype(np.uint8))
    return np.concatenate(out)


def decode(codes: np.ndarray, books: np.ndarray, dim: int) -> np.ndarray:
    return books[np.arange(len(books)), codes].reshape(len(codes), len(books) * WIDTH)[:, :dim]


def _usable(rows: DataFrame, dim: int) -> DataFrame:
    ok = valid(F.col("v"), dim) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x))
    return rows.select("id", F.col("v").cast("array<float>").alias("v")).where(F.coalesce(ok, F.lit(False)))


def create(rows: DataFrame, folder: str, dim: int, cells: int | None = None, seed: int = 11) -> None:
    """Learn an index for vectors like those of ``rows`` (id, v) in a new folder; it holds none yet. FileExistsError if there is an index.

    Without ``cells`` there is one for about the square root of the number of rows, ``CELLS`` at most.
    """
    spark = rows.sparkSession
    if collection._numbers(spark, folder):
        raise FileExistsError(f"{folder} holds an index")
    usable = _usable(rows, dim)
    cells = cells or min(CELLS, max(1, math.isqrt(usable.count())))
    sample = usable.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(SAMPLE).select("v").toArrow()["v"]
    sample = sample.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    data = spark.sparkContext.broadcast(_unit(sample))  # at most SAMPLE vectors

    def coarse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                c = means(data.value, cells, seed)
                yield pd.DataFrame({"cell": np.arange(len(c), dtype=np.int32), "v": list(c)})

    spark.range(0, 1, 1, 1).mapInPandas(coarse, "cell int, v array<float>").write.mode("overwrite").parquet(f"{folder}/model/cells")
    centres = _centres(spark, folder)

    def fine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = data.value - centres[_cell(data.value, centres)]
        parts = _parts(rest)
        for b in batches:
            for part in b["id"]:
                c = means(parts[:, part], 256, seed + int(part))
                c = np.pad(c, ((0, 256 - len(c)), (0, 0)), mode="edge")  # an entry that is there twice is never the nearer one
                yield pd.DataFrame({"part": np.int32(part), "book": [c.ravel()]})

    n = math.ceil(dim / WIDTH)
    spark.range(0, n, 1, min(n, 64)).mapInPandas(fine, "part int, book array<float>").write.mode("overwrite").parquet(f"{folder}/model/codes")
    data.unpersist()
    collection.commit(spark, folder, lambda old: None if old else {"dim": dim, "data": [], "deleted": []})


def _centres(spark: SparkSession, folder: str) -> np.ndarray:
    return np.stack([np.array(r.v, np.float32) for r in spark.read.parquet(f"{folder}/model/cells").orderBy("cell").collect()])


def _books(spark: SparkSession, folder: str) -> np.ndarray:
    return np.stack([np.array(r.book, np.float32).reshape(256, WIDTH) for r in spark.read.parquet(f"{folder}/model/codes").orderBy("part").collect()])


def _cell(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * v @ centres.T).argmin(axis=1)


def add(rows: DataFrame, folder: str) -> None:
    """Index ``rows`` (id, v) as one more batch; nothing moves between tasks, and a crash leaves the index as it was."""
    spark = rows.sparkSession
    dim = collection.current(spark, folder)["dim"]
    centres, books = _centres(spark, folder), _books(spark, folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _unit(_stacked(b["v"], dim))
            cell = _cell(v, centres)
            code = encode(v - centres[cell], books)
            yield pd.DataFrame({"id": b["id"], "cell": cell.astype(np.int32), "code": [c.tobytes() for c in code], "v": b["v"]})

    name = uuid.uuid4().hex
    out = _usable(rows, dim).withColumn("id", F.col("id").cast("long")).mapInPandas(run, "id long, cell int, code binary, v array<float>")
    out.sortWithinPartitions("cell").write.parquet(f"{folder}/data/{name}", compression="zstd")
    collection.commit(spark, folder, lambda old: old | {"data": [*old["data"], name]})


def remove(ids: DataFrame, folder: str) -> None:
    """Take the rows of ``ids`` (id) out of the batches that are there now; no code is rewritten, and the ids may be added again."""
    spark = ids.sparkSession
    name = uuid.uuid4().hex
    ids.select(F.col("id").cast("long").alias("id")).distinct().write.parquet(f"{folder}/deleted/{name}")
    collection.commit(spark, folder, lambda old: old | {"deleted": [*old["deleted"], [name, len(old["data"])]]})


def load(spark: SparkSession, folder: str) -> DataFrame:
    """(id, cell, code, v) of the newest version; FileNotFoundError if there is no index."""
    at = collection.current(spark, folder)
    kind = "id long, cell int, code binary, v array<float>"
    out, since = spark.createDataFrame([], kind), 0
    # batches between two deletions are read together, and each stretch loses the ids of all later deletions
    for until in sorted({n for _, n in at["deleted"]} | {len(at["data"])}):
        if names := at["data"][since:until]:
            part = spark.read.schema(kind).parquet(*(f"{folder}/data/{x}" for x in names))
            if gone := [x for x, n in at["deleted"] if n >= until]:
                part = part.join(spark.read.schema("id long").parquet(*(f"{folder}/deleted/{x}" for x in gone)), "id", "left_anti")
            out = part if since == 0 else out.unionByName(part)
        since = until
    return out


def probes(queries: DataFrame, folder: str, effort: float) -> DataFrame:
    """(query, v, cell): each query (id, v) with the cells that it looks into, nearest first, one at least."""
    spark = queries.sparkSession
    centres, dim = _centres(spark, folder), collection.current(spark, folder)["dim"]
    most = min(len(centres), max(1, math.ceil(effort * len(centres))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _unit(_stacked(b["v"], dim))
            cell = np.argsort((centres * centres).sum(axis=1) - 2 * v @ centres.T, axis=1, kind="stable")[:, :most]
            yield pd.DataFrame({"query": np.repeat(b["id"].to_numpy(), most), "v": [x for x in v for _ in range(most)], "cell": cell.ravel().astype(np.int32)})

    return _usable(queries, dim).mapInPandas(run, "query long, v array<float>, cell int")


def candidates(queries: DataFrame, folder: str, keep: int, effort: float, skip_self: bool = True) -> DataFrame:
    """(query, id): for each query the ``keep`` rows that come first by their codes. No stored vector is read."""
    spark = queries.sparkSession
    centres, books = _centres(spark, folder), _books(spark, folder)
    dim = centres.shape[1]
    asked = table(probes(queries, folder, effort), "probes")
    codes = load(spark, folder).select("id", "cell", "code")
    blocks = lambda rows, most, name: rows.groupBy("cell").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    place = F.broadcast(blocks(asked, QUERIES, "x").join(blocks(codes, ROWS, "y"), "cell"))  # a row a cell, CELLS at most
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    q = asked.join(place, "cell").select("cell", "query", "v", own("query", "x").alias("x"), every("y").alias("y"))
    g = codes.join(place, "cell").select("cell", "id", "code", own("id", "y").alias("y"), every("x").alias("x"))

    def rank(key: tuple, q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": "int64", "id": "int64", "score": "float64"})]
        g = g.sort_values("id")
        gid = g["id"].to_numpy()
        if len(q) and len(g):
            code = np.frombuffer(b"".join(g["code"]), np.uint8).reshape(len(g), -1)
            for a in range(0, len(q), TILE):
                ids, v = q["query"].to_numpy()[a : a + TILE], np.stack(q["v"][a : a + TILE].to_numpy()).astype(np.float32)
                score = np.concatenate([v @ (centres[key[0]] + decode(code[c : c + 1024], books, dim)).T for c in range(0, len(code), 1024)], axis=1)
                if skip_self:
                    score[ids[:, None] == gid] = -np.inf
                order = np.argsort(-score, axis=1, kind="stable")[:, :keep]
                found = np.take_along_axis(score, order, 1).ravel()
                ok = np.isfinite(found)
                out.append(pd.DataFrame({"query": np.repeat(ids, order.shape[1])[ok], "id": gid[order].ravel()[ok], "score": found[ok].astype(np.float64)}))
        return pd.concat(out)

    keys = ("cell", "x", "y")
    return ranked(q.groupBy(*keys).cogroup(g.groupBy(*keys)).applyInPandas(rank, "query long, id long, score double"), keep).select("query", "id").distinct()


def search(queries: DataFrame, folder: str, k: int, effort: float = 0.75, keep: int | None = None, skip_self: bool = True) -> DataFrame:
    """(query, rank, id, score): approximately the k rows of the index of the best cosine to each of ``queries`` (id, v), each cosine exact.

    ``effort`` from 0 to 1 is the share of cells that are looked into, ``keep`` (8 k) how many rows a query compares
    exactly. With all cells and a ``keep`` of all rows the result is that of ``similar.nearest``.
    """
    spark = queries.sparkSession
    pairs = candidates(queries, folder, keep or 8 * k, effort, skip_self)
    stored = load(spark, folder).select("id", "v")
    asked = queries.select(F.col("id").alias("query"), F.col("v").alias("qv")).distinct()
    pairs = pairs.join(stored, "id").join(asked, "query")
    return ranked(pairs.select("query", "id", F.round(cosine(F.col("qv"), F.col("v")), 6).alias("score")), k)


def describe(spark: SparkSession, folder: str) -> dict[str, object]:
    """Kind, metric, cells, bytes of a code and of a vector, and rows."""
    centres, books = _centres(spark, folder), _books(spark, folder)
    return {"index_type": "cells and codes", "metric_type": "COSINE", "cells": len(centres), "code_bytes": len(books), "vector_bytes": 4 * centres.shape[1], "row_count": load(spark, folder).count()}
