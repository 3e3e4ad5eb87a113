"""Similarity joins and nearest neighbours by blocks of matrix products.

Vectors are dealt to blocks of bounded size, and pairs of blocks are tasks of their own. Where there is
more than one block, rows go to the nearest of a bounded number of pivots first: two cells whose
pivots are further apart than their radii and the angle of the threshold allow are never compared, which
loses no pair. Nothing but pivots and sums by cell reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinspark.operators.graph import connected_components, local_components
from twinspark.shared import table

BLOCK_BYTES = 16 << 20  #: vectors of a block, as doubles
TILE_ROWS = 1024  #: rows of a block that are multiplied at once
TILE_CELLS = 1 << 22  #: products of queries with a block of the gallery that are held at once
FEW = 1 / 16  #: share of candidates below which a query's are picked first, and not multiplied with all rows
PIVOTS = 1024  #: most pivots


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def _blocks(vectors: DataFrame) -> tuple[int, int]:
    """How many vectors there are, and how many blocks they make."""
    n, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    return n, max(1, math.ceil(n * (dim or 1) * 8 / BLOCK_BYTES))


def _in_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, cell, angle, norm): the nearest pivot of each vector, and how far from it."""
    unit = pivots / np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-300)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _matrix(b["v"])
            norm = np.linalg.norm(v, axis=1)
            near = (v @ unit.T if len(v) else np.zeros((0, len(unit)))) / np.maximum(norm, 1e-300)[:, None]
            cell = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(b)), cell], -1, 1))
            yield pd.DataFrame({"id": b["id"], "v": b["v"], "cell": cell.astype(np.int32), "angle": angle, "norm": norm})

    return vectors.select("id", F.col("v").cast("array<double>").alias("v")).mapInPandas(run, "id long, v array<double>, cell int, angle double, norm double")


def _met(vectors: DataFrame, floor: float) -> DataFrame:
    """(id, v, own, x, y): each row once for each pair of blocks x <= y, one of them its own, that may hold a pair of ``floor``."""
    spark = vectors.sparkSession
    n, blocks = _blocks(vectors)
    if blocks == 1:
        return vectors.select("id", "v", *(F.lit(0).alias(c) for c in ("own", "x", "y")))
    chosen = vectors.orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(min(PIVOTS, blocks)).select("v").collect()
    pivots = np.array([r.v for r in chosen], np.float64)
    rows = table(_in_cells(vectors, pivots), "cells")
    cells = {r.cell: r for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle"), F.max("norm").alias("norm")).collect()}
    share = math.ceil(n / blocks)
    first, each = {}, {}
    for c in sorted(cells):  # numbers of the blocks of each cell
        first[c], each[c] = sum(each.values()), math.ceil(cells[c].n / share)
    unit = pivots / np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-300)
    apart = np.arccos(np.clip(unit @ unit.T, -1, 1))
    near = []
    for c in cells.values():
        for d in cells.values():
            gap = max(0.0, apart[c.cell, d.cell] - c.angle - d.angle - 1e-6)
            if floor <= 0 or c.norm * d.norm * max(0.0, math.cos(min(gap, math.pi))) >= floor - 1e-6:
                near.append((c.cell, list(range(first[d.cell], first[d.cell] + each[d.cell]))))
    near = spark.createDataFrame(near, "cell int, others array<int>").groupBy("cell").agg(F.flatten(F.collect_list("others")).alias("others"))
    place = spark.createDataFrame([(c, first[c], each[c]) for c in cells], "cell int, first int, each int")
    own = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("each"))).cast("int")
    met = rows.join(place.join(near, "cell"), "cell").select("id", "v", own.alias("own"), F.explode("others").alias("other"))
    return met.select("id", "v", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))


def _tiles(key: tuple, rows: pd.DataFrame, floor: float, precision: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sim): places in ``rows`` of the pairs of a pair of blocks that reach ``floor``, a tile at a time."""
    own, id_ = rows["own"].to_numpy(), rows["id"].to_numpy()
    one, two = np.flatnonzero(own == key[0]), np.flatnonzero(own == key[1])
    if not len(one) or not len(two):
        return
    v = _matrix(rows["v"])
    right = v[two].T
    for a in range(0, len(one), TILE_ROWS):
        part = one[a : a + TILE_ROWS]
        sim = v[part] @ right
        if precision == "half":
            at = np.nonzero((sim.astype(np.float32) >= np.float32(floor - 0.01)) & (sim.astype(np.float16) >= np.float16(floor)))
        else:
            at = np.nonzero(sim >= floor)
        i, j = part[at[0]], two[at[1]]
        keep = id_[i] < id_[j] if key[0] == key[1] else id_[i] != id_[j]
        yield i[keep], j[keep], sim[at][keep]


def edges(vectors: DataFrame, floor: float, precision: str = "double") -> DataFrame:
    """(id, v) to (i, j, sim) with i < j and a dot product of at least ``floor``.

    ``precision='half'`` compares in half precision, as vector stores that keep similarities in two
    bytes do.
    """

    def multiply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = list(_tiles(key, rows, floor, precision))
        i, j, sim = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind) for k, kind in enumerate((np.int64, np.int64, np.float64)))
        a, b = rows["id"].to_numpy()[i], rows["id"].to_numpy()[j]
        return pd.DataFrame({"i": np.minimum(a, b), "j": np.maximum(a, b), "sim": sim})

    return _met(vectors, floor).groupBy("x", "y").applyInPandas(multiply, "i long, j long, sim double")


def linked(vectors: DataFrame, thresholds: list[float], precision: str = "double") -> tuple[DataFrame, DataFrame]:
    """What pairs at each threshold say, without listing them: (t, u, v) whose closure is that of all pairs, and (t, id, links), the number of partners.

    ``t`` is the place of the threshold in descending order. A task sends each row at most once as a
    link and once as a count.
    """
    levels = sorted(thresholds, reverse=True)

    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, out, id_ = len(rows), [], rows["id"].to_numpy()
        label, count = np.tile(np.arange(n), (len(levels), 1)), np.zeros((len(levels), n), np.int64)
        for i, j, sim in _tiles(key, rows, levels[-1], precision):
            for t, level in enumerate(levels):
                ok = sim.astype(np.float16) >= np.float16(level) if precision == "half" else sim >= level
                a, b = i[ok], j[ok]
                count[t] += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
                label[t] = local_components(n, label[t][a], label[t][b])[label[t]]
        for t in range(len(levels)):
            at = np.flatnonzero(label[t] != np.arange(n))
            out.append(pd.DataFrame({"t": t, "u": id_[at], "v": pd.array(id_[label[t][at]], "Int64"), "links": 0}))
            at = np.flatnonzero(count[t])
            out.append(pd.DataFrame({"t": t, "u": id_[at], "v": pd.array([None] * len(at), "Int64"), "links": count[t][at]}))
        return pd.concat(out)

    found = table(_met(vectors, levels[-1]).groupBy("x", "y").applyInPandas(gather, "t int, u long, v long, links long"), "linked")
    counts = found.where("v is null").groupBy("t", F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    return found.where("v is not null").select("t", "u", "v"), counts


def partners(vectors: DataFrame, threshold: float, precision: str = "double") -> DataFrame:
    """(id, links, component) of every row: how many others reach the threshold, and the smallest id of its class."""
    links, counts = linked(vectors, [threshold], precision)
    label = connected_components(links.select("u", "v")).withColumnRenamed("node", "id")
    out = vectors.select("id").join(counts.select("id", "links"), "id", "left").join(label, "id", "left")
    return out.select("id", F.coalesce("links", F.lit(0).cast("long")).alias("links"), F.coalesce("component", "id").alias("component"))


def sensitivity(vectors: DataFrame, thresholds: list[float], chosen: float | None = None, precision: str = "double") -> DataFrame:
    """(threshold, clusters, multi, largest): classes at each of ``thresholds`` and the chosen one (to four digits).

    Pairs are found once. Thresholds go down, and each starts from the classes of the one before.
    """
    levels = sorted({*thresholds, *([round(chosen, 4)] if chosen is not None else [])}, reverse=True)
    links, _ = linked(vectors, levels, precision)
    label, out = vectors.select("id", F.col("id").alias("root")), None
    for t, level in enumerate(levels):
        own = links.where(F.col("t") == t)
        ends = own.join(label.select(F.col("id").alias("u"), F.col("root").alias("a")), "u").join(label.select(F.col("id").alias("v"), F.col("root").alias("b")), "v")
        up = connected_components(ends.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "root")
        label = table(label.join(up, "root", "left").select("id", F.coalesce("component", "root").alias("root")), "classes")
        sizes = label.groupBy("root").agg(F.count("*").alias("n"))
        row = sizes.agg(F.lit(level).cast("double").alias("threshold"), F.count("*").alias("clusters"), F.count_if(F.col("n") > 1).alias("multi"), F.max("n").alias("largest"))
        out = row if out is None else out.unionByName(row)
    return out


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """(query, id, score) to (query, rank, id, score): the k best of each query, equal scores by id."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "id", "score")


def rounded(x: np.ndarray) -> np.ndarray:
    """To six digits as SQL does: halves go away from zero."""
    up = np.abs(x) * 1e6
    whole = np.floor(up)
    return np.copysign((whole + (up - whole >= 0.5)) / 1e6, x)


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.where(n > 1e-9, v / np.maximum(n, 1e-9), v)


def _best(ids: np.ndarray, q: np.ndarray, gid: np.ndarray, g: np.ndarray, k: int, skip_self: bool, among: Callable[[int, int], np.ndarray] | None = None) -> pd.DataFrame:
    """(query, id, score): the k largest products of each row of ``q`` with rows of ``g``, by score and then id, a tile of queries at a time.

    ``among`` says which rows count for the queries at places a to z, as a matrix of booleans.
    """
    out = [pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": "int64", "id": "int64", "score": "float64"})]
    rows = max(1, TILE_CELLS // max(1, len(g)))
    for a in range(0, len(q) if len(g) else 0, rows):
        part, own = q[a : a + rows], ids[a : a + rows]
        may = among(a, a + rows) if among else np.ones((len(part), len(g)), bool)
        if skip_self:
            may &= own[:, None] != gid
        if may.mean() < FEW:
            s = np.full(may.shape, -np.inf)
            for r, row in enumerate(may):
                s[r, row] = g[row] @ part[r]
        else:
            s = part @ g.T
        s[~(may & np.isfinite(s))] = -np.inf
        least = np.partition(s, -k, axis=1)[:, -k, None] - 2e-6 if len(g) > k else -np.inf  # what is below can't round to the k-th best
        i, j = np.nonzero((s > -np.inf) & (s >= least))
        score = rounded(s[i, j])
        order = np.lexsort((gid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append(pd.DataFrame({"query": own[i[top]], "id": gid[j[top]], "score": score[top]}))
    return pd.concat(out)


def _crossed(queries: DataFrame, gallery: DataFrame, best: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """What ``best`` makes of each block of queries with each block of the gallery, every pair in a task of its own."""
    _, x = _blocks(queries)
    _, y = _blocks(gallery)
    y = max(y, gallery.sparkSession.sparkContext.defaultParallelism)
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("id", "v", part(x).alias("x"), every(y).alias("y"))
    g = gallery.select("id", "v", part(y).alias("y"), every(x).alias("x"))
    return q.groupBy("x", "y").cogroup(g.groupBy("x", "y")).applyInPandas(best, "query long, id long, score double")


def nearest(queries: DataFrame, gallery: DataFrame, k: int, skip_self: bool = True, metric: str = "cosine") -> DataFrame:
    """(query, rank, id, score): the k best of ``gallery`` (id, v) for each of ``queries`` (id, v), by score and then id.

    ``metric`` is ``cosine`` or ``dot``. Blocks of queries meet blocks of the gallery, each pair in a task of its
    own that sends k rows a query; the driver sees neither queries nor vectors.
    """
    scaled = _unit if metric == "cosine" else lambda v: v

    def best(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        return _best(q["id"].to_numpy(), scaled(_matrix(q["v"])), g["id"].to_numpy(), scaled(_matrix(g["v"])), k, skip_self)

    return ranked(_crossed(queries, gallery, best), k)


def _rotations(dim: int, tables: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(tables)])


def _buckets(v: np.ndarray, turns: np.ndarray, most: int) -> np.ndarray:
    """Of each vector the numbers of its ``most`` buckets in every table: an axis of the turned vector, and its sign."""
    tables, dim, _ = turns.shape
    flat, most = turns.transpose(1, 0, 2).reshape(dim, -1), min(most, dim)
    out, rows = np.zeros((len(v), tables * most), np.int64), max(1, (1 << 20) // (tables * dim))
    for a in range(0, len(v), rows):
        z = (v[a : a + rows] @ flat).reshape(-1, tables, dim)
        axis = np.argpartition(-np.abs(z), most - 1, axis=2)[:, :, :most]
        key = (np.arange(tables)[:, None] * dim + axis) * 2 + (np.take_along_axis(z, axis, 2) > 0)
        out[a : a + rows] = key.reshape(len(z), -1)
    return out


def lsh_candidates(queries: DataFrame, gallery: DataFrame, tables: int, probes: int, stored: int, seed: int = 7) -> DataFrame:
    """(query, id): pairs that share one of ``tables`` cross-polytope buckets.

    A table turns the vectors; a bucket is an axis with a sign. A gallery row is stored under its ``stored``
    largest axes and a query looks at its ``probes`` largest. Only ids move.
    """
    dim = gallery.select(F.max(F.size("v"))).first()[0] or 1
    turns = _rotations(dim, tables, seed)

    def keyed(most: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                key = _buckets(_matrix(b["v"]), turns, most)
                yield pd.DataFrame({"id": np.repeat(b["id"].to_numpy(), key.shape[1]), "key": key.ravel()})

        return run

    q = queries.select("id", "v").mapInPandas(keyed(probes), "id long, key long").select(F.col("id").alias("query"), "key")
    g = gallery.select("id", "v").mapInPandas(keyed(stored), "id long, key long")
    return q.join(g, "key").where("query <> id").select("query", "id").distinct()


def lsh_nearest(queries: DataFrame, gallery: DataFrame, k: int, tables: int = 28, probes: int = 2, stored: int = 1, seed: int = 7) -> DataFrame:
    """Approximate ``nearest``: of the rows that ``lsh_candidates`` names for a query, the k best by cosine, compared exactly.

    Candidates are a fixed share of all pairs, so they never leave a task: blocks meet as in ``nearest``, each pair looks up
    the buckets of its own rows and sends k rows a query.
    """
    dim = gallery.select(F.max(F.size("v"))).first()[0] or 1
    turns = _rotations(dim, tables, seed)

    def best(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        left, right = _matrix(q["v"]), _matrix(g["v"])
        if len(q) and len(g):
            asked, key = _buckets(left, turns, probes), _buckets(right, turns, stored)
            order = np.argsort(key, axis=None, kind="stable")
            start, row = np.searchsorted(key.ravel()[order], np.arange(2 * tables * dim + 1)), order // key.shape[1]

        def among(a: int, z: int) -> np.ndarray:
            may = np.zeros((len(asked[a:z]), len(right)), bool)
            for r, keys in enumerate(asked[a:z]):
                for c in keys:
                    may[r, row[start[c] : start[c + 1]]] = True
            return may

        return _best(q["id"].to_numpy(), _unit(left), g["id"].to_numpy(), _unit(right), k, True, among)

    return ranked(_crossed(queries, gallery, best), k)
