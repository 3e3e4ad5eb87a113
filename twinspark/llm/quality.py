"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Every text becomes a short vector of statistics. Standardised, it goes through cosines of random
directions, whose inner products approximate a Gaussian kernel. The normal equations of a ridge
regression are summed by partition, for each of a few folds, so that each fold's rows can be scored by a
model that has not seen them; those scores, in bins, give the isotonic (pooled adjacent violators)
map from score to probability. What reaches the driver has the size of the model, not of the data.

Edge cases: null and empty texts have the statistics of nothing and get a score like any text; rows
with null labels, and labels of ids without a document, are ignored; several labels of an id all
count; without any label the score is 0.5, with labels of one kind it is near that label; an empty
table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinspark.llm.common import crc_mod, free_name
from twinspark.shared import table

DIMENSIONS = 160
WIDTH = 5.0  #: of the Gaussian kernel, in standard deviations
RIDGE = 1e-3  #: as a share of the rows
FOLDS = 4
BINS = 256
SEED = 20240131
THRESHOLD = 0.3
STATS = (
    "log_bytes", "log_words", "word_mean", "word_std", "letters", "upper", "digits", "high_bytes", "spaces", "newlines", "stops", "commas",
    "pipes", "symbols", "marks", "words_with_symbols", "words_upper", "distinct", "top_word", "next_equal", "line_mean", "distinct_lines", "entropy",
)


def _group(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[np.frombuffer(chars, np.uint8)] = 1
    return out


_LOWER, _UPPER, _DIGIT = bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58))
_GROUPS = np.stack([_group(x) for x in (_LOWER + _UPPER + bytes(range(128, 256)), _UPPER, _DIGIT, bytes(range(128, 256)), b" \t", b"\n", b".", b",;:", b"|", b"#$%&*@^~<>{}[]\\/=+_", b"!?")])
_SYMBOL = b"|#$%&*@^~<>{}[]\\/=+_!"
_PLAIN = bytes(b for b in range(256) if b not in _SYMBOL and b not in b" \t\n\r\x0b\f")  # taken out to count words with symbols


def statistics(text: bytes | None) -> list[float]:
    """The numbers named in STATS, from the whole text."""
    text = text or b""
    words = text.split()
    n, m = max(1, len(text)), max(1, len(words))
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    marked = text.translate(None, _PLAIN)
    lines = text.split(b"\n")
    p = hist[hist > 0] / n
    g = (_GROUPS @ hist) / n
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        math.log1p(len(text)), math.log1p(len(words)), float(size.mean()), float(size.std()), *g.tolist(),
        len(marked.split()) / m, sum(map(bytes.isupper, words)) / m, len(counts) / m, max(counts.values(), default=0) / m, same / m,
        math.log1p(n / len(lines)), len(set(lines)) / len(lines), float(-(p * np.log2(p)).sum()),
    ]


def stats(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(1).to_pylist()]).reshape(-1, len(STATS))
            listed = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(STATS), dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), listed], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  #: raw scores, ascending
    values: np.ndarray  #: their calibrated scores

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.standard_normal((len(STATS), DIMENSIONS)) / WIDTH
        phase = rng.uniform(0, 2 * np.pi, DIMENSIONS)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(x), 1)), np.sqrt(2 / DIMENSIONS) * np.cos(z @ w + phase)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(x) @ self.weights, self.knots, self.values), 0, 1)


def isotonic(x: np.ndarray, total: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over ascending bins: knots and non-decreasing shares (each pulled a little to the mean)."""
    mean = good.sum() / max(1.0, total.sum())
    blocks: list[list[float]] = []
    for a, n, g in zip(x, total, good, strict=True):
        blocks.append([a, a, n, g])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            a0, _, n0, g0 = blocks[-2]
            _, b1, n1, g1 = blocks.pop()
            blocks[-1] = [a0, b1, n0 + n1, g0 + g1]
    knots = [k for b in blocks for k in (b[0], max(b[1], b[0] + 1e-9))]
    return np.array(knots), np.array([v for b in blocks for v in [(b[3] + mean) / (b[2] + 1)] * 2])


def fit(x: DataFrame, labels: DataFrame) -> Model:
    """``x``: (doc_id, x); ``labels``: (doc_id, y 0 or 1, fold 0 to FOLDS - 1)."""
    rows = table(x.join(labels.where("y is not null"), "doc_id").select("x", F.col("y").cast("double").alias("y"), F.col("fold").cast("int").alias("fold")), "train")
    k = len(STATS)
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    model = Model(np.zeros(k), np.ones(k), np.zeros(DIMENSIONS + 1), np.zeros(1), np.full(1, 0.5))
    if not sums:
        return model
    for r in sums:
        model.mean[r.i], model.scale[r.i] = r.m, max(r.s, 1e-6)

    def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = DIMENSIONS + 2
        acc = np.zeros((FOLDS, n, n))
        for b in batches:
            z = np.concatenate([model.features(np.stack(b["x"])), b["y"].to_numpy()[:, None]], 1)
            for f in range(FOLDS):
                part = z[b["fold"].to_numpy() == f]
                acc[f] += part.T @ part
        f, i, j = np.nonzero(np.triu(acc))
        yield pd.DataFrame({"fold": f, "i": i, "j": j, "v": acc[f, i, j]})

    moments = np.zeros((FOLDS, DIMENSIONS + 2, DIMENSIONS + 2))
    sums = rows.mapInPandas(normal, "fold int, i int, j int, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).toArrow()
    f, i, j, v = (sums.column(c).to_numpy() for c in ("fold", "i", "j", "v"))
    moments[f, i, j] = moments[f, j, i] = v

    def solve(m: np.ndarray) -> np.ndarray:
        a, b, n = m[:-1, :-1], m[:-1, -1], max(1.0, m[0, 0])
        ridge = RIDGE * n * np.eye(len(a))
        ridge[0, 0] = 1e-9
        return np.linalg.solve(a + ridge, b)

    total = moments.sum(0)
    model.weights = solve(total)
    others = [solve(total - m) if (total - m)[0, 0] else model.weights for m in moments]

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z = model.features(np.stack(b["x"]))
            raw = np.einsum("ij,ij->i", z, np.stack(others)[b["fold"].to_numpy()])
            yield pd.DataFrame({"bin": np.clip(np.round((raw + 0.5) / 2 * BINS), 0, BINS).astype(np.int32), "y": b["y"]})

    bins = rows.mapInPandas(binned, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("g")).orderBy("bin").collect()
    at = np.array([r.bin for r in bins]) / BINS * 2 - 0.5
    model.knots, model.values = isotonic(at, np.array([r.n for r in bins], float), np.array([r.g for r in bins], float))
    return model


def score(x: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b.drop(columns="x")
            out["score"] = model.score(np.stack(b["x"])) if len(b) else np.zeros(0)
            yield out

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema if f.name != "x"]
    return x.mapInPandas(run, ", ".join([*kinds, "score double"]))


def learned(x: DataFrame, labels: DataFrame) -> Model:
    """The model of the labels whose crc32 of the id, modulo 5, is not 0."""
    fold = crc_mod("doc_id", FOLDS + 1)
    return fit(x, labels.where(fold != 0).select("doc_id", F.col("quality").alias("y"), (fold - 1).alias("fold")))


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more; each text is parsed once, its statistics stored beside it."""
    name = free_name(docs, "x")
    text = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(text).cast(pa.binary()).to_pylist()]).reshape(-1, len(STATS))
            listed = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(STATS), dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, listed], [*b.schema.names, name])

    rows = table(docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])), "scored")
    model = learned(rows.select("doc_id", F.col(name).alias("x")), labels)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x)) if len(x) else np.zeros(0))

    return rows.where(scored(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    x = table(stats(read(spark, sf_dir, "documents")), "stats")
    return score(x, learned(x, read(spark, sf_dir, "labels"))).select("doc_id", (crc_mod("doc_id", FOLDS + 1) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
