"""Nearest neighbours against SQL, in every digit, and what their search moves."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from twinspark.functions import names
from twinspark.operators import similar


def _against_sql(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from read_parquet('{folder}/embeddings.parquet/*.parquet')")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    got = __spark_entry__.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select([f"`{c}`" for c in want.columns]).collect())) == sorted(want.fetchall())


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Vectors that are not of unit length, copies among them; their products have seven digits, many a 5 at the end."""
    folder = str(tmp_path_factory.mktemp("uneven"))
    v = np.random.default_rng(4).integers(-9, 10, (700, 8)) / np.array([8.0, 16.0])[np.arange(700) % 2, None]
    v[300:400] = v[7]
    rows = [(i, x.tolist(), i % 6) for i, x in enumerate(v)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_knn_top5(spark, uneven):
    _against_sql(spark, uneven, "knn_top5")


def test_knn_wide(spark, uneven):
    _against_sql(spark, uneven, "knn_wide")


def test_search_responses(spark, uneven):
    _against_sql(spark, uneven, "search_responses")


def test_results_table(spark, uneven):
    _against_sql(spark, uneven, "results_table")


def test_fixed_is_printf(spark):
    x = [s * i / 100000 for i in range(0, 100001, 5) for s in (1, -1)] + [i / 64 + 0.00005 for i in range(99)] + [1234.56785, 5e-324, 0.03125, 0.09375]
    df = spark.createDataFrame([(a,) for a in x], "x double")
    for digits in (0, 3, 4, 6):
        assert [r.t for r in df.select(names.fixed(F.col("x"), digits).alias("t")).collect()] == [f"{a:.{digits}f}" for a in x]


def _first(pairs, score, k):
    """The k pairs (query, id) of each query with the best scores of six digits, then the smallest ids, with their ranks."""
    out, n = [], Counter()
    for q, _, i in sorted((q, -round(score[q, i], 6), i) for q, i in pairs):
        n[q] += 1
        if n[q] <= k:
            out.append((q, n[q], i))
    return out


@pytest.mark.parametrize("rows", [50, 4096])
def test_lsh_keeps_its_candidates_within_tasks(spark, monkeypatch, rows):
    monkeypatch.setattr(similar, "BLOCK_BYTES", rows * 16 * 8)
    v = np.random.default_rng(8).standard_normal((900, 16))
    v[100:160] = v[3]
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    q = df.where("id % 9 = 0")
    pairs = {(r.query, r.id) for r in similar.lsh_candidates(q, df, 12, 2, 1).collect()}
    sc = spark.sparkContext
    sc.setJobGroup(f"lsh{rows}", "")
    got = similar.lsh_nearest(q, df, 4, 12).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.query, r.rank, r.id) for r in got) == _first(pairs, unit @ unit.T, 4)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"lsh{rows}")]
    moved = sum(sc._jsc.sc().statusStore().lastStageAttempt(x).shuffleWriteRecords() for x in {x for j in jobs for x in j.stageIds})
    x, y = -(-100 // rows), max(-(-900 // rows), sc.defaultParallelism)  # blocks
    assert moved <= 900 * x + 100 * y + 100 * 4 * y + 20 < len(pairs)


@pytest.mark.parametrize("cells, few", [(1, 0), (1000, 1.1), (1 << 22, 0.5)])
def test_best_in_tiles(monkeypatch, cells, few):
    monkeypatch.setattr(similar, "TILE_CELLS", cells)
    monkeypatch.setattr(similar, "FEW", few)
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (200, 6)) / 16
    ids = rng.permutation(200)
    may = rng.random((200, 200)) < 0.3
    may[5] = False
    pairs = {(ids[a], ids[b]) for a, b in zip(*np.nonzero(may), strict=True) if a != b}
    score = np.empty((200, 200))
    score[np.ix_(ids, ids)] = v @ v.T
    got = similar._best(ids, v, ids, v, 5, True, lambda a, z: may[a:z].copy())
    want = [(q, i) for q, _, i in _first(pairs, score, 5)]
    assert sorted(zip(got["query"], got["id"], strict=True)) == sorted(want)
    assert not len(similar._best(ids, v, ids[:0], v[:0], 5, True)) and not len(similar._best(ids[:0], v[:0], ids, v, 5, True))
