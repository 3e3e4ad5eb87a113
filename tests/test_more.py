import json
import os
import pickle
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinspark.functions import names
from twinspark.operators import collection, embed, extract, similar, split, store
from twinspark.sources import files, paths, sinks


def _unit(n, dim, seed, near=0.0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim)) + near * rng.standard_normal((6, dim))[rng.integers(0, 6, n)]
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _frame(spark, v):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")


def _classes(n, pairs):
    root = list(range(n))
    for i, j in pairs:
        a, b = sorted((root[i], root[j]))
        if a != b:
            root = [a if r == b else r for r in root]
    return root


@pytest.mark.parametrize("near", [0.0, 4.0])
def test_blocks_lose_no_pair(spark, monkeypatch, near):
    monkeypatch.setattr(similar, "BLOCK_BYTES", 8 * 8 * 20)
    monkeypatch.setattr(similar, "TILE_ROWS", 7)
    v = _unit(150, 8, 1, near)
    v[3] *= 0.5  # not of unit length
    df, sim = _frame(spark, v), v @ v.T
    for floor in (0.5, 0.95, -0.2):
        want = {(i, j) for i in range(150) for j in range(i + 1, 150) if sim[i, j] >= floor}
        assert {(r.i, r.j) for r in similar.edges(df, floor).collect()} == want
    met = similar._met(df, 0.95).select("x", "y").distinct().count()
    assert near == 0.0 or met < 36 * 37 // 2  # cells that lie apart never meet
    for precision, kind in (("double", np.float64), ("half", np.float16)):
        at = {(i, j) for i in range(150) for j in range(i + 1, 150) if sim[i, j].astype(np.float32).astype(kind) >= kind(0.9)} if precision == "half" else {(i, j) for i in range(150) for j in range(i + 1, 150) if sim[i, j] >= 0.9}
        root = _classes(150, at)
        got = {r.id: (r.links, r.component) for r in similar.partners(df, 0.9, precision).collect()}
        assert got == {i: (sum(i in p for p in at), root[i]) for i in range(150)}


def test_sensitivity(spark):
    v = _unit(80, 6, 2, 1.0)
    sim = v @ v.T
    got = {r.threshold: (r.clusters, r.multi, r.largest) for r in similar.sensitivity(_frame(spark, v), [0.6, 0.8, 0.9], chosen=0.70004).collect()}
    assert set(got) == {0.6, 0.7, 0.8, 0.9}
    for t, row in got.items():
        root = _classes(80, [(i, j) for i in range(80) for j in range(i) if sim[i, j] >= t])
        n = [root.count(r) for r in set(root)]
        assert row == (len(n), sum(x > 1 for x in n), max(n))


def test_nearest_by_cosine(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK_BYTES", 8 * 5 * 9)
    v = _unit(60, 5, 3)
    df = _frame(spark, v * np.arange(1, 61)[:, None])
    for metric, s in (("cosine", v @ v.T), ("dot", (v @ v.T) * np.outer(np.arange(1, 61), np.arange(1, 61)))):
        hits = similar.nearest(df.where("id < 20"), df, 4, metric=metric).collect()
        for q in range(20):
            x = np.round(s[q], 6)
            x[q] = -np.inf
            assert [r.id for r in sorted((r for r in hits if r.query == q), key=lambda r: r.rank)] == np.lexsort((np.arange(60), -x))[:4].tolist()
    assert similar.nearest(df.limit(0), df, 3).count() == 0 == similar.nearest(df, df.limit(0), 3).count()


def test_folders(spark, tmp_path):
    for name in ("A/x.JPG", "A/deep/y.png", "B/p1/a.jpg", "B/p2/b.jpeg", "C/readme.txt", "z.bmp"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    root = str(tmp_path)
    every = files.folder(spark, root, recursive=True)
    ends = lambda df: sorted(r.path.removeprefix(f"file:{root}/") for r in df.select("path").collect())
    assert ends(every) == ["A/deep/y.png", "A/x.JPG", "B/p1/a.jpg", "B/p2/b.jpeg", "z.bmp"]
    assert ends(files.folder(spark, root)) == ["z.bmp"]
    assert ends(files.folder(spark, root, True, "*.jpg")) == ["B/p1/a.jpg"]
    found = files.datasets(every.where("path not like '%.bmp'"), root)
    assert sorted(r.dataset for r in found.collect()) == ["A", "B"]
    assert [(r.position, r.dataset) for r in files.known(found, ["C", "B", "A"]).orderBy("position").collect()] == [(1, "B"), (2, "A")]
    persons = files.person_folders(files.folder(spark, f"{root}/B", True), f"{root}/B", 1)
    assert [(r.person, r.name) for r in persons.collect()] == [("p1", "a.jpg")]
    assert files.person_folders(every, f"file://{root}/B", 0).count() == 2
    assert len({r.stored for r in files.uploads(every).collect()}) == 5
    assert paths.children(spark, root, True) == ["A", "B", "C"] and paths.children(spark, f"{root}/none", True) == []
    assert paths.dataset_dir(spark, root, "z.bmp") == root and paths.dataset_dir(spark, f"{root}/B", "b.jpeg") == f"{root}/B/p2"
    with pytest.raises(FileNotFoundError):
        paths.dataset_dir(spark, root, "train.rec")
    paths.check_apart("/a/b", "/a/bc")
    for one, other in (("/a/b", "/a/b/c"), ("C:\\x\\y", "C:/x")):
        with pytest.raises(ValueError):
            paths.check_apart(one, other)


def test_lists_in_splits(spark, tmp_path):
    rows = "".join(f"0\tset/{i}/img.jpg{'/' * (i % 3)}\t{0 if i % 2 else i}\n" for i in range(3000))
    (tmp_path / "train.lst").write_text("0\ta/b/c\t1.5\nno\n" + rows + "1\tx\t0\n2\ta/q/c\t0\n")
    (tmp_path / "train.idx").write_text("".join(f"{i}\t{i * 10}\n" for i in range(3000)) + " 5 \t 77 \n9\t1.0\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r.position: r.label for r in files.labels(spark, str(tmp_path / "train.lst")).collect()}
        assert got == {i: i for i in range(3000)} | {3000: 0}
        index = {r.idx: r.offset for r in files.index(spark, str(tmp_path / "train.idx")).collect()}
        assert index == {i: i * 10 for i in range(3000)} | {5: 77}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    (tmp_path / "bad.idx").write_text("nothing\n")
    with pytest.raises(ValueError):
        files.index(spark, str(tmp_path / "bad.idx"))


def test_verification_sets(spark, tmp_path):
    for name, n in (("lfw.bin", 4), ("calfw.bin", 3), ("other.bin", 2)):
        (tmp_path / name).write_bytes(pickle.dumps(([b"x%d" % i for i in range(n)], [True] * 2)))
    images = files.verification_sets(spark, str(tmp_path), {"lfw": "CASIA-LFW", "calfw": "CASIA-CALFW", "gone": "G"})
    assert {(r.dataset, r.image, bytes(r.jpeg)) for r in images.collect()} == {(d, i, b"x%d" % i) for d, n in (("CASIA-LFW", 4), ("CASIA-CALFW", 3)) for i in range(n)}
    assert sorted((r.images, r.pairs, r.complete) for r in files.check_bins(images).collect()) == [(3, 2, False), (4, 2, True)]
    with pytest.raises(FileNotFoundError):
        files.verification_sets(spark, str(tmp_path), {"none": "N"})


def test_written_files(spark, tmp_path):
    rows = spark.createDataFrame([("train", "train/a_1.jpg", bytearray(b"\xff\x00a")), ("test", "test/b.jpg", bytearray(b"")), ("dropped_exact_dup", "", bytearray(b"z")), ("test", "../out", bytearray(b"q"))], "split string, dest_name string, content binary")
    got = {r.split: (r.copied, r.failed) for r in sinks.materialise(rows, str(tmp_path)).collect()}
    assert got == {"train": (1, 0), "test": (1, 0), "..": (0, 1)}
    assert (tmp_path / "train/a_1.jpg").read_bytes() == b"\xff\x00a" and (tmp_path / "test/b.jpg").read_bytes() == b""
    every = spark.createDataFrame([("p1", "d/1", bytearray(b"1")), ("p2", "d/2", bytearray(b"2"))], "path string, dest string, content binary")
    assert [r.dest for r in sinks.export(every, every.where("path = 'p1'"), str(tmp_path / "x")).collect()] == ["d/2"]
    assert (tmp_path / "x/d/2").read_bytes() == b"2"


def test_tables(spark, tmp_path):
    hits = spark.createDataFrame([("q,1", 3, 7, 0.5, None, True, False, True), ("q2", 4, None, None, None, False, False, False)], "query_file string, expected_cluster int, top1_cluster int, top1_score double, best_correct_score double, `hit@1` boolean, `hit@5` boolean, has_train_row boolean")
    sinks.write_table(hits.withColumn("query_dataset", F.lit(None).cast("string")), "results", str(tmp_path / "r"))
    back = spark.read.csv(str(tmp_path / "r"), header=True)
    assert back.columns == sinks.TABLES["results"][0]
    assert [tuple(r) for r in back.orderBy("query_file").collect()] == [("q,1", None, "3", "7", "0.5", None, "true", "false", "true"), ("q2", None, "4", None, None, None, "false", "false", "false")]
    wide = spark.createDataFrame([("a", None, "x", 0.25, "d"), ("b", "no_face", None, None, None)], "query_file string, error string, rank1_person string, rank1_score double, rank1_dataset string")
    sinks.write_wide(wide, 1, str(tmp_path / "w"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "w"), header=True).orderBy("query_file").collect()] == [("a", None, "x", "0.250000", "d"), ("b", "no_face", None, None, None)]
    rows = spark.createDataFrame([("m", "p2", "A", 1), ("m", "p1", "A", 1), ("n", "p3", "B", 0), (None, "p4", "B", 0), (None, "p5", "B", 0)], "md5 string, path string, dataset string, rank int")
    assert sorted((r.path, r.kept, r.group_spans_multiple_datasets) for r in sinks.duplicate_rows(rows).collect()) == [("p1", True, False), ("p2", False, False)]
    told = spark.createDataFrame([("p1", "no_face_detected"), ("p2", None)], "path string, reason string")
    assert sinks.write_failures(store.failures(told), str(tmp_path / "f")) and not sinks.write_failures(store.failures(told.where("path = 'p2'")), str(tmp_path / "g"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == ["p1\tno_face_detected"] and not (tmp_path / "g").exists()
    one = split.one_train(spark.createDataFrame([("i", "b"), ("i", "a"), ("i", "c"), ("j", "x")], "identity string, name string"), "identity", "name").first()
    assert tuple(one) == ("i", 3, "a", 2, "b|c")


def test_collection(spark, tmp_path):
    store = collection
    where = str(tmp_path / "col")
    assert "error" in store.describe(spark, where)
    with pytest.raises(FileNotFoundError):
        store.load(spark, where)
    assert store.create(spark, where, 2).count() == 0
    rows = spark.createDataFrame([([1.0, 0.0], f"p{i}", None if i else "x") for i in range(5)] + [([1.0], "bad", "y")], "embedding array<double>, image_path string, person_id string")
    told = {r.image_path: (r.id, r.outcome, r.reason) for r in store.append(spark, where, rows).collect()}
    assert told["p0"] == (1, "inserted", None) and told["bad"] == (None, "rejected", "a vector of 1 numbers, not 2") and len(told) == 6
    store.append(spark, where, rows.where("image_path = 'p0'"))
    assert sorted((r.id, r.image_path) for r in store.create(spark, where, 2).collect()) == [(1, "p0"), (2, "p1"), (3, "p2"), (4, "p3"), (5, "p4"), (6, "p0")]
    assert store.describe(spark, where) == {"index_type": "exact", "metric_type": "COSINE", "params": {}, "dim": 2, "row_count": 6}
    told = store.delete(spark, where, spark.createDataFrame([(1,), (99,)], "id long"))
    assert {r.id: r.outcome for r in told.collect()} == {1: "deleted", 99: "missing"}
    assert sorted(r.id for r in store.load(spark, where).collect()) == [2, 3, 4, 5, 6]
    assert store.create(spark, where, 3, drop_existing=True).count() == 0 and store.describe(spark, where)["dim"] == 3


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*") if p.is_file()}


def test_collection_survives_crashes(spark, tmp_path):
    where = str(tmp_path / "col")
    collection.create(spark, where, 2)
    rows = lambda *names: spark.createDataFrame([([1.0, 0.0], n) for n in names], "embedding array<float>, image_path string")
    collection.append(spark, where, rows("a", "b", "c"))
    ids = lambda: sorted((r.id, r.image_path) for r in collection.load(spark, where).collect())
    before, data = ids(), _files(tmp_path / "col" / "data")
    # a delete that dies before its commit, in the midst of it, and one that ends
    real = paths.create_text
    for text in (None, '{"dim": 2, "da'):
        def dies(spark, path, whole, text=text):
            if text:
                real(spark, path, text)
                os.utime(path, (1, 1))
            raise KeyboardInterrupt

        paths.create_text = dies
        try:
            with pytest.raises(KeyboardInterrupt):
                collection.delete(spark, where, spark.createDataFrame([(2,)], "id long"))
        finally:
            paths.create_text = real
        assert ids() == before
    old = collection.current(spark, where)["version"]
    collection.delete(spark, where, spark.createDataFrame([(2,), (2,)], "id long"))
    assert ids() == [(1, "a"), (3, "c")] and _files(tmp_path / "col" / "data") == data
    assert sorted(r.id for r in collection.load(spark, where, old).collect()) == [1, 2, 3]
    assert [r.outcome for r in collection.delete(spark, where, spark.createDataFrame([(2,)], "id long")).collect()] == ["missing"]
    collection.append(spark, where, rows("d"))
    collection.compact(spark, where)
    assert collection.vacuum(spark, where) and ids() == [(1, "a"), (3, "c"), (4, "d")]


def test_collection_batches_and_writers(spark, tmp_path):
    where = str(tmp_path / "col")
    collection.create(spark, where, 2)
    rows = spark.createDataFrame([([1.0, float(i)], f"p{i:02}", "x" * (300 if i == 3 else 3)) for i in range(20)] + [([1.0, float("nan")], "q", ""), (None, "r", "")], "embedding array<double>, image_path string, person_id string")
    broken = lambda d: d.withColumn("person_id", F.when(F.col("image_path") == "p07", F.raise_error(F.lit("no room")).cast("string")).otherwise(F.col("person_id")))
    told = {r.image_path: r for r in collection.append(spark, where, rows, 5, broken).collect()}
    assert len(told) == 22 and told["p03"].reason == "person_id has 300 characters of 256" and told["q"].reason == "an invalid vector" and told["r"].reason == "no vector"
    assert {n for n, r in told.items() if r.outcome == "failed"} == {"p06", "p07", "p08", "p09", "p10"} and "no room" in told["p06"].reason
    assert {r.image_path for r in collection.load(spark, where).collect()} == {n for n, r in told.items() if r.outcome == "inserted"}
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: collection.append(spark, where, rows.where(f"image_path = 'p{i:02}'")), range(10, 14)))
    got = [r.id for r in collection.load(spark, where).collect()]
    assert len(got) == len(set(got)) == 14 + 4


def test_ingest_batches_embed_once(spark, tmp_path):
    from twinspark.streaming.ingest import ingest_batch, ingest_collection

    where, seen = str(tmp_path / "col"), spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b.assign(embedding=[None if p == "bad" else [1.0, 2.0] for p in b["image_path"]], reason=["no_face_detected" if p == "bad" else None for p in b["image_path"]])

    embedded = lambda d: d.mapInPandas(run, "image_path string, embedding array<float>, reason string")
    batch = lambda *names: spark.createDataFrame([(n,) for n in names], "image_path string")
    collection.create(spark, where, 2)
    told = lambda df: sorted((r.image_path, r.outcome, r.reason) for r in df.collect())
    first = told(ingest_batch(spark, batch("a", "b", "b", "bad"), 0, where, embedded))
    assert first == [("a", "inserted", None), ("b", "inserted", None), ("bad", "failed", "no_face_detected")] and seen.value == 3
    ingest_batch(spark, batch("a", "b", "b", "bad"), 0, where, embedded).collect()  # comes again
    assert seen.value == 3 and collection.load(spark, where).count() == 2
    assert told(ingest_batch(spark, batch("a", "c"), 1, where, embedded)) == [("a", "skipped", None), ("c", "inserted", None)] and seen.value == 4
    land = str(tmp_path / "land")
    batch("c", "e").write.parquet(land)
    for _ in range(2):
        ingest_collection(spark, land, "image_path string", where, str(tmp_path / "check"), embedded, 2, "files").awaitTermination()
    assert seen.value == 5 and collection.load(spark, where).count() == 4


def test_embedding_goes_on_where_it_broke_off(spark, tmp_path):
    where, seen, fail = str(tmp_path / "pass"), spark.sparkContext.accumulator(0), [3]
    records = spark.range(100).withColumnRenamed("id", "key")

    def model(rows):
        fail[0] -= 1
        if fail[0] < 0:
            raise KeyboardInterrupt

        def run(batches):
            for b in batches:
                seen.add(len(b))
                yield b

        return rows.mapInPandas(run, "key long")

    with pytest.raises(KeyboardInterrupt):
        store.embed_in_parts(records, where, model, 5)
    assert 0 < seen.value < 100
    fail[0] = 9
    assert sorted(r.key for r in store.embed_in_parts(records, where, model, 5).collect()) == list(range(100)) and seen.value == 100
    with pytest.raises(ValueError):
        store.embed_in_parts(records, where, model, 6)


def test_guards(spark):
    assert store.check_top_k() == 5 and store.check_top_k(50) == 50
    for k in (0, 51):
        with pytest.raises(ValueError):
            store.check_top_k(k)
    rows = spark.createDataFrame([("train", "a"), ("test", "b"), ("test", "a")], "split string, dest_name string")
    with pytest.raises(ValueError, match="a"):
        split.check_splits(rows)
    assert split.check_splits(rows.where("dest_name = 'b'")).count() == 1
    a, b = spark.range(3).toDF("k"), spark.range(4).toDF("k")
    assert store.same_keys(a, spark.range(3).toDF("k"), ["k"]) and not store.same_keys(a, b, ["k"]) and not store.same_keys(a.unionAll(a), a, ["k"])


def test_caches(spark, tmp_path):
    where = str(tmp_path / "cache")
    assert sinks.load_cache(spark, where, "key long, v array<double>").count() == 0
    records = spark.range(4).toDF("key")
    model = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [3.0])], "key long, v array<double>")
    asked = []

    def embed(rows):
        asked.append(sorted(r.key for r in rows.collect()))
        return rows.join(model, "key")

    for want in ({0: "embedded", 1: "failed_embed", 2: "failed_embed", 3: "failed_embed"}, {0: "cached", 1: "failed_embed", 2: "failed_embed", 3: "failed_embed"}):
        out = store.embed_pass(records, sinks.load_cache(spark, where, "key long, v array<double>"), embed, 2)
        assert {r.key: r.status for r in out.collect()} == want
        sinks.save_cache(out.where("status = 'embedded'").select("key", "v"), where)
    assert asked == [[0, 1, 2, 3], [1, 2, 3]]


def test_vector_cache(spark, tmp_path):
    v = np.arange(60, dtype=np.float32).reshape(20, 3)
    np.save(tmp_path / "embeddings.npy", v)
    assert files.vector_cache(spark, str(tmp_path)) is None
    (tmp_path / "embed_meta.json").write_text(json.dumps({"keys": [["d", f"n{i}"] for i in range(20)]}, indent=1))
    got = {r.name: r.v for r in files.vector_cache(spark, str(tmp_path)).collect()}
    assert got == {f"n{i}": v[i].tolist() for i in range(20)}
    found = store.with_cache(spark.createDataFrame([("d", "n0"), ("d", "n7"), ("d", "q")], "dataset_source string, name string"), files.vector_cache(spark, str(tmp_path)), ["dataset_source", "name"])
    assert {r.name: r.cached for r in found.collect()} == {"n0": True, "n7": True, "q": False}
    for bad in ('{"keys": [["d", "n"]]}', "{broken"):
        (tmp_path / "embed_meta.json").write_text(bad)
        assert files.vector_cache(spark, str(tmp_path)) is None
    (tmp_path / "embeddings.npy").write_bytes(b"no matrix")
    assert files.vector_cache(spark, str(tmp_path)) is None


def test_embedder(spark):
    def load():
        def model(content):
            if not content:
                raise embed.NoFace
            return [float(x) for x in content]

        return model

    rows = spark.createDataFrame([(1, bytearray(b"\x03\x04")), (2, bytearray(b"")), (3, bytearray(b"\x00\x00")), (4, bytearray(b"abc"))], "key long, content binary")
    made = embed.embedder(load, 2)
    got = {r.key: (r.v and [round(x, 6) for x in r.v], r.reason) for r in made(rows).collect()}
    assert got[1] == ([0.6, 0.8], None) and got[2] == (None, "no_face_detected") and "length" in got[3][1] and "not 2" in got[4][1]
    cache = spark.createDataFrame([(4, [1.0, 0.0], 0)], "key long, v array<float>, at int")
    assert {r.key: r.status for r in store.embed_pass(rows, cache, made, 2).collect()} == {1: "embedded", 2: "failed_embed", 3: "failed_embed", 4: "cached"}


def test_extraction(spark):
    records = spark.createDataFrame([(10, 5, True), (20, 6, False), (30, 7, True), (40, 8, True), (50, 9, False)], "offset long, label long, ok boolean")
    listed = spark.createDataFrame([(0, 100), (2, 102)], "position long, label long")
    assert [r.label for r in extract.with_labels(records, listed, "offset").orderBy("offset").collect()] == [100, 6, 102, 8, 9]
    cut = lambda n: [(r.offset, r.sequence) for r in extract.first_successes(records, "offset", F.col("ok"), n).orderBy("offset").collect()]
    assert cut(2) == [(10, 1), (20, None), (30, 2)] and cut(0) == [(10, 1), (20, None), (30, 2), (40, 3), (50, None)]
    images = spark.createDataFrame([("d", 0, "x"), ("d", 1, "y"), ("d", 2, "x"), ("d", 3, None), ("d", 4, "z"), ("e", 0, "x"), ("e", 1, "q")], "dataset string, image long, md5 string")
    rows = extract.counters(extract.image_outcomes(images)).collect()
    assert {tuple(r) for r in rows} == {("d", 3, 1, 1, 2), ("e", 2, 0, 0, 0), (None, 5, 1, 1, 2)}


def test_small_functions(spark):
    df = spark.createDataFrame([([[0.0, 0.0, 2.0, 2.0], [5.0, 5.0, 7.0, 7.0], [3.0, 3.0, 1.0, 9.0]],), ([],)], "boxes array<array<double>>")
    assert [r[0] for r in df.select(names.largest_box(F.col("boxes"))).collect()] == [0, None]
    one = spark.range(1).select(names.cluster_of_person(F.lit("cluster_12")), names.cluster_of_person(F.lit("someone")), names.image_name(F.lit(7)), names.top_folder(F.lit("s3a://b/root/x/y.jpg"), "s3a://b/root/"), names.mime_type(F.lit("a.JPEG"))).first()
    assert tuple(one) == (12, None, "img_00007.jpg", "x", "image/jpeg")
    assert names.two_lists(["a", "b"], ["b", "c"]) == ["a", "b", "c"]
