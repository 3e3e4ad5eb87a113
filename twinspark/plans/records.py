"""Registered queries on containers, caches, guards, collections and tables that are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.functions import names, vectors
from twinspark.operators import collection, extract, order, similar, split, store
from twinspark.plans.base import query, read
from twinspark.plans.catalog import _E, _EVAL, _KNN, K, PRIORITY, _docs, _hits, _results, _splits, _vectors
from twinspark.plans.catalog import _SPLIT as _SPLIT_SQL
from twinspark.shared import shared_dir
from twinspark.sources import files, sinks

KNOWN = ["src3", "src0", "nowhere", "src11"]


def _text_path(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# discovery


@query("SELECT CAST(p AS INTEGER) AS position, d AS dataset FROM (VALUES (0, 'src3'), (1, 'src0'), (2, 'nowhere'), (3, 'src11')) x(p, d) WHERE d IN (SELECT source FROM documents)")
def known_datasets(s, d):
    paths = read(s, d, "documents").select(_text_path("file:/data/", F.col("source"), "/", F.col("doc_id").cast("string"), ".jpg").alias("path"))
    return files.known(files.datasets(paths, "/data/"), KNOWN)


@query("SELECT 'p' || CAST(label AS VARCHAR) AS person, CAST(vec_id AS VARCHAR) || '.png' AS name FROM embeddings WHERE label IN (SELECT DISTINCT label FROM embeddings ORDER BY 'p' || CAST(label AS VARCHAR) LIMIT 4)")
def person_folders(s, d):
    v = _vectors(s, d)
    path = _text_path("hdfs://name:1/root/p", F.col("label").cast("string"), "/", F.col("id").cast("string"))
    deeper = v.select(_text_path(path, "/x/y.png").alias("path"))  # not right in a person's folder
    return files.person_folders(v.select(_text_path(path, ".png").alias("path")).unionByName(deeper), "hdfs://name:1/root", 4).select("person", "name")


@query("SELECT source AS dataset_source, CAST(doc_id AS VARCHAR) AS name FROM documents WHERE doc_id % 3 <> 0 AND source IS NOT NULL")
def manifest_keys(s, d):
    blank = F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("doc_id").cast("string"))
    return files.manifest_keys(read(s, d, "documents").select(F.col("source").alias("dataset_source"), blank.alias("name")))


@query("SELECT source, doc_id, row_number() OVER (ORDER BY source, string_split('a/' || CASE WHEN doc_id % 2 = 0 THEN 'b' ELSE 'b-c' END || '/' || CAST(doc_id AS VARCHAR), '/'), doc_id) - 1 AS pos FROM documents WHERE source IS NOT NULL")
def record_order(s, d):
    path = _text_path("a/", F.when(F.col("doc_id") % 2 == 0, "b").otherwise("b-c"), "/", F.col("doc_id").cast("string"))
    rows = read(s, d, "documents").where("source is not null").select("source", "doc_id", names.path_parts(path).alias("parts"))
    return order.numbered(rows, ["source", "parts", "doc_id"], "pos").select("source", "doc_id", "pos")


# containers

_PLACED = "o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents), z AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, quality AS listed FROM labels WHERE quality IS NOT NULL)"


def _labelled(s, d):
    records = read(s, d, "documents").select("doc_id", (-F.col("doc_id")).alias("label"), "n_chars")
    listed = order.numbered(read(s, d, "labels").where("quality is not null").select("doc_id", "quality"), ["doc_id"], "position")
    return extract.with_labels(records, listed.select("position", F.col("quality").cast("long").alias("label")), "doc_id")


@query(f"WITH {_PLACED} SELECT doc_id, CAST(o.position AS BIGINT) AS position, CAST(coalesce(listed, -doc_id) AS BIGINT) AS label FROM o LEFT JOIN z ON o.position = z.position")
def positional_labels(s, d):
    return _labelled(s, d).select("doc_id", "position", "label")


@query(f"WITH {_PLACED}, w AS (SELECT o.doc_id, coalesce(listed, -doc_id) AS label, n_chars >= 500 AS ok, sum(CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS k FROM o LEFT JOIN z ON o.position = z.position) SELECT doc_id, CAST(label AS BIGINT) AS label, CASE WHEN ok THEN printf('%05d.jpg', CAST(k AS BIGINT)) END AS file FROM w WHERE k - CASE WHEN ok THEN 1 ELSE 0 END < 60")
def extracted_images(s, d):
    rows = extract.first_successes(_labelled(s, d), "doc_id", F.col("n_chars") >= 500, 60)
    return rows.select("doc_id", "label", F.when(F.col("sequence").isNotNull(), names.sequence_name(F.col("sequence"))).alias("file"))


_IMAGES = (
    "i AS (SELECT source AS dataset, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS image, CASE WHEN doc_id % 17 <> 0 THEN md5(text) END AS md5 FROM documents WHERE source IS NOT NULL), "
    "f AS (SELECT *, CASE WHEN md5 IS NULL THEN 'failed' WHEN image = min(image) OVER (PARTITION BY dataset, md5) THEN 'written' ELSE 'intra_bin_dupe' END AS outcome FROM i), "
    "p AS (SELECT dataset, image // 2 AS pair, count(*) FILTER (WHERE outcome = 'written') = 2 AS kept FROM f GROUP BY dataset, image // 2), "
    "c AS (SELECT dataset, count(*) FILTER (WHERE outcome = 'written') AS written, count(*) FILTER (WHERE outcome = 'intra_bin_dupe') AS intra_bin_dupes, count(*) FILTER (WHERE outcome = 'failed') AS failed FROM f GROUP BY dataset), "
    "x AS (SELECT c.*, d.pairs_dropped FROM c JOIN (SELECT dataset, count(*) FILTER (WHERE NOT kept) AS pairs_dropped FROM p GROUP BY dataset) d ON c.dataset = d.dataset)"
)


def _images(s, d):
    docs = read(s, d, "documents").where("source is not null")
    first = order.numbered(docs.select("source", "doc_id"), ["source", "doc_id"], "n")
    start = first.groupBy("source").agg(F.min("n").alias("start"))
    image = first.join(start, "source").select("doc_id", (F.col("n") - F.col("start")).alias("image"))
    md5 = F.when(F.col("doc_id") % 17 != 0, F.md5(F.col("text").cast("binary"))).alias("md5")
    return docs.select("doc_id", F.col("source").alias("dataset"), md5).join(image, "doc_id").select("dataset", "image", "md5")


@query(f"WITH {_IMAGES} SELECT * FROM x UNION ALL SELECT NULL, CAST(sum(written) AS BIGINT), CAST(sum(intra_bin_dupes) AS BIGINT), CAST(sum(failed) AS BIGINT), CAST(sum(pairs_dropped) AS BIGINT) FROM x")
def extraction_counters(s, d):
    return extract.counters(extract.image_outcomes(_images(s, d)))


@query(f"WITH {_IMAGES} SELECT dataset, CAST(pair AS BIGINT) AS pair_index, printf('img_%05d.jpg', CAST(2 * pair AS BIGINT)) AS image_a, printf('img_%05d.jpg', CAST(2 * pair + 1 AS BIGINT)) AS image_b FROM p WHERE kept")
def pair_manifest(s, d):
    pairs = extract.kept_pairs(extract.image_outcomes(_images(s, d))).where("kept")
    return pairs.select("dataset", F.col("pair").alias("pair_index"), names.image_name(2 * F.col("pair")).alias("image_a"), names.image_name(2 * F.col("pair") + 1).alias("image_b"))


@query("WITH r AS (SELECT md5(text) AS md5, 'img/' || source || '/' || CAST(doc_id AS VARCHAR) AS path, source AS dataset, CASE source " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(PRIORITY)) + " ELSE 5 END AS rank FROM documents), g AS (SELECT *, count(*) OVER (PARTITION BY md5) AS n, row_number() OVER (PARTITION BY md5 ORDER BY rank, path) AS w FROM r), m AS (SELECT md5, count(DISTINCT dataset) > 1 AS spans FROM r GROUP BY md5) SELECT g.md5, path, dataset AS dataset_folder, CASE WHEN w = 1 THEN 'true' ELSE 'false' END AS kept, CASE WHEN spans THEN 'true' ELSE 'false' END AS group_spans_multiple_datasets FROM g JOIN m ON g.md5 = m.md5 WHERE n > 1")
def duplicate_manifest(s, d):
    docs = _docs(s, d)
    rows = docs.select("md5", _text_path("img/", F.col("dataset"), "/", F.col("name").cast("string")).alias("path"), "dataset", names.priority(F.col("dataset"), names.two_lists(PRIORITY, PRIORITY[:2])).alias("rank"))
    return sinks.cells(sinks.duplicate_rows(rows), "duplicates")


# caches


@query("WITH k AS (SELECT source || '_' || CAST(doc_id AS VARCHAR) AS file, source, doc_id FROM documents WHERE doc_id % 4 <> 1) SELECT d.doc_id, coalesce(k.source, 'folder') AS dataset_source, k.doc_id IS NOT NULL AND vec_id IS NOT NULL AS cached FROM documents d LEFT JOIN k ON k.file = d.source || '_' || CAST(d.doc_id AS VARCHAR) LEFT JOIN embeddings ON vec_id = k.doc_id")
def cache_two_hops(s, d):
    docs = read(s, d, "documents")
    named = docs.select("doc_id", _text_path("in\\", names.cache_key(F.col("source"), F.col("doc_id").cast("string"))).alias("path"))
    keys = docs.where("doc_id % 4 <> 1").select(F.col("source").alias("dataset_source"), F.col("doc_id").cast("string").alias("name"), F.col("doc_id").alias("at"))
    own = docs.select(F.col("source").alias("dataset_source"), F.col("doc_id").cast("string").alias("name"), F.col("doc_id").alias("id"))
    cache = own.join(_vectors(s, d).select("id", "v"), "id").select("dataset_source", "name", "v", F.lit(0).alias("at"))
    return store.two_hops(named, keys, cache, "folder").select("doc_id", "dataset_source", "cached")


@query("SELECT source AS dataset_source, doc_id AS name, doc_id % 5 <> 0 AS reused, CASE WHEN doc_id % 5 <> 0 THEN md5(text) END AS md5 FROM documents WHERE source IS NOT NULL")
def hash_inventory(s, d):
    rows = _docs(s, d).where("dataset is not null").select(F.col("dataset").alias("dataset_source"), "name", "md5")
    return store.hash_inventory(rows.drop("md5"), rows.where("name % 5 <> 0"))


@query("SELECT doc_id AS key, CASE WHEN vec_id % 2 = 0 THEN 'cached' WHEN vec_id % 7 = 0 OR vec_id IS NULL THEN 'failed_embed' ELSE 'embedded' END AS status FROM documents LEFT JOIN embeddings ON vec_id = doc_id")
def embed_pass(s, d):
    v = _vectors(s, d).select(F.col("id").alias("key"), "v")
    zero = F.transform("v", lambda x: x * 0)
    model = v.withColumn("v", F.when(F.col("key") % 7 == 0, zero).otherwise(F.col("v")))  # stands for the embedding model
    cache = v.where("key % 2 = 0").withColumn("at", F.lit(0))
    out = store.embed_pass(read(s, d, "documents").select(F.col("doc_id").alias("key")), cache, lambda rows: rows.select("key").join(model, "key"), 64)
    return out.select("key", "status")


@query("SELECT 'images/' || CAST(doc_id AS VARCHAR) AS path, 'missing_on_disk' AS reason FROM documents WHERE doc_id % 6 = 5 UNION ALL SELECT 'images/' || CAST(doc_id AS VARCHAR), 'no_face_detected' FROM documents WHERE doc_id % 6 <> 5 AND doc_id NOT IN (SELECT vec_id FROM embeddings)")
def ingest_failures(s, d):
    rows = read(s, d, "documents").select("doc_id", _text_path("images/", F.col("doc_id").cast("string")).alias("path"))
    there = rows.where("doc_id % 6 <> 5")
    gone = store.missing_files(rows, there).withColumn("reason", F.lit("missing_on_disk"))
    found = store.with_cache(there, _vectors(s, d).select(F.col("id").alias("doc_id"), "v", F.lit(0).alias("at")), ["doc_id"])
    told = found.select("doc_id", "path", F.when(~F.col("cached"), "no_face_detected").alias("reason"))
    return store.failures(gone.unionByName(told))


# splits


@query(_SPLIT_SQL + "SELECT split AS status, count(*) AS n FROM s GROUP BY split UNION ALL SELECT 'all', count(*) FROM s")
def split_totals(s, d):
    return split.totals(_splits(s, d))


@query(_SPLIT_SQL + "SELECT pos, split || '/' || coalesce(dataset, '') AS dest_name FROM s WHERE split = 'train'")
def train_rows(s, d):
    rows = _splits(s, d).withColumn("dest_name", F.when(F.col("split").isin("train", "test"), F.concat_ws("/", "split", F.coalesce("dataset", F.lit("")))).otherwise(""))
    return split.of_split(rows, "train").select("pos", "dest_name")


@query("SELECT source || '_' || CAST(doc_id % 3 AS VARCHAR) AS identity, source AS prefix, count(*) AS images, array_to_string(list(f ORDER BY f), '|') AS names FROM (SELECT *, source || '_' || CAST(doc_id % 3 AS VARCHAR) || '_' || CAST(doc_id AS VARCHAR) || '.jpg' AS f FROM documents WHERE source IS NOT NULL) GROUP BY source, doc_id % 3")
def images_by_identity(s, d):
    name = F.concat_ws("_", "source", (F.col("doc_id") % 3).cast("string"), F.col("doc_id").cast("string"))
    return split.by_identity(read(s, d, "documents").where("source is not null").select(_text_path("x/", name, ".jpg").alias("path")))


@query(f"WITH RECURSIVE {_E}, p AS (SELECT a.id AS i, b.id AS j, list_inner_product(a.v, b.v) AS sim FROM e a JOIN e b ON a.id < b.id), ids AS (SELECT id FROM e), t AS (SELECT unnest([0.5::DOUBLE, 0.42::DOUBLE, 0.4213::DOUBLE]) AS t), l AS (SELECT t, i AS a, j AS b FROM p, t WHERE sim >= t UNION ALL SELECT t, j, i FROM p, t WHERE sim >= t), w(t, a, b) AS (SELECT t, id, id FROM ids, t UNION SELECT w.t, w.a, l.b FROM w JOIN l ON w.b = l.a AND w.t = l.t), c AS (SELECT t, a AS id, min(b) AS component FROM w GROUP BY t, a), z AS (SELECT t, component, count(*) AS n FROM c GROUP BY t, component) SELECT t AS threshold, count(*) AS clusters, count(*) FILTER (WHERE n > 1) AS multi, max(n) AS largest FROM z GROUP BY t")
def sensitivity_with_chosen(s, d):
    return similar.sensitivity(_vectors(s, d), (0.5, 0.42), chosen=0.42134)


# evaluation


@query(_EVAL + ", x AS (SELECT *, query % 300 = 0 AS bad FROM r) SELECT CAST(expected AS INTEGER) AS identity, count(*) AS n_images, avg(hit1::INT) AS hit1_rate, avg(hitk::INT) AS hitk_rate, round(avg(best_correct_score), 6) AS mean_correct_score, CAST(NULL AS BIGINT) AS n_identities, CAST(NULL AS BIGINT) AS n_errors FROM x WHERE NOT bad GROUP BY expected UNION ALL SELECT NULL, count(*), coalesce(avg(hit1::INT), 0), coalesce(avg(hitk::INT), 0), round(avg(best_correct_score), 6), count(DISTINCT expected), (SELECT count(*) FROM x WHERE bad) FROM x WHERE NOT bad")
def identity_rates(s, d):
    error = F.when(F.col("query") % 300 == 0, "no_face_detected").alias("error")
    return store.summarise_identities(_results(s, d).select("*", error))


@query(_EVAL + "SELECT 'q' || CAST(query AS VARCHAR) AS query_file, '' AS query_dataset, CAST(expected AS VARCHAR) AS expected_cluster, coalesce(CAST(top1_label AS VARCHAR), '') AS top1_cluster, coalesce(printf('%.4f', top1_score), '') AS top1_score, coalesce(printf('%.4f', best_correct_score), '') AS best_correct_score, CASE WHEN hit1 THEN 'true' ELSE 'false' END AS \"hit@1\", CASE WHEN hitk THEN 'true' ELSE 'false' END AS \"hit@5\", CASE WHEN has_train_row THEN 'true' ELSE 'false' END AS has_train_row FROM r")
def results_table(s, d):
    shown = lambda c: names.fixed(F.col(c), 4, "").alias(c)
    rows = _results(s, d).select(
        F.concat(F.lit("q"), F.col("query").cast("string")).alias("query_file"), F.lit(None).alias("query_dataset"), F.col("expected").alias("expected_cluster"),
        F.col("top1_label").alias("top1_cluster"), shown("top1_score"), shown("best_correct_score"), F.col("hit1").alias("hit@1"), F.col("hitk").alias("hit@5"), "has_train_row",
    )
    return sinks.cells(rows, "results")


@query(_KNN + """SELECT query, '{"top_k":' || CAST(count(*) AS VARCHAR) || ',"results":[' || string_agg('{"image_path":"images/' || CAST(k.id AS VARCHAR) || '","dataset_source":"emb","person_id":"cluster_' || CAST(label AS VARCHAR) || '","score":"' || printf('%.6f', score) || '"}', ',' ORDER BY rank) || ']}' AS response FROM k JOIN e ON k.id = e.id GROUP BY query""")
def search_responses(s, d):
    k = store.check_top_k(K)
    stored = _vectors(s, d).select("id", _text_path("images/", F.col("id").cast("string")).alias("image_path"), F.lit("emb").alias("dataset_source"), names.person_of_cluster(F.col("label")).alias("person_id"))
    return store.search_responses(_hits(s, d).where(F.col("rank") <= k), stored)


_UPLOAD = """WITH u AS (SELECT 'images/' || CAST(doc_id AS VARCHAR) || '.jpg' AS image_path, repeat(source, 1 + CAST(doc_id % 20 AS INTEGER)) AS dataset_source, vec_id, doc_id FROM documents LEFT JOIN embeddings ON vec_id = doc_id),
j AS (SELECT *, CASE WHEN vec_id IS NULL THEN 'no vector' WHEN vec_id % 11 = 0 THEN 'an invalid vector' WHEN vec_id % 13 = 0 THEN 'a vector of 63 numbers, not 64' WHEN length(dataset_source) > 64 THEN 'dataset_source has ' || CAST(length(dataset_source) AS VARCHAR) || ' characters of 64' END AS reason FROM u),
g AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY reason IS NULL ORDER BY image_path, dataset_source) END AS n FROM j), b AS (SELECT *, (n - 1) // 100 AS batch FROM g),
o AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN bool_or(doc_id % 97 = 5) OVER (PARTITION BY batch) THEN 'failed' ELSE 'inserted' END AS outcome FROM b) """


def _uploaded(s, d) -> tuple[str, DataFrame]:
    """A new collection, and the outcomes of an upload in batches of 100, of which those fail that hold a certain row."""
    v = _vectors(s, d).select(F.col("id").alias("doc_id"), "v")
    v = v.withColumn("v", F.when(F.col("doc_id") % 11 == 0, F.transform("v", lambda x: x * 0)).when(F.col("doc_id") % 13 == 0, F.slice("v", 1, 63)).otherwise(F.col("v")))
    rows = read(s, d, "documents").select("doc_id", _text_path("images/", F.col("doc_id").cast("string"), ".jpg").alias("image_path"), F.expr("repeat(source, cast(1 + doc_id % 20 as int))").alias("dataset_source"))
    rows = rows.join(v, "doc_id", "left").withColumnRenamed("v", "embedding")
    where = f"{shared_dir(s)}/collection-{uuid.uuid4().hex}"
    collection.create(s, where, 64)
    broken = lambda rows: rows.withColumn("person_id", F.when(F.regexp_extract("image_path", r"(\d+)", 1).cast("long") % 97 == 5, F.raise_error(F.lit("bad row")).cast("string")).otherwise(F.col("person_id")))
    return where, collection.append(s, where, rows, 100, broken)


@query(_UPLOAD + "SELECT image_path, dataset_source, CASE WHEN outcome = 'inserted' THEN n END AS id, batch, outcome, CASE outcome WHEN 'failed' THEN true ELSE false END AS broken, CASE outcome WHEN 'rejected' THEN reason END AS reason FROM o")
def append_outcomes(s, d):
    _, told = _uploaded(s, d)
    return told.withColumn("broken", F.col("outcome").eqNullSafe("failed") & F.col("reason").isNotNull()).withColumn("reason", F.when(F.col("outcome") == "rejected", F.col("reason")))


@query(_UPLOAD + "SELECT n AS id, image_path, dataset_source FROM o WHERE outcome = 'inserted' AND n % 5 <> 0")
def collection_versions(s, d):
    where, told = _uploaded(s, d)
    collection.delete(s, where, told.where("id % 5 = 0").select("id"))
    return collection.load(s, where).select("id", "image_path", "dataset_source")


@query("SELECT 'exact' AS index_type, 'COSINE' AS metric_type, count(*) AS row_count, count(*) FILTER (WHERE vec_id % 9 <> 0) AS searchable FROM embeddings")
def collection_status(s, d):
    rows = read(s, d, "embeddings").select(F.when(F.col("vec_id") % 9 == 0, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")).alias("embedding"))
    return store.status(rows)


# scalar functions


@query("WITH b AS (SELECT l_orderkey, l_linenumber, greatest(0, l_quantity - 20) * greatest(0, l_extendedprice - 3000) AS area FROM lineitem) SELECT l_orderkey, CAST(arg_min(place, (-area, place)) AS INTEGER) AS largest, max(area) AS area FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, area) - 1 AS place FROM b) GROUP BY l_orderkey")
def largest_box(s, d):
    box = F.array(F.lit(20.0), F.lit(3000.0), F.col("l_quantity"), F.col("l_extendedprice"))
    faces = read(s, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", names.box_area(box).alias("area"), box.alias("box")).alias("f"))
    boxes = faces.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("f")).alias("f")).select("l_orderkey", F.transform("f", lambda f: f["box"]).alias("boxes"))
    return boxes.select("l_orderkey", names.largest_box(F.col("boxes")).alias("largest"), F.array_max(F.transform("boxes", names.box_area)).alias("area"))


@query("SELECT vec_id AS id, 'cluster_' || CAST(label AS VARCHAR) AS person, CAST(label AS BIGINT) AS cluster, '/file?path=a%20b%2F' || CAST(vec_id AS VARCHAR) || '.PNG' AS url, 'image/png' AS mime, '&lt;b&gt;&quot;' || CAST(vec_id AS VARCHAR) || '&#39;&amp;' AS html FROM embeddings")
def shown_fields(s, d):
    v = _vectors(s, d)
    person, path = names.person_of_cluster(F.col("label")), _text_path("a b/", F.col("id").cast("string"), ".PNG")
    html = names.escaped_html(_text_path('<b>"', F.col("id").cast("string"), "'&"))
    return v.select("id", person.alias("person"), names.cluster_of_person(person).alias("cluster"), names.file_url(path).alias("url"), names.mime_type(path).alias("mime"), html.alias("html"))


@query(f"WITH {_E} SELECT a.id, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM e a JOIN e b ON b.id = a.id + 1")
def pair_cosine(s, d):
    v = _vectors(s, d).select("id", "v")
    return v.join(v.select((F.col("id") - 1).alias("id"), F.col("v").alias("w")), "id").select("id", F.round(vectors.cosine(F.col("v"), F.col("w")), 6).alias("score"))
