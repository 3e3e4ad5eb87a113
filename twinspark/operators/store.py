"""Rows of vector collections: types, status, idempotent ingest, deletion; and evaluation of searches. ``collection`` has the stored form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.functions.vectors import valid
from twinspark.functions.names import cache_key, file_name
from twinspark.operators import collection
from twinspark.operators.order import numbered
from twinspark.sources import paths


def typed(rows: DataFrame, dim: int) -> DataFrame:
    """The rows that fit the collection (``collection.judged`` says why the others don't): vector of ``dim`` numbers, text lengths within limits; null texts become ''."""
    out = collection.judged(rows, dim).where("reason is null")
    return out.select(F.col("embedding").cast("array<float>").alias("embedding", metadata={"dim": dim}), *collection.LENGTHS)


def status(stored: DataFrame) -> DataFrame:
    """One row: index, metric, rows and, of them, those whose vector is valid."""
    return stored.agg(F.lit("exact").alias("index_type"), F.lit("COSINE").alias("metric_type"), F.count("*").alias("row_count"), F.count_if(valid(F.col("embedding"))).alias("searchable"))


def skip_existing(rows: DataFrame, stored: DataFrame, key: str = "image_path") -> DataFrame:
    return rows.join(stored.select(key), key, "left_anti")


def with_cache(rows: DataFrame, cache: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``v`` and ``cached`` from ``cache`` (key, v, at), whose last valid entry of a key counts."""
    last = cache.where(valid(F.col("v"))).groupBy(*key).agg(F.max_by("v", "at").alias("v"))
    return rows.join(last, key, "left").withColumn("cached", F.col("v").isNotNull())


def two_hops(files: DataFrame, keys: DataFrame, cache: DataFrame, dataset: str) -> DataFrame:
    """Files (path) of a merged folder with ``dataset_source`` and ``v``: the file's name leads to a key (dataset_source, name, at), the key to a vector.

    Of keys that make the same file name the last counts. Files without a key get ``dataset``.
    """
    named = keys.groupBy(cache_key(F.col("dataset_source"), F.col("name")).alias("file")).agg(F.max_by(F.struct("dataset_source", "name"), "at").alias("key"))
    rows = files.withColumn("file", file_name(F.col("path"))).join(named, "file", "left").select(*files.columns, "key.dataset_source", "key.name")
    return with_cache(rows, cache, ["dataset_source", "name"]).withColumn("dataset_source", F.coalesce("dataset_source", F.lit(dataset)))


def hash_inventory(records: DataFrame, saved: DataFrame) -> DataFrame:
    """Records (dataset_source, name) with the ``md5`` of ``saved`` (dataset_source, name, md5) and ``reused``; the others are to be hashed."""
    last = saved.groupBy("dataset_source", "name").agg(F.max("md5").alias("md5"), F.lit(True).alias("reused"))
    return records.join(last, ["dataset_source", "name"], "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def same_keys(one: DataFrame, other: DataFrame, key: list[str]) -> bool:
    """Whether two tables list the same keys, each as often: a cache of one then serves the other."""
    a, b = one.select(key), other.select(key)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def embed_pass(records: DataFrame, cache: DataFrame, embed, dim: int) -> DataFrame:
    """Records (key, ...) with ``v`` and ``status``: cached, embedded or failed_embed. ``embed`` turns the rows that
    the cache (key, v, at) lacks into (key, v); writing what it gives back to the cache makes the pass resumable."""
    rows = with_cache(records, cache, ["key"])
    made = embed(rows.where("not cached").drop("v", "cached")).select("key", F.col("v").alias("new"))
    out = rows.join(made, "key", "left")
    fresh = valid(F.col("new"), dim)
    said = F.when(F.col("cached"), "cached").when(fresh, "embedded").otherwise("failed_embed")
    return out.withColumns({"status": said, "v": F.when(F.col("cached"), F.col("v")).when(fresh, F.col("new"))}).drop("new", "cached")


def embed_in_parts(records: DataFrame, folder: str, embed, parts: int) -> DataFrame:
    """What ``embed`` makes of ``records`` (key, ...), written to ``folder`` part by part: a pass that is killed goes on with the parts that aren't finished.

    A key's part is its hash; ``parts`` of a folder can't change (ValueError).
    """
    spark = records.sparkSession
    if not paths.create_text(spark, f"{folder}/parts", str(parts)) and paths.read_text(spark, f"{folder}/parts") != str(parts):
        raise ValueError(f"{folder} has {paths.read_text(spark, f'{folder}/parts')} parts, not {parts}")
    for i in range(parts):
        if not paths.exists(spark, f"{folder}/part={i}/_SUCCESS"):
            embed(records.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == i)).write.mode("overwrite").parquet(f"{folder}/part={i}")
    return spark.read.parquet(*(f"{folder}/part={i}" for i in range(parts)))


def missing_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose ``path`` isn't among ``files`` (path)."""
    return rows.join(files.select("path"), "path", "left_anti")


def failures(outcomes: DataFrame) -> DataFrame:
    """(path, reason) of outcomes that failed: no face, an error with its text, a missing file, a failed insert."""
    return outcomes.where("reason is not null and reason <> ''").select("path", "reason")


def check_top_k(k: int | None = None) -> int:
    """The number of hits: 5 if none is given; ValueError unless it is 1 to 50."""
    k = 5 if k is None else k
    if not 1 <= k <= 50:
        raise ValueError(f"top_k must be from 1 to 50, not {k}")
    return k


def insert(stored: DataFrame, rows: DataFrame, dim: int) -> DataFrame:
    """``stored`` with new rows, whose ids go on from the largest."""
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = numbered(typed(rows, dim), ["image_path", "dataset_source"], "id", top + 1)
    return stored.unionByName(new.select(stored.columns))


def ingest_outcomes(rows: DataFrame, stored: DataFrame, cache: DataFrame) -> DataFrame:
    """(image_path, key, ...) with ``outcome``: skipped if the path is stored, from_cache if the key has a valid vector, else embed."""
    have = stored.select("image_path").distinct().withColumn("_have", F.lit(True))
    cached = cache.where(valid(F.col("v"))).groupBy("key").agg(F.max_by("v", "at").alias("v"))  # the last entry of a key counts
    out = rows.join(have, "image_path", "left").join(cached, "key", "left")
    return out.withColumn("outcome", F.when(F.col("_have"), "skipped").when(F.col("v").isNotNull(), "from_cache").otherwise("embed")).drop("_have")


def delete(stored: DataFrame, ids: DataFrame) -> DataFrame:
    return stored.join(ids.select("id"), "id", "left_anti")


def evaluate(hits: DataFrame, queries: DataFrame, gallery: DataFrame) -> DataFrame:
    """Ranked ``hits`` (query, rank, id, score) against the labels of ``queries`` and ``gallery`` (id, label): a row a query."""
    told = hits.join(gallery.select("id", F.col("label").alias("found")), "id").join(queries.select(F.col("id").alias("query"), F.col("label").alias("expected")), "query")
    right = F.col("found") == F.col("expected")
    rows = told.groupBy("query").agg(
        F.max(F.when(F.col("rank") == 1, F.col("found"))).alias("top1_label"), F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("top1_score"),
        F.max(F.when(right, F.col("score"))).alias("best_correct_score"), F.bool_or(right & (F.col("rank") == 1)).alias("hit1"), F.bool_or(right).alias("hitk"),
    )
    train = gallery.select(F.col("label").alias("expected")).distinct().withColumn("has_train_row", F.lit(True))
    out = queries.select(F.col("id").alias("query"), F.col("label").alias("expected")).join(rows, "query", "left").join(train, "expected", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("hit1", "hitk", "has_train_row")})


def summarise(results: DataFrame, *by: str) -> DataFrame:
    """Hit rates over queries that could hit; mean best score of a right answer."""
    rated = F.col("has_train_row")
    return results.groupBy(*by).agg(
        F.count_if(rated).alias("n"), F.count_if(~rated).alias("n_no_train"),
        F.avg(F.when(rated, F.col("hit1").cast("int"))).alias("hit1_rate"), F.avg(F.when(rated, F.col("hitk").cast("int"))).alias("hitk_rate"),
        F.count(F.when(rated, F.col("best_correct_score"))).alias("n_correct"), F.round(F.avg(F.when(rated, F.col("best_correct_score"))), 6).alias("mean_correct_score"),
    )


def summarise_identities(results: DataFrame) -> DataFrame:
    """Results (expected, hit1, hitk, best_correct_score, error): rates by identity over rows without an error, and of all (identity null) with the numbers of identities and errors."""
    ok = results.where("error is null")
    rates = lambda g: (F.count("*").alias("n_images"), F.avg(F.col("hit1").cast("int")).alias("hit1_rate"), F.avg(F.col("hitk").cast("int")).alias("hitk_rate"), F.round(F.avg("best_correct_score"), 6).alias("mean_correct_score"), *g)
    none = F.lit(None).cast("long")
    each = ok.groupBy(F.col("expected").alias("identity")).agg(*rates([none.alias("n_identities"), none.alias("n_errors")]))
    errors = results.agg(F.count_if(F.col("error").isNotNull()).alias("n_errors"))
    whole = ok.agg(*rates([F.countDistinct("expected").alias("n_identities")])).join(F.broadcast(errors)).withColumn("identity", F.lit(None).cast(each.schema["identity"].dataType))
    return each.unionByName(whole.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("hit1_rate", "hitk_rate")}))


def wide(hits: DataFrame, k: int) -> DataFrame:
    """Ranked hits (query, rank, id, score) as a row a query: rank1_id, rank1_score, ..."""
    out = hits.groupBy("query").pivot("rank", list(range(1, k + 1))).agg(F.max("id").alias("id"), F.max("score").alias("score"))
    return out.select("query", *[F.col(f"{r}_{c}").alias(f"rank{r}_{c}") for r in range(1, k + 1) for c in ("id", "score")])


def most_common(hits: DataFrame, by: str) -> DataFrame:
    """(by, hits, share, place): the most frequent first, equals by name."""
    g = hits.groupBy(by).agg(F.count("*").alias("hits"))
    total = g.agg(F.sum("hits").alias("total"))
    out = g.join(F.broadcast(total)).select(by, "hits", F.round(100.0 * F.col("hits") / F.col("total"), 6).alias("share"), (-F.col("hits")).alias("less"))
    return numbered(out, ["less", by], "place", 1).drop("less")


def search_responses(hits: DataFrame, stored: DataFrame) -> DataFrame:
    """(query, response): hits (query, rank, id, score) with what ``stored`` (id, image_path, dataset_source, person_id) says of them, as JSON, best first."""
    told = hits.join(stored.select("id", "image_path", "dataset_source", "person_id"), "id")
    hit = F.struct("rank", F.struct("image_path", "dataset_source", "person_id", F.format_string("%.6f", "score").alias("score")).alias("hit"))
    rows = F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["hit"])
    return told.groupBy("query").agg(F.to_json(F.struct(F.count("*").alias("top_k"), rows.alias("results"))).alias("response"))


def ingest_response(outcomes: DataFrame, row_count: int) -> DataFrame:
    """(response): outcomes (path, outcome, reason) of an upload as one JSON text for each, and counts."""
    each = outcomes.select("path", F.to_json(F.struct(file_name(F.col("path")).alias("filename"), F.col("outcome").alias("status"), "reason")).alias("response"))
    return each.withColumn("db_row_count", F.lit(row_count).cast("long"))
