"""Duplicate groups, identities, and train/test assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinspark.functions.names import file_name, identity, source_prefix
from twinspark.operators.graph import connected_components
from twinspark.operators.order import numbered
from twinspark.operators.similar import linked


def duplicate_groups(rows: DataFrame, key: str, *rank: Column) -> DataFrame:
    """(key, copies, datasets, kept): groups of two and more rows (key, dataset, name), and the representative by ``rank``."""
    return rows.groupBy(key).agg(
        F.count("*").alias("copies"), F.countDistinct("dataset").alias("datasets"), F.min(F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], "dataset", "name")).alias("kept")
    ).where("copies > 1")


def identities(vectors: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component, cluster_id): components of ``links`` (i, j) over all ids; labels are dense, in the order of the smallest member."""
    linked = connected_components(links.select(F.col("i").alias("u"), F.col("j").alias("v"))).withColumnRenamed("node", "id")
    all_ids = vectors.select("id").join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    label = numbered(all_ids.select("component").distinct(), ["component"], "cluster_id")
    return all_ids.join(label, "component").select("id", "component", "cluster_id")


def assign_splits(rows: DataFrame, singleton_train: bool = True, seed: int | None = None) -> DataFrame:
    """Rows (cluster_id, md5, prio, dataset, name, ...) with ``split``.

    Of each cluster one row is the test representative (the best by priority, or with a ``seed`` one drawn by a hash of
    seed and name) and its exact copies go; every other hash keeps its best copy in train. Null hashes are ``failed_decode``, null clusters ``failed_embed``.
    Representatives are minima of structs, combined before the shuffle, so a large cluster is no single task.
    """
    order = F.struct("prio", "dataset", "name")
    ok = rows.where("cluster_id is not null and md5 is not null")
    drawn = F.lit("") if seed is None else F.md5(F.concat(F.lit(f"{seed}:"), F.col("name").cast("string")).cast("binary"))
    cluster = ok.groupBy("cluster_id").agg(F.count("*").alias("_n"), F.min(F.struct(drawn.alias("h"), order.alias("o"), "md5")).alias("_rep"))
    each = ok.groupBy("cluster_id", "md5").agg(F.min(order).alias("_best"))
    out = rows.join(cluster, "cluster_id", "left").join(each, ["cluster_id", "md5"], "left")
    split = (
        F.when(F.col("md5").isNull(), "failed_decode").when(F.col("cluster_id").isNull(), "failed_embed")
        .when(F.col("_n") == 1, "train" if singleton_train else "dropped_singleton").when(order == F.col("_rep.o"), "test")
        .when(F.col("md5") == F.col("_rep.md5"), "dropped_exact_dup").when(order == F.col("_best"), "train").otherwise("dropped_exact_dup")
    )
    return out.withColumn("split", split).drop("_n", "_rep", "_best")


def identity_split(records: DataFrame, threshold: float, precision: str = "half", singleton_train: bool = True, seed: int | None = None) -> DataFrame:
    """Records (pos, canon, dataset, name, md5, prio, v) to clusters and splits; copies share the vector of ``canon``.

    Similarities are compared in half precision, as they are stored; ``precision='double'`` compares them as they are.
    """
    vectors = records.where("v is not null and pos = canon").select(F.col("canon").alias("id"), "v")
    links, _ = linked(vectors, [threshold], precision)
    found = identities(vectors, links.select(F.col("u").alias("i"), F.col("v").alias("j")))
    rows = records.drop("v").join(found.select(F.col("id").alias("canon"), "cluster_id"), "canon", "left")
    return assign_splits(rows, singleton_train, seed)


def round_robin(rows: DataFrame, group: str, by: str, limit: int) -> DataFrame:
    """The first ``limit`` rows taken in turn from the groups."""
    turn = F.row_number().over(Window.partitionBy(group).orderBy(by))
    return rows.withColumn("turn", turn).where(F.col("turn") <= limit).orderBy("turn", group).limit(limit)


def keep_first(rows: DataFrame, key: str, by: str) -> DataFrame:
    """The row of smallest ``by`` of each key; combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min(F.struct(by, *[c for c in rest if c != by])).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def unique_names(rows: DataFrame, name: str, by: str) -> DataFrame:
    """``name`` with a running suffix for later rows of the same name."""
    first = rows.groupBy(name).agg(F.min(by).alias("_first"))
    marked = rows.join(first, name).withColumn("_again", F.col(by) != F.col("_first"))
    again = numbered(marked.where("_again").select(F.col(by).alias("_by")), ["_by"], "_k")
    out = marked.join(again, marked[by] == again["_by"], "left")
    renamed = F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_"), F.col("_k"), F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return out.withColumn("dest", F.when(F.col("_again"), renamed).otherwise(F.col(name))).drop("_first", "_again", "_k", "_by")


def seeded_split(rows: DataFrame, group: str, name: str, first_train: int, seed: int, least: int = 1) -> DataFrame:
    """Train (the first ``first_train`` after a shuffle) and test rows of each group of ``least`` rows and more.

    The shuffle sorts by a hash of seed and name, so that no generator's state has to pass through all groups in turn.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(name).cast("string")).cast("binary"))
    kept = rows.join(sizes.select(group), group).withColumn("_h", h)
    chosen = kept.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_h", name))).where(F.col("_r") <= first_train)
    chosen = chosen.select(group, F.col(name).alias("_name"), F.lit("train").alias("split"))
    out = kept.drop("_h").join(chosen.withColumnRenamed("_name", name), [group, name], "left")
    return out.withColumn("split", F.coalesce("split", F.lit("test")))


def one_train(rows: DataFrame, group: str, name: str, least: int = 2) -> DataFrame:
    """(group, total, train, tests, test_names): of each group of ``least`` rows and more the first name trains; the rest are joined by |."""
    g = rows.groupBy(group).agg(F.count("*").alias("total"), F.array_sort(F.collect_list(name)).alias("names")).where(F.col("total") >= least)
    rest = F.array_join(F.slice("names", F.lit(2), F.col("total").cast("int")).cast("array<string>"), "|")
    return g.select(group, "total", F.get("names", F.lit(0)).alias("train"), (F.col("total") - 1).alias("tests"), rest.alias("test_names"))


def of_split(rows: DataFrame, split: str) -> DataFrame:
    """The rows of a split that have a destination."""
    return rows.where((F.col("split") == split) & (F.trim("dest_name") != ""))


def untrained(rows: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Keys of test rows that no train row has."""
    return rows.where("split = 'test'").select(key).distinct().join(rows.where("split = 'train'").select(key), key, "left_anti")


def overlap(rows: DataFrame, name: str = "dest_name") -> DataFrame:
    """Names that are in both splits."""
    return rows.where("split = 'test'").select(name).distinct().join(rows.where("split = 'train'").select(name), name, "left_semi")


def check_splits(rows: DataFrame, name: str = "dest_name") -> DataFrame:
    """``rows``, or ValueError if a name is in both splits."""
    found = [r[0] for r in overlap(rows, name).orderBy(name).limit(3).collect()]
    if found:
        raise ValueError(f"in train and test: {found}")
    return rows


def whole_pairs(pairs: DataFrame, written: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) of which both images are among ``written`` (image)."""
    for side in ("a", "b"):
        pairs = pairs.join(written.select(F.col("image").alias(side)), side, "left_semi")
    return pairs


def totals(rows: DataFrame) -> DataFrame:
    """(status, n) of ``split``, rows without one as unassigned, and all of them."""
    each = rows.groupBy(F.coalesce("split", F.lit("unassigned")).alias("status")).agg(F.count("*").alias("n"))
    return each.unionByName(each.agg(F.lit("all").alias("status"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def by_identity(paths: DataFrame) -> DataFrame:
    """(path) to (identity, prefix, images, names): images of a person, whose files are named like it."""
    who = identity(F.col("path"))
    return paths.groupBy(who.alias("identity")).agg(F.count("*").alias("images"), F.array_join(F.array_sort(F.collect_list(file_name(F.col("path")))), "|").alias("names")).withColumn("prefix", source_prefix(F.col("identity")))
