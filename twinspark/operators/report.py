"""Reports as Markdown, from aggregates of a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinspark.functions.names import fixed


def markdown(rows: DataFrame, *by: Column | str, limit: int | None = None) -> str:
    """A table of the rows in the order ``by``, or of the first ``limit`` of them; fractions with four digits, nulls as n/a. For aggregates: the text is made by the driver."""
    real = {c for c, kind in rows.dtypes if kind in ("double", "float")}
    cells = rows.orderBy(*by) if by else rows
    cells = cells.limit(limit) if limit else cells
    cells = cells.select(*[fixed(F.col(c), 4) if c in real else F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c in rows.columns])
    lines = [rows.columns, ["---"] * len(rows.columns), *cells.collect()]
    return "\n".join("| " + " | ".join(x.replace("|", "\\|") for x in r) + " |" for r in lines)


def merge_report(rows: DataFrame, sensitivity: DataFrame | None = None) -> str:
    """Rows (dataset, md5, cluster_id, split): counts by dataset and split, totals, the 20 largest cluster sizes, exact copies, and classes by threshold (``similar.sensitivity``)."""
    splits = F.coalesce("split", F.lit("unassigned")).alias("split")
    datasets = rows.groupBy("dataset", splits).agg(F.count("*").alias("rows"))
    totals = rows.groupBy(splits).agg(F.count("*").alias("rows"))
    sizes = rows.where("cluster_id is not null").groupBy("cluster_id").agg(F.count("*").alias("size"), F.countDistinct("dataset").alias("datasets"))
    sizes = sizes.groupBy("size").agg(F.count("*").alias("clusters"), F.max("datasets").alias("most_datasets"))
    copies = rows.where("md5 is not null").groupBy("md5").agg(F.count("*").alias("copies")).where("copies > 1").groupBy("copies").agg(F.count("*").alias("groups"))
    parts = [
        ("Datasets", markdown(datasets, "dataset", "split")), ("Totals", markdown(totals, "split")),
        ("Cluster sizes", markdown(sizes, F.desc("size"), limit=20)), ("Exact copies", markdown(copies, "copies")),
    ]
    if sensitivity is not None:
        parts.append(("Threshold sensitivity", markdown(sensitivity, "threshold")))
    return "\n\n".join(f"## {title}\n\n{text}" for title, text in parts) + "\n"


def evaluation_report(overall: DataFrame, by_label: DataFrame) -> str:
    """Hit rates as ``store.summarise`` gives them, overall and by label."""
    return f"## Overall\n\n{markdown(overall)}\n\n## By label\n\n{markdown(by_label, by_label.columns[0])}\n"
