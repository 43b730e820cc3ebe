"""Comparison of labellings and the tables behind the plots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.functions.exprs import fixed
from cohorta.operators.rules import display_label
from cohorta.operators.stats import cluster_means, distinct_labels, label_facts

# The labellings a full run produces.
ALGORITHMS = ("kmeans", "hierarchical", "dbscan", "spectral")


def union_labelled(tables: dict, id_col: str) -> DataFrame | None:
    """(algorithm, id, cluster) of all tables that have a label column."""
    parts = [
        t.select(F.lit(name).alias("algorithm"), id_col, "cluster") for name, t in tables.items()
        if "cluster" in t.columns]
    return reduce(DataFrame.unionByName, parts) if parts else None


def compare_algorithms(labelled: DataFrame) -> DataFrame:
    return label_facts(labelled, "algorithm")


def comparison_formatted(comparison: DataFrame) -> DataFrame:
    return comparison.select(
        "algorithm", "n_clusters", "total_samples", "noise_count",
        F.concat(fixed("(noise_ratio * 100)", 2), F.lit("%")).alias("noise_pct"))


def plot_comparison(comparison: DataFrame) -> DataFrame:
    return comparison.select("algorithm", "n_clusters", (F.col("noise_ratio") * 100).alias("noise_pct"))


def plot_scatter(scores: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """(id, pc1, pc2, cluster, label, series): points with their legend text and colour index."""
    series = distinct_labels(labels).select(
        "cluster", (F.row_number().over(Window.orderBy("cluster")) - 1).alias("series"))  # one row per label
    return scores.select(id_col, "pc1", "pc2").join(labels.select(id_col, "cluster"), id_col).join(
        series, "cluster").select(id_col, "pc1", "pc2", "cluster", display_label().alias("label"), "series")


def plot_scatter_binned(scores: DataFrame, labels: DataFrame, id_col: str, width: float = 0.5) -> DataFrame:
    """(cluster, bin_x, bin_y, n): rows per square of the plane, for tables too large to draw point by point."""
    return scores.select(id_col, "pc1", "pc2").join(labels.select(id_col, "cluster"), id_col).groupBy(
        "cluster", F.floor(F.col("pc1") / width).alias("bin_x"), F.floor(F.col("pc2") / width).alias("bin_y")
    ).agg(F.count(F.lit(1)).alias("n"))


def plot_feature_means(labelled: DataFrame, features) -> DataFrame:
    return cluster_means(labelled, features).select("feature", "cluster", "mean", display_label().alias("label"))


def agreement(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """(n, rand, adjusted): the share of pairs of rows on which two labellings agree, and that share corrected for chance (Hubert &
    Arabie, 1985), from the counts of rows per pair of labels. Names and numbers of labels play no part."""
    both = a.select(id_col, F.col("cluster").alias("a")).join(b.select(id_col, F.col("cluster").alias("b")), id_col)
    cells = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))

    def pairs(counts: DataFrame, name: str) -> DataFrame:
        return counts.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).alias(name), F.lit(0).alias("one"))
    sides = [cells.groupBy(side).agg(F.sum("n").alias("n")) for side in "ab"]
    facts = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.lit(0).alias("one"))
    for counts, name in ((cells, "s"), (sides[0], "sa"), (sides[1], "sb")):
        facts = facts.join(pairs(counts, name), "one")  # one row each
    every = F.col("n") * (F.col("n") - 1) / 2
    chance, top = F.col("sa") * F.col("sb") / every, (F.col("sa") + F.col("sb")) / 2
    return facts.select(
        "n", F.when(F.col("n") > 1, (every + 2 * F.col("s") - F.col("sa") - F.col("sb")) / every).alias("rand"),
        F.when(F.col("n") > 1, F.when(top == chance, 1.0).otherwise((F.col("s") - chance) / (top - chance))).alias("adjusted"))
