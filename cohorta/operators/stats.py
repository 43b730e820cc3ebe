"""Profiles of tables and statistics of clusters. Each is one grouped aggregate with map-side combining."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.functions.exprs import fixed, half_even_2, missing
from cohorta.operators.dbscan import NOISE

# Noise share and cluster counts behind the density quality flag.
TOO_NOISY, TOO_FEW, TOO_MANY = 0.5, 2, 10
# Columns whose means describe a group.
KEY_COLUMNS = {
    "mean_age": "RIDAGEYR", "mean_gender": "RIAGENDR", "mean_bmi": "BMXBMI",
    "mean_systolic": "BPXSY1", "mean_diastolic": "BPXDI1",
}


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def _per_column(df: DataFrame, columns, name: str, **cells) -> DataFrame:
    """One aggregate over all columns, turned to one row per column."""
    aggs = [fn(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, fn in cells.items()]
    rows = [
        F.struct(F.lit(c).alias(name), *[F.col(f"{k}_{i}").alias(k) for k in cells]) for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def dtypes(df: DataFrame) -> DataFrame:
    """(position, column, dtype, filled): declared types with the number of filled cells."""
    kinds, order = dict(df.dtypes), {c: i for i, c in enumerate(df.columns)}
    return _per_column(
        df, df.columns, "column",
        position=lambda c: F.max(F.lit(order[c])), dtype=lambda c: F.max(F.lit(kinds[c])),
        filled=lambda c: F.count(F.when(~missing(c, kinds[c]), 1)))


def missing_by_column(df: DataFrame, columns=None) -> DataFrame:
    kinds = dict(df.dtypes)
    return _per_column(
        df, columns or df.columns, "feature", missing=lambda c: F.count(F.when(missing(c, kinds[c]), 1)))


def missing_total(df: DataFrame) -> DataFrame:
    return missing_by_column(df).agg(F.sum("missing").alias("missing_total"))


def _by_cluster(df: DataFrame, features, **stats) -> DataFrame:
    """(cluster, feature, stat...) from one groupBy."""
    aggs = [fn(f).alias(f"{f}_{s}") for f in features for s, fn in stats.items()]
    rows = [F.struct(F.lit(f).alias("feature"), *[F.col(f"{f}_{s}").alias(s) for s in stats]) for f in features]
    return df.groupBy("cluster").agg(*aggs).select("cluster", F.inline(F.array(*rows)))


def cluster_stats_full(df: DataFrame, features) -> DataFrame:
    """Mean, sample deviation, least and greatest value; noise is a group like the others."""
    return _by_cluster(df, features, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max)


def cluster_stats_rounded(df: DataFrame, features) -> DataFrame:
    """Mean and sample deviation at two decimals, half to even."""
    return _by_cluster(
        df, features, mean=lambda f: half_even_2(F.avg(f)), std=lambda f: half_even_2(F.stddev_samp(f)))


def cluster_stats_wide(df: DataFrame, features) -> DataFrame:
    """The rounded statistics with one <feature>_<stat> column each, as the statistics file has them."""
    return df.groupBy("cluster").agg(*[
        half_even_2(fn(f)).alias(f"{f}_{s}")
        for f in features for s, fn in (("mean", F.avg), ("std", F.stddev_samp))])


def cluster_means(df: DataFrame, features) -> DataFrame:
    return _by_cluster(df, features, mean=F.avg)


def cluster_sizes(df: DataFrame, k: int) -> DataFrame:
    """(cluster, size, share_pct) for the labels 0..k-1, empty ones included."""
    counts = df.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    total = F.sum("size").over(Window.partitionBy())
    sized = counts.withColumn("total", total)  # a window over one row per cluster
    wanted = df.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return wanted.join(sized, "cluster", "left").select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"),
        F.coalesce(F.col("size") / F.col("total") * 100, F.lit(0.0)).alias("share"),
    ).select("cluster", "size", fixed("share", 1).alias("share_pct"))


def cluster_sizes_non_noise(df: DataFrame) -> DataFrame:
    return df.filter(F.col("cluster") != NOISE).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def label_facts(df: DataFrame, *keys) -> DataFrame:
    """(n_clusters, noise_count, noise_ratio, total_samples), per key when keys are given."""
    # Counting by label first leaves one row per label to the final step, however large a cluster is.
    sizes = df.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("size"))
    noise = F.coalesce(F.sum(F.when(F.col("cluster") == NOISE, F.col("size"))), F.lit(0))
    return sizes.groupBy(*keys).agg(
        F.count(F.when(F.col("cluster") != NOISE, 1)).alias("n_clusters"),
        noise.alias("noise_count"),
        (noise / F.sum("size")).alias("noise_ratio"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_samples"))


def distinct_labels(df: DataFrame) -> DataFrame:
    return df.select("cluster").distinct().orderBy("cluster")


def quality_flag(df: DataFrame) -> DataFrame:
    """Too much noise, else too few clusters, else many clusters, else ok."""
    noisy = F.col("noise_ratio") > TOO_NOISY
    flag = F.when(noisy, "too_much_noise").when(F.col("n_clusters") < TOO_FEW, "too_few_clusters").when(
        F.col("n_clusters") > TOO_MANY, "many_clusters").otherwise("ok")
    return label_facts(df).select("n_clusters", "noise_ratio", flag.alias("quality"))


def key_means(df: DataFrame) -> DataFrame:
    """(cluster, size, mean_*) per cluster; a column the table lacks gives null."""
    means = [
        (F.avg(c) if c in df.columns else F.max(F.lit(None).cast("double"))).alias(name)
        for name, c in KEY_COLUMNS.items()]
    return df.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *means)
