"""K-means from a repeatable k-means++ start, its steps as plain DataFrame jobs, and the built-in estimator."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.functions import kernels
from cohorta.functions.exprs import sq_dist_to
from cohorta.session import stage

#: Up to so many centres are literals of an expression; more go to a numpy kernel. The rows are the same.
LITERAL_CENTRES = 64


def kmeans_fit(df: DataFrame, features, k: int = 5, seed: int = 42):
    """Fitted estimator. The input is held for the passes of the fit; lost pieces are rebuilt from it."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="v").transform(df).select("v")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, featuresCol="v", predictionCol="cluster", maxIter=300, tol=1e-4).fit(vectors)
    finally:
        vectors.unpersist()


def plus_plus_centres(df: DataFrame, id_col: str, features, k: int, seed: int = 42) -> list[list[float]]:
    """k-means++ start (Arthur & Vassilvitskii, 2007): each next centre is a row drawn by its squared distance to the
    nearest centre so far, the first one evenly. Fewer centres come back if there are fewer distinct rows.

    The draw is a race: every row has a number u from a digest of (key, seed, turn), and the least -ln(u) / d2 wins,
    which draws in proportion to d2. It is one minimum per turn, whatever the order or partitioning of the rows, and any engine
    that has the digest draws the same rows.
    """
    centres: list[list[float]] = []
    for turn in range(k):
        digest = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed)), F.lit(str(turn))))
        u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / float(1 << 52)
        rows = assign(df, features, centres) if centres else df.withColumn("d2", F.lit(1.0))
        drawn = rows.filter("d2 > 0").agg(F.min(F.struct((-F.log(u) / F.col("d2")).alias("race"), id_col, *features))).first()[0]
        if drawn is None:
            break
        centres.append([float(drawn[f]) for f in features])
    return centres


def _means(df: DataFrame, features, centres) -> list[tuple[int, list[float]]]:
    """centroids of the rows around given centres, summed in tasks; a long run of rounds need not compile each anew."""
    names = list(features)
    cols = ", ".join(f"{f} double" for f in names)
    sums = df.select(*names).mapInArrow(kernels.cluster_sums(np.array(centres, dtype=float), names), f"cluster int, n long, {cols}")
    rows = sums.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in names]).filter("n > 0").collect()
    return sorted((r["cluster"], [r[f] / r["n"] for f in names]) for r in rows)  # k rows


def settle(df: DataFrame, features, centres, max_rounds: int = 300, tol: float = 1e-4) -> list[list[float]]:
    """Centres after assign-and-average rounds until their squared moves add up to at most tol times the mean variance of
    the features, or after max_rounds. With tol 0 it ends where a round moves nothing."""
    limit = 0.0
    if tol:
        spread = df.agg(*[F.coalesce(F.var_pop(f), F.lit(0.0)) for f in features]).first()
        limit = tol * sum(spread) / len(spread)
    for _ in range(max_rounds if centres else 0):
        moved = [list(c) for c in centres]
        for cluster, mean in _means(df, features, centres):
            moved[cluster] = mean
        shift = sum((a - b) ** 2 for old, new in zip(centres, moved) for a, b in zip(old, new))
        centres = moved
        if shift <= limit:
            break
    return centres


def kmeans(df: DataFrame, id_col: str, features, k: int = 5, seed: int = 42, max_rounds: int = 300,
           tol: float = 1e-4) -> DataFrame:
    """(id, cluster) from one seeded k-means++ start; the same rows and seed give the same labels."""
    rows = stage(df.select(id_col, *features), "kmeans")
    centres = settle(rows, features, plus_plus_centres(rows, id_col, features, k, seed), max_rounds, tol)
    return assign(rows, features, centres).select(id_col, "cluster")


def first_centres(df: DataFrame, id_col: str, features, k: int) -> list[list[float]]:
    """The rows with the k smallest keys, as fixed starting centres."""
    return [[float(r[f]) for f in features] for r in df.select(id_col, *features).orderBy(id_col).limit(k).collect()]


def _nearest(features, centres) -> Column:
    if len(centres) > LITERAL_CENTRES:
        points = np.array(centres, dtype=float)

        @F.pandas_udf("struct<d2 double, cluster int>")
        def nearest(*cols: pd.Series) -> pd.DataFrame:
            x, out = np.column_stack(cols).astype(float), []
            for i in range(0, len(x), 1024):
                # The same sum in the same order as the expression, so that ties fall alike.
                d2 = sum((x[i:i + 1024, j, None] - points[None, :, j]) ** 2 for j in range(x.shape[1]))
                at = d2.argmin(axis=1)
                out.append(pd.DataFrame({"d2": d2[np.arange(len(at)), at], "cluster": at.astype("int32")}))
            return pd.concat(out) if out else pd.DataFrame({"d2": [], "cluster": []})
        return nearest(*features)
    return F.array_min(F.array(*[
        F.struct(sq_dist_to(features, c).alias("d2"), F.lit(i).alias("cluster")) for i, c in enumerate(centres)]))


def assign(df: DataFrame, features, centres) -> DataFrame:
    """Add the nearest centre (cluster) and its squared distance (d2); ties go to the smaller number.

    Centres are literals, so the step is one projection: no join and no shuffle.
    """
    if not centres:
        return df.select("*", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("d2"))
    return df.withColumn("near", _nearest(features, centres)).select(
        *df.columns, F.col("near.cluster").alias("cluster"), F.col("near.d2").alias("d2"))


def centroids(assigned: DataFrame, features) -> list[tuple[int, list[float]]]:
    rows = assigned.groupBy("cluster").agg(*[F.avg(f).alias(f) for f in features]).collect()  # k rows
    return sorted((r["cluster"], [r[f] for f in features]) for r in rows)


def lloyd(df: DataFrame, features, centres, rounds: int) -> list[list[float]]:
    """Centres after a number of assign-and-average rounds; a centre without rows stays where it is."""
    centres = [list(c) for c in centres]
    for _ in range(rounds):
        for cluster, mean in centroids(assign(df, features, centres), features):
            centres[cluster] = mean
    return centres


def inertia(assigned: DataFrame) -> DataFrame:
    """Rows and within-cluster squared distance per cluster."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("inertia"))
