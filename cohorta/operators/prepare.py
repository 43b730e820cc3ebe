"""Feature choice, projection, null-drop and feature transforms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.functions.exprs import missing, total, z, zs

# Survey column names and their selection order.
MANDATORY = ("RIDAGEYR", "RIAGENDR")
OPTIONAL = ("BMXBMI", "BPXSY1", "BPXDI1", "LBXTC", "LBXTR", "SMQ020", "ALQ101")
ALTERNATIVES = (("LBXGLU", "LBXGH", "LBXGLT"), ("LBXHDL", "LBDLDL"))


def choose_features(columns) -> list[str]:
    """Mandatory columns, the optional ones present, and the first present of each alternative group."""
    have = set(columns)
    lacking = [c for c in MANDATORY if c not in have]
    if lacking:
        raise ValueError(f"mandatory column {lacking[0]} is not in the table")
    chosen = [*MANDATORY, *(c for c in OPTIONAL if c in have)]
    firsts = (next((c for c in group if c in have), None) for group in ALTERNATIVES)
    return chosen + [c for c in firsts if c]


def complete_rows(df: DataFrame, id_col: str, features) -> DataFrame:
    """Key and features of the rows that miss none of them."""
    return df.select(id_col, *features).na.drop("any", subset=list(features))


def dropna_effect(df: DataFrame, features) -> DataFrame:
    kinds = dict(df.dtypes)
    gap = F.lit(False)
    for f in features:
        gap = gap | missing(f, kinds[f])
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(F.when(~gap, 1)).alias("rows_after"),
        F.count(F.when(gap, 1)).alias("rows_dropped"),
    )


@dataclass(frozen=True)
class Scaler:
    features: tuple
    mean: tuple
    std: tuple

    def columns(self):
        for f, m, s in zip(self.features, self.mean, self.std):
            yield ((F.col(f) - F.lit(m)) / F.lit(s or 1.0)).alias(z(f))


def _moments(df: DataFrame, features):
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}_mean"), F.stddev_pop(f).alias(f"{f}_std")]
    return df.agg(*aggs)


def fit_scaler(df: DataFrame, features) -> Scaler:
    """Mean and population standard deviation; one aggregate, 2d numbers to the driver."""
    row = _moments(df, features).first()
    return Scaler(
        tuple(features),
        tuple(float(row[f"{f}_mean"] or 0.0) for f in features),
        tuple(float(row[f"{f}_std"] or 0.0) for f in features),
    )


def scaler_params(df: DataFrame, features) -> DataFrame:
    pairs = F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}_mean").alias("mean"), F.col(f"{f}_std").alias("std"))
        for f in features]))
    return _moments(df, features).select(pairs)


def standardize(df: DataFrame, features, scaler: Scaler | None = None) -> DataFrame:
    """Add z_<feature> columns; a constant column becomes 0."""
    scaler = scaler or fit_scaler(df, features)
    return df.select("*", *scaler.columns())


def feature_correlation(df: DataFrame, features) -> DataFrame:
    """Correlation of every feature pair, long form, from one aggregate."""
    fs = list(features)
    upper = [(i, j) for i in range(len(fs)) for j in range(i, len(fs))]
    row = df.agg(*[F.corr(fs[i], fs[j]).alias(f"c{i}_{j}") for i, j in upper])
    cells = [
        F.struct(F.lit(fs[i]).alias("feature_a"), F.lit(fs[j]).alias("feature_b"),
                 F.col(f"c{min(i, j)}_{max(i, j)}").alias("corr"))
        for i in range(len(fs)) for j in range(len(fs))
    ]
    return row.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class Components:
    features: tuple
    loadings: np.ndarray   # features x k, largest-magnitude loading of each component positive
    explained: tuple

    def columns(self):
        for j in range(self.loadings.shape[1]):
            yield total(F.col(z(f)) * F.lit(float(v)) for f, v in zip(self.features, self.loadings[:, j])).alias(
                f"pc{j + 1}")


def fit_components(df: DataFrame, features, k: int = 2) -> Components:
    """Principal components of standardised columns; only a d x k matrix reaches the driver."""
    vectors = VectorAssembler(inputCols=zs(features), outputCol="v").transform(df.select(*zs(features)))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    load = model.pc.toArray().copy()
    for j in range(k):
        if load[np.argmax(np.abs(load[:, j])), j] < 0:
            load[:, j] *= -1
    return Components(tuple(features), load, tuple(float(v) for v in model.explainedVariance.toArray()))


def project(df: DataFrame, comps: Components, *keep) -> DataFrame:
    return df.select(*keep, *comps.columns())
