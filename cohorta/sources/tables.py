"""Parquet inputs and the survey view built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SURVEY_ID = "SEQN"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer, with measurements derived from its urgent orders; none gives nulls."""
    orders = load(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("ap"),
        F.min("o_totalprice").alias("mn"), F.max("o_totalprice").alias("mx"))
    people = load(spark, folder, "customer")
    return people.join(orders, people["c_custkey"] == orders["o_custkey"], "left").selectExpr(
        "c_custkey AS SEQN",
        "CAST(floor((c_acctbal + 1000) / 11000 * 81) AS double) AS RIDAGEYR",
        "CAST(1 + c_custkey % 2 AS double) AS RIAGENDR",
        "CAST(round(16 + ap / 500000 * 36, 1) AS double) AS BMXBMI",
        "CAST(round(92 + mx / 500000 * 70, 0) AS double) AS BPXSY1",
        "CAST(round(50 + mn / 500000 * 60, 0) AS double) AS BPXDI1",
        "CAST(round(110 + (mx - mn) / 500000 * 160, 0) AS double) AS LBXTC",
        "CAST(1 + c_nationkey % 2 AS double) AS SMQ020",
        "CAST(CASE WHEN c_nationkey = 24 THEN 9 WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2 ELSE 1 END "
        "AS double) AS ALQ101",
        "CAST(4.6 + n * 0.35 AS double) AS LBXGH")
