"""Helpers on keys: distributed numbering, ordered prefixes, duplicate collapse, components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohorta.session import cut, parallelism, stage

#: Rows of a table that may be broadcast once they have been counted.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """The same table, sent to all executors if a count finds it small; a join then moves none of its other side."""
    df = stage(df, "small")
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def dense_index(keys: DataFrame, key: str, name: str) -> DataFrame:
    """Number distinct keys 0, 1, 2, ... in order, without sorting them in one task."""
    spark = keys.sparkSession
    spot = cut(
        keys.select(key).distinct().repartitionByRange(parallelism(spark), key).sortWithinPartitions(key)
        .withColumn("at", F.monotonically_increasing_id())
    ).select(key, F.shiftright("at", 33).alias("slot"), (F.col("at") % (1 << 33)).alias("place"))
    # One row per range partition, so the running total is over a bounded table.
    sizes = spot.groupBy("slot").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("slot", F.coalesce(
        F.sum("size").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("before"))
    return spot.join(F.broadcast(before), "slot").select(
        key, (F.col("place") + F.col("before")).cast("int").alias(name))


#: Relative rank error of the sketches that a cut is read from is one over this.
SKETCH_ACCURACY = 2000


def cut_prefix(df: DataFrame, mark: Column, n: int) -> DataFrame:
    """Rows that hold the n with the smallest mark (nulls are smallest) and not many more; all rows if there are fewer.

    Each partition sketches the ranks of its marks, and a limit is read from the merged sketch whose rank lies above n by
    more than the sketch can be wrong, so no row is lost and none need be counted. While the sketch is too coarse for n,
    as on a very large table, the cut is repeated below the limit. So a final sort reads about n rows (ties with the limit
    besides), not n rows of every partition.
    """
    rows, error = df.withColumn("_mark", mark), 1 / SKETCH_ACCURACY
    shares = [2 ** (k / 4) * 4 * error for k in range(60) if 2 ** (k / 4) * 4 * error < 1]
    before = None
    while True:
        got = rows.agg(F.count("_mark").alias("n"), F.percentile_approx("_mark", shares, SKETCH_ACCURACY).alias("at")).first()
        total = got["n"]
        fit = [k for k, s in enumerate(shares) if (s - 2 * error) * total >= n]
        if not fit or total == before:
            return rows.drop("_mark")
        rows, before = rows.filter(F.col("_mark").isNull() | (F.col("_mark") <= F.lit(got["at"][fit[0]]))), total
        if shares[fit[0]] * total <= 4 * n or total <= SKETCH_ACCURACY:
            return rows.drop("_mark")


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest keys. Numeric keys are first cut to about n rows; other keys are merged from each
    partition's own first n."""
    if isinstance(df.schema[key].dataType, NumericType):
        df = cut_prefix(df, F.col(key), n)
    return df.orderBy(key).limit(n)


@dataclass(frozen=True)
class Collapsed:
    rows: DataFrame      # the keyed input rows
    points: DataFrame    # distinct feature vectors: pid (smallest id), wt (copies), features
    n_rows: int
    n_points: int
    id_col: str
    by: tuple            # columns that identify a point

    @property
    def has_copies(self) -> bool:
        return self.n_points != self.n_rows

    def spread(self, values: DataFrame) -> DataFrame:
        """Hand per-point values (keyed by pid) back to every row."""
        if not self.has_copies:
            return values.withColumnRenamed("pid", self.id_col)
        keys = [f"_by{i}" for i in range(len(self.by))]  # apart from any name the values may use

        def keyed(df, col):
            return df.select(col, *[F.col(c).alias(k) for c, k in zip(self.by, keys)])
        known = keyed(self.points, "pid").join(values, "pid")
        return keyed(self.rows, self.id_col).join(known, keys).drop("pid", *keys)


def collapse(df: DataFrame, id_col: str, features, within=()) -> Collapsed:
    """Replace exact copies by one weighted point; copies are combined before the shuffle."""
    by = [*within, *features]
    points = stage(
        df.groupBy(*by).agg(F.min(id_col).alias("pid"), F.count(F.lit(1)).alias("wt")), "points")
    size = points.agg(F.count(F.lit(1)).alias("m"), F.coalesce(F.sum("wt"), F.lit(0)).alias("n")).first()
    return Collapsed(df, points, size["n"], size["m"], id_col, tuple(by))


def connected_components(edges: DataFrame, vertices: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest vertex of the component of each vertex: alternating large-star and small-star rounds.

    (Kiveris et al., 2014.) Edges are (u, v), vertices are (v); each round rewires edges towards smaller ids.
    """
    e = cut(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        ends = e.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select("v", F.lit(0), F.lit(1)))
        loose = ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if loose.filter("up > 1 OR up + down > 1").isEmpty():  # every edge already points at a root
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return vertices.join(e.select(F.col("u").alias("v"), F.col("v").alias("root")), "v", "left").select(
        "v", F.coalesce("root", "v").alias("comp"))
