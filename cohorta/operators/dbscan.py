"""Density clustering as range-count joins, connected components and a border rule.

Order-free form of the sequential method (Ester et al., 1996): a row is core when at least ``min_samples`` rows
lie within ``eps`` (itself included); clusters are the components of core rows within ``eps`` of each other,
numbered by their smallest core id; a border row takes the smallest number in reach; the rest is noise (-1).

Node pairs that lie wholly within ``eps`` are settled by their totals, so a dense region costs one row per
node pair, whatever number of rows it holds.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.functions import kernels
from cohorta.operators.blocks import Blocks, RangePairs, pack_tree, range_pairs, run_pairs, sums_by
from cohorta.operators.keys import Collapsed, collapse, connected_components, dense_index
from cohorta.session import cut, stage

NOISE = -1


def _mirror(pairs: DataFrame, level: str) -> DataFrame:
    """Unordered node pairs seen from both ends; a node paired with itself counts once."""
    a, b = F.col(f"a_{level}"), F.col(f"b_{level}")
    return pairs.select(a.alias("node"), b.alias("peer")).union(
        pairs.filter(a != b).select(b.alias("node"), a.alias("peer")))


def _peers(pairs: DataFrame, level: str, facts: DataFrame) -> DataFrame:
    """(node, fact columns of each node wholly in reach of it)."""
    return _mirror(pairs, level).join(facts.withColumnRenamed(level, "peer"), "peer").drop("peer")


@dataclass(frozen=True)
class DensityInput:
    """Distinct points in blocks; shared by runs with different parameters."""
    copies: Collapsed
    blocks: Blocks


def density_input(df: DataFrame, id_col: str, features) -> DensityInput:
    copies = collapse(df, id_col, features)
    return DensityInput(copies, pack_tree(copies.points, features, copies.n_points))


class Density:
    """The steps of one run, each computed when first asked for."""

    def __init__(self, source: DensityInput, eps: float, min_samples: int):
        self.source, self.blocks = source, source.blocks
        self.eps2, self.min_samples = float(eps) * float(eps), min_samples

    @cached_property
    def pairs(self) -> RangePairs:
        return range_pairs(self.blocks, self.eps2)

    def _whole(self, points: DataFrame, seen: DataFrame) -> DataFrame:
        """points with n: rows seen in open pairs and those of nodes wholly in reach."""
        out = points.join(seen.groupBy("pid").agg(F.sum("n").alias("n_open")), "pid", "left")
        parts = ["coalesce(n_open, 0D)"]
        for level, inside in self.pairs.inside:
            weights = self.blocks.heads().groupBy(level).agg(F.sum("w").alias("w_node"))
            totals = _peers(inside, level, weights).groupBy("node").agg(F.sum("w_node").alias(f"n_{level}"))
            out = out.join(totals.withColumnRenamed("node", level), level, "left")
            parts.append(f"coalesce(n_{level}, 0D)")
        return out.select(*points.columns, F.expr(" + ".join(parts)).cast("long").alias("n"))

    @cached_property
    def counts(self) -> DataFrame:
        """part, block, pid, w, n: rows within eps of each point, itself included."""
        seen = run_pairs(
            self.blocks, self.pairs.open, kernels.count_within(self.eps2), "pid long, n double",
            ("pid", "wt", "x"), ("pid", "wt", "x"), sums_by("pid", values=("n",)))
        return stage(self._whole(self.blocks.points(), seen), "density")

    @cached_property
    def cores(self) -> DataFrame:
        """part, block, pid, core. The own block alone makes most points of a dense region core; only the others, whose
        counts are then whole, meet further blocks."""
        own = stage(self.blocks.table.select("part", "block", "pid", "wt", "x").mapInArrow(
            kernels.count_own(self.eps2), "part int, block long, pid long, w double, n_own double").select(
            "part", "block", "pid", (F.col("n_own") >= self.min_samples).alias("core")), "own-cores")
        done = own.groupBy("block").agg(F.min("core").alias("done"))
        open_ = self.pairs.open
        for side in "ab":
            open_ = open_.join(done.select(F.col("block").alias(f"{side}_block"), F.col("done").alias(f"{side}_done")), f"{side}_block")
        open_ = open_.filter("NOT (a_done AND b_done)").select("a_block", "b_block")
        columns = ("pid", "wt", "x", "core")
        seen = run_pairs(
            self.blocks.with_arrays(own.select("block", "pid", "core"), "core"), open_, kernels.count_open(self.eps2),
            "pid long, n double", columns, columns, sums_by("pid", values=("n",)))
        return stage(self._whole(own, seen).select(
            "part", "block", "pid", (F.col("core") | (F.col("n") >= self.min_samples)).alias("core")), "cores")

    @cached_property
    def components(self) -> DataFrame:
        """pid, comp for core points; comp is the smallest core id of the component. Core points of a block that reach each
        other within it are one root, so what moves and is linked is one row per root."""
        blk = self.blocks.with_arrays(self.cores.select("block", "pid", "core"), "core")
        roots = blk.table.select("block", "pid", "x", "core").mapInArrow(
            kernels.block_roots(self.eps2), "block long, root array<long>")
        blk = replace(blk, table=stage(blk.table.join(roots, "block"), "roots"))
        cores = blk.points("core", "root").filter("core").select("part", "block", "pid", "root")
        roots = cut(cores.select("part", "block", "root").distinct())
        live = roots.select("block").distinct()
        open_ = self.pairs.open
        for side in ("a_block", "b_block"):
            open_ = open_.join(live.withColumnRenamed("block", side), side, "left_semi")
        columns = ("x", "core", "root")
        links = run_pairs(blk, open_.filter("a_block <> b_block"), kernels.core_links(self.eps2), "u long, v long",
                          columns, columns)
        for level, inside in self.pairs.inside:
            first = roots.groupBy(level).agg(F.min("root").alias("first"))
            # All cores of a node that lies wholly in reach of a node with a core share one component:
            # each is linked to the first core of one such node, and node to node by first cores.
            mutual = _peers(inside, level, first).join(
                first.withColumnRenamed("first", "own").withColumnRenamed(level, "node"), "node")
            anchor = mutual.groupBy("node").agg(F.min("first").alias("v"))
            links = links.union(mutual.select("own", "first")).union(
                roots.join(anchor.withColumnRenamed("node", level), level).select(F.col("root").alias("u"), "v"))
        found = connected_components(links, roots.select(F.col("root").alias("v")))
        return cut(cores.join(found.withColumnRenamed("v", "root"), "root").select("pid", "comp"))

    @cached_property
    def reached(self) -> DataFrame:
        """pid, comp for border points: smallest component with a core point in reach."""
        placed = cut(self.cores.select("part", "block", "pid").join(self.components, "pid", "left").select(
            "part", "block", "pid", F.coalesce("comp", F.lit(NOISE).cast("long")).alias("comp")))
        blk = self.blocks.with_arrays(placed.select("block", "pid", "comp"), "comp")
        kind = placed.groupBy("block").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        a, b = (kind.select(*[F.col(c).alias(f"{p}_{c}") for c in kind.columns]) for p in "ab")
        open_ = self.pairs.open.join(a, "a_block").join(b, "b_block").filter(
            "(a_low < 0 AND b_high >= 0) OR (b_low < 0 AND a_high >= 0)").select("a_block", "b_block")
        hits = run_pairs(
            blk, open_, kernels.border_reach(self.eps2), "pid long, comp long",
            ("pid", "x", "comp"), ("pid", "x", "comp"))
        rim, hub = placed.filter("comp < 0").select("part", "block", "pid"), placed.filter("comp >= 0")
        for level, inside in self.pairs.inside:
            least = hub.groupBy(level).agg(F.min("comp").alias("comp"))
            near = _peers(inside, level, least).groupBy("node").agg(F.min("comp").alias("comp"))
            hits = hits.union(rim.join(near.withColumnRenamed("node", level), level).select("pid", "comp"))
        return cut(hits.groupBy("pid").agg(F.min("comp").alias("comp")))

    @cached_property
    def numbers(self) -> DataFrame:
        """comp, cluster: components numbered from 0 by their smallest core id."""
        return dense_index(self.components.select("comp"), "comp", "cluster")

    def _per_row(self, points: DataFrame) -> DataFrame:
        return self.source.copies.spread(points)

    def neighbor_counts(self) -> DataFrame:
        return self._per_row(self.counts.select(
            "pid", F.col("n").alias("n_neighbors"), (F.col("n") >= self.min_samples).alias("is_core")))

    def core_clusters(self) -> DataFrame:
        return self._per_row(self.components.join(self.numbers, "comp").select("pid", "cluster"))

    def border_clusters(self) -> DataFrame:
        return self._per_row(self.reached.join(self.numbers, "comp").select("pid", "cluster"))

    def labels(self) -> DataFrame:
        named = self.components.union(self.reached.select("pid", "comp")).join(self.numbers, "comp").select(
            "pid", "cluster")
        every = self.cores.select("pid").join(named, "pid", "left").select(
            "pid", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))
        return self._per_row(every)


def dbscan(df: DataFrame, id_col: str, features, eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """(id, cluster) with -1 for noise."""
    return Density(density_input(df, id_col, features), eps, min_samples).labels()


def noise_share(labels: DataFrame) -> float:
    share = labels.agg(F.avg(F.when(F.col("cluster") == NOISE, 1.0).otherwise(0.0))).first()[0]
    return float(share or 0.0)


# First parameters, the noise share that triggers a second run, and its parameters.
FIRST_TRY = (0.8, 15)
RETRY_ABOVE = 0.5
SECOND_TRY = (1.0, 10)


def dbscan_adaptive(df: DataFrame, id_col: str, features) -> DataFrame:
    """First parameters, or the looser ones when more than half of the rows come out as noise."""
    source = density_input(df, id_col, features)
    labels = cut(Density(source, *FIRST_TRY).labels())
    if noise_share(labels) > RETRY_ABOVE:
        labels = Density(source, *SECOND_TRY).labels()
    return labels
