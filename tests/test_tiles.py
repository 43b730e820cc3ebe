"""Blocks and tiles: what moves, what is opened, and results above the size that may be broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.functions import kernels
from cohorta.functions.exprs import zs
from cohorta.operators import blocks, prepare, silhouette, ward
from cohorta.operators.keys import collapse
from cohorta.session import stage
from cohorta.sources.tables import survey


def shuffled(spark):
    """Bytes that all stages so far have written to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    no_quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = sc.statusStore().stageList(None, False, False, no_quantiles, spark._jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def cloud(spark, n, dims):
    value = [(F.xxhash64("id", F.lit(j)) / 9.3e18).alias(f"f{j}") for j in range(dims)]
    return spark.range(n).select(F.col("id").alias("pid"), F.lit(1).cast("long").alias("wt"), *value), [
        f"f{j}" for j in range(dims)]


def test_all_pairs_move_less_than_three_times_at_twice_the_points(spark):
    moved = []
    for n in (100_000, 200_000):
        df, fs = cloud(spark, n, 2)
        blk = blocks.pack(df, fs, n)
        start = shuffled(spark)
        blocks.run_tiles(blk, None, lambda batches: iter([b for b in batches if False]), "pid long", ("pid", "x"), ("pid", "x")
                         ).count()
        moved.append(shuffled(spark) - start)
    assert 0 < moved[0] and moved[1] < 3 * moved[0]


def test_silhouette_above_the_broadcast_size(spark, monkeypatch):
    n, dims = 26_000, 256
    plain, sizes = blocks.run_tiles, []
    monkeypatch.setattr(blocks, "run_tiles", lambda blk, *rest: sizes.append(blk.payload_bytes) or plain(blk, *rest))
    df, fs = cloud(spark, n, dims)
    df = stage(df.select(F.col("pid").alias("id"), (F.col("pid") % 3).cast("int").alias("cluster"), *fs), "wide")
    got = silhouette.silhouette(df, "id", fs).first()
    rows = df.toPandas().sort_values("id")
    x, own = rows[fs].to_numpy(), rows["cluster"].to_numpy()
    square, score = (x ** 2).sum(axis=1), np.zeros(n)
    for k in range(0, n, 2000):
        d = np.sqrt(np.maximum(square[k:k + 2000, None] + square - 2 * x[k:k + 2000] @ x.T, 0))
        d[np.arange(len(d)), np.arange(k, k + len(d))] = 0
        means = np.stack([d[:, own == c].sum(axis=1) for c in range(3)], axis=1)
        size = np.bincount(own)
        mine = own[k:k + 2000]
        line = np.arange(len(d))
        a = means[line, mine] / (size[mine] - 1)
        rest = means / size
        rest[line, mine] = np.inf
        b = rest.min(axis=1)
        score[k:k + 2000] = (b - a) / np.maximum(a, b)
    assert len(sizes) == 1 and sizes[0] > 48 << 20
    assert got["n"] == n and got["silhouette"] == pytest.approx(score.mean(), abs=1e-9)


def test_tree_leaves_part_codes_and_hold_every_row():
    g = np.random.default_rng(1)
    x = np.column_stack([g.normal(size=4000), g.integers(0, 2, 4000) * 2.0, g.normal(size=4000)])
    leaves = list(blocks._leaf_rows(x, np.arange(4000), 512))
    assert sorted(np.concatenate(leaves)) == list(range(4000)) and max(map(len, leaves)) <= 512
    assert all(len(np.unique(x[rows, 1])) == 1 for rows in leaves)
    same = list(blocks._leaf_rows(np.ones((1300, 2)), np.arange(1300), 512))
    assert [len(rows) for rows in same] == [512, 512, 276]
    tree = blocks._upper_tree(x, 7)
    assert sorted(t[1] for t in tree if t[0] < 0) == list(range(7))


def test_tree_opens_fewer_pairs_than_the_curve(spark, sf):
    folder = sf.replace("0.001", "0.01")
    table = survey(spark, folder)
    fs = prepare.choose_features(table.columns)
    rows = prepare.standardize(prepare.complete_rows(table, "SEQN", fs), fs)
    copies = collapse(rows, "SEQN", zs(fs))

    def work(blk):  # pairs of points that are opened
        size = blk.table.select("block", "n")
        pairs = blocks.range_pairs(blk, 1.0).open
        return pairs.join(size.withColumnsRenamed({"block": "a_block", "n": "a"}), "a_block").join(
            size.withColumnsRenamed({"block": "b_block", "n": "b"}), "b_block").agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert 2 * work(blocks.pack_tree(copies.points, zs(fs), copies.n_points)) < work(
        blocks.pack(copies.points, zs(fs), copies.n_points))


def test_ward_keeps_partners_and_merges_as_without(spark):
    g = np.random.default_rng(7)
    x = np.concatenate([g.normal(size=(300, 3)), g.integers(0, 4, (100, 3))])
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "id long, a double, b double, c double")
    fs = ["a", "b", "c"]

    def tidy(merges):
        return sorted((round(r[0], 9), r[1], r[2], r[3]) for r in merges.collect())
    state = ward._unsought(collapse(df, "id", fs).points, fs)
    near = ward._partnered(state, fs, 400)
    after = stage(ward._merge(near, fs), "after")
    kept = after.filter("NOT stale")
    assert 0 < kept.count() < after.count()
    fresh = {r["pid"]: (r["npid"], r["cost"]) for r in ward._partnered(ward._unsought(after, fs), fs, after.count()).collect()}
    assert all(fresh[r["pid"]][1] == r["cost"] for r in kept.collect())
    spread = x + g.normal(scale=1e-6, size=x.shape)  # without ties, all orders agree
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(spread)], "id long, a double, b double, c double")
    assert tidy(ward.ward_merges(df, "id", fs, 20)) == tidy(ward.ward_merges(df, "id", fs, 1000))


def test_bound_of_clusters_that_do_not_search():
    x, w = np.array([[0.0, 1.0, 3.0]]), np.ones(3)
    assert kernels.ward_bound(x, w, np.array([1.0, 0.0, 0.0])).tolist() == [1.0, -1.0, -1.0]


def test_work_of_a_few_thousand_points_is_spread_over_tasks(spark):
    df, fs = cloud(spark, 20_000, 2)
    blk = blocks.pack(df, fs, 20_000)

    def where(batches):
        from pyspark import TaskContext
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([b.num_rows])], ["at", "n"])
    near = blk.table.select(F.col("block").alias("a_block")).crossJoin(blk.table.select(F.col("block").alias("b_block"))).filter(
        "a_block <= b_block")
    n = blk.table.count()
    for pairs in (None, near):
        got = blocks.run_tiles(blk, pairs, where, "at int, n long", ("pid", "x"), ("pid", "x")).groupBy("at").agg(F.sum("n")).collect()
        assert sum(r[1] for r in got) == n * (n + 1) // 2 and len(got) > 6


def test_kernels_decide_as_differences_do_without_taking_them_all(monkeypatch):
    g = np.random.default_rng(4)
    plain = kernels.sq_dists

    def refuse(*_):
        raise AssertionError("all differences taken")
    for x in (g.normal(size=(4, 90)), g.integers(0, 4, (4, 90)) * 0.25 + 1000, g.normal(size=(4, 90)) * 10.0 ** g.integers(-9, 9, 90)):
        a, b = x[:, :50], x[:, 30:]
        d2 = plain(a, b)
        monkeypatch.setattr(kernels, "sq_dists", refuse)
        for limit in (0.0, 0.25, float(np.median(d2)), float(d2.max())):
            assert (kernels.within(a, b, limit) == (d2 <= limit)).all()
        bound = np.sort(d2, axis=1)[:, 5]
        r, c, d = kernels._within_bounds(a, b, bound)
        assert (np.stack([r, c]) == np.stack(np.nonzero(d2 <= bound[:, None]))).all() and (d == d2[r, c]).all()
        wa, wb = g.integers(1, 9, 50).astype(float), g.integers(1, 9, 60).astype(float)
        cost = d2 * kernels._ward_weight(wa[:, None], wb[None, :])
        r, c, least = kernels._cheapest(a, wa, b, wb, np.full(50, np.inf))
        assert (r == np.arange(50)).all() and (c == cost.argmin(axis=1)).all() and (least == cost.min(axis=1)).all()
        monkeypatch.setattr(kernels, "sq_dists", plain)
