"""What the block kernels look at, and density labels over many blocks and tiles."""

import glob
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohorta.functions import kernels
from cohorta.operators import blocks, dbscan
from cohorta.session import CLEANUP, stage


def pair(a, b, **columns):
    """One row of a pair batch: columns maps a name to what block k holds."""
    row = {}
    for side, k in (("a", a), ("b", b)):
        row[f"{side}_block"] = k
        row |= {f"{side}_{name}": values[k] for name, values in columns.items()}
    return row


def test_linked_blocks_are_not_compared_again(monkeypatch):
    g = np.random.default_rng(3)
    x = [g.uniform(0, 1, (2, 40)).tolist() for _ in range(6)]
    root = [[100 * k] * 40 for k in range(6)]
    seen, plain = [], kernels._slabs
    monkeypatch.setattr(kernels, "_slabs", lambda a, b: seen.append(1) or plain(a, b))
    rows = [pair(i, j, x=x, root=root, core=[[True] * 40] * 6) for i in range(6) for j in range(i + 1, 6)]
    out = pa.Table.from_batches(kernels.core_links(4.0)(iter([pa.RecordBatch.from_pylist(rows)])))
    assert out.num_rows == 5 and len(seen) == 5


def test_core_points_are_not_counted_again():
    x, core = [[[0.0, 1.0, 5.0]], [[0.5, 5.5]]], [[True, True, False], [True, False]]
    rows = [pair(0, 1, x=x, core=core, wt=[[1.0, 1.0, 1.0], [2.0, 3.0]], pid=[[1, 2, 3], [4, 5]])]
    (out,) = kernels.count_open(1.0)(iter([pa.RecordBatch.from_pylist(rows)]))
    assert dict(zip(out.column("pid").to_pylist(), out.column("n").to_pylist())) == {3: 3.0, 5: 1.0}


def test_roots_are_components_within_a_block():
    g = np.random.default_rng(4)
    x = g.uniform(0, 6, (2, 60))
    pid = g.permutation(60)
    hit = kernels.within(x, x, 0.5)
    reach = np.linalg.matrix_power(hit.astype(float), 60) > 0
    assert (kernels._local_roots(hit, pid) == [pid[row].min() for row in reach]).all()


def test_a_block_is_unpacked_once(monkeypatch):
    g = np.random.default_rng(5)
    x = [g.normal(size=(3, 20)).tolist() for _ in range(5)]
    cluster = [g.integers(0, 4, 20).tolist() for _ in range(5)]
    seen, plain = [], kernels._mat
    monkeypatch.setattr(kernels, "_mat", lambda *a: seen.append(1) or plain(*a))
    rows = [pair(i, j, x=x, cluster=cluster, wt=[[1.0] * 20] * 5, pid=[list(range(20 * k, 20 * k + 20)) for k in range(5)])
            for i in range(5) for j in range(i, 5)]
    out = pa.Table.from_batches(kernels.distance_sums()(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(seen) == 5
    got = out.group_by(["pid", "other"]).aggregate([("dist", "sum"), ("n", "sum")]).to_pylist()
    points, own = np.concatenate([np.array(v) for v in x], axis=1), np.concatenate(cluster)
    for r in got:
        d = np.sqrt(((points - points[:, [r["pid"]]]) ** 2).sum(axis=0))[own == r["other"]]
        assert r["dist_sum"] == pytest.approx(d.sum()) and r["n_sum"] == len(d)
    assert len(got) == 100 * 4


@pytest.mark.parametrize("eps,need", [(0.35, 4), (0.6, 6)])
def test_density_labels_over_many_blocks(spark, monkeypatch, eps, need):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 32)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "BLOCKS_PER_PART", 4)
    g = np.random.default_rng(6)
    x = np.concatenate([g.normal(c, 0.5, (150, 2)) for c in ((0, 0), (3, 0), (0, 4))] + [g.uniform(-2, 6, (150, 2))])
    rows = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(x)], "id long, a double, b double")
    got = [r["cluster"] for r in dbscan.dbscan(rows, "id", ["a", "b"], eps, need).orderBy("id").collect()]
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= need
    comp = np.where(core, np.arange(len(x)), len(x))
    while True:
        low = np.where(core, np.where(near & core[None, :], comp[None, :], len(x)).min(axis=1), len(x))
        if (low == comp).all():
            break
        comp = low
    number = {c: k for k, c in enumerate(sorted(set(comp[core])))}
    reached = np.where(near & core[None, :], comp[None, :], len(x)).min(axis=1)
    assert got == [number.get(c, -1) for c in reached]
    assert len(number) > 1 and -1 in got


def test_a_staged_table_leaves_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}

    before, wanted = files(), spark.conf.get(CLEANUP, "false")
    got = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert sorted(r["count"] for r in got.collect()) == [142] + [143] * 6 and spark.conf.get(CLEANUP) == wanted
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
