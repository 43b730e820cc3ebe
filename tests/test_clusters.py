"""Clusterings and scores against brute force on small fixtures, copies and hot groups included."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohorta.functions import kernels
from cohorta.functions.exprs import zs
from cohorta.operators import blocks, compare, dbscan, keys, kmeans, neighbors, prepare, sampling, silhouette, spectral, ward
from cohorta.sources.tables import survey

FS = ["a", "b", "c"]


def frame(spark, x):
    rows = [(int(i) * 3 + 1, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5)


def points(seed=0, n=160, copies=50):
    """Blobs, a grid of ties, scattered rows, and a third of all rows as copies of one point."""
    g = np.random.default_rng(seed)
    blob = np.concatenate([g.normal(c, 0.25, (n // 4, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 3, 2))])
    far = g.uniform(-6, 6, (n // 4, 3))
    x = np.concatenate([blob, far, np.tile([[0.1, 0.2, 0.0]], (copies, 1))])
    return x[g.permutation(len(x))]


@pytest.fixture(scope="module")
def data(spark):
    x = points()
    return x, frame(spark, x).cache()


@pytest.fixture(params=[9, 4])
def block_bits(request, monkeypatch):
    """Default blocks, and tiny ones with several range partitions so that every level of pruning is used."""
    monkeypatch.setattr(blocks, "BLOCK_BITS", request.param)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 1 << request.param)
    if request.param == 4:
        monkeypatch.setattr(blocks, "BLOCKS_PER_PART", 2)
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(blocks, "BAND_ROWS", 60)


def labels_of(df, key="id"):
    return np.array([r["cluster"] for r in df.orderBy(key).collect()])


def d2_of(x):
    return ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)


def sequential_dbscan(x, eps, need):
    near = d2_of(x) <= eps * eps
    core = near.sum(1) >= need
    out, c = np.full(len(x), -1), 0
    for i in np.flatnonzero(core):
        if out[i] >= 0:
            continue
        todo, out[i] = [i], c
        while todo:
            j = todo.pop()
            if core[j]:
                for k in np.flatnonzero(near[j] & (out < 0)):
                    out[k] = c
                    todo.append(k)
        c += 1
    return out


@pytest.mark.parametrize("eps,need", [(0.3, 4), (0.8, 6), (2.5, 10), (30.0, 3), (0.01, 500)])
def test_dbscan(spark, data, block_bits, eps, need):
    x, df = data
    assert (labels_of(dbscan.dbscan(df, "id", FS, eps, need)) == sequential_dbscan(x, eps, need)).all()


def test_dbscan_counts(spark, data, block_bits):
    x, df = data
    run = dbscan.Density(dbscan.density_input(df, "id", FS), 0.8, 6)
    got = [r["n_neighbors"] for r in run.neighbor_counts().orderBy("id").collect()]
    assert got == list((d2_of(x) <= 0.8 * 0.8).sum(1))


def test_dense_region_is_settled_by_nodes(spark, monkeypatch):
    """Rows in one small ball leave no block pair to be decided point by point."""
    monkeypatch.setattr(blocks, "BLOCK_BITS", 4)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    x = np.random.default_rng(1).uniform(0, 0.1, (300, 3))
    source = dbscan.density_input(frame(spark, x), "id", FS)
    run = dbscan.Density(source, 1.0, 5)
    assert run.pairs.open.count() == 0
    assert set(labels_of(run.labels())) == {0}


def test_noise_shrinks_with_eps(spark, data):
    _, df = data
    source = dbscan.density_input(df, "id", FS)
    noise = [dbscan.noise_share(dbscan.Density(source, e, 5).labels()) for e in (0.2, 0.6, 1.5)]
    assert noise == sorted(noise, reverse=True)


def brute_knn(x, k):
    d2, n = d2_of(x), len(x)
    out = []
    for i in range(n):
        order = sorted((j for j in range(n) if j != i), key=lambda j: (d2[i, j], j))
        out.append([i] + order[: k - 1])
    return out


def test_knn_graph(spark, data, block_bits):
    x, df = data
    got = {}
    for r in neighbors.knn_graph(df, "id", FS, 6).orderBy("id", "rank").collect():
        got.setdefault((r["id"] - 1) // 3, []).append((r["neighbor"] - 1) // 3)
    assert got == dict(enumerate(brute_knn(x, 6)))


def brute_ward(x):
    """One merge at a time, smallest cost first, ties by ids; returns heights and the cut function."""
    groups = {i: [i] for i in range(len(x))}
    merges = []
    while len(groups) > 1:
        best = None
        keys = sorted(groups)
        for ai, a in enumerate(keys):
            for b in keys[ai + 1:]:
                na, nb = len(groups[a]), len(groups[b])
                gap = x[groups[a]].mean(0) - x[groups[b]].mean(0)
                cost = 2 * na * nb / (na + nb) * (gap @ gap)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, a, b)
        cost, a, b = best
        groups[a] += groups.pop(b)
        merges.append((np.sqrt(cost), a, b))
    return merges


def cut_brute(merges, n, k):
    lab = np.arange(n)
    for _, a, b in merges[: n - k]:
        lab[lab == lab[b]] = lab[a]
    return lab


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("finish_at", [1024, 8])
def test_ward(spark, finish_at, block_bits):
    x = points(3, 48, 12)
    want = brute_ward(x)
    df = frame(spark, x)
    merges = ward.ward_merges(df, "id", FS, finish_at)
    got = sorted(r["height"] for r in merges.collect())
    assert np.allclose(got, sorted(h for h, _, _ in want), atol=1e-9)
    for k in (2, 5):
        lab = labels_of(ward.cut_merges(df, "id", merges, k))
        assert same_partition(lab, cut_brute(want, len(x), k))


def test_ward_cuts_from_a_finer_one(spark, block_bits):
    """Every cut taken from the one into most clusters is the cut taken by itself; copies give tied heights."""
    x = points(4, 40, 9)
    df = frame(spark, x)
    merges = ward.ward_merges(df, "id", FS)
    finest = ward.cut_merges(df, "id", merges, len(x) - 3).cache()
    for k in (1, 2, 3, 6, 40, len(x) - 3):
        want = ward.cut_merges(df, "id", merges, k)
        got = ward.cut_merges(df, "id", merges, k, (len(x) - 3, finest))
        assert got.dtypes == want.dtypes
        assert (labels_of(got) == labels_of(want)).all() and len(set(labels_of(got))) == k


def brute_silhouette(x, lab):
    d = np.sqrt(d2_of(x))
    s = np.zeros(len(x))
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        s[i] = (b - a) / max(a, b) if max(a, b) else 0.0
    return s


def test_silhouette(spark, data, block_bits):
    x, df = data
    df = df.selectExpr("*", "CAST(CASE WHEN id = 4 THEN 9 ELSE id % 3 END AS int) AS cluster")
    lab = labels_of(df)
    want = brute_silhouette(x, lab)
    got = np.array([r["s"] for r in silhouette.silhouette_by_row(df, "id", FS).orderBy("id").collect()])
    assert np.allclose(got, want, atol=1e-9)
    assert abs(silhouette.silhouette(df, "id", FS).first()["silhouette"] - want.mean()) < 1e-9
    row = silhouette.silhouette_sampled(df, "id", FS, 1000).first()
    assert row["n_anchors"] == len(x) and abs(row["estimate"] - want.mean()) < 1e-9


def brute_means(x, labellings):
    out = {}
    for name, lab in labellings.items():
        solid = lab >= 0
        out[name] = brute_silhouette(x[solid], lab[solid]).mean()
    return out


@pytest.mark.parametrize("held", [1 << 22, 300])
def test_sums_of_a_tile_for_several_labellings(monkeypatch, held):
    """Two bands and one with itself, whole and parted to small sums; a copy, a row without a cluster, and weights."""
    monkeypatch.setattr(kernels, "HELD_SUMS", held)
    monkeypatch.setattr(kernels, "CHUNK", 16)
    monkeypatch.setattr(kernels, "STRIP", 5)
    g = np.random.default_rng(8)
    x, w = g.normal(size=(3, 120)), g.integers(1, 4, 120).astype(float)
    x[:, 7] = x[:, 90]
    labs = [g.integers(0, 3, 120).tolist(), g.integers(5, 9, 120).tolist()]
    labs[1][7] = None
    rows = [{"pid": list(range(s, s + 40)), "wt": w[s:s + 40].tolist(), "x": x[:, s:s + 40].tolist(),
             "one": labs[0][s:s + 40], "two": labs[1][s:s + 40]} for s in (0, 40, 80)]
    kind = pa.schema([("pid", pa.list_(pa.int64())), ("wt", pa.list_(pa.float64())), ("x", pa.list_(pa.list_(pa.float64()))),
                      ("one", pa.list_(pa.int32())), ("two", pa.list_(pa.int32()))])
    table = pa.Table.from_pylist(rows, kind)
    run, got = kernels.band_sums(["one", "two"]), {}
    for one, two in (([0, 1], None), ([0, 1], [2]), ([2], None)):
        for batch in run(table, np.array(one), two and np.array(two)):
            for r in batch.to_pylist():
                key = r["pid"], r["lab"], r["other"]
                got[key] = got.get(key, 0.0) + r["dist"]
    d = np.sqrt(d2_of(x.T))
    want = {(i, k, c): (d[i] * w)[[v == c for v in lab]].sum() for k, lab in enumerate(labs) for c in set(lab) - {None}
            for i in range(120) if lab[i] is not None}
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(want[key], abs=1e-9) for key in want)


def test_silhouettes_of_several_labellings_at_once(spark, data, block_bits):
    """Noise in one labelling, copies that one of them parts, rows that another has twice, and more points than a few."""
    x, df = data
    copy = (d2_of(x)[:, [np.flatnonzero((x == x[:, None]).all(axis=2).sum(axis=1) > 1)[0]]] == 0)[:, 0]
    g = np.random.default_rng(5)
    labs = {"plain": np.where(x[:, 0] > 1, 1, 0), "noisy": np.where(x[:, 1] > 2.5, 3, np.where(x[:, 2] > 1, -1, 2)),
            "parted": np.where(copy, np.arange(len(x)) % 2, g.integers(0, 4, len(x)))}
    labs["parted"][~copy] += x[~copy, 0] > 9
    tables = {}
    for name, lab in labs.items():
        rows = [(int(i) * 3 + 1, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, lab)) if c >= 0]
        tables[name] = spark.createDataFrame(rows, "id long, a double, b double, c double, cluster int")
    want = brute_means(x, labs)
    twice = np.concatenate([np.arange(len(x)), np.arange(0, len(x), 2)])
    tables["twice"] = tables["plain"].union(tables["plain"].filter("(id - 1) / 3 % 2 = 0"))
    want["twice"] = brute_means(x[twice], {"twice": labs["plain"][twice]})["twice"]
    got = silhouette.silhouettes(tables, FS)
    assert got == pytest.approx(want, abs=1e-9)


def test_silhouette_of_many_points_equals_that_of_block_pairs(spark, monkeypatch):
    x = points(6, 240, 40)
    df = frame(spark, x).selectExpr("*", "CAST(id % 4 AS int) AS cluster")
    few = silhouette.silhouette_by_row(df, "id", FS).orderBy("id").collect()
    monkeypatch.setattr(silhouette, "FEW_POINTS", 10)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks, "BLOCK_BITS", 4)
    many = silhouette.silhouette_by_row(df, "id", FS).orderBy("id").collect()
    assert [r["id"] for r in few] == [r["id"] for r in many] and [r["cluster"] for r in few] == [r["cluster"] for r in many]
    for c in ("a", "b", "s"):
        assert np.allclose([r[c] for r in few], [r[c] for r in many], atol=1e-12)


def test_silhouette_guards(spark, data):
    _, df = data
    one = df.selectExpr("*", "0 AS cluster")
    noisy = df.selectExpr("*", "CAST(CASE WHEN id % 2 = 0 THEN -1 ELSE 0 END AS int) AS cluster")
    two = df.selectExpr("*", "CAST(id % 2 AS int) AS cluster")
    assert silhouette.silhouette_strict(one, "id", FS).first()["silhouette"] is None
    assert silhouette.silhouette_strict(noisy, "id", FS).first()["silhouette"] is None
    assert silhouette.silhouette_strict(two, "id", FS).first()["silhouette"] is not None
    assert silhouette.silhouette_non_noise(noisy, "id", FS).first()["silhouette"] is None
    assert {m: silhouette.silhouette_by(two, "id", FS, m).first()["mode"] for m in ("exact", "anchors", "squared")} == {
        m: m for m in ("exact", "anchors", "squared")}


def test_lloyd_matches_numpy(spark, data):
    x, df = data
    centres = kmeans.first_centres(df, "id", FS, 4)
    got = kmeans.lloyd(df, FS, centres, 3)
    c = x[:4].copy()
    for _ in range(3):
        lab = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        for j in range(4):
            if (lab == j).any():
                c[j] = x[lab == j].mean(0)
    assert np.allclose(got, c)


def test_vote_breaks_ties_by_smaller_label(spark):
    x = np.array([[0, 0, 0], [2, 0, 0], [1, 0, 0], [9, 9, 9]])
    df = frame(spark, x)
    sample = df.filter("id IN (1, 4)").selectExpr("*", "CAST(CASE WHEN id = 1 THEN 7 ELSE 3 END AS int) AS cluster")
    got = {r["id"]: r["cluster"] for r in sampling.propagate(df, sample, "id", FS, 2).collect()}
    assert got == {1: 7, 4: 3, 7: 3, 10: 3}


def test_spectral_embedding_spans_eigenvectors(spark, sf):
    table = survey(spark, sf)
    fs = prepare.choose_features(table.columns)
    rows = prepare.standardize(prepare.complete_rows(table, "SEQN", fs), fs)
    edges = spectral.affinity(neighbors.knn_graph(rows, "SEQN", zs(fs), 10), "SEQN").cache()
    deg = spectral.graph_degree(edges)
    comps = spectral.graph_components(edges)
    k = comps.select("comp").distinct().count() + 2
    emb = spectral.embedding(edges, deg, comps, k, tol=1e-6).orderBy("id").toPandas()
    ids = {v: i for i, v in enumerate(emb["id"])}
    w = np.zeros((len(ids), len(ids)))
    for r in edges.collect():
        if r["src"] != r["dst"]:
            w[ids[r["src"]], ids[r["dst"]]] = r["weight"]
    s = np.sqrt(w.sum(1))
    val, vec = np.linalg.eigh(w / np.outer(s, s))
    want = vec[:, ::-1][:, :k]
    got = emb[[f"e{j}" for j in range(k)]].to_numpy() * s[:, None]
    q, _ = np.linalg.qr(got)
    assert np.linalg.svd(q.T @ want)[1].min() > 1 - 1e-6


def test_spectral_labels_respect_blobs(spark):
    g = np.random.default_rng(5)
    x = np.concatenate([g.normal(c, 0.1, (30, 3)) for c in ((0, 0, 0), (5, 0, 0), (0, 5, 0))])
    df, want = frame(spark, x), np.repeat([0, 1, 2], 30)
    assert (labels_of(spectral.spectral(df, "id", FS, 3)) == want).all()
    assert (labels_of(spectral.spectral_discretize(df, "id", FS, 3)) == want).all()
    assert (labels_of(spectral.spectral_sampled(df, "id", FS, 54, 3)) == want).all()


def test_discretize_with_more_components_than_clusters(spark):
    g = np.random.default_rng(6)
    sizes = (30, 28, 26, 12)
    x = np.concatenate([g.normal(c, 0.1, (n, 3)) for c, n in zip(((0, 0, 0), (9, 0, 0), (0, 9, 0), (0, 0, 9)), sizes)])
    got = labels_of(spectral.spectral_discretize(frame(spark, x), "id", FS, 3))
    assert len(got) == len(x) and (got[:84] == np.repeat([0, 1, 2], sizes[:3])).all()
    assert set(got[84:]) <= {0, 1, 2}


def test_degenerate_inputs(spark):
    one = frame(spark, np.zeros((1, 3)))
    same = frame(spark, np.zeros((40, 3)))
    none = one.filter("id < 0")
    assert labels_of(dbscan.dbscan(one, "id", FS, 1.0, 5)).tolist() == [-1]
    assert set(labels_of(dbscan.dbscan(same, "id", FS, 1.0, 5))) == {0}
    assert dbscan.dbscan(none, "id", FS).count() == 0
    assert ward.ward_merges(same, "id", FS).filter("height = 0").count() == 39
    assert ward.ward_merges(one, "id", FS).count() == 0
    assert neighbors.knn_graph(same, "id", FS, 10).count() == 400
    assert neighbors.knn_graph(one, "id", FS, 10).count() == 1


def test_order_and_partitioning_do_not_matter(spark, data):
    _, df = data
    a = labels_of(dbscan.dbscan(df.repartition(11), "id", FS, 0.8, 6))
    b = labels_of(dbscan.dbscan(df.coalesce(1).orderBy("c"), "id", FS, 0.8, 6))
    assert (a == b).all()


def test_plus_plus_start_draws_by_distance_and_repeats(spark, data):
    x, df = data
    first = kmeans.plus_plus_centres(df, "id", FS, 4, seed=5)
    assert first == kmeans.plus_plus_centres(df.repartition(3), "id", FS, 4, seed=5)
    assert first != kmeans.plus_plus_centres(df, "id", FS, 4, seed=6)
    two = spark.createDataFrame([(k, float(k % 2), 0.0, 0.0) for k in range(40)], "id long, a double, b double, c double")
    assert sorted(kmeans.plus_plus_centres(two, "id", FS, 5)) == [[0.0, 0.0, 0.0], [1.0, 0.0, 0.0]]
    assert kmeans.plus_plus_centres(two.limit(0), "id", FS, 5) == []
    # A row of three times the squared distance is drawn three times as often.
    line = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 1.0, 0.0, 0.0), (2, -3.0 ** 0.5, 0.0, 0.0)], "id long, a double, b double, c double")
    drawn = [kmeans.plus_plus_centres(line, "id", FS, 2, seed=s) for s in range(24)]
    second = [c[1][0] for c in drawn if c[0][0] == 0.0]
    assert len(second) >= 4 and sum(v < 0 for v in second) > len(second) / 2
    want = kmeans.lloyd(df, FS, first, 6)
    assert np.allclose(kmeans.settle(df, FS, first, 6, 0.0), want)


def test_vote_by_blocks_is_the_vote_of_a_small_sample(spark, data, block_bits, monkeypatch):
    x, df = data
    sample = df.filter("id % 2 = 1").withColumn("cluster", (F.col("id") % 3).cast("int"))
    rest = df.filter("id % 2 = 0")
    plain = sorted(map(tuple, neighbors.knn_vote(sample, rest, "id", FS, 5).collect()))
    monkeypatch.setattr(neighbors, "SENT_VOTERS", 0)
    assert len(plain) > 50 and sorted(map(tuple, neighbors.knn_vote(sample, rest, "id", FS, 5).collect())) == plain
    few = sample.limit(3)
    assert neighbors.knn_vote(few, rest, "id", FS, 5).count() == rest.count()
    assert neighbors.knn_vote(sample.limit(0), rest, "id", FS, 5).collect() == []


def test_prefix_is_cut_before_it_is_sorted(spark):
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_000).alias("key"), F.col("id")).repartition(64)
    df = df.withColumn("key", F.when(F.col("id") % 5000 == 0, None).otherwise(F.col("key")))
    for n in (1, 30, 5000, 300_000):
        near = keys.cut_prefix(df, F.col("key"), n)
        assert min(n, 200_000) <= near.count() <= max(4 * n, 40 * 200_000 / keys.SKETCH_ACCURACY)
    got = [r["key"] for r in keys.first_rows(df, "key", 100).collect()]
    want = sorted((r["key"] for r in df.select("key").collect()), key=lambda v: (v is not None, v or 0))[:100]
    assert got == want
    same = spark.range(1000).select(F.lit(7).alias("key"))
    assert keys.first_rows(same, "key", 10).count() == 10 and keys.first_rows(same.limit(0), "key", 10).count() == 0
    assert [r["id"] for r in sampling.hash_sample(df.select("id"), "id", 50).collect()] == [
        r["id"] for r in df.orderBy(F.md5(F.col("id").cast("string")), "id").limit(50).collect()]


def test_spectral_step_moves_no_edges(spark):
    edges = spark.range(4000).selectExpr("id % 200 AS src", "(id * 7) % 200 AS dst", "0.5D AS weight")
    nodes = spark.range(200).selectExpr("id", "id % 3 AS comp", "1D AS s")
    vec = spectral._Vectors(edges, nodes, 3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = vec.step_frame(1.5, -0.5, 0.0)
        plan = step._jdf.queryExecution().sparkPlan().toString(), step._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan[1]
        # One exchange, of partial sums: it lies above the join and above the partial aggregate.
        assert plan[1].count("Exchange hashpartitioning") == 1
        assert plan[1].index("Exchange hashpartitioning") < plan[1].index("SortMergeJoin")
        got = {r["id"]: r["y0"] for r in step.collect()}
        y = {r["id"]: r["y0"] for r in vec.state.collect()}
        want = {k: -0.5 * v for k, v in y.items()}
        for r in edges.collect():
            want[r["dst"]] += 1.5 * r["weight"] * y[r["src"]]
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    tables = [vec.edges.name, vec.kept.name]
    vec.close()
    assert not [t for t in tables if spark.catalog.tableExists(t)]


def test_eigen_check_tells_a_wrong_embedding(spark, sf):
    table = survey(spark, sf)
    fs = prepare.choose_features(table.columns)
    rows = prepare.standardize(prepare.complete_rows(table, "SEQN", fs), fs)
    edges = spectral.affinity(neighbors.knn_graph(rows, "SEQN", zs(fs), 10), "SEQN").cache()
    degree, comps = spectral.graph_degree(edges).cache(), spectral.graph_components(edges).cache()
    k = comps.select("comp").distinct().count() + 1
    emb = spectral.embedding(edges, degree, comps, k)
    good = spectral.eigen_check(edges, degree, emb, k).toPandas()
    assert good["residual"].max() < 1e-3 and good["overlap"].max() < 1e-6 and (good["value"] > 1 - 1e-9).sum() == k - 1
    last = f"e{k - 1}"
    turned = emb.withColumn(last, F.col(last) + F.when(F.col("id") % 7 == 0, 0.02).otherwise(0.0))
    assert spectral.eigen_check(edges, degree, turned, k).toPandas()["residual"].max() > 1e-3
    twice = emb.withColumn(last, F.col("e0"))
    assert spectral.eigen_check(edges, degree, twice, k).toPandas()["overlap"].max() > 0.99


def test_agreement_of_labellings(spark):
    def table(values):
        return spark.createDataFrame(list(enumerate(values)), "id long, cluster int")
    same, other = table([0, 0, 1, 1, 2, 2]), table([5, 5, 3, 3, -1, -1])
    assert tuple(compare.agreement(same, other, "id").first()) == (6, 1.0, 1.0)
    got = compare.agreement(table([0, 0, 1, 1]), table([0, 1, 0, 1]), "id").first()
    assert got["n"] == 4 and got["rand"] == pytest.approx(1 / 3) and got["adjusted"] == pytest.approx(-0.5)
    assert tuple(compare.agreement(same.limit(0), other, "id").first()) == (0, None, None)
