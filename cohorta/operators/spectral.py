"""Spectral clustering on a nearest-neighbour graph held as an edge table.

Eigenvectors come from Chebyshev-filtered subspace iteration (Zhou & Saad, 2007): a step is one join of the
edges with the current vectors and one grouped sum; only p x p inner products reach the driver. Edges are written once,
in buckets of their source, and the vectors of each step in the same buckets of their row, so edges stay where they are
in every step: what moves is one partial sum per task and target. The
eigenvalue 1 has one eigenvector per connected component, known exactly, so components are resolved first and
the iteration works beside them.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.operators.keys import connected_components, dense_index, small
from cohorta.operators.kmeans import kmeans
from cohorta.operators.neighbors import knn_graph
from cohorta.operators.sampling import hash_sample, propagate
from cohorta.session import bucketed, cut, stage

# Neighbours in the graph and neighbours in the label vote.
GRAPH_NEIGHBORS = 10
VOTE_NEIGHBORS = 5


def affinity(knn: DataFrame, id_col: str) -> DataFrame:
    """(src, dst, weight): half of the directed graph plus half of its transpose, diagonal included."""
    a = knn.select(F.col(id_col).alias("src"), F.col("neighbor").alias("dst"))
    both = a.union(a.select("dst", "src"))
    return both.groupBy("src", "dst").agg((F.count(F.lit(1)) * 0.5).alias("weight"))


def graph_degree(edges: DataFrame) -> DataFrame:
    """(id, degree): weight of the edges of each row, without its own loop."""
    return edges.groupBy(F.col("src").alias("id")).agg(
        F.sum(F.when(F.col("src") != F.col("dst"), F.col("weight")).otherwise(0.0)).alias("degree"))


def normalized_affinity(edges: DataFrame, degree: DataFrame) -> DataFrame:
    """(src, dst, weight) of D^-1/2 W D^-1/2 without loops (von Luxburg, 2007)."""
    a = degree.select(F.col("id").alias("src"), F.col("degree").alias("ds"))
    b = degree.select(F.col("id").alias("dst"), F.col("degree").alias("dd"))
    return edges.filter("src <> dst").join(a, "src").join(b, "dst").select(
        "src", "dst", (F.col("weight") / F.sqrt(F.col("ds") * F.col("dd"))).alias("weight"))


def graph_components(edges: DataFrame) -> DataFrame:
    """(id, comp): smallest id of the connected component of each row."""
    return connected_components(
        edges.select(F.col("src").alias("u"), F.col("dst").alias("v")),
        edges.filter("src = dst").select(F.col("src").alias("v"))).withColumnRenamed("v", "id")


def _mix(names, weights) -> str:
    return " + ".join(f"{n} * {float(w)!r}D" for n, w in zip(names, weights))


class _Vectors:
    """p vectors over the rows of a graph: columns y0.. (current) and x0.. (previous filter step)."""

    def __init__(self, edges: DataFrame, nodes: DataFrame, p: int):
        self.p, self.kept = p, None
        self.edges = bucketed(edges.repartition("src"), "src", "edges")
        self.y, self.x = [f"y{j}" for j in range(p)], [f"x{j}" for j in range(p)]
        # Repeatable noise from the key; any start that is not orthogonal to the answer will do.
        noise = [f"xxhash64(id, {j}) / 9.3e18D AS y{j}" for j in range(p)]
        self._keep(nodes.repartition("id").selectExpr("id", "comp", "s", *noise))

    def _keep(self, state: DataFrame):
        """Write the vectors of a step in their buckets; the ones before are no longer read."""
        before, self.kept = self.kept, bucketed(state, "id", "vectors")
        self.state = self.kept.table
        if before:
            before.drop()

    def close(self):
        self.edges.drop()
        self.kept.drop()

    def _flow(self) -> DataFrame:
        """Edges with the vectors of their sources; both lie in the same buckets."""
        return self.edges.table.join(self.state.select(F.col("id").alias("src"), *self.y), "src")

    def _times(self) -> DataFrame:
        """The graph matrix times the current vectors, beside the state, as m0..."""
        sums = [F.sum(F.col("weight") * F.col(y)).alias(f"m{j}") for j, y in enumerate(self.y)]
        prod = self._flow().groupBy(F.col("dst").alias("id")).agg(*sums)
        return self.state.join(prod, "id", "left").fillna(0.0, [f"m{j}" for j in range(self.p)])

    def deflate(self):
        """Remove the component indicators, whose eigenvalue is 1."""
        part = self.state.groupBy("comp").agg(
            *[(F.sum(F.col("s") * F.col(y)) / F.sum(F.col("s") * F.col("s"))).alias(f"c{j}")
              for j, y in enumerate(self.y)])
        self._keep(self.state.join(part, "comp").repartition("id").selectExpr(
            "id", "comp", "s", *[f"{y} - s * c{j} AS {y}" for j, y in enumerate(self.y)]))

    def step_frame(self, a: float, b: float, c: float) -> DataFrame:
        """a * (matrix times y) + b * y + c * x as y, and the old y as x: one join and one grouped sum."""
        old = f"{c!r}D * x{{0}}" if c else "0D"
        own = self.state.selectExpr(
            "id", "comp", "s", *[f"{b!r}D * y{j} + {old.format(j)} AS y{j}" for j in range(self.p)],
            *[f"y{j} AS x{j}" for j in range(self.p)])
        flow = self._flow().selectExpr(
            "dst AS id", "CAST(NULL AS bigint) AS comp", "CAST(NULL AS double) AS s",
            *[f"{a!r}D * weight * y{j} AS y{j}" for j in range(self.p)], *[f"0D AS x{j}" for j in range(self.p)])
        return own.union(flow).groupBy("id").agg(
            F.max("comp").alias("comp"), F.max("s").alias("s"), *[F.sum(v).alias(v) for v in self.y + self.x])

    def _step(self, a: float, b: float, c: float):
        self._keep(self.step_frame(a, b, c))

    def filter(self, low: float, degree: int):
        """Chebyshev polynomial that is small on [-1, low] and grows above it."""
        half, mid = (low + 1) / 2, (low - 1) / 2
        self._step(1 / half, -mid / half, 0.0)
        for _ in range(1, degree):
            self._step(2 / half, -2 * mid / half, -1.0)

    def ritz(self):
        """Rotate to Ritz vectors; returns their values and residual norms, largest value first."""
        p = self.p
        cells = [(i, j) for i in range(p) for j in range(i, p)]
        sums = []
        for tag, l, r in (("g", "y", "y"), ("h", "y", "m"), ("k", "m", "m")):
            sums += [f"sum({l}{i} * {r}{j}) AS {tag}{i}_{j}" for i, j in cells]
        row = self._times().selectExpr(*sums).first()

        def square(tag):
            out = np.zeros((p, p))
            for i, j in cells:
                out[i, j] = out[j, i] = row[f"{tag}{i}_{j}"]
            return out
        g, h, k = square("g"), square("h"), square("k")
        scale = 1 / np.sqrt(np.diag(g))
        w, u = np.linalg.eigh(g * np.outer(scale, scale))
        basis = scale[:, None] * (u[:, w > w.max() * 1e-12] / np.sqrt(w[w > w.max() * 1e-12]))
        theta, v = np.linalg.eigh(basis.T @ h @ basis)
        order = np.argsort(-theta)
        theta, v = theta[order], basis @ v[:, order]
        gaps = np.einsum("ij,ik,kj->j", v, k, v) - theta ** 2
        self.p = len(theta)
        old, self.y, self.x = self.y, [f"y{j}" for j in range(self.p)], [f"x{j}" for j in range(self.p)]
        self.state = self.state.selectExpr(
            "id", "comp", "s", *[f"{_mix(old, v[:, j])} AS y{j}" for j in range(self.p)])
        return theta, np.sqrt(np.maximum(gaps, 0))


def embedding(edges: DataFrame, degree: DataFrame, comps: DataFrame, k: int, spare: int = 4,
              filter_degree: int = 12, tol: float = 2e-4, max_rounds: int = 40) -> DataFrame:
    """(id, e0..e{k-1}): leading eigenvectors of the normalised graph, divided by the root of the degree.

    Component indicators come first (largest components), then the next eigenvectors.
    """
    nodes = cut(degree.join(comps, "id").select("id", "comp", F.sqrt("degree").alias("s")))
    volume = nodes.groupBy("comp").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("s") * F.col("s")).alias("vol"))
    lead = volume.orderBy(F.desc("rows"), "comp").limit(k).collect()
    marks = [
        f"CASE WHEN comp = {r['comp']} THEN {float(1 / np.sqrt(r['vol'] or 1.0))!r}D ELSE 0D END AS e{j}"
        for j, r in enumerate(lead)]
    more = k - len(lead)
    if not more:
        return nodes.selectExpr("id", *marks)
    vec = _Vectors(normalized_affinity(edges, degree), nodes, more + spare)
    low = 0.5
    for _ in range(max_rounds):
        vec.deflate()
        vec.filter(low, filter_degree)
        theta, gap = vec.ritz()
        if gap[:more].max() < tol:
            break
        low = float(np.clip(theta[-1], 0.0, 0.999))
    else:
        raise RuntimeError(f"spectral vectors did not settle in {max_rounds} rounds")
    rest = [f"CASE WHEN s > 0 THEN y{j} / s ELSE 0D END AS e{len(lead) + j}" for j in range(more)]
    found = stage(vec.state.selectExpr("id", *marks, *rest), "embedding")
    vec.close()
    return found


def _embed(df: DataFrame, id_col: str, features, k: int, neighbors: int) -> DataFrame:
    edges = cut(affinity(knn_graph(df, id_col, features, neighbors), id_col))
    return embedding(edges, cut(graph_degree(edges)), cut(graph_components(edges)), k)


def canonical(labels: DataFrame, id_col: str) -> DataFrame:
    """Renumber clusters 0, 1, ... by their smallest member; noise (-1) stays."""
    real = cut(labels.filter("cluster <> -1").groupBy(F.col("cluster").alias("raw")).agg(F.min(id_col).alias("low")))
    names = small(real.join(dense_index(real, "low", "number"), "low").select("raw", "number"))
    return labels.join(names, labels["cluster"] == names["raw"], "left").select(
        id_col, F.coalesce("number", F.lit(-1)).alias("cluster"))


def eigen_check(edges: DataFrame, degree: DataFrame, emb: DataFrame, k: int) -> DataFrame:
    """(vector, value, residual, overlap) of an embedding: for each vector y its Rayleigh value t, the length of M y - t y
    beside that of y, and the largest cosine with another vector. It needs no labels and no order of rows.
    """
    root = degree.select("id", F.sqrt("degree").alias("s"))
    y = emb.join(root, "id").selectExpr("id", *[f"e{j} * s AS y{j}" for j in range(k)])
    sent = normalized_affinity(edges, degree).join(y.withColumnRenamed("id", "src"), "src")
    m = sent.groupBy(F.col("dst").alias("id")).agg(*[F.sum(F.expr(f"weight * y{j}")).alias(f"m{j}") for j in range(k)])
    both = y.join(m, "id", "left").fillna(0.0, [f"m{j}" for j in range(k)])
    sums = [f"sum(y{i} * y{j}) AS g{i}_{j}" for i in range(k) for j in range(i, k)]
    sums += [f"sum(y{j} * m{j}) AS h{j}" for j in range(k)] + [f"sum(m{j} * m{j}) AS q{j}" for j in range(k)]
    rows = []
    for j in range(k):
        others = [f"abs(g{min(i, j)}_{max(i, j)}) / sqrt(g{i}_{i} * g{j}_{j})" for i in range(k) if i != j]
        rows.append(f"struct({j} AS vector, h{j} / g{j}_{j} AS value, sqrt(greatest(q{j} / g{j}_{j} - "
                    f"pow(h{j} / g{j}_{j}, 2), 0D)) AS residual, greatest(0D, {', '.join(others or ['0D'])}) AS overlap)")
    return both.selectExpr(*sums).selectExpr(f"inline(array({', '.join(rows)}))")


def spectral_labels(emb: DataFrame, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """(id, cluster): K-means on a spectral embedding."""
    return canonical(kmeans(emb, "id", [f"e{j}" for j in range(k)], k, seed), "id").withColumnRenamed("id", id_col)


def spectral(df: DataFrame, id_col: str, features, k: int = 5, neighbors: int = GRAPH_NEIGHBORS,
             seed: int = 42) -> DataFrame:
    """(id, cluster): K-means on the spectral embedding."""
    return spectral_labels(_embed(df, id_col, features, k, neighbors), id_col, k, seed)


def discretize(emb: DataFrame, k: int, max_rounds: int = 200) -> DataFrame:
    """(id, cluster): alternate between the nearest axis and the best rotation (Yu & Shi, 2003) until it settles."""
    e = [f"e{j}" for j in range(k)]
    norm = " + ".join(f"{c} * {c}" for c in e)
    # Rows of components beyond the k largest lie at the origin and stay there.
    unit = cut(emb.selectExpr("id", *[f"coalesce(try_divide({c}, sqrt({norm})), 0D) AS {c}" for c in e]))
    # Start axes: the first row, then each time the row least like the axes so far.
    rot = [list(unit.orderBy("id").select(*e).first())]
    seen = "0D"
    for _ in range(1, k):
        seen = f"{seen} + abs({_mix(e, rot[-1])})"
        rot.append(list(unit.selectExpr("id", *e, f"{seen} AS c").orderBy("c", "id").select(*e).first()))
    rot, last = np.array(rot).T, None
    for _ in range(max_rounds):
        axes = ", ".join(f"struct(-({_mix(e, rot[:, j])}) AS a, {j} AS cluster)" for j in range(k))
        labelled = unit.selectExpr("id", *e, f"array_min(array({axes})).cluster AS cluster")
        sums = labelled.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in e]).collect()  # k rows
        cross = np.zeros((k, k))
        for r in sums:
            cross[r["cluster"]] = [r[c] for c in e]
        u, s, vt = np.linalg.svd(cross)
        if last is not None and abs(s.sum() - last) < 1e-12 * max(1.0, last):
            break
        last, rot = s.sum(), vt.T @ u.T
    else:
        raise RuntimeError(f"discretisation did not settle in {max_rounds} rounds")
    return labelled.select("id", "cluster")


def spectral_discretize(df: DataFrame, id_col: str, features, k: int = 5, neighbors: int = GRAPH_NEIGHBORS) -> DataFrame:
    """(id, cluster): the embedding of all rows, discretised."""
    labels = discretize(_embed(df, id_col, features, k, neighbors), k)
    return canonical(labels.withColumnRenamed("id", id_col), id_col)


def spectral_sampled(df: DataFrame, id_col: str, features, sample_rows: int, k: int = 5,
                     neighbors: int = GRAPH_NEIGHBORS) -> DataFrame:
    """(id, cluster): a fit on sample_rows hash-chosen rows, whose labels the others get by vote. The caller names the
    size; a table that is not larger is fitted as a whole."""
    fit_on = cut(hash_sample(df.select(id_col, *features), id_col, sample_rows))
    labels = cut(discretize(_embed(fit_on, id_col, features, k, neighbors), k).withColumnRenamed("id", id_col))
    return canonical(propagate(df, labels, id_col, features, VOTE_NEIGHBORS), id_col)


def spectral_pic(df: DataFrame, id_col: str, features, k: int = 5, neighbors: int = GRAPH_NEIGHBORS,
                 iterations: int = 30) -> DataFrame:
    """(id, cluster) by built-in power iteration: faster, approximate."""
    # The iteration takes each undirected edge once.
    edges = affinity(knn_graph(df, id_col, features, neighbors), id_col).filter("src < dst")
    pic = PowerIterationClustering(k=k, maxIter=iterations, initMode="degree", weightCol="weight")
    return pic.assignClusters(edges).select(F.col("id").alias(id_col), F.col("cluster").cast("int"))


def normalized_cut(edges: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """(ncut): over the clusters, the share of the edge weight at a cluster's nodes that leaves it, summed."""
    a, b = (labels.select(F.col(id_col).alias(end), F.col("cluster").alias(f"c_{end}")) for end in ("src", "dst"))
    both = edges.filter("src <> dst").join(a, "src").join(b, "dst")
    return both.groupBy("c_src").agg(
        F.sum("weight").alias("volume"), F.sum(F.when(F.col("c_src") != F.col("c_dst"), F.col("weight")).otherwise(0.0)).alias(
            "cut")).agg(F.sum(F.col("cut") / F.col("volume")).alias("ncut"))
