"""Named queries: each maps (spark, folder) to a DataFrame over the given tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorta.functions.exprs import r6, zs
from cohorta.operators import compare, kmeans, neighbors, prepare, rules, sampling, silhouette, spectral, stats, ward
from cohorta.operators import dbscan as density
from cohorta.operators.keys import first_rows
from cohorta.plans import batch
from cohorta.session import cut, scratch_path
from cohorta.sources import files
from cohorta.sources.tables import SURVEY_ID as ID
from cohorta.sources.tables import load, survey

K = 5
LLOYD_ROUNDS = 2
DENSE = (1.2, 8)
VOTE_SAMPLE = 400
ANCHORS = 300
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- inputs ----

def _raw(spark, sf) -> tuple[DataFrame, list[str]]:
    table = survey(spark, sf)
    return table, prepare.choose_features(table.columns)


def _complete(spark, sf):
    table, fs = _raw(spark, sf)
    return prepare.complete_rows(table, ID, fs), fs


def _scaled(spark, sf):
    """Standardised rows, written once: every later step starts from the file."""
    rows, fs = _complete(spark, sf)
    rows = cut(rows)
    return prepare.standardize(rows, fs), fs


def _lloyd(spark, sf, rounds=LLOYD_ROUNDS):
    """Rows with K-means labels after fixed rounds from the first k rows; repeatable in any engine."""
    rows, fs = _scaled(spark, sf)
    centres = kmeans.lloyd(rows, zs(fs), kmeans.first_centres(rows, ID, zs(fs), K), rounds)
    return kmeans.assign(rows, zs(fs), centres), fs


def _dense(spark, sf, eps=DENSE[0], min_samples=DENSE[1]):
    """Rows with density labels, noise included."""
    rows, fs = _scaled(spark, sf)
    return rows.join(density.dbscan(rows, ID, zs(fs), eps, min_samples), ID), fs


def _run(spark, sf) -> density.Density:
    rows, fs = _scaled(spark, sf)
    return density.Density(density.density_input(rows, ID, zs(fs)), *DENSE)


def _groups(spark, sf):
    rows, _ = _lloyd(spark, sf)
    return stats.key_means(rows)


def _evaluated(spark, sf):
    return rules.evaluate(_groups(spark, sf))


def _tables(spark, sf):
    lab, fs = _lloyd(spark, sf)
    dense = lab.drop("cluster", "d2").join(density.dbscan(lab, ID, zs(fs), *DENSE), ID)
    return {"kmeans": lab, "dbscan": dense, "raw": lab.drop("cluster")}, fs


def _union(spark, sf):
    return compare.union_labelled(_tables(spark, sf)[0], ID)


def _knn(spark, sf):
    rows, fs = _scaled(spark, sf)
    return neighbors.knn_graph(rows, ID, zs(fs), spectral.GRAPH_NEIGHBORS)


def _edges(spark, sf):
    return cut(spectral.affinity(_knn(spark, sf), ID))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---- sources and sinks ----

@query
def scan_csv_full(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(survey(spark, sf), path)
    return files.read_csv(spark, path, ID)


@query
def scan_first_n(spark, sf):
    return first_rows(survey(spark, sf), ID, 5000)


@query
def scan_first_hundred(spark, sf):
    """A limit smaller than the table."""
    return first_rows(survey(spark, sf), ID, 100)


def _folder(spark, sf):
    root = scratch_path(spark, "folder")
    files.write_csv(survey(spark, sf), f"{root}/survey.csv")
    for name in ("supplier", "part"):
        files.write_csv(load(spark, sf, name), f"{root}/{name}.csv")
    survey(spark, sf).selectExpr("CAST(SEQN AS string) AS t").filter("t IS NULL").write.text(f"{root}/empty.csv")
    files.write_csv(load(spark, sf, "supplier"), f"{root}/supplier.txt")
    return root


@query
def scan_directory_profile(spark, sf):
    return files.directory_profile(spark, _folder(spark, sf))


@query
def scan_directory_columns(spark, sf):
    return files.directory_columns(spark, _folder(spark, sf))


@query
def preview_head(spark, sf):
    return first_rows(survey(spark, sf), ID, 5)


def _labelled(spark, sf):
    tables, fs = _tables(spark, sf)
    every = None
    for name in ("kmeans", "dbscan"):
        part = tables[name].select(F.lit(name).alias("algorithm"), ID, *fs, "cluster")
        every = part if every is None else every.unionByName(part)
    return every


@query
def sink_labelled_roundtrip(spark, sf):
    every, path = _labelled(spark, sf), scratch_path(spark, "labelled")
    files.write_labelled(every, path)
    return files.read_labelled(spark, path, every.schema).select(every.columns)


@query
def sink_labelled_csv_roundtrip(spark, sf):
    """The labelled tables as CSV, the form other tools read."""
    every, path = _labelled(spark, sf), scratch_path(spark, "labelled-csv")
    files.write_labelled_csv(every, path)
    return files.read_labelled_csv(spark, path, every.schema).select(every.columns)


@query
def sink_stats_roundtrip(spark, sf):
    rows, fs = _lloyd(spark, sf)
    path = scratch_path(spark, "stats")
    files.write_csv(stats.cluster_stats_wide(rows, fs), path)
    return files.read_csv(spark, path).withColumn("cluster", F.col("cluster").cast("int"))


def _stored_documents(spark, sf):
    tables, _ = _tables(spark, sf)
    root = scratch_path(spark, "reports")
    every = None
    for name in ("kmeans", "dbscan"):
        doc = rules.document(rules.render(rules.evaluate(stats.key_means(tables[name]))), name)
        every = doc if every is None else every.unionByName(doc)
    files.write_documents(every, root)
    return files.read_documents(spark, root)


@query
def sink_recommendation_text(spark, sf):
    docs = _stored_documents(spark, sf)
    return docs.select("algorithm", F.posexplode(F.split("content", "\n")).alias("line", "text"))


@query
def load_recommendation_docs(spark, sf):
    docs = _stored_documents(spark, sf)
    wanted = spark.createDataFrame([(a,) for a in compare.ALGORITHMS], "algorithm string")
    return wanted.join(docs, "algorithm", "left").select("algorithm", "content")


def _stored_labels(spark, sf):
    path = scratch_path(spark, "labelled")
    files.write_labelled(_union(spark, sf), path)
    return files.read_labelled(spark, path, f"{ID} long, cluster int, algorithm string")


@query
def load_results_present(spark, sf):
    return files.results_present(_stored_labels(spark, sf))


@query
def load_results_missing(spark, sf):
    return files.results_missing(_stored_labels(spark, sf))


@query
def comparison_formatted(spark, sf):
    return compare.comparison_formatted(compare.compare_algorithms(_union(spark, sf)))


# ---- profiling ----

@query
def profile_shape(spark, sf):
    return stats.shape(survey(spark, sf))


@query
def profile_dtypes(spark, sf):
    return stats.dtypes(survey(spark, sf))


@query
def profile_missing_total(spark, sf):
    return stats.missing_total(survey(spark, sf))


@query
def profile_missing_by_column(spark, sf):
    table, fs = _raw(spark, sf)
    return stats.missing_by_column(table, fs)


@query
def profile_dropna_effect(spark, sf):
    return prepare.dropna_effect(*_raw(spark, sf))


# ---- projections and filters ----

@query
def select_features(spark, sf):
    table, fs = _raw(spark, sf)
    return table.select(ID, *fs)


@query
def select_first_alternative(spark, sf):
    """Both glucose columns present: the earlier one in the declared order is taken."""
    table = survey(spark, sf).withColumn("LBXGLU", F.col("LBXGH") * 18).withColumn("LBDLDL", F.col("LBXTC") / 2)
    return table.select(ID, *prepare.choose_features(table.columns))


@query
def drop_incomplete(spark, sf):
    return _complete(spark, sf)[0]


@query
def filter_cluster(spark, sf):
    rows, fs = _lloyd(spark, sf)
    return rows.filter("cluster = 1").select(ID, *fs, "cluster")


@query
def sample_split(spark, sf):
    rows, _ = _complete(spark, sf)
    rows = cut(rows.select(ID))
    inside, outside = sampling.split(rows, sampling.hash_sample(rows, ID, VOTE_SAMPLE), ID)
    return inside.select(ID, F.lit("sample").alias("part")).unionByName(outside.select(ID, F.lit("rest").alias("part")))


@query
def display_label(spark, sf):
    rows, _ = _dense(spark, sf)
    return rows.select(ID, "cluster", rules.display_label().alias("label"))


# ---- transforms ----

@query
def standardize(spark, sf):
    rows, fs = _complete(spark, sf)
    return _rounded(prepare.standardize(rows, fs).select(ID, *zs(fs)))


@query
def scaler_params(spark, sf):
    return _rounded(prepare.scaler_params(*_complete(spark, sf)))


@query
def feature_correlation(spark, sf):
    return _rounded(prepare.feature_correlation(*_complete(spark, sf)))


def _scores(spark, sf):
    rows, fs = _scaled(spark, sf)
    return prepare.project(rows, prepare.fit_components(rows, fs), ID), rows, fs


@query
def pca_scores(spark, sf):
    return _rounded(_scores(spark, sf)[0])


@query
def pca_invariants(spark, sf):
    scores, rows, fs = _scores(spark, sf)
    return scores.agg(
        r6(F.var_pop("pc1")).alias("var_1"), r6(F.var_pop("pc2")).alias("var_2"),
        F.abs(r6(F.covar_pop("pc1", "pc2"))).alias("cov_12"), F.count(F.lit(1)).alias("n"))


@query
def pca_explained(spark, sf):
    rows, fs = _scaled(spark, sf)
    comps = prepare.fit_components(rows, fs)
    ratios = [F.struct(F.lit(j + 1).alias("component"), F.lit(v).alias("ratio")) for j, v in enumerate(comps.explained)]
    return _rounded(rows.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*ratios)), "n"))


# ---- K-means ----

@query
def kmeans_labels(spark, sf):
    """From a seeded k-means++ start, until a round moves no centre, after 20 rounds at most."""
    rows, fs = _scaled(spark, sf)
    return spectral.canonical(kmeans.kmeans(rows, ID, zs(fs), K, max_rounds=20, tol=0.0), ID)


@query
def kmeans_start(spark, sf):
    """The rows that a seeded k-means++ start draws, in turn."""
    rows, fs = _scaled(spark, sf)
    centres = kmeans.plus_plus_centres(rows, ID, zs(fs), K)
    drawn = spark.createDataFrame([(j, *c) for j, c in enumerate(centres)], "cluster int, " + ", ".join(f"{f} double" for f in zs(fs)))
    return _rounded(drawn)


@query
def kmeans_invariants(spark, sf):
    """All k clusters are used, every row sits with its nearest fitted centre, one more step moves no centre beyond the
    tolerance (of 1e-4, as the fit's), and the fit is no worse than 20 steps from fixed starts, a fifth given."""
    rows, fs = _scaled(spark, sf)
    model = kmeans.kmeans_fit(rows, zs(fs), K)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    labelled = model.transform(VectorAssembler(inputCols=zs(fs), outputCol="v").transform(rows))
    near = cut(kmeans.assign(labelled.withColumnRenamed("cluster", "fitted").drop("v"), zs(fs), centres))
    moved = max(sum((a - b) ** 2 for a, b in zip(centres[j], c)) for j, c in kmeans.centroids(near, zs(fs)))
    plain = kmeans.lloyd(rows, zs(fs), kmeans.first_centres(rows, ID, zs(fs), K), 20)
    bound = kmeans.assign(rows, zs(fs), plain).agg(F.sum("d2")).first()[0]
    return near.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("fitted").alias("n_clusters"),
        F.count(F.when(F.col("fitted") != F.col("cluster"), 1)).alias("n_misplaced"),
        F.lit(moved <= 1e-4).alias("at_rest"),
        (F.sum("d2") <= 1.2 * bound).alias("no_worse_than_fixed_starts"))


@query
def kmeans_assign(spark, sf):
    rows, fs = _lloyd(spark, sf, 0)
    return _rounded(rows.select(ID, "cluster", "d2"))


@query
def kmeans_lloyd_n(spark, sf):
    rows, fs = _lloyd(spark, sf, 3)
    return rows.select(ID, "cluster")


@query
def kmeans_inertia(spark, sf):
    rows, _ = _lloyd(spark, sf)
    return _rounded(kmeans.inertia(rows))


# ---- Ward ----

@query
def ward_labels(spark, sf):
    rows, fs = _scaled(spark, sf)
    return spectral.canonical(ward.ward(rows, ID, zs(fs), K), ID)


@query
def ward_first_round(spark, sf):
    rows, fs = _scaled(spark, sf)
    return _rounded(ward.first_round(rows, ID, zs(fs)))


@query
def ward_merges(spark, sf):
    rows, fs = _scaled(spark, sf)
    return _rounded(ward.ward_merges(rows, ID, zs(fs)))


@query
def ward_cut_k(spark, sf):
    """Cluster counts for every cut from 2 to 8, from one merge table."""
    rows, fs = _scaled(spark, sf)
    merges = ward.ward_merges(rows, ID, zs(fs))
    ks = range(2, 9)
    finest = cut(ward.cut_merges(rows, ID, merges, ks[-1]))
    out = None
    for k in ks:
        sizes = stats.cluster_sizes_non_noise(ward.cut_merges(rows, ID, merges, k, (ks[-1], finest))).select(
            F.lit(k).alias("k"), F.col("cluster").alias("smallest_member"), "size")
        out = sizes if out is None else out.unionByName(sizes)
    return out


@query
def ward_invariants(spark, sf):
    """n-1 merges whose heights account for the whole sum of squares of the data."""
    rows, fs = _scaled(spark, sf)
    return _rounded(ward.ward_merges(rows, ID, zs(fs)).agg(
        F.count(F.lit(1)).alias("n_merges"), (F.sum(F.col("height") * F.col("height")) / 2).alias("sum_of_squares"),
        F.max("size").alias("largest"), F.countDistinct("rgt").alias("absorbed")))


# ---- DBSCAN ----

@query
def dbscan_labels(spark, sf):
    return _dense(spark, sf, 0.5, 5)[0].select(ID, "cluster")


@query
def dbscan_labels_dense(spark, sf):
    return _dense(spark, sf)[0].select(ID, "cluster")


@query
def eps_neighbors(spark, sf):
    return _run(spark, sf).neighbor_counts().select(ID, "n_neighbors")


@query
def dbscan_core(spark, sf):
    return _run(spark, sf).neighbor_counts()


@query
def dbscan_components(spark, sf):
    return _run(spark, sf).core_clusters()


@query
def dbscan_border(spark, sf):
    return _run(spark, sf).border_clusters()


@query
def dbscan_noise(spark, sf):
    return _dense(spark, sf)[0].filter("cluster = -1").select(ID)


@query
def dbscan_adaptive(spark, sf):
    rows, fs = _scaled(spark, sf)
    return density.dbscan_adaptive(rows, ID, zs(fs))


@query
def dbscan_quality_flag(spark, sf):
    rows, fs = _scaled(spark, sf)
    source = density.density_input(rows, ID, zs(fs))
    out = None
    for name, eps, need in (("strict", 0.5, 5), ("dense", *DENSE)):
        flag = stats.quality_flag(density.Density(source, eps, need).labels()).select(F.lit(name).alias("run"), "*")
        out = flag if out is None else out.unionByName(flag)
    return _rounded(out)


# ---- spectral ----

@query
def spectral_labels(spark, sf):
    rows, fs = _scaled(spark, sf)
    return spectral.spectral(rows, ID, zs(fs), K)


@query
def spectral_discretize(spark, sf):
    rows, fs = _scaled(spark, sf)
    return spectral.spectral_discretize(rows, ID, zs(fs), K)


@query
def spectral_invariants(spark, sf):
    """Both spectral labellings of one embedding: all rows, k clusters numbered by their smallest member, and a normalised cut
    not above that of k-means labels from fixed starts. Its vectors are eigenvectors: they stay in direction under the graph
    matrix, have nothing of each other, and as many of them have the value 1 as there are components."""
    rows, fs = _scaled(spark, sf)
    edges = cut(_edges(spark, sf))
    degree, comps = cut(spectral.graph_degree(edges)), cut(spectral.graph_components(edges))
    emb = spectral.embedding(edges, degree, comps, K)
    facts = spectral.eigen_check(edges, degree, emb, K).agg(
        F.count(F.when(F.col("value") > 1 - 1e-9, 1)).alias("n_unit"), (F.max("residual") < 1e-3).alias("at_rest"),
        (F.max("overlap") < 1e-6).alias("apart")).first()
    plain, _ = _lloyd(spark, sf)
    bound = spectral.normalized_cut(edges, plain.select(ID, "cluster"), ID).first()["ncut"]
    out = None
    for name, labels in (("kmeans", spectral.spectral_labels(emb, ID, K)), (
            "discretize", spectral.canonical(spectral.discretize(emb, K).withColumnRenamed("id", ID), ID))):
        labels = cut(labels)
        ncut = spectral.normalized_cut(edges, labels, ID).first()["ncut"]
        firsts = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min(ID).alias("low"))
        part = firsts.select("*", F.dense_rank().over(Window.orderBy("low")).alias("at")).agg(
            F.sum("size").alias("n"), F.count(F.lit(1)).alias("n_clusters"),
            F.max(F.abs(F.col("at") - 1 - F.col("cluster"))).alias("misnumbered")).select(
            F.lit(name).alias("step"), "n", "n_clusters", "misnumbered", F.lit(ncut <= bound + 1e-9).alias("cut_held"),
            F.lit(facts["n_unit"]).cast("long").alias("n_unit"), F.lit(facts["at_rest"]).alias("at_rest"),
            F.lit(facts["apart"]).alias("apart"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def labelling_agreement(spark, sf):
    """How far K-means and density labels, and each with itself, put the same rows together."""
    tables, _ = _tables(spark, sf)
    out = None
    for one, other in (("kmeans", "dbscan"), ("kmeans", "kmeans"), ("dbscan", "dbscan")):
        part = compare.agreement(tables[one], tables[other], ID).select(F.lit(f"{one} {other}").alias("labellings"), "n", "rand", "adjusted")
        out = part if out is None else out.unionByName(part)
    return _rounded(out)


@query
def spectral_pic(spark, sf):
    rows, fs = _scaled(spark, sf)
    return spectral.canonical(spectral.spectral_pic(rows, ID, zs(fs), K), ID)


@query
def knn_graph(spark, sf):
    return _rounded(_knn(spark, sf))


@query
def knn_affinity(spark, sf):
    return _edges(spark, sf)


@query
def graph_degree(spark, sf):
    return spectral.graph_degree(_edges(spark, sf))


@query
def normalized_affinity(spark, sf):
    edges = _edges(spark, sf)
    return _rounded(spectral.normalized_affinity(edges, spectral.graph_degree(edges)))


@query
def graph_components(spark, sf):
    return spectral.graph_components(_edges(spark, sf))


# ---- sampling and label propagation ----

@query
def sample_without_replacement(spark, sf):
    rows, _ = _complete(spark, sf)
    return sampling.hash_sample(rows, ID, VOTE_SAMPLE)


@query
def sample_size_rule(spark, sf):
    return sampling.sample_size_rule(_complete(spark, sf)[0], above=1000)


def _voting(spark, sf):
    rows, fs = _lloyd(spark, sf)
    rows = cut(rows.select(ID, *zs(fs), "cluster"))
    return rows, sampling.hash_sample(rows, ID, VOTE_SAMPLE), fs


@query
def knn_vote(spark, sf):
    rows, sample, fs = _voting(spark, sf)
    return neighbors.knn_vote(sample, sampling.split(rows, sample, ID)[1], ID, zs(fs), spectral.VOTE_NEIGHBORS)


@query
def propagate_full(spark, sf):
    rows, sample, fs = _voting(spark, sf)
    return sampling.propagate(rows, sample, ID, zs(fs), spectral.VOTE_NEIGHBORS)


@query
def canonical_labels(spark, sf):
    rows, _ = _lloyd(spark, sf)
    return spectral.canonical(cut(rows.select(ID, "cluster")), ID)


# ---- quality ----

def _by_smoking(spark, sf):
    rows, fs = _scaled(spark, sf)
    return rows.withColumn("cluster", F.col("SMQ020").cast("int")), fs


@query
def silhouette_exact(spark, sf):
    rows, fs = _by_smoking(spark, sf)
    return _rounded(silhouette.silhouette(rows, ID, zs(fs)))


@query
def silhouette_by_row(spark, sf):
    rows, fs = _by_smoking(spark, sf)
    return _rounded(silhouette.silhouette_by_row(rows, ID, zs(fs)))


@query
def silhouette_by_cluster(spark, sf):
    rows, fs = _lloyd(spark, sf)
    return _rounded(silhouette.silhouette_by_cluster(rows, ID, zs(fs)))


@query
def silhouette_guard_strict(spark, sf):
    """The older guard: noise present gives no score, none present gives one."""
    noisy, fs = _dense(spark, sf)
    clean, _ = _by_smoking(spark, sf)
    a = silhouette.silhouette_strict(noisy, ID, zs(fs)).select(F.lit("noisy").alias("labels"), "n", "silhouette")
    b = silhouette.silhouette_strict(clean, ID, zs(fs)).select(F.lit("clean").alias("labels"), "n", "silhouette")
    return _rounded(a.unionByName(b))


@query
def silhouette_non_noise(spark, sf):
    rows, fs = _dense(spark, sf)
    return _rounded(silhouette.silhouette_non_noise(cut(rows), ID, zs(fs)))


@query
def silhouette_sampled(spark, sf):
    rows, fs = _by_smoking(spark, sf)
    return _rounded(silhouette.silhouette_sampled(rows, ID, zs(fs), ANCHORS))


@query
def silhouette_squared(spark, sf):
    """The linear score on squared distances."""
    rows, fs = _lloyd(spark, sf)
    return _rounded(silhouette.silhouette_squared(rows, ID, zs(fs)))


@query
def silhouette_embeddings(spark, sf):
    """The same score on 64-dimensional labelled vectors."""
    dims = [f"v{i}" for i in range(64)]
    rows = load(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias("cluster"),
        *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(dims)])
    return _rounded(silhouette.silhouette_by_cluster(rows, "vec_id", dims))


# ---- aggregates ----

@query
def cluster_stats_full(spark, sf):
    return _rounded(stats.cluster_stats_full(*_dense(spark, sf)))


@query
def cluster_stats_rounded(spark, sf):
    return stats.cluster_stats_rounded(*_lloyd(spark, sf))


@query
def cluster_means(spark, sf):
    return _rounded(stats.cluster_means(*_lloyd(spark, sf)))


@query
def cluster_sizes(spark, sf):
    rows, _ = _lloyd(spark, sf)
    return stats.cluster_sizes(rows, K + 1)


@query
def cluster_sizes_non_noise(spark, sf):
    return stats.cluster_sizes_non_noise(_dense(spark, sf)[0])


@query
def n_clusters(spark, sf):
    return stats.label_facts(_dense(spark, sf)[0]).select("n_clusters")


@query
def noise_ratio(spark, sf):
    return _rounded(stats.label_facts(_dense(spark, sf)[0]).select("noise_count", "noise_ratio"))


@query
def distinct_labels(spark, sf):
    return stats.distinct_labels(_dense(spark, sf)[0])


@query
def cluster_key_means(spark, sf):
    """One pressure column is absent: its mean is null, the others are there."""
    rows, _ = _lloyd(spark, sf)
    return _rounded(stats.key_means(rows.drop("BPXDI1")))


@query
def compare_algorithms(spark, sf):
    return _rounded(compare.compare_algorithms(_union(spark, sf)))


@query
def union_labelled(spark, sf):
    return _union(spark, sf)


@query
def attach_labels(spark, sf):
    """Features joined to a separate label table by key."""
    rows, fs = _complete(spark, sf)
    labels, _ = _lloyd(spark, sf)
    return rows.join(labels.select(ID, "cluster"), ID).select(ID, *fs, "cluster")


@query
def lineitem_cluster_stats(spark, sf):
    """Statistics of the fact table by quantity band: the linear operators at scale."""
    rows = load(spark, sf, "lineitem").withColumn("cluster", F.floor(F.col("l_quantity") / 10).cast("int"))
    return _rounded(stats.cluster_stats_full(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query
def lineitem_scaler(spark, sf):
    return _rounded(prepare.scaler_params(
        load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


# ---- rules ----

@query
def rule_age_band(spark, sf):
    return _rounded(_groups(spark, sf).select("cluster", "mean_age", rules.age_band().alias("band")))


@query
def rule_gender_majority(spark, sf):
    return _evaluated(spark, sf).select("cluster", "majority")


@query
def rule_bmi_band(spark, sf):
    return _rounded(_groups(spark, sf).select("cluster", "mean_bmi", rules.bmi_band().alias("band")))


@query
def rule_bp_band(spark, sf):
    return _rounded(_groups(spark, sf).select(
        "cluster", "mean_systolic", "mean_diastolic", rules.bp_band().alias("band")))


def _every_row_as_group(spark, sf):
    """Each complete row taken as a group of its own, so that all bands occur."""
    rows, _ = _complete(spark, sf)
    return stats.key_means(rows.withColumn("cluster", F.col(ID).cast("int")))


@query
def rule_group_type(spark, sf):
    return rules.evaluate(_every_row_as_group(spark, sf)).select("cluster", "group_type", "majority")


@query
def rule_issues(spark, sf):
    return rules.evaluate(_every_row_as_group(spark, sf)).select(
        "cluster", F.array_join("issues", "|").alias("issues"))


@query
def rule_advice_items(spark, sf):
    return rules.advice_items(rules.evaluate(_every_row_as_group(spark, sf)))


@query
def rule_noise_group(spark, sf):
    rows, _ = _dense(spark, sf)
    return rules.render(rules.evaluate(stats.key_means(rows))).filter("cluster = -1")


@query
def rule_insufficient(spark, sf):
    """Groups by nation parity over all rows, with the age emptied in one group."""
    table, _ = _raw(spark, sf)
    rows = table.withColumn("cluster", F.col("SMQ020").cast("int")).withColumn(
        "RIDAGEYR", F.when(F.col("SMQ020") > 1, F.col("RIDAGEYR")))
    return rules.render(rules.evaluate(stats.key_means(rows)))


@query
def rules_basic(spark, sf):
    return rules.evaluate_basic(_every_row_as_group(spark, sf)).select("cluster", "group_type", "advice_text")


@query
def render_group_block(spark, sf):
    return rules.render(_evaluated(spark, sf))


@query
def render_basic_block(spark, sf):
    """The older report; raw means are printed in full, so only their fixed parts are compared."""
    rows, _ = _lloyd(spark, sf)
    blocks = rules.render_basic(rules.evaluate_basic(stats.key_means(rows.drop("BMXBMI", "BPXSY1", "BPXDI1"))))
    return blocks


@query
def member_advice(spark, sf):
    rows, _ = _lloyd(spark, sf)
    rows = cut(rows.select(ID, "cluster", *stats.KEY_COLUMNS.values()))
    return rules.member_advice(rows, rules.evaluate(stats.key_means(rows)), ID)


# ---- plot tables and the whole job ----

@query
def plot_scatter(spark, sf):
    scores, rows, fs = _scores(spark, sf)
    labels = density.dbscan(rows, ID, zs(fs), *DENSE)
    return _rounded(compare.plot_scatter(scores, cut(labels), ID))


@query
def plot_scatter_binned(spark, sf):
    scores, rows, fs = _scores(spark, sf)
    labels = kmeans.assign(rows, zs(fs), kmeans.first_centres(rows, ID, zs(fs), K))
    return compare.plot_scatter_binned(scores, labels, ID)


@query
def plot_feature_means(spark, sf):
    return _rounded(compare.plot_feature_means(*_lloyd(spark, sf)))


@query
def plot_comparison(spark, sf):
    return _rounded(compare.plot_comparison(compare.compare_algorithms(_union(spark, sf))))


@query
def batch_summary(spark, sf):
    return _rounded(batch.run(survey(spark, sf), ID, "exact", scratch_path(spark, "batch")))


@query
def batch_scores(spark, sf):
    """The whole job with the three labellings that SQL can repeat, scores included, stopped after the first and gone on with."""
    out = scratch_path(spark, "batch")
    methods = batch.labellings(K)
    methods["kmeans"] = lambda df, key, fs: spectral.canonical(kmeans.kmeans(df, key, fs, K, max_rounds=20, tol=0.0), key)
    batch.run(survey(spark, sf), ID, "exact", out, methods={"kmeans": methods["kmeans"]})
    chosen = {name: methods[name] for name in ("kmeans", "hierarchical", "dbscan")}
    return _rounded(batch.run(survey(spark, sf), ID, "exact", out, methods=chosen))


@query
def batch_facts(spark, sf):
    """The whole job's counts, which SQL can predict; its scores are in batch_scores and batch_summary."""
    return batch.run(survey(spark, sf), ID, "exact").select("algorithm", "status", "n_clusters", "noise_count", "total_samples")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Scan, select, clean, scale, assign, describe, and advise: one row per segment."""
    rows, fs = _lloyd(spark, sf)
    told = rules.evaluate(stats.key_means(rows))
    return _rounded(told.select(
        "cluster", "size", "mean_age", "mean_bmi", "mean_systolic", "mean_diastolic", "group_type", "majority",
        F.array_join("issues", "|").alias("issues"), F.size("advice").alias("n_advice")))


QUERIES["segment_report"] = flagship
