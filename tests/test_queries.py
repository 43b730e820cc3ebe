"""Registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare, connect

QUICK = [
    "segment_report", "profile_dtypes", "profile_dropna_effect", "standardize", "pca_scores", "kmeans_assign",
    "kmeans_lloyd_n", "dbscan_labels_dense", "knn_graph", "knn_vote", "silhouette_by_row", "cluster_sizes",
    "rule_advice_items", "rules_basic", "render_group_block", "scan_csv_full", "scan_directory_profile",
    "sample_split", "ward_merges", "kmeans_start", "kmeans_labels",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUICK)
def test_query(spark, con, sf, name):
    text, _, _ = compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert text.startswith("ok"), text


def test_ward_cut_k_takes_every_cut(spark, con, sf):
    got = entry.queries()["ward_cut_k"](spark, sf).groupBy("k").count().orderBy("k").collect()
    assert [(r["k"], r["count"]) for r in got] == [(k, k) for k in range(2, 9)]
    text, _, _ = compare(spark, con, sf, "ward_cut_k", entry.queries()["ward_cut_k"], entry.oracle_sql()["ward_cut_k"])
    assert text.startswith("ok"), text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}
    assert own - set(entry.oracle_sql()) == {
        "spectral_labels", "spectral_discretize", "spectral_pic", "batch_summary"}
