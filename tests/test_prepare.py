import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohorta.functions.exprs import fixed, half_even_2, zs
from cohorta.operators import prepare, sampling, stats
from cohorta.operators.keys import connected_components, dense_index, first_rows
from cohorta.session import scratch_path
from cohorta.sources import files
from cohorta.sources.tables import survey


def test_feature_choice():
    assert prepare.choose_features(["x", "LBXGLT", "RIAGENDR", "ALQ101", "RIDAGEYR", "LBXGH", "BMXBMI", "LBDLDL"]) == [
        "RIDAGEYR", "RIAGENDR", "BMXBMI", "ALQ101", "LBXGH", "LBDLDL"]
    with pytest.raises(ValueError, match="RIAGENDR"):
        prepare.choose_features(["RIDAGEYR"])


def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(i, float(i), 5.0) for i in range(4)], "id long, a double, b double")
    out = prepare.standardize(df, ["a", "b"]).orderBy("id").toPandas()
    want = (np.arange(4) - 1.5) / np.arange(4).std()
    assert np.allclose(out["z_a"], want) and (out["z_b"] == 0).all()


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id long, a double")
    assert prepare.standardize(df, ["a"]).count() == 0


def test_components_match_numpy(spark, sf):
    table = survey(spark, sf)
    fs = prepare.choose_features(table.columns)
    rows = prepare.standardize(prepare.complete_rows(table, "SEQN", fs), fs)
    x = rows.orderBy("SEQN").select(*zs(fs)).toPandas().to_numpy()
    comps = prepare.fit_components(rows, fs)
    got = prepare.project(rows, comps, "SEQN").orderBy("SEQN").select("pc1", "pc2").toPandas().to_numpy()
    w, v = np.linalg.eigh(np.cov(x.T))
    v = v[:, ::-1][:, :2]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(2)])
    assert np.allclose(got, x @ v, atol=1e-8)
    assert np.allclose(comps.explained, w[::-1][:2] / w.sum())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=30, max_size=30))
def test_fixed_text_is_exact(spark, values):
    values = [v for x in values for v in (x, x / 2.5e5, x / 1e12)]
    values += [71.55, 0.05, 0.25, 0.35, 2.5, 99.95, 1.005, 0.0, -3.25, 0.005, 0.025, 0.055, 0.125, 5e-324, 1e-30]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2):
        got = df.select("v", fixed("v", digits).alias("t")).collect()
        for r in got:
            assert r["t"] == f"{r['v']:.{digits}f}"


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (5.334999999999999,), (2.675,)], "v double")
    assert [r[0] for r in df.select(half_even_2("v")).collect()] == [0.12, 0.14, 5.34, 2.68]


def test_dense_index_and_first_rows(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7 % 5000).alias("k"))
    idx = dense_index(df.filter("k % 5 = 0"), "k", "n").toPandas().sort_values("k")
    assert (idx["n"].to_numpy() == np.arange(1000)).all()
    assert sorted(r["k"] for r in first_rows(df, "k", 10).collect()) == list(range(10))


def test_partitions_change_nothing(spark):
    df = spark.range(0, 3000, 1, 8).select(F.col("id").alias("k"))
    plain = [r["k"] for r in sampling.hash_sample(df, "k", 50).collect()]
    for parts in (1, 300):
        assert [r["k"] for r in sampling.hash_sample(df.repartition(parts), "k", 50).collect()] == plain
        assert [r["k"] for r in first_rows(df.repartition(parts), "k", 7).collect()] == list(range(7))


def test_sample_size_rule(spark):
    assert [sampling.sample_size(n) for n in (10, 10_000, 10_001, 33_333, 40_000)] == [10, 10_000, 3000, 9999, 10_000]
    row = sampling.sample_size_rule(spark.range(40), above=30).first()
    assert (row["n_rows"], row["sample_rows"], row["sampled"]) == (40, 12, True)


def test_components_of_chain_star_and_loose(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 900)]
    edges = spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")
    nodes = spark.createDataFrame([(v,) for v in [*range(100, 161), *range(500, 900), 5, 7]], "v long")
    got = {r["v"]: r["comp"] for r in connected_components(edges, nodes).collect()}
    assert got[160] == 100 and got[899] == 500 and got[5] == 5 and got[7] == 7 and len(got) == 463


def test_csv_tokens_and_types(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("SEQN,x,y,t\n1,1.5,NA,u\n2,nan,3,\n3,,4,w\n")
    (folder / "empty.csv").write_text("")
    (folder / "skip.txt").write_text("p,q\n1,2\n")
    rows = files.read_csv(spark, str(folder / "a.csv"), "SEQN").drop("t").orderBy("SEQN").collect()
    assert [tuple(r) for r in rows] == [(1, 1.5, None), (2, None, 3.0), (3, None, 4.0)]
    prof = {r["file"]: r for r in files.directory_profile(spark, str(folder)).collect()}
    assert set(prof) == {"a.csv", "empty.csv"}
    assert tuple(prof["a.csv"])[1:] == (3, 4, 4, "ok") and prof["empty.csv"]["status"] == "unreadable: no columns"
    kinds = {r["column"]: r["dtype"] for r in files.directory_columns(spark, str(folder)).collect()}
    assert kinds == {"SEQN": "int64", "x": "float64", "y": "float64", "t": "object"}


def test_directory_of_many_files_is_one_plan(spark, tmp_path):
    folder = tmp_path / "my data+1"
    folder.mkdir()
    for k in range(40):
        (folder / f"t{k:02d}.csv").write_text(f"id,c{k}\n" + "".join(f"{r},{r * k}.5\n" for r in range(k)))
    (folder / "wide.csv").write_text('\n"a, ""b""",n,,z\n1,2,3,4,5,6\nx,"open, 7\n\n9\n')
    (folder / "blank.csv").write_text("\n \n")
    parts = folder / "parts.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("a,b\n1,2\n")
    (parts / "part-1.csv").write_text("b,a\n3,4\n5,NA\n")
    plans = []
    for keep in (41, 3):
        got = files.directory_columns(spark, str(folder))
        plans.append(len(got._jdf.queryExecution().analyzed().toString()))
        if keep == 41:
            prof = {r["file"]: tuple(r)[1:] for r in files.directory_profile(spark, str(folder)).collect()}
            kinds = {(r["file"], r["column"]): (r["dtype"], r["missing"], r["n_rows"]) for r in got.collect()}
            for k in range(3, 40):
                (folder / f"t{k:02d}.csv").unlink()
    assert plans[0] < plans[1] * 1.5  # as large for 43 files as for 6
    assert len(prof) == 43 and prof["t00.csv"] == (0, 2, 0, "ok") and prof["t39.csv"] == (39, 2, 0, "ok")
    assert prof["blank.csv"] == (None, None, None, "unreadable: no columns")
    assert kinds["t39.csv", "id"] == ("int64", 0, 39) and kinds["t39.csv", "c39"] == ("float64", 0, 39)
    assert kinds["wide.csv", 'a, "b"'] == ("object", 0, 3) and kinds["wide.csv", "n"] == ("object", 1, 3)
    assert kinds["wide.csv", "z"] == ("float64", 2, 3)
    assert sum(v[2] for k, v in kinds.items() if k[0] == "parts.csv") == 6


def test_bad_cells_are_told(spark, tmp_path):
    path = str(tmp_path / "b.csv")
    (tmp_path / "b.csv").write_text('SEQN,x,"y ""q"""\n1,1,2\n2,<5,3\n3,4,\n')
    assert {r["column"]: r["n"] for r in files.uncastable_cells(spark, path, "SEQN").collect()} == {"SEQN": 0, "x": 1, 'y "q"': 0}
    assert files.read_csv(spark, path, "SEQN", strict=False).filter("x IS NULL").count() == 1
    with pytest.raises(Exception, match="column x holds no number: <5"):
        files.read_csv(spark, path, "SEQN").collect()


def test_absent_columns_give_null_means(spark):
    df = spark.createDataFrame([(0, 30.0, 1.0), (0, 40.0, 2.0)], "cluster int, RIDAGEYR double, RIAGENDR double")
    row = stats.key_means(df).first()
    assert row["mean_age"] == 35.0 and row["mean_bmi"] is None and row["size"] == 2


def test_documents_of_any_size_are_written_and_read_in_parts(spark):
    docs = spark.range(2500).selectExpr("'big' AS algorithm", "id AS position", "concat('line ', id) AS text").union(
        spark.createDataFrame([("small", 0, "head"), ("small", 1, "two\nlines")], "algorithm string, position long, text string"))
    root = scratch_path(spark, "docs")
    files.write_documents(docs.repartition(3), root, part_lines=400)
    whole = {r["algorithm"]: r["content"] for r in files.read_documents(spark, root).collect()}
    assert whole["big"] == "".join(f"line {k}\n\n" for k in range(2500)) and whole["small"] == "head\n\ntwo\nlines\n\n"
    parts = files.read_document_parts(spark, root)
    assert parts.filter("algorithm = 'big'").count() == 7
    got = files.read_document_parts(spark, root, 401, 805).filter("algorithm = 'big'").orderBy("part").collect()
    assert [(r["part"], r["first"], r["last"]) for r in got] == [(1, 400, 799), (2, 800, 1199)]
    assert got[0]["content"].startswith("line 400\n")
    files.write_documents(docs.limit(0), root, "overwrite")
    assert files.read_documents(spark, root).count() == 0 == files.read_document_parts(spark, root).count()
