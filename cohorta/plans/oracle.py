"""DuckDB SQL with the same results as the registered queries, assembled from named common tables."""

from __future__ import annotations

import re

from cohorta.operators import rules as R

FS = ["RIDAGEYR", "RIAGENDR", "BMXBMI", "BPXSY1", "BPXDI1", "LBXTC", "SMQ020", "ALQ101", "LBXGH"]
ZS = [f"z_{f}" for f in FS]
K = 5
PARTS: dict[str, str] = {}
#: Parts in long chains, which must not be unfolded at each use.
ONCE: set[str] = set()


def _cols(prefix, names):
    return ", ".join(f"{prefix}.{n}" for n in names)


def _d2(a, b, names=ZS):
    return " + ".join(f"({a}.{n} - {b}.{n}) * ({a}.{n} - {b}.{n})" for n in names)


def _needs(sql: str, seen: list[str], inside: tuple = ()) -> list[str]:
    for name in re.findall(r"\b[a-z][a-z0-9_]*\b", sql):
        if name in PARTS and name not in seen and name not in inside:
            _needs(PARTS[name], seen, (*inside, name))
            seen.append(name)
    return seen


def sql(body: str) -> str:
    """The query with every common table it uses, in order of need."""
    names = _needs(body, [])
    if not names:
        return body
    return "WITH RECURSIVE " + ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in ONCE else ''}({PARTS[n]})" for n in names) + "\n" + body


# ---- survey, complete rows, z-scores ----

PARTS["urgent"] = """SELECT o_custkey, count(*) n, avg(o_totalprice) ap, min(o_totalprice) mn, max(o_totalprice) mx
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey"""
PARTS["survey"] = """SELECT c.c_custkey AS SEQN,
  CAST(floor((c_acctbal + 1000) / 11000 * 81) AS double) AS RIDAGEYR,
  CAST(1 + c_custkey % 2 AS double) AS RIAGENDR,
  CAST(round(16 + ap / 500000 * 36, 1) AS double) AS BMXBMI,
  CAST(round(92 + mx / 500000 * 70, 0) AS double) AS BPXSY1,
  CAST(round(50 + mn / 500000 * 60, 0) AS double) AS BPXDI1,
  CAST(round(110 + (mx - mn) / 500000 * 160, 0) AS double) AS LBXTC,
  CAST(1 + c_nationkey % 2 AS double) AS SMQ020,
  CAST(CASE WHEN c_nationkey = 24 THEN 9 WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 2 ELSE 1 END AS double)
    AS ALQ101,
  CAST(4.6 + n * 0.35 AS double) AS LBXGH
  FROM customer c LEFT JOIN urgent o ON c.c_custkey = o.o_custkey"""
PARTS["complete"] = f"SELECT SEQN, {', '.join(FS)} FROM survey WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in FS)
PARTS["moments"] = "SELECT " + ", ".join(f"avg({f}) m_{f}, stddev_pop({f}) s_{f}" for f in FS) + " FROM complete"
PARTS["zed"] = f"SELECT c.SEQN, {_cols('c', FS)}, " + ", ".join(
    f"(c.{f} - m.m_{f}) / CASE WHEN m.s_{f} = 0 THEN 1 ELSE m.s_{f} END AS z_{f}" for f in FS
) + " FROM complete c, moments m"

# ---- K-means from the first k rows ----

PARTS["cen0"] = (f"SELECT CAST(row_number() OVER (ORDER BY SEQN) - 1 AS integer) AS cluster, {', '.join(ZS)} "
                 f"FROM zed QUALIFY row_number() OVER (ORDER BY SEQN) <= {K}")


def _rounds(asg: str, cen: str, rounds: int):
    for r in range(rounds):
        PARTS[f"{asg}{r}"] = (
            f"SELECT SEQN, {', '.join(FS + ZS)}, cluster, d2 FROM (SELECT z.*, c.cluster, {_d2('z', 'c')} AS d2 "
            f"FROM zed z CROSS JOIN {cen}{r} c) QUALIFY row_number() OVER (PARTITION BY SEQN ORDER BY d2, cluster) = 1")
        PARTS[f"{cen}{r + 1}"] = (
            "SELECT c.cluster, " + ", ".join(f"coalesce(avg(a.{z}), any_value(c.{z})) AS {z}" for z in ZS) +
            f" FROM {cen}{r} c LEFT JOIN {asg}{r} a ON a.cluster = c.cluster GROUP BY c.cluster")


_rounds("asg", "cen", 4)
PARTS["lab"] = "SELECT * FROM asg2"

# ---- K-means from a k-means++ start that is drawn by digests ----


def _race(turn: int) -> str:
    return f"-ln((CAST('0x' || substr(md5(z.SEQN || ':42:{turn}'), 1, 13) AS bigint) + 1) / {1 << 52}::DOUBLE)"


PLUS_ROUNDS = 20
PARTS["plus0"] = f"SELECT z.* FROM zed z ORDER BY {_race(0)}, z.SEQN LIMIT 1"
for _r in range(1, K):
    PARTS[f"plus{_r}"] = (
        "SELECT * EXCLUDE (race) FROM (SELECT z.*, " + _race(_r) + " / least(" + ", ".join(
            _d2("z", f"p{j}") for j in range(_r)) + ") AS race FROM zed z, " + ", ".join(f"plus{j} p{j}" for j in range(_r)) +
        ") WHERE isfinite(race) ORDER BY race, SEQN LIMIT 1")
PARTS["pcen0"] = " UNION ALL ".join(
    f"SELECT CAST({j} AS integer) AS cluster, {', '.join(ZS)} FROM plus{j}" for j in range(K))
_rounds("pasg", "pcen", PLUS_ROUNDS + 1)
ONCE |= {"zed"} | {n for n in PARTS if n.startswith(("plus", "pasg", "pcen"))}
PARTS["plab"] = (
    "SELECT SEQN, CAST(dense_rank() OVER (ORDER BY low) - 1 AS integer) AS cluster FROM "
    f"(SELECT SEQN, min(SEQN) OVER (PARTITION BY cluster) AS low FROM pasg{PLUS_ROUNDS})")

# ---- DBSCAN with (eps, min_samples) ----


def _density(tag: str, eps: float, need: int):
    PARTS[f"near_{tag}"] = f"SELECT a.SEQN i, b.SEQN j FROM zed a JOIN zed b ON {_d2('a', 'b')} <= {eps} * {eps}::DOUBLE"
    PARTS[f"cnt_{tag}"] = f"SELECT i, count(*) n FROM near_{tag} GROUP BY i"
    PARTS[f"core_{tag}"] = f"SELECT i FROM cnt_{tag} WHERE n >= {need}"
    PARTS[f"link_{tag}"] = (
        f"SELECT p.i, p.j FROM near_{tag} p JOIN core_{tag} a ON a.i = p.i JOIN core_{tag} b ON b.i = p.j")
    PARTS[f"walk_{tag}"] = (
        f"SELECT i, i AS r FROM core_{tag} UNION SELECT l.j AS i, w.r FROM walk_{tag} w JOIN link_{tag} l ON l.i = w.i")
    PARTS[f"comp_{tag}"] = (
        f"SELECT i, CAST(dense_rank() OVER (ORDER BY low) - 1 AS integer) AS cluster FROM "
        f"(SELECT i, min(r) AS low FROM walk_{tag} GROUP BY i)")
    PARTS[f"rim_{tag}"] = (
        f"SELECT p.i, min(c.cluster) AS cluster FROM near_{tag} p JOIN comp_{tag} c ON c.i = p.j "
        f"WHERE p.i NOT IN (SELECT i FROM core_{tag}) GROUP BY p.i")
    PARTS[f"den_{tag}"] = (
        f"SELECT z.*, coalesce(c.cluster, r.cluster, -1) AS cluster FROM zed z "
        f"LEFT JOIN comp_{tag} c ON c.i = z.SEQN LEFT JOIN rim_{tag} r ON r.i = z.SEQN")


_density("a", 0.5, 5)
_density("b", 1.2, 8)
_density("c", 0.8, 15)
_density("d", 1.0, 10)
PARTS["adapt"] = (
    "SELECT SEQN, cluster FROM den_c WHERE (SELECT avg(CASE WHEN cluster = -1 THEN 1.0 ELSE 0 END) FROM den_c) <= 0.5 "
    "UNION ALL "
    "SELECT SEQN, cluster FROM den_d WHERE (SELECT avg(CASE WHEN cluster = -1 THEN 1.0 ELSE 0 END) FROM den_c) > 0.5")
PARTS["tagged"] = ("SELECT 'kmeans' AS algorithm, SEQN, cluster FROM lab UNION ALL "
                 "SELECT 'dbscan', SEQN, cluster FROM den_b")
_FACTS = ("CAST(count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS bigint) AS n_clusters, "
          "CAST(count(CASE WHEN cluster = -1 THEN 1 END) AS bigint) AS noise_count, "
          "count(CASE WHEN cluster = -1 THEN 1 END) / CAST(count(*) AS double) AS noise_ratio, "
          "count(*) AS total_samples")
PARTS["versus"] = f"SELECT algorithm, {_FACTS} FROM tagged GROUP BY algorithm"

# ---- nearest-neighbour graph ----

PARTS["knn"] = (
    f"SELECT SEQN, neighbor, CAST(row_number() OVER w AS integer) AS rank, d2 FROM "
    f"(SELECT a.SEQN, b.SEQN AS neighbor, {_d2('a', 'b')} AS d2 FROM zed a CROSS JOIN zed b) "
    "WINDOW w AS (PARTITION BY SEQN ORDER BY CAST(neighbor <> SEQN AS integer), d2, neighbor) "
    "QUALIFY row_number() OVER w <= 10")
PARTS["aff"] = ("SELECT src, dst, count(*) * 0.5::DOUBLE AS weight FROM (SELECT SEQN src, neighbor dst FROM knn "
                "UNION ALL SELECT neighbor, SEQN FROM knn) GROUP BY src, dst")
PARTS["deg"] = "SELECT src AS id, sum(CASE WHEN src <> dst THEN weight ELSE 0 END) AS degree FROM aff GROUP BY src"
PARTS["gwalk"] = "SELECT src AS i, src AS r FROM deg_nodes UNION SELECT a.dst AS i, w.r FROM gwalk w JOIN aff a ON a.src = w.i"
PARTS["deg_nodes"] = "SELECT DISTINCT src FROM aff"

# ---- silhouettes ----


def _sil(tag: str, table: str, key: str = "SEQN", dims=ZS, where: str = "TRUE"):
    PARTS[f"sp_{tag}"] = (
        f"SELECT a.{key} AS id, a.cluster AS own, b.cluster AS other, sum(sqrt({_d2('a', 'b', dims)})) AS ds, "
        f"count(*) AS n FROM {table} a CROSS JOIN {table} b WHERE {where.replace('@', 'a')} AND "
        f"{where.replace('@', 'b')} GROUP BY a.{key}, a.cluster, b.cluster")
    PARTS[f"sr_{tag}"] = (
        "SELECT id, own AS cluster, max(CASE WHEN own = other THEN ds / greatest(n - 1, 1) END) AS a, "
        "min(CASE WHEN own <> other THEN ds / n END) AS b, max(CASE WHEN own = other THEN n END) AS size "
        f"FROM sp_{tag} GROUP BY id, own")
    PARTS[f"si_{tag}"] = (
        "SELECT id, cluster, a, b, CASE WHEN b IS NULL THEN NULL WHEN size = 1 OR greatest(a, b) = 0 THEN 0 "
        f"ELSE (b - a) / greatest(a, b) END AS s FROM sr_{tag}")


PARTS["smoke"] = f"SELECT SEQN, {', '.join(ZS)}, CAST(SMQ020 AS integer) AS cluster FROM zed"
_DIMS = [f"v{i}" for i in range(64)]
PARTS["vecs"] = "SELECT vec_id, CAST(label AS integer) AS cluster, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS double) AS v{i}" for i in range(64)) + " FROM embeddings"
_sil("smoke", "smoke")
_sil("lab", "lab")
_sil("den", "den_b", where="@.cluster <> -1")
_sil("vec", "vecs", "vec_id", _DIMS)

# ---- principal components: powers of the correlation matrix, squared until one projector is left ----

PARTS["corr"] = " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS v FROM complete"
    for i, a in enumerate(FS) for j, b in enumerate(FS))
SQUARINGS = 14


def _component(n: int, source: str):
    PARTS[f"pw{n}_0"] = f"SELECT i, j, v / (SELECT sum(v) FROM {source} WHERE i = j) AS v FROM {source}"
    for s in range(SQUARINGS):
        PARTS[f"sq{n}_{s}"] = (f"SELECT a.i, b.j, sum(a.v * b.v) AS v FROM pw{n}_{s} a JOIN pw{n}_{s} b ON a.j = b.i "
                               "GROUP BY a.i, b.j")
        PARTS[f"pw{n}_{s + 1}"] = f"SELECT i, j, v / (SELECT sum(v) FROM sq{n}_{s} WHERE i = j) AS v FROM sq{n}_{s}"
    proj = f"pw{n}_{SQUARINGS}"
    PARTS[f"ev{n}"] = f"SELECT sum(p.v * c.v) AS ev FROM {proj} p JOIN {source} c ON c.i = p.j AND c.j = p.i"
    # The projector is v v': its column at the largest diagonal cell gives v with that loading positive.
    PARTS[f"load{n}"] = (
        f"SELECT p.i, p.v / sqrt(d.v) AS v FROM {proj} p JOIN (SELECT i, v FROM {proj} WHERE i = j "
        "ORDER BY v DESC, i LIMIT 1) d ON p.j = d.i")
    PARTS[f"rest{n}"] = f"SELECT c.i, c.j, c.v - (SELECT ev FROM ev{n}) * p.v AS v FROM {source} c JOIN {proj} p " \
                        "ON p.i = c.i AND p.j = c.j"


_component(1, "corr")
_component(2, "rest1")
PARTS["scores"] = "SELECT SEQN, " + ", ".join(
    " + ".join(f"z_{f} * (SELECT v FROM load{n} WHERE i = {i})" for i, f in enumerate(FS)) + f" AS pc{n}"
    for n in (1, 2)) + " FROM zed"

# ---- rules ----

PARTS["kmeans_groups"] = (
    "SELECT cluster, count(*) AS size, avg(RIDAGEYR) mean_age, avg(RIAGENDR) mean_gender, avg(BMXBMI) mean_bmi, "
    "avg(BPXSY1) mean_systolic, avg(BPXDI1) mean_diastolic FROM lab GROUP BY cluster")
PARTS["dense_groups"] = PARTS["kmeans_groups"].replace("FROM lab", "FROM den_b")
PARTS["row_groups"] = (
    "SELECT CAST(SEQN AS integer) AS cluster, CAST(1 AS bigint) AS size, RIDAGEYR mean_age, RIAGENDR mean_gender, "
    "BMXBMI mean_bmi, BPXSY1 mean_systolic, BPXDI1 mean_diastolic FROM complete")
PARTS["hole_groups"] = (
    "SELECT CAST(SMQ020 AS integer) AS cluster, count(*) AS size, avg(CASE WHEN SMQ020 > 1 THEN RIDAGEYR END) mean_age, "
    "avg(RIAGENDR) mean_gender, avg(BMXBMI) mean_bmi, avg(BPXSY1) mean_systolic, avg(BPXDI1) mean_diastolic "
    "FROM survey GROUP BY CAST(SMQ020 AS integer)")
_AGE = "CASE WHEN mean_age < 30 THEN 'young' WHEN mean_age > 65 THEN 'old' WHEN mean_age IS NOT NULL THEN 'middle' END"
_BMI = ("CASE WHEN mean_bmi < 18.5 THEN 'under' WHEN mean_bmi < 24 THEN 'normal' WHEN mean_bmi < 28 THEN 'over' "
        "WHEN mean_bmi IS NOT NULL THEN 'obese' END")
_BP = ("CASE WHEN mean_systolic >= 140 OR mean_diastolic >= 90 THEN 'high' "
       "WHEN mean_systolic <= 90 OR mean_diastolic <= 60 THEN 'low' END")


def _names(table: str, labels: dict):
    PARTS[table] = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in labels.items()) + ") t(band, label)"


_names("age_names", R.AGE_LABELS)
_names("bmi_names", R.BMI_LABELS)
_names("bp_names", R.BP_LABELS)
_names("basic_names", R.BASIC_LABELS)
for _name, _cat in (("advice_rows", R.ADVICE), ("basic_rows", R.BASIC_ADVICE)):
    PARTS[_name] = "SELECT * FROM (VALUES " + ", ".join(
        f"('{band}', {n}, '{code}', '{code}')" for band, items in _cat.items() for n, code in items
    ) + ") t(band, number, code, text)"


def _rules(tag: str):
    """Bands, type, majority, issues and numbered advice of one group table."""
    PARTS[f"banded_{tag}"] = (
        f"SELECT *, {_AGE} AS age_band, {_BMI} AS bmi_band, {_BP} AS bp_band FROM {tag}_groups "
        "WHERE cluster <> -1 AND mean_age IS NOT NULL AND mean_gender IS NOT NULL")
    PARTS[f"told_{tag}"] = (
        "SELECT b.*, a.label || coalesce(' - ' || m.label, '') || coalesce(' - ' || p.label, '') AS group_type, "
        "CASE WHEN mean_gender < 1.5 THEN '男性为主' ELSE '女性为主' END AS majority, "
        "CASE WHEN bmi_band <> 'normal' AND p.label IS NOT NULL THEN m.label || '|' || p.label "
        "WHEN bmi_band <> 'normal' THEN m.label WHEN p.label IS NOT NULL THEN p.label ELSE '无明显健康风险' END AS issues "
        f"FROM banded_{tag} b JOIN age_names a ON a.band = b.age_band LEFT JOIN bmi_names m ON m.band = b.bmi_band "
        "LEFT JOIN bp_names p ON p.band = b.bp_band")
    PARTS[f"items_{tag}"] = (
        "SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY part, number) - 1 AS integer) AS seq, "
        f"CAST(number AS integer) AS number, code, text FROM (SELECT cluster, 1 AS part, age_band AS band FROM banded_{tag} "
        f"UNION ALL SELECT cluster, 2, bmi_band FROM banded_{tag} UNION ALL SELECT cluster, 3, bp_band FROM banded_{tag}) g "
        "JOIN advice_rows r ON r.band = g.band")
    PARTS[f"block_{tag}"] = (
        "SELECT t.cluster, '群体 ' || (t.cluster + 1) || ': ' || group_type || ' (样本数: ' || size || ')\n\n特征概况:\n' || "
        "printf('- 年龄均值: %.1f 岁', mean_age) || '\n- 性别分布: ' || majority || "
        "coalesce(printf('\n- BMI均值: %.1f', mean_bmi), '') || "
        "CASE WHEN mean_systolic IS NOT NULL AND mean_diastolic IS NOT NULL THEN "
        "printf('\n- 收缩压均值: %.1f mmHg\n- 舒张压均值: %.1f mmHg', mean_systolic, mean_diastolic) ELSE '' END || "
        "'\n\n潜在健康问题:\n- ' || replace(issues, '|', '\n- ') || '\n\n健康管理建议:\n' || i.lines || "
        f"'\n\n========================================' AS block FROM told_{tag} t JOIN (SELECT cluster, "
        f"string_agg(number || '. ' || text, '\n' ORDER BY seq) AS lines FROM items_{tag} GROUP BY cluster) i "
        "ON i.cluster = t.cluster "
        "UNION ALL SELECT cluster, '群体: 噪声点 (样本数: ' || size || ')\n"
        "描述: 这些样本被识别为异常值，不属于任何主要健康群体\n建议: 需要个体化评估' "
        f"FROM {tag}_groups WHERE cluster = -1 "
        f"UNION ALL SELECT cluster, '群体 ' || (cluster + 1) || ': 数据不足以进行详细分析' FROM {tag}_groups "
        "WHERE cluster <> -1 AND (mean_age IS NULL OR mean_gender IS NULL)")


for _tag in ("kmeans", "dense", "row", "hole"):
    _rules(_tag)
PARTS["docs"] = " UNION ALL ".join(
    f"SELECT '{name}' AS algorithm, '=== {name} 聚类健康群体分析 ===\n\n' || "
    f"string_agg(block || '\n\n', '' ORDER BY cluster) AS content FROM block_{tag}"
    for name, tag in (("kmeans", "kmeans"), ("dbscan", "dense")))
PARTS["basic"] = (
    "SELECT *, CASE WHEN mean_age < 30 THEN 'young' WHEN mean_age > 65 THEN 'old' END AS a, "
    "CASE WHEN mean_bmi > 30 THEN 'obese' END AS b, "
    "CASE WHEN mean_systolic >= 140 OR mean_diastolic >= 90 THEN 'high' END AS p FROM row_groups")
PARTS["basic_items"] = (
    "SELECT cluster, string_agg(number || '. ' || text, '\n' ORDER BY part, number) AS lines FROM ("
    "SELECT cluster, 1 AS part, CASE WHEN coalesce(a, b, p) IS NULL THEN 'general' ELSE a END AS band FROM basic "
    "UNION ALL SELECT cluster, 2, b FROM basic UNION ALL SELECT cluster, 3, p FROM basic) g "
    "JOIN basic_rows r ON r.band = g.band GROUP BY cluster")

ALGOS = "(VALUES ('kmeans'), ('hierarchical'), ('dbscan'), ('spectral')) w(algorithm)"
_WIDE = "SEQN, " + ", ".join(FS)
ORACLES: dict[str, str] = {}


def _add(name: str, body: str):
    ORACLES[name] = sql(body)


def _stats(table, fs, *cells):
    return " UNION ALL ".join(
        f"SELECT cluster, '{f}' AS feature, " + ", ".join(c.replace("@", f) for c in cells) +
        f" FROM {table} GROUP BY cluster" for f in fs)


def _r6(e, name):
    return f"round({e}, 6) AS {name}"


# sources and sinks
_add("scan_csv_full", f"SELECT {_WIDE} FROM survey")
_add("scan_first_n", f"SELECT {_WIDE} FROM survey ORDER BY SEQN LIMIT 5000")
_add("scan_first_hundred", f"SELECT {_WIDE} FROM survey ORDER BY SEQN LIMIT 100")
_add("preview_head", f"SELECT {_WIDE} FROM survey ORDER BY SEQN LIMIT 5")
_GAPS = " + ".join(f"count(*) - count({f})" for f in FS)
_add("scan_directory_profile",
     f"SELECT 'survey.csv' AS file, count(*) AS n_rows, CAST(10 AS bigint) AS n_columns, CAST({_GAPS} AS bigint) AS "
     "missing_total, 'ok' AS status FROM survey "
     "UNION ALL SELECT 'supplier.csv', count(*), 4, 0, 'ok' FROM supplier "
     "UNION ALL SELECT 'part.csv', count(*), 6, 0, 'ok' FROM part "
     "UNION ALL SELECT 'empty.csv', NULL, NULL, NULL, 'unreadable: no columns'")
_add("scan_directory_columns", " UNION ALL ".join(
    f"SELECT '{t}.csv' AS file, '{c}' AS \"column\", '{k}' AS dtype, CAST(count(*) - count({c}) AS bigint) AS missing, "
    f"count(*) AS n_rows FROM {t}"
    for t, cols in (
        ("survey", [("SEQN", "int64")] + [(f, "float64") for f in FS]),
        ("supplier", [("s_suppkey", "int64"), ("s_name", "object"), ("s_nationkey", "int64"), ("s_acctbal", "float64")]),
        ("part", [("p_partkey", "int64"), ("p_name", "object"), ("p_brand", "object"), ("p_type", "object"),
                  ("p_size", "int64"), ("p_retailprice", "float64")]))
    for c, k in cols))
_add("sink_labelled_roundtrip",
     f"SELECT 'kmeans' AS algorithm, {_WIDE}, cluster FROM lab UNION ALL SELECT 'dbscan', {_WIDE}, cluster FROM den_b")
_add("sink_labelled_csv_roundtrip",
     f"SELECT 'kmeans' AS algorithm, {_WIDE}, cluster FROM lab UNION ALL SELECT 'dbscan', {_WIDE}, cluster FROM den_b")
_HALF = "round_even(round({}, 9), 2)"
_add("sink_stats_roundtrip", "SELECT cluster, " + ", ".join(
    f"{_HALF.format(f'avg({f})')} AS {f}_mean, {_HALF.format(f'stddev_samp({f})')} AS {f}_std" for f in FS)
    + " FROM lab GROUP BY cluster")
_add("sink_recommendation_text",
     "SELECT algorithm, CAST(line AS integer) AS line, lines[line + 1] AS text FROM (SELECT algorithm, lines, "
     "unnest(range(len(lines))) AS line FROM (SELECT algorithm, string_split(content, '\n') AS lines FROM docs))")
_add("load_recommendation_docs",
     f"SELECT w.algorithm, d.content FROM {ALGOS} LEFT JOIN docs d ON d.algorithm = w.algorithm")
_add("load_results_present",
     f"SELECT w.algorithm, count(*) AS n_rows FROM {ALGOS} JOIN tagged b ON b.algorithm = w.algorithm GROUP BY w.algorithm")
_add("load_results_missing", f"SELECT w.algorithm FROM {ALGOS} WHERE w.algorithm NOT IN (SELECT algorithm FROM tagged)")
_add("comparison_formatted",
     "SELECT algorithm, n_clusters, total_samples, noise_count, printf('%.2f%%', noise_ratio * 100) AS noise_pct FROM versus")

# profiling
_add("profile_shape", "SELECT count(*) AS n_rows, CAST(10 AS bigint) AS n_columns FROM survey")
_add("profile_dtypes", " UNION ALL ".join(
    f"SELECT CAST({i} AS integer) AS position, '{c}' AS \"column\", '{'bigint' if c == 'SEQN' else 'double'}' AS dtype, "
    f"count({c}) AS filled FROM survey" for i, c in enumerate(["SEQN"] + FS)))
_add("profile_missing_total", f"SELECT CAST({_GAPS} AS bigint) AS missing_total FROM survey")
_add("profile_missing_by_column", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(count(*) - count({f}) AS bigint) AS missing FROM survey" for f in FS))
_add("profile_dropna_effect",
     "SELECT (SELECT count(*) FROM survey) AS rows_before, (SELECT count(*) FROM complete) AS rows_after, "
     "CAST((SELECT count(*) FROM survey) - (SELECT count(*) FROM complete) AS bigint) AS rows_dropped")

# projections and filters
_add("select_features", f"SELECT {_WIDE} FROM survey")
_add("select_first_alternative",
     f"SELECT SEQN, {', '.join(FS[:-1])}, LBXGH * 18 AS LBXGLU, LBXTC / 2 AS LBDLDL FROM survey")
_add("drop_incomplete", f"SELECT {_WIDE} FROM complete")
_add("filter_cluster", f"SELECT {_WIDE}, cluster FROM lab WHERE cluster = 1")
PARTS["chosen"] = "SELECT SEQN FROM complete ORDER BY md5(CAST(SEQN AS varchar)), SEQN LIMIT 400"
_add("sample_split", "SELECT SEQN, CASE WHEN SEQN IN (SELECT SEQN FROM chosen) THEN 'sample' ELSE 'rest' END AS part "
                     "FROM complete")
_LABEL = "CASE WHEN cluster = -1 THEN '噪声' ELSE '群体 ' || (cluster + 1) END"
_add("display_label", f"SELECT SEQN, cluster, {_LABEL} AS label FROM den_b")

# transforms
_add("standardize", "SELECT SEQN, " + ", ".join(_r6(z, z) for z in ZS) + " FROM zed")
_add("scaler_params", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {_r6(f'avg({f})', 'mean')}, {_r6(f'stddev_pop({f})', 'std')} FROM complete" for f in FS))
_add("feature_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_r6(f'corr({a}, {b})', 'corr')} FROM complete" for a in FS for b in FS))
_add("pca_scores", "SELECT SEQN, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2 FROM scores")
_add("pca_invariants", "SELECT (SELECT round(ev, 6) FROM ev1) AS var_1, (SELECT round(ev, 6) FROM ev2) AS var_2, "
                       "CAST(0 AS double) AS cov_12, (SELECT count(*) FROM complete) AS n")
_add("pca_explained", " UNION ALL ".join(
    f"SELECT CAST({n} AS integer) AS component, (SELECT round(ev / {len(FS)}, 6) FROM ev{n}) AS ratio, "
    "(SELECT count(*) FROM complete) AS n" for n in (1, 2)))

# K-means
_add("kmeans_invariants", f"SELECT count(*) AS n, CAST({K} AS bigint) AS n_clusters, CAST(0 AS bigint) AS n_misplaced, "
                          "true AS at_rest, true AS no_worse_than_fixed_starts FROM complete")
_add("kmeans_labels", "SELECT SEQN, cluster FROM plab")
_add("kmeans_start", "SELECT cluster, " + ", ".join(f"round({z}, 6) AS {z}" for z in ZS) + " FROM pcen0")
_add("kmeans_assign", "SELECT SEQN, cluster, round(d2, 6) AS d2 FROM asg0")
_add("kmeans_lloyd_n", "SELECT SEQN, cluster FROM asg3")
_add("kmeans_inertia", "SELECT cluster, count(*) AS n, round(sum(d2), 6) AS inertia FROM asg2 GROUP BY cluster")

# Ward
PARTS["cheap"] = (
    f"SELECT i, j, d2 FROM (SELECT a.SEQN i, b.SEQN j, {_d2('a', 'b')} AS d2 FROM zed a JOIN zed b ON a.SEQN <> b.SEQN) "
    "QUALIFY row_number() OVER (PARTITION BY i ORDER BY d2, j) = 1")
_add("ward_first_round", "SELECT round(sqrt(a.d2), 6) AS height, a.i AS lft, a.j AS rgt FROM cheap a JOIN cheap b "
                         "ON a.i = b.j AND a.j = b.i WHERE a.i < a.j")
_add("ward_invariants",
     "SELECT CAST(count(*) - 1 AS bigint) AS n_merges, round(" + " + ".join(f"sum({z} * {z})" for z in ZS) +
     ", 6) AS sum_of_squares, count(*) AS largest, CAST(count(*) - 1 AS bigint) AS absorbed FROM zed")

# Rounds of mutual nearest clusters, unrolled; rounds after the last merge find nothing and cost nothing.
ROUNDS = 48
PARTS["wc0"] = f"SELECT SEQN AS cid, 1.0::DOUBLE AS w, {', '.join(ZS)} FROM zed"
for _r in range(ROUNDS):
    PARTS[f"wn{_r}"] = (
        f"SELECT i, j, cost, n FROM (SELECT a.cid i, b.cid j, 2 * a.w * b.w / (a.w + b.w) * ({_d2('a', 'b')}) AS cost, "
        f"a.w + b.w AS n FROM wc{_r} a JOIN wc{_r} b ON a.cid <> b.cid) "
        "QUALIFY row_number() OVER (PARTITION BY i ORDER BY cost, j) = 1")
    PARTS[f"wm{_r}"] = (f"SELECT a.i AS lft, a.j AS rgt, a.cost, a.n FROM wn{_r} a JOIN wn{_r} b "
                        "ON a.i = b.j AND a.j = b.i WHERE a.i < a.j")
    PARTS[f"wc{_r + 1}"] = (
        "SELECT coalesce(m.lft, c.cid) AS cid, sum(c.w) AS w, " +
        ", ".join(f"sum(c.w * c.{z}) / sum(c.w) AS {z}" for z in ZS) +
        f" FROM wc{_r} c LEFT JOIN wm{_r} m ON m.rgt = c.cid GROUP BY 1")
PARTS["wardm"] = " UNION ALL ".join(
    f"SELECT sqrt(cost) AS height, lft, rgt, CAST(n AS bigint) AS size FROM wm{r}" for r in range(ROUNDS))
for _k in range(2, 9):
    PARTS[f"kept{_k}"] = (f"SELECT lft, rgt FROM wardm QUALIFY row_number() OVER (ORDER BY height DESC, lft DESC, "
                          f"rgt DESC) > {_k - 1}")
    PARTS[f"climb{_k}"] = (f"SELECT SEQN AS i, SEQN AS r FROM zed UNION ALL SELECT c.i, k.lft AS r FROM climb{_k} c "
                           f"JOIN kept{_k} k ON k.rgt = c.r")
    PARTS[f"root{_k}"] = f"SELECT i, min(r) AS root FROM climb{_k} GROUP BY i"
_add("ward_merges", "SELECT round(height, 6) AS height, lft, rgt, size FROM wardm")
_add("ward_labels", "SELECT i AS SEQN, CAST(dense_rank() OVER (ORDER BY root) - 1 AS integer) AS cluster FROM root5")
_add("ward_cut_k", " UNION ALL ".join(
    f"SELECT CAST({k} AS integer) AS k, root AS smallest_member, count(*) AS size FROM root{k} GROUP BY root"
    for k in range(2, 9)))

# DBSCAN
_add("dbscan_labels", "SELECT SEQN, cluster FROM den_a")
_add("dbscan_labels_dense", "SELECT SEQN, cluster FROM den_b")
_add("eps_neighbors", "SELECT i AS SEQN, n AS n_neighbors FROM cnt_b")
_add("dbscan_core", "SELECT i AS SEQN, n AS n_neighbors, n >= 8 AS is_core FROM cnt_b")
_add("dbscan_components", "SELECT i AS SEQN, cluster FROM comp_b")
_add("dbscan_border", "SELECT i AS SEQN, cluster FROM rim_b")
_add("dbscan_noise", "SELECT SEQN FROM den_b WHERE cluster = -1")
_add("dbscan_adaptive", "SELECT SEQN, cluster FROM adapt")
_add("dbscan_quality_flag", " UNION ALL ".join(
    f"SELECT '{run}' AS run, n_clusters, round(noise_ratio, 6) AS noise_ratio, CASE WHEN noise_ratio > 0.5 THEN "
    "'too_much_noise' WHEN n_clusters < 2 THEN 'too_few_clusters' WHEN n_clusters > 10 THEN 'many_clusters' ELSE 'ok' "
    f"END AS quality FROM (SELECT {_FACTS} FROM den_{t})" for run, t in (("strict", "a"), ("dense", "b"))))

_add("batch_facts", " UNION ALL ".join(
    f"SELECT '{name}' AS algorithm, 'ok' AS status, CAST({K} AS bigint) AS n_clusters, CAST(0 AS bigint) AS noise_count, "
    "count(*) AS total_samples FROM complete" for name in ("kmeans", "hierarchical", "spectral"))
    + " UNION ALL SELECT 'dbscan', 'ok', count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END), "
      "count(CASE WHEN cluster = -1 THEN 1 END), count(*) FROM adapt")

for _tag, _rows in (("bk", "plab"), ("bw", "wlab"), ("bd", "adapt")):
    PARTS[f"{_tag}_rows"] = f"SELECT z.*, l.cluster FROM zed z JOIN {_rows} l ON l.SEQN = z.SEQN"
    _sil(_tag, f"{_tag}_rows", where="@.cluster <> -1")
PARTS["wlab"] = "SELECT i AS SEQN, CAST(dense_rank() OVER (ORDER BY root) - 1 AS integer) AS cluster FROM root5"
_add("batch_scores", " UNION ALL ".join(
    f"SELECT '{name}' AS algorithm, 'ok' AS status, n_clusters, noise_count, total_samples, "
    "CASE WHEN n_clusters >= 2 AND n_clusters < total_samples - noise_count THEN 'exact' END AS score_mode, "
    "CASE WHEN n_clusters >= 2 AND n_clusters < total_samples - noise_count THEN "
    f"(SELECT round(avg(s), 6) FROM si_{tag}) END AS silhouette FROM (SELECT {_FACTS} FROM {tag}_rows)"
    for name, tag in (("kmeans", "bk"), ("hierarchical", "bw"), ("dbscan", "bd"))))

# spectral graph
PARTS["parts_of"] = "SELECT i, min(r) AS comp FROM gwalk GROUP BY i"
_add("spectral_invariants", " UNION ALL ".join(
    f"SELECT '{name}' AS step, CAST(count(*) AS bigint) AS n, CAST({K} AS bigint) AS n_clusters, 0 AS misnumbered, "
    f"true AS cut_held, (SELECT least({K}, count(DISTINCT comp)) FROM parts_of) AS n_unit, true AS at_rest, true AS apart "
    "FROM complete" for name in ("kmeans", "discretize")))
PARTS["lab_den"] = "SELECT x.cluster AS p, y.cluster AS q FROM lab x JOIN den_b y ON x.SEQN = y.SEQN"
PARTS["lab_lab"] = "SELECT x.cluster AS p, y.cluster AS q FROM lab x JOIN lab y ON x.SEQN = y.SEQN"
PARTS["den_den"] = "SELECT x.cluster AS p, y.cluster AS q FROM den_b x JOIN den_b y ON x.SEQN = y.SEQN"


def _agree(name: str, table: str) -> str:
    def half(by):
        return f"(SELECT sum(n * (n - 1) / 2.0::DOUBLE) FROM (SELECT count(*) AS n FROM {table} GROUP BY {by}))"
    return (f"SELECT '{name}' AS labellings, n, round((c + 2 * s - a - b) / c, 6) AS rand, "
            "round((s - a * b / c) / ((a + b) / 2 - a * b / c), 6) AS adjusted "
            f"FROM (SELECT count(*) AS n, count(*) * (count(*) - 1) / 2.0::DOUBLE AS c, {half('p, q')} AS s, {half('p')} AS a, "
            f"{half('q')} AS b FROM {table})")


_add("labelling_agreement", " UNION ALL ".join(_agree(n, t) for n, t in (
    ("kmeans dbscan", "lab_den"), ("kmeans kmeans", "lab_lab"), ("dbscan dbscan", "den_den"))))
_add("knn_graph", "SELECT SEQN, neighbor, rank, round(d2, 6) AS d2 FROM knn")
_add("knn_affinity", "SELECT src, dst, weight FROM aff")
_add("graph_degree", "SELECT id, degree FROM deg")
_add("normalized_affinity", "SELECT a.src, a.dst, round(a.weight / sqrt(s.degree * d.degree), 6) AS weight FROM aff a "
                            "JOIN deg s ON s.id = a.src JOIN deg d ON d.id = a.dst WHERE a.src <> a.dst")
_add("graph_components", "SELECT i AS id, min(r) AS comp FROM gwalk GROUP BY i")

# sampling and propagation
_add("sample_without_replacement", f"SELECT {_WIDE} FROM complete WHERE SEQN IN (SELECT SEQN FROM chosen)")
_add("sample_size_rule",
     "SELECT n AS n_rows, CASE WHEN n <= 1000 THEN n ELSE least(10000, CAST(floor(n * 0.3::DOUBLE) AS bigint)) END AS "
     "sample_rows, n > 1000 AS sampled FROM (SELECT count(*) AS n FROM complete)")
PARTS["votes"] = (
    f"SELECT SEQN, label, count(*) AS c FROM (SELECT r.SEQN, s.cluster AS label FROM lab r CROSS JOIN lab s "
    "WHERE r.SEQN NOT IN (SELECT SEQN FROM chosen) AND s.SEQN IN (SELECT SEQN FROM chosen) "
    f"QUALIFY row_number() OVER (PARTITION BY r.SEQN ORDER BY {_d2('r', 's')}, s.SEQN) <= 5) GROUP BY SEQN, label")
PARTS["won"] = ("SELECT SEQN, label AS cluster FROM votes "
                "QUALIFY row_number() OVER (PARTITION BY SEQN ORDER BY c DESC, label) = 1")
_add("knn_vote", "SELECT SEQN, cluster FROM won")
_add("propagate_full", "SELECT SEQN, cluster FROM won UNION ALL SELECT SEQN, cluster FROM lab "
                       "WHERE SEQN IN (SELECT SEQN FROM chosen)")
_add("canonical_labels", "SELECT SEQN, CAST(dense_rank() OVER (ORDER BY low) - 1 AS integer) AS cluster FROM "
                         "(SELECT SEQN, min(SEQN) OVER (PARTITION BY cluster) AS low FROM lab)")

# quality
_add("silhouette_exact", "SELECT count(*) AS n, round(avg(s), 6) AS silhouette FROM si_smoke")
_add("silhouette_by_row", "SELECT id AS SEQN, cluster, round(a, 6) AS a, round(b, 6) AS b, round(s, 6) AS s FROM si_smoke")
_add("silhouette_by_cluster", "SELECT cluster, count(*) AS n, round(avg(s), 6) AS silhouette FROM si_lab GROUP BY cluster")
_add("silhouette_guard_strict",
     "SELECT 'clean' AS labels, count(*) AS n, round(avg(s), 6) AS silhouette FROM si_smoke UNION ALL "
     "SELECT 'noisy', count(*), NULL FROM den_b")
_add("silhouette_non_noise", "SELECT count(*) AS n, round(avg(s), 6) AS silhouette FROM si_den")
PARTS["anchors"] = "SELECT SEQN FROM complete ORDER BY md5(CAST(SEQN AS varchar)), SEQN LIMIT 300"
_add("silhouette_sampled", "SELECT (SELECT count(*) FROM complete) AS n_rows, count(*) AS n_anchors, "
                           "round(avg(s), 6) AS estimate FROM si_smoke WHERE id IN (SELECT SEQN FROM anchors)")
_SQ = " + ".join(f"{z} * {z}" for z in ZS)
PARTS["sq_line"] = (f"SELECT cluster, count(*) AS size, avg({_SQ}) AS q, "
                    + ", ".join(f"avg({z}) AS m_{z}" for z in ZS) + " FROM lab GROUP BY cluster")
PARTS["sq_dist"] = (
    f"SELECT l.SEQN, l.cluster AS own, c.cluster, c.size, {' + '.join(f'l.{z} * l.{z}' for z in ZS)} "
    f"- 2 * ({' + '.join(f'l.{z} * c.m_{z}' for z in ZS)}) + c.q AS d FROM lab l CROSS JOIN sq_line c")
PARTS["sq_ab"] = (
    "SELECT SEQN, max(CASE WHEN cluster = own THEN d * size / greatest(size - 1, 1) END) AS a, "
    "max(CASE WHEN cluster = own THEN size END) AS size, min(CASE WHEN cluster <> own THEN d END) AS b "
    "FROM sq_dist GROUP BY SEQN")
_add("silhouette_squared",
     "SELECT count(*) AS n, round(avg(CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) "
     "AS silhouette FROM sq_ab")
_add("silhouette_embeddings", "SELECT cluster, count(*) AS n, round(avg(s), 6) AS silhouette FROM si_vec GROUP BY cluster")

# aggregates
_FULL = (_r6("avg(@)", "mean"), _r6("stddev_samp(@)", "std"), _r6("min(@)", "min"), _r6("max(@)", "max"))
_add("cluster_stats_full", _stats("den_b", FS, *_FULL))
_add("cluster_stats_rounded", _stats("lab", FS, f"{_HALF.format('avg(@)')} AS mean", f"{_HALF.format('stddev_samp(@)')} AS std"))
_add("cluster_means", _stats("lab", FS, _r6("avg(@)", "mean")))
_add("cluster_sizes",
     f"SELECT CAST(w.k AS integer) AS cluster, count(l.SEQN) AS size, printf('%.1f', count(l.SEQN) * 100.0::DOUBLE / "
     f"(SELECT count(*) FROM lab)) AS share_pct FROM range({K + 1}) w(k) LEFT JOIN lab l ON l.cluster = w.k GROUP BY w.k")
_add("cluster_sizes_non_noise", "SELECT cluster, count(*) AS size FROM den_b WHERE cluster <> -1 GROUP BY cluster")
_add("n_clusters", f"SELECT n_clusters FROM (SELECT {_FACTS} FROM den_b)")
_add("noise_ratio", f"SELECT noise_count, round(noise_ratio, 6) AS noise_ratio FROM (SELECT {_FACTS} FROM den_b)")
_add("distinct_labels", "SELECT DISTINCT cluster FROM den_b ORDER BY cluster")
_add("cluster_key_means", "SELECT cluster, size, round(mean_age, 6) AS mean_age, round(mean_gender, 6) AS mean_gender, "
                          "round(mean_bmi, 6) AS mean_bmi, round(mean_systolic, 6) AS mean_systolic, "
                          "CAST(NULL AS double) AS mean_diastolic FROM kmeans_groups")
_add("compare_algorithms", "SELECT algorithm, n_clusters, noise_count, round(noise_ratio, 6) AS noise_ratio, "
                           "total_samples FROM versus")
_add("union_labelled", "SELECT algorithm, SEQN, cluster FROM tagged")
_add("attach_labels", f"SELECT {_WIDE}, cluster FROM lab")
_L = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PARTS["lines"] = "SELECT *, CAST(floor(l_quantity / 10) AS integer) AS cluster FROM lineitem"
_add("lineitem_cluster_stats", _stats("lines", _L, *_FULL))
_add("lineitem_scaler", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {_r6(f'avg({f})', 'mean')}, {_r6(f'stddev_pop({f})', 'std')} FROM lineitem" for f in _L))

# rules
_add("rule_age_band", f"SELECT cluster, round(mean_age, 6) AS mean_age, {_AGE} AS band FROM kmeans_groups")
_add("rule_gender_majority", "SELECT cluster, majority FROM told_kmeans")
_add("rule_bmi_band", f"SELECT cluster, round(mean_bmi, 6) AS mean_bmi, {_BMI} AS band FROM kmeans_groups")
_add("rule_bp_band", f"SELECT cluster, round(mean_systolic, 6) AS mean_systolic, round(mean_diastolic, 6) AS "
                     f"mean_diastolic, {_BP} AS band FROM kmeans_groups")
_add("rule_group_type", "SELECT cluster, group_type, majority FROM told_row")
_add("rule_issues", "SELECT cluster, issues FROM told_row")
_add("rule_advice_items", "SELECT cluster, seq, number, code, text FROM items_row")
_add("rule_noise_group", "SELECT cluster, block FROM block_dense WHERE cluster = -1")
_add("rule_insufficient", "SELECT cluster, block FROM block_hole")
_add("rules_basic",
     "SELECT s.cluster, CASE WHEN coalesce(s.a, s.b, s.p) IS NULL THEN '普通健康群体 ' || (s.cluster + 1) ELSE "
     "concat_ws(' - ', x.label, y.label, w.label) END AS group_type, "
     "CASE WHEN s.a IS NULL AND coalesce(s.b, s.p) IS NOT NULL THEN '\n' ELSE '' END || i.lines AS advice_text "
     "FROM basic s LEFT JOIN age_names x ON x.band = s.a LEFT JOIN basic_names y ON y.band = s.b "
     "LEFT JOIN basic_names w ON w.band = s.p JOIN basic_items i ON i.cluster = s.cluster")
_add("render_group_block", "SELECT cluster, block FROM block_kmeans")
_add("render_basic_block",
     "SELECT cluster, '群体 ' || (cluster + 1) || ': ' || CASE WHEN mean_age < 30 THEN '青年健康群体' WHEN mean_age > 65 "
     "THEN '老年健康群体' ELSE '普通健康群体 ' || (cluster + 1) END || '\n' || printf('年龄均值: %.1f 岁', mean_age) || "
     "'\nBMI均值: 未知\n收缩压均值: 未知\n舒张压均值: 未知\n\n健康管理建议:\n' || (SELECT string_agg(number || '. ' || "
     "text, '\n' ORDER BY number) FROM basic_rows b WHERE b.band = CASE WHEN mean_age < 30 THEN 'young' WHEN mean_age > 65 "
     "THEN 'old' ELSE 'general' END) AS block FROM kmeans_groups")
_add("member_advice",
     "SELECT l.SEQN, l.cluster, t.group_type, CAST(i.n AS integer) AS n_advice FROM lab l JOIN told_kmeans t "
     "ON t.cluster = l.cluster JOIN (SELECT cluster, count(*) AS n FROM items_kmeans GROUP BY cluster) i "
     "ON i.cluster = l.cluster")
_add("segment_report",
     "SELECT t.cluster, t.size, round(mean_age, 6) AS mean_age, round(mean_bmi, 6) AS mean_bmi, round(mean_systolic, 6) "
     "AS mean_systolic, round(mean_diastolic, 6) AS mean_diastolic, group_type, majority, issues, CAST(i.n AS integer) AS "
     "n_advice FROM told_kmeans t JOIN (SELECT cluster, count(*) AS n FROM items_kmeans GROUP BY cluster) i "
     "ON i.cluster = t.cluster")

# plots
_add("plot_scatter",
     f"SELECT d.SEQN, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2, d.cluster, {_LABEL} AS label, "
     "CAST(dense_rank() OVER (ORDER BY d.cluster) - 1 AS integer) AS series FROM den_b d JOIN scores s ON s.SEQN = d.SEQN")
_add("plot_scatter_binned",
     "SELECT cluster, CAST(floor(pc1 / 0.5) AS bigint) AS bin_x, CAST(floor(pc2 / 0.5) AS bigint) AS bin_y, "
     "count(*) AS n FROM asg0 a JOIN scores s ON s.SEQN = a.SEQN GROUP BY 1, 2, 3")
_add("plot_feature_means", f"SELECT feature, cluster, mean, {_LABEL} AS label FROM (" +
     _stats("lab", FS, _r6("avg(@)", "mean")) + ")")
_add("plot_comparison", "SELECT algorithm, n_clusters, round(noise_ratio * 100, 6) AS noise_pct FROM versus")
