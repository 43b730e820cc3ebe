"""The named queries of the corpus operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm.decontaminate import leaks
from cohorta.llm.embedding_forest import near_vectors
from cohorta.llm.exact_dedup import exact_dedup
from cohorta.llm.html_text import extract
from cohorta.llm.jaccard_join import jaccard_components
from cohorta.llm.licenses import scan
from cohorta.llm.lm_scores import lm_scores
from cohorta.llm.mask_search import search
from cohorta.llm.packing import pack
from cohorta.llm.repeats import remove_repeats
from cohorta.llm.token_files import round_trip
from cohorta.llm.toxicity import toxicity
from cohorta.llm.turn_repair import repair
from cohorta.sources.tables import load


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(load(spark, folder, "pages"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(load(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(load(spark, folder, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(load(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(load(spark, folder, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(load(spark, folder, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(load(spark, folder, "documents")).withColumn("log_score", F.round("log_score", 3))


def op8_lm_scores_order2(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(load(spark, folder, "documents"), order=2).withColumn("log_score", F.round("log_score", 3))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(load(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op12_embedding_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(load(spark, folder, "embeddings"))


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair(load(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_extraction, op2_license_scan, op3_exact_dedup, op4_ngram_jaccard_join, op5_best_fit_packing,
        op6_suffix_array_dedup, op7_benchmark_decontamination, op8_lm_scores, op8_lm_scores_order2,
        op9_toxicity, op10_token_files, op11_ranked_search, op12_embedding_forest, op13_turn_repair)}

ORACLES = {
    "op3_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256,
                   length(coalesce(text, '')) AS n
            FROM documents),
        g AS (
            SELECT doc_id, text_sha256,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g""",
    "op4_ngram_jaccard_join": """
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS l
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(
                       CASE WHEN len(l) >= 5 THEN [array_to_string(l[i:i + 4], ' ') FOR i IN range(1, len(l) - 3)]
                            WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS shingle
            FROM t),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
            FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        e AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * o >= 75 * (x.n + y.n - o)),
        r AS (SELECT doc_id AS v, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v),
        c AS (SELECT v, min(root) AS component_id FROM r GROUP BY v)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.v = d.doc_id""",
    "op6_suffix_array_dedup": """
        WITH t AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM t, unnest(range(0, greatest(n - 49, 0))) u(i)),
        f AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM w)
            WHERE least < doc_id),
        g AS (
            SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS gap
            FROM f),
        k AS (SELECT doc_id, i, sum(gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
        r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
        x AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
        y AS (
            SELECT t.doc_id, count(*) AS spans, sum(b - a) AS gone, max(b) AS last,
                   string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
            FROM t JOIN x ON x.doc_id = t.doc_id GROUP BY t.doc_id)
        SELECT t.doc_id, t.n AS n_bytes, CAST(coalesce(y.gone, 0) AS bigint) AS n_removed,
               coalesce(y.spans, 0) AS n_spans,
               sha256(unhex(coalesce(y.kept, '') || substr(t.h, 2 * coalesce(y.last, 0) + 1))) AS kept_sha256
        FROM t LEFT JOIN y ON y.doc_id = t.doc_id""",
    "op8_lm_scores": """
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS l
            FROM documents),
        w AS (SELECT r, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM t),
        p AS (
            SELECT r, i, word, lag(word) OVER o AS p1, lag(word, 2) OVER o AS p2
            FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
        c AS (
            SELECT r, i, p1, p2, count(*) OVER (PARTITION BY word) - count(*) OVER (PARTITION BY r, word) AS n1,
                   count(*) OVER (PARTITION BY p1, word) - count(*) OVER (PARTITION BY r, p1, word) AS n2,
                   count(*) OVER (PARTITION BY p2, p1, word) - count(*) OVER (PARTITION BY r, p2, p1, word) AS n3,
                   count(*) OVER () - count(*) OVER (PARTITION BY r) AS n
            FROM p),
        s AS (
            SELECT r, CASE WHEN p2 IS NOT NULL AND n3 > 0 THEN 3 WHEN p1 IS NOT NULL AND n2 > 0 THEN 2
                           WHEN n1 > 0 THEN 1 ELSE 0 END AS used,
                   CASE used WHEN 3 THEN n3 / lag(n2) OVER o
                             WHEN 2 THEN pow(0.4::DOUBLE, least(i, 3) - 2) * n2 / lag(n1) OVER o
                             WHEN 1 THEN pow(0.4::DOUBLE, least(i, 3) - 1) * n1 / n
                             ELSE pow(0.4::DOUBLE, greatest(least(i, 3), 2)) / (n + 1) END AS v
            FROM c WINDOW o AS (PARTITION BY r ORDER BY i)),
        a AS (SELECT r, count(*) AS n, count(*) FILTER (used > 1) AS hits, sum(ln(v)) AS x FROM s GROUP BY r)
        SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(hits, 0) AS n_pairs, coalesce(n - hits, 0) AS n_backed_off,
               round(coalesce(x, 0.0), 3) AS log_score
        FROM t LEFT JOIN a USING (r)""",
    "op8_lm_scores_order2": """
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS l
            FROM documents),
        w AS (SELECT r, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM t),
        p AS (SELECT r, i, word, lag(word) OVER (PARTITION BY r ORDER BY i) AS prev FROM w),
        c AS (
            SELECT r, i, prev, count(*) OVER (PARTITION BY word) - count(*) OVER (PARTITION BY r, word) AS u,
                   count(*) OVER (PARTITION BY prev, word) - count(*) OVER (PARTITION BY r, prev, word) AS b,
                   count(*) OVER () - count(*) OVER (PARTITION BY r) AS n
            FROM p),
        s AS (
            SELECT r, prev IS NOT NULL AND b > 0 AS hit,
                   CASE WHEN prev IS NOT NULL AND b > 0 THEN b / lag(u) OVER (PARTITION BY r ORDER BY i)
                        WHEN u > 0 THEN CASE WHEN prev IS NULL THEN 1.0 ELSE 0.4 END::DOUBLE * u / n
                        ELSE 0.4::DOUBLE * 0.4::DOUBLE / (n + 1) END AS v
            FROM c),
        a AS (SELECT r, count(*) AS n, sum(hit::BIGINT)::BIGINT AS hits, sum(ln(v)) AS x FROM s GROUP BY r)
        SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(hits, 0) AS n_pairs, coalesce(n - hits, 0) AS n_backed_off,
               round(coalesce(x, 0.0), 3) AS log_score
        FROM t LEFT JOIN a USING (r)""",
    "op11_ranked_search": """
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS l
            FROM documents),
        s AS (SELECT count(*) FILTER (len(l) > 0) AS n_docs, sum(len(l))::BIGINT AS n_terms FROM t),
        i AS (
            SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS l
            FROM benchmark),
        k AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(l) AS term FROM i) GROUP BY ALL),
        p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(l) AS term FROM t)
              WHERE term IN (SELECT term FROM k) GROUP BY d, term),
        w AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM p, s GROUP BY term, n_docs),
        m AS (SELECT d, doc_id, 100 - 25 + ((25 * len(l) * n_docs) // n_terms) AS m FROM t, s WHERE len(l) > 0),
        a AS (
            SELECT q, item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM k JOIN p USING (term) JOIN w USING (term) JOIN m USING (d) GROUP BY q, item_id, d, doc_id),
        o AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
            FROM a WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""",
    "op12_embedding_forest": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y <> 0)) > 0
              AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        e AS (
            SELECT a.vec_id AS p, b.vec_id AS q
            FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
        r AS (SELECT vec_id AS w, vec_id AS root FROM embeddings UNION SELECT e.q, r.root FROM r JOIN e ON e.p = r.w),
        c AS (SELECT w, min(root) AS component_id FROM r GROUP BY w),
        n AS (SELECT p, count(*) AS n FROM e GROUP BY p)
        SELECT m.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
        FROM embeddings m JOIN c ON c.w = m.vec_id LEFT JOIN n ON n.p = m.vec_id""",
    "op13_turn_repair": """
        WITH RECURSIVE src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations),
        hit AS (
            SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
                       [4294967295] || flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(key, '')]),
                       lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 20 AS kind
            FROM src),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
            FROM hit WHERE kind <> 0),
        line AS (
            SELECT conv_id, turn, role, text, left(role, 1) AS ini,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
            FROM hurt),
        f AS (
            SELECT *, shown = '' AS blank,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
                   right(shown, 1) NOT IN ('.', '!', '?') AS cut, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev
            FROM line),
        e AS (SELECT *, blank OR seen AS gone, CASE WHEN cut AND NOT blank AND NOT seen THEN 1 ELSE 0 END AS late FROM f),
        r AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS z, {'c': 1000000000::BIGINT, 'a': ''} AS s,
                   {'c': 2::BIGINT, 'a': 'I'} AS u, {'c': 4::BIGINT, 'a': 'II'} AS v
            FROM conversations
            UNION ALL
            SELECT conv_id, i, z, s,
                   list_min([u, {'c': z.c + 2, 'a': z.a || 'I'}, {'c': s.c + 2, 'a': s.a || 'I'}, {'c': v.c + 2, 'a': v.a || 'I'}]),
                   list_min([v, {'c': z.c + 4, 'a': z.a || 'II'}, {'c': s.c + 4, 'a': s.a || 'II'}, {'c': u.c + 2, 'a': u.a || 'I'}])
            FROM (
                SELECT r.conv_id, e.i, {'c': z.c + 3, 'a': z.a || 'D'} AS z,
                       list_min([{'c': s.c + 3, 'a': s.a || 'D'},
                                 {'c': z.c + late + CASE WHEN ini = 's' AND NOT gone THEN 0 ELSE 1000000000 END, 'a': z.a || 'K'}]) AS s,
                       list_min([{'c': u.c + 3, 'a': u.a || 'D'}] || [
                                 {'c': p.c + late + CASE WHEN gone THEN 1000000000 WHEN ini = 'u' THEN 0 ELSE 2 END,
                                  'a': p.a || CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END} FOR p IN [z, s, v]]) AS u,
                       list_min([{'c': v.c + 3, 'a': v.a || 'D'},
                                 {'c': u.c + late + CASE WHEN gone THEN 1000000000 WHEN ini = 'a' THEN 0 ELSE 2 END,
                                  'a': u.a || CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END}]) AS v
                FROM r JOIN e ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i + 1)),
        b AS (SELECT conv_id, list_min([arg_max(z, i), arg_max(v, i)]) AS w FROM r GROUP BY conv_id),
        o AS (
            SELECT conv_id, k, l, sum((l <> 'I')::INT) OVER w AS i
            FROM (SELECT conv_id, unnest(string_split(w.a, '')) AS l, generate_subscripts(string_split(w.a, ''), 1) AS k
                  FROM b WHERE w.a <> '')
            WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
        t AS (
            SELECT o.conv_id, k, l, e.role, CASE WHEN l = 'I' THEN '' ELSE e.text END AS text,
                   sum((l <> 'D' AND NOT (l = 'K' AND ini = 's'))::INT) OVER (PARTITION BY o.conv_id ORDER BY k) AS n
            FROM o LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.i = o.i),
        h AS (
            SELECT conv_id, sha256(string_agg(
                       CASE WHEN l = 'K' THEN role WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10)
                       ORDER BY k)) AS sha
            FROM t WHERE l <> 'D' GROUP BY conv_id),
        g AS (
            SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, sum(blank::INT) AS blank,
                   sum((seen AND NOT blank)::INT) AS duplicate, sum(late) AS truncated,
                   sum((prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au'))::INT) AS illegal
            FROM e GROUP BY conv_id)
        SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, w.c::BIGINT AS cost, w.a AS audit,
               coalesce(sha, sha256('')) AS repaired_sha256
        FROM b LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM b.conv_id""",
}
