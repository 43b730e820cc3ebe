"""Exact dedup with a heavy-hitter split, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.common import WHITE, digest, same_row, texts
from cohorta.session import stage

#: Counters of the Misra-Gries summary: a digest held by more than 1/COUNTERS of the rows is always among them.
COUNTERS = 8192
#: How many of them are looked at; also the bound of the broadcast.
CANDIDATES = 1024
#: Rows from which a verified digest goes the broadcast way.
HEAVY_ROWS = 64


def squeezed(text: Column) -> Column:
    """Text without its white space."""
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _winner(*ties: str) -> Column:
    # Nulls order first, so in this maximum a row without an id wins only where no other row ties with it.
    return F.max(F.struct("n", F.negative("doc_id").alias("neg"), *ties))


def _digests(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, sha, n, more): taken where the rows are read and written down, so texts never move."""
    return stage(
        texts(docs, id_col, text_col).select(
            "doc_id", F.unhex(F.sha2(squeezed(F.col("text")), 256)).alias("sha"),
            F.char_length("text").cast("long").alias("n"), *more), "digests")


def _decided(rows: DataFrame, ties: list[str], counters: int, candidates: int, heavy_rows: int) -> DataFrame:
    """rows with `best`, what the row of its group that stays looks like, and `size` of the group."""
    columns, short = rows.columns, F.xxhash64("sha")
    named = rows.agg(F.expr(f"approx_top_k(xxhash64(sha), {candidates}, {counters})").alias("top")).select(
        F.explode("top").alias("t")).select(F.col("t.item").alias("short"))
    heavy = stage(
        rows.join(F.broadcast(named), short == F.col("short"), "left_semi").groupBy("sha")
        .agg(_winner(*ties).alias("best"), F.count(F.lit(1)).alias("size")).filter(F.col("size") >= heavy_rows), "heavy")
    hot = rows.join(F.broadcast(heavy), "sha")
    group = Window.partitionBy("sha")
    cold = rows.join(F.broadcast(heavy.select("sha")), "sha", "left_anti").select(
        *columns, _winner(*ties).over(group).alias("best"), F.count(F.lit(1)).over(group).alias("size"))
    return hot.select(*columns, "best", "size").unionByName(cold)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, counters: int = COUNTERS,
                candidates: int = CANDIDATES, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; of equal texts the one with the most code points, then the
    smallest id, stays. Steps: (1) digests are taken where the rows are read and written down, so texts never move;
    (2) a Misra-Gries summary (the frequent-items sketch behind approx_top_k) names digests that may be frequent;
    (3) their exact counts and winners come from one map-side combined aggregate, and those with at least heavy_rows
    rows, at most `candidates` of them, are broadcast, so that their rows leave the stream without a shuffle;
    (4) the remaining digests, each in few rows, are shuffled once.

    Null text counts as empty. All empty texts are one group. A null id loses every tie and is its own keep_id only
    in a group without ids. Rows that share id and text are one document given twice: they bear the same decision.
    An empty table gives no rows.
    """
    rows = _digests(docs, id_col, text_col)
    return _decided(rows, [], counters, candidates, heavy_rows).select(
        "doc_id", F.negative("best.neg").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.negative("best.neg")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, counters: int = COUNTERS,
                candidates: int = CANDIDATES, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """One row of docs of each group of equal texts, all columns: as exact_dedup decides, and among rows without id that
    tie, the one with the smallest digest of its text. Of rows that share id and text one stays, any of them."""
    rows = _digests(docs, id_col, text_col, digest(F.col("text")).alias("digest"))
    decided = _decided(rows, ["digest"], counters, candidates, heavy_rows)
    stays = F.col("doc_id").eqNullSafe(F.negative("best.neg")) & (F.col("digest") == F.col("best.digest"))
    fates = stage(decided.groupBy(F.col("doc_id").alias("named_id"), F.col("digest").alias("named_digest")).agg(
        F.max(stays).alias("stays"), F.count(F.lit(1)).alias("copies")).filter("copies > 1 OR NOT stays"), "fates")
    out = docs.join(fates, same_row(docs, fates, id_col, text_col), "left_anti")
    again = fates.filter("stays")
    if again.isEmpty():
        return out
    held = docs.join(again, same_row(docs, again, id_col, text_col)).dropDuplicates(["named_id", "named_digest"])
    return out.unionByName(held.drop("named_id", "named_digest", "stays", "copies"))
