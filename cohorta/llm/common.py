"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the characters [\x20\x09-\x0D] that separate words.
WHITE = " \t\n\x0b\x0c\r"


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any table: other columns, whatever their names, are left behind; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def parts_for(df: DataFrame, text_col: str = "text", part_bytes: int = 16 << 20) -> int:
    """How many pieces of about part_bytes of text the table makes: grows with the input, at least 1."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return int(size // part_bytes) + 1


def digest(text: Column) -> Column:
    """128 bits that tell texts apart; null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def same_row(docs: DataFrame, named: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Whether a row of docs is the one that named(named_id, named_digest) means: as much of a row as decisions depend
    on, its id, null or not, and its text."""
    return docs[id_col].cast("long").eqNullSafe(named["named_id"]) & (digest(docs[text_col]) == named["named_digest"])


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs that dropped(doc_id, digest) does not name: rows go by id and text, so neither rows without id nor
    rows that share an id are taken for one another."""
    gone = dropped.select(F.col("doc_id").alias("named_id"), F.col("digest").alias("named_digest"))
    return docs.join(gone, same_row(docs, gone, id_col, text_col), "left_anti")
