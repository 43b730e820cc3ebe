"""Ranked lexical search: every item of a query table against all documents, by groups of documents with one term mask.

Terms are letters, digits and non-ASCII characters, A-Z made small. A first pass counts documents, terms and the documents
of each query term, and writes the postings of the query terms as one row per document. A second pass works on blocks
of documents: each query term has a bitmap of the block's documents that hold it; an item's bitmaps, turned, give each
document its presence mask, and documents are grouped by mask. The distinct masks are evaluated by descending maximum
score (weight times the largest share of each of their terms in the block) until the ``top`` best documents of the block lie above the
maximum of all masks left, so no document that could still enter is skipped. A window then merges the blocks' best per
item; Spark cuts each map task to ``top`` rows of an item before they are sent.

Items are read in blocks of at most ``block_bytes`` of text, which bounds what is sent to all tasks; each block takes one
pass over the documents, and its results are appended to one table. Scores are whole numbers, as the query's contract
says; Python's own integers hold the products that could pass 64 bits in the length factor.

Defined results: documents without a term, null and empty ones included, are found by no item and not counted. Rows are the
documents: rows that share an id, or have none, are ranked each; equal scores are ordered by id, those without id last.
Each row of the items is ranked by itself, repeated ones too; items without a term, or an empty table, give no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.common import texts
from cohorta.session import scratch_path, stage

#: Documents of a block at most, its postings at most, and bytes of the mask matrix of one item at most.
BLOCK_DOCS, BLOCK_POSTINGS, MASK_BYTES = 1 << 15, 1 << 22, 1 << 24
#: Bitmaps that are kept for further items of a block.
BITMAP_BYTES = 1 << 26
#: Text of items that is sent to all tasks at once, and text that is split into words at once.
ITEM_BYTES, SLICE_BYTES = 4 << 20, 4 << 20

#: Bytes of a term with A-Z made small; all other ASCII bytes part terms, bytes of longer characters belong to them.
_TABLE = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in slices that end between terms."""
    raw, at = text.encode().translate(_TABLE), 0
    while at < len(raw):
        end = at + SLICE_BYTES
        end = len(raw) if end >= len(raw) else raw.find(b" ", end)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _counts(text: str) -> tuple[int, Counter]:
    n, got = 0, Counter()
    for words in terms(text):
        n += len(words)
        got.update(words)
    return n, got


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log(float(2 * n_docs + 2) / float(2 * df + 1)))


class Block:
    """Postings of a block of documents by term: shares (the score of weight one), bitmaps, largest shares."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, docs: np.ndarray, tids: np.ndarray, tfs: np.ndarray):
        self.ids, self.n = doc_ids, len(doc_ids)
        order = np.lexsort((docs, tids))
        self.docs, tids, tfs = docs[order], tids[order], tfs[order]
        self.shares = (1_000_000_000 * tfs) // (1000 * tfs + 12 * lengths[self.docs])
        starts = np.flatnonzero(np.diff(tids, prepend=-1))
        self.spans = {int(tids[a]): (int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(tids)))}
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, tid: int) -> np.ndarray:
        if tid not in self.bitmaps:
            if len(self.bitmaps) * self.n >= 8 * BITMAP_BYTES:
                self.bitmaps.clear()
            a, b = self.spans[tid]
            bits = np.zeros(self.n, np.uint8)
            bits[self.docs[a:b]] = 1
            self.bitmaps[tid] = np.packbits(bits)
        return self.bitmaps[tid]

    def _masks(self, tids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(distinct masks as rows of bits, mask number of each document), by turning the bitmaps of the terms."""
        step = max(MASK_BYTES // max(len(tids), 1) // 8 * 8, 8)
        seen: dict[bytes, int] = {}
        number = np.empty(self.n, np.int64)
        for low in range(0, self.n, step):  # a slice of documents, so that an item of any length fits
            here = np.stack([self.bitmap(t)[low // 8:(low + step) // 8] for t in tids])
            turned = np.packbits(np.unpackbits(here, axis=1)[:, :self.n - low], axis=0).T
            kinds, back = np.unique(np.ascontiguousarray(turned).view(f"V{turned.shape[1]}").ravel(), return_inverse=True)
            number[low:low + step] = np.array([seen.setdefault(k.tobytes(), len(seen)) for k in kinds])[back]
        bits = np.frombuffer(b"".join(seen), np.uint8).reshape(len(seen), -1)
        return np.unpackbits(bits, axis=1, count=len(tids)), number

    def _scores(self, docs: np.ndarray, factors: dict[int, int]) -> np.ndarray:
        score = np.zeros(len(docs), np.int64)
        for tid, factor in factors.items():
            a, b = self.spans[tid]
            at = np.searchsorted(self.docs[a:b], docs)
            hit = (at < b - a) & (self.docs[a:b][np.minimum(at, b - a - 1)] == docs)
            score[hit] += factor * self.shares[a:b][at[hit]]
        return score

    def best(self, factors: dict[int, int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc ids, scores) of the block's top documents; factors are weight times repeats of the item's terms."""
        factors = {t: f for t, f in factors.items() if f > 0 and t in self.spans}
        none = np.zeros(0, np.int64)
        if not factors:
            return none, none
        tids = list(factors)
        masks, number = self._masks(tids)
        most = np.array([factors[t] * int(self.shares[slice(*self.spans[t])].max()) for t in tids], np.int64)
        bound = masks.astype(np.int64) @ most
        order = np.argsort(-bound, kind="stable")
        by_mask = np.argsort(number, kind="stable")
        edges = np.searchsorted(number[by_mask], np.arange(len(masks) + 1))
        docs, scores, k, want = none, none, 0, top
        while k < len(order) and bound[order[k]] > 0:
            if len(scores) >= top and bound[order[k]] < scores[top - 1]:
                break  # every document left lies below the last one kept
            some, size = [], 0
            while k < len(order) and size < want and bound[order[k]] > 0:
                some.append(by_mask[edges[order[k]]:edges[order[k] + 1]])
                size += len(some[-1])
                k += 1
            fresh = np.concatenate(some)
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, self._scores(fresh, factors)])
            keep = np.lexsort((self.ids[docs], -scores))[:top]
            docs, scores, want = docs[keep], scores[keep], 2 * want
        docs, scores = docs[scores > 0], scores[scores > 0]
        return self.ids[docs], scores


#: Stands for a missing id within a block: it is ranked after all others.
_NO_ID = np.iinfo(np.int64).max


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, tids, tfs): one row per document with a term; only terms of the vocabulary are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, ns, tids, tfs = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, got = _counts(text.as_py())
                if n:
                    held = [(known[t], got[t]) for t in got.keys() & known.keys()]
                    ids.append(doc)
                    ns.append(n)
                    tids.append([t for t, _ in held])
                    tfs.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(tids, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "tids", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, tids array<int>, tfs array<int>")


def _rank_blocks(postings: DataFrame, items, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The best documents of each block for each item: (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], 0, 0

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            ids = t.column("doc_id").fill_null(_NO_ID).to_numpy()
            lengths = np.array([75 + 25 * n * n_docs // n_terms for n in t.column("n").to_pylist()], np.int64)
            tids, tfs = t.column("tids").combine_chunks(), t.column("tfs").combine_chunks()
            counts = tids.value_lengths().to_numpy()
            block = Block(ids, lengths, np.repeat(np.arange(len(ids)), counts), tids.flatten().to_numpy(),
                          tfs.flatten().to_numpy().astype(np.int64))
            who, found, score = [], [], []
            for item, factors in items.value:
                doc_ids, scores = block.best(factors, top)
                who.append(np.full(len(doc_ids), item, np.int64))
                found.append(doc_ids)
                score.append(scores)
            found = np.concatenate(found)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(who)), pa.array(found, mask=found == _NO_ID), pa.array(np.concatenate(score))],
                ["item", "doc_id", "score"])

        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                held.append(batch.slice(low, 4096))
                docs += held[-1].num_rows
                size += len(held[-1].column("tids").flatten())
                if docs + 4096 > BLOCK_DOCS or size > BLOCK_POSTINGS:
                    yield flush()
                    held, docs, size = [], 0, 0
        if docs:
            yield flush()

    return postings.mapInArrow(run, "item long, doc_id long, score long")


def _numbered(items: DataFrame, block_bytes: int) -> DataFrame:
    """(item, item_id, text, part, piece): items with a number of their own, in pieces of at most block_bytes or one item."""
    at = stage(items.withColumn("item", F.monotonically_increasing_id()), "items")
    at = at.withColumn("part", F.shiftright("item", 33))
    before = F.sum(F.octet_length("text") + 1).over(
        Window.partitionBy("part").orderBy("item").rowsBetween(Window.unboundedPreceding, -1))
    return stage(at.withColumn("piece", F.floor(F.coalesce(before, F.lit(0)) / block_bytes)), "item-pieces")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", *, top: int = 20, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    docs = texts(docs, id_col, text_col)
    kind = items.schema[item_col].dataType.simpleString()
    queries = _numbered(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter(
        "text IS NOT NULL"), block_bytes)
    out, written = scratch_path(spark, "ranked"), False
    for part, piece in sorted(tuple(r) for r in queries.select("part", "piece").distinct().collect()):
        rows = queries.filter((F.col("part") == part) & (F.col("piece") == piece)).select("item", "text").collect()
        asked = [(r["item"], _counts(r["text"])[1]) for r in rows]
        names = {t: k for k, t in enumerate(sorted(set().union(*(c.keys() for _, c in asked))))}
        if not names:
            continue
        vocabulary = spark.sparkContext.broadcast(names)
        postings = stage(_postings(docs, vocabulary), "postings")
        n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(tuple(r) for r in postings.select(F.explode("tids").alias("t")).groupBy("t").count().collect())
        factors = spark.sparkContext.broadcast([
            (item, {names[t]: c * weight(n_docs, df[names[t]]) for t, c in counts.items() if names[t] in df})
            for item, counts in asked])
        best = _rank_blocks(postings, factors, n_docs, n_terms, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).write.mode("append").parquet(out)
        written = True
    if not written:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = spark.read.schema("item long, doc_id long, score long, rank int").parquet(out)
    return found.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
