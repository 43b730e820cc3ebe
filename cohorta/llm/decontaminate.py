"""Benchmark decontamination: n-gram seeds find the places, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import texts
from cohorta.llm.hashing import HASH_BYTES, LETTERS, LOWER, flat_bytes, hash_runs, hash_words, word_spans
from cohorta.llm.tokens import slices

#: Words per seed; every run of so many words of an item is a seed.
SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: An item counts as leaked from this share of its score against itself, or where the alignment scores as much as so many
#: equal words in a row.
SHARE, LONG_RUN = 0.5, 13
#: Bytes of benchmark text that go with one pass over the corpus; more of it takes more passes.
BLOCK_BYTES = 4 << 20

HITS = "doc_id long, item_id long, score double, matches int, words int"


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters and digits, A-Z made small) of a string array, and where each text's begin."""
    flat, offsets = flat_bytes(column)
    flat = LOWER[flat]
    begin, end, first = word_spans(flat, offsets, LETTERS)
    return hash_words(flat, begin, end), first


class Grams:
    """A set of hashes with a fast first look: a table of their low bits sends most others away."""

    def __init__(self, hashes: np.ndarray, bits: int = 20):
        self.hashes, self.mask = np.unique(hashes), np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.hashes & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where, which): places of `hashes` that hold a member, and its number."""
        where = np.flatnonzero(self.table[hashes & self.mask])
        which = np.searchsorted(self.hashes, hashes[where])
        ok = np.append(self.hashes, np.uint64(0))[which] == hashes[where]
        ok &= which < len(self.hashes)
        return where[ok], which[ok]


def runs_within(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the runs of `size` words that do not leave their text."""
    hashes = hash_runs(words, size)
    ends = np.repeat(first[1:], np.diff(first))[:len(hashes)]
    place = np.flatnonzero(np.arange(len(hashes)) + size <= ends)
    return place, hashes[place]


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(score, matching words) of the best local alignment (Smith and Waterman, 1981), row by row over the item.

    With the same cost for every word of a gap, a row's gaps are a running maximum, so a row is a few array steps.
    Matches of the best path are carried along in the low bits of each cell.
    """
    unit = 1 << 20
    ramp = -GAP * unit * np.arange(len(text) + 1, dtype=np.int64)
    row, best = np.zeros(len(text) + 1, np.int64), 0
    for word in item:
        same = text == word
        new = np.maximum(row + GAP * unit, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(same, MATCH * unit + 1, MISMATCH * unit))
        new[new < unit] = 0
        row = np.maximum.accumulate(new + ramp) - ramp
        best = max(best, int(row.max()))
    return best >> 20, best & (unit - 1)


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of about BLOCK_BYTES of text, one at a time at the driver."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for k in range(n):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()


def _runs(words: np.ndarray) -> np.ndarray:
    return hash_runs(words, min(len(words), SEED_WORDS)) if len(words) else np.zeros(0, np.uint64)


def _finder(block: list, share: float, long_run: int) -> Callable[[pa.Array], Iterator[tuple]]:
    """What finds a block of items in a column of texts: (row, item_id, score, matches, words) of each leak."""
    words, first = words_of(pa.array([r["text"] for r in block], pa.string()))
    items = [words[a:b] for a, b in zip(first[:-1], first[1:])]
    sizes = sorted({min(len(i), SEED_WORDS) for i in items if len(i)})
    known = Grams(np.concatenate([_runs(i) for i in items] or [np.zeros(0, np.uint64)]))
    spots: list[list[tuple[int, int]]] = [[] for _ in known.hashes]
    for k, item in enumerate(items):
        for at, gram in enumerate(np.searchsorted(known.hashes, _runs(item)).tolist()):
            spots[gram].append((k, at))
    ids = [r["item_id"] for r in block]

    def find(column: pa.Array) -> Iterator[tuple]:
        for i, j in slices(column, HASH_BYTES):
            words, first = words_of(column.slice(i, j - i))
            near: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for size in sizes:
                place, hashes = runs_within(words, first, size)
                where, which = known.find(hashes)
                own = place[where]
                doc = np.searchsorted(first, own, "right") - 1
                for d, at, gram in zip(doc.tolist(), own.tolist(), which.tolist()):
                    for k, spot in spots[gram]:
                        pad = len(items[k]) // 4 + 2
                        low = max(at - spot - pad, int(first[d]))
                        high = min(at - spot + len(items[k]) + pad, int(first[d + 1]))
                        near.setdefault((d, k), []).append((low, high))
            for (d, k), spans in near.items():
                score, matches = best_of(words, sorted(spans), items[k], share, long_run)
                full = MATCH * len(items[k])
                if score >= min(share * full, MATCH * long_run):
                    yield i + d, ids[k], score / full, matches, len(items[k])

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, *, share: float = SHARE, long_run: int = LONG_RUN) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, score (share of the item's score against
    itself), matches (equal words in the alignment), words (of the item).

    For each block of items one pass reads the corpus where it lies, looks for the seeds and aligns the words around
    them. All runs are seeds, so a copy is aligned wherever SEED_WORDS words in a row were left as they are, whatever
    other documents hold; a place without such a run is not looked at. Null and empty texts and items match nothing;
    items shorter than a seed are one seed as a whole. Repeated rows give repeated results. Rows without id are
    searched too and come out with a null id. Empty tables give no rows.
    """
    rows = texts(docs)
    out = None
    for block in _item_blocks(benchmark):
        find = _finder(block, share, long_run)

        def search(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                found = [(keys[row], *rest) for row, *rest in find(batch.column(1))]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*found), (
                            pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()))],
                        names=["doc_id", "item_id", "score", "matches", "words"])

        hits = rows.mapInArrow(search, HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def _item_blocks(benchmark: DataFrame) -> Iterator[list]:
    return _blocks(texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id"))


def best_of(words: np.ndarray, spans: list[tuple[int, int]], item: np.ndarray, share: float, long_run: int
            ) -> tuple[int, int]:
    """The best alignment of the item within spans of a text, overlapping ones taken as one. A span that has too few of
    the item's words for either limit is not aligned."""
    merged = [spans[0]]
    for low, high in spans[1:]:
        if low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    best = (0, 0)
    least = min(int(np.ceil(share * len(item))), long_run)
    for low, high in merged:
        if np.isin(item, words[low:high]).sum() >= least:
            best = max(best, align(words[low:high], item))
    return best


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", share: float = SHARE, long_run: int = LONG_RUN
          ) -> DataFrame:
    """The rows of docs in which no benchmark item was found, all columns. Each row is kept or dropped where it is read,
    by its own text, whatever its id."""
    at = docs.columns.index(text_col)
    out = docs
    for block in _item_blocks(benchmark):
        find = _finder(block, share, long_run)

        def keep(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = pc.fill_null(batch.column(at), "")
                for i, j in slices(column, HASH_BYTES):  # what goes back to the JVM goes in small batches
                    clean_rows = np.ones(j - i, bool)
                    clean_rows[[row for row, *_ in find(column.slice(i, j - i))]] = False
                    yield batch.slice(i, j - i).filter(pa.array(clean_rows))

        out = out.mapInArrow(keep, docs.schema)
    return out
