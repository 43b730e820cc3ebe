"""Stupid-backoff language-model scores from counts over the whole corpus.

Counts of runs of up to `order` words are tables partitioned by hash. Documents are dealt into groups of bounded text; a group
sends its distinct n-grams with their counts, one packed row per partition of the count table, and gets the totals back
in the same order. Each document is scored on the counts of all others, so that its own words do not vouch for
themselves: what nobody else wrote is backed off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import parts_for, texts
from cohorta.llm.hashing import HASH_BYTES, LOWER, NOT_WHITE, flat_bytes, hash_runs, hash_words, word_spans
from cohorta.llm.tokens import slices
from cohorta.session import bucketed, stage

#: Fixed value: the weight of each step back (Brants et al., 2007).
ALPHA = 0.4
#: Words of the longest n-grams.
ORDER = 3
#: Text per group of documents, and text whose n-grams one partition of the count table holds, at order two; a higher
#: order has more n-grams in as much text and takes less of it.
GROUP_BYTES, PARTITION_BYTES = 4 << 20, 16 << 20

#: The key space is counted in so many passes from order three on, so that the n-grams on their way lie on disk in part only.
PASSES = 2

SCORES = "doc_id long, n_words long, n_pairs long, n_backed_off long, log_score double"


def _grams(column: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(for n from 1 to order the hash of each word and the n - 1 before it, first word of each text): 0 stands where
    the text has fewer words before."""
    column = column.combine_chunks()
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for i, j in slices(column, HASH_BYTES):
        flat, offsets = flat_bytes(column.slice(i, j - i))
        flat = LOWER[flat]
        begin, end, first = word_spans(flat, offsets, NOT_WHITE)
        hashes.append(hash_words(flat, begin, end))
        counts.append(np.diff(first))
    words, first = np.concatenate(hashes), np.cumsum(np.concatenate(counts))
    nth, grams = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first)), [words]
    for n in range(2, order + 1):
        runs = np.zeros(len(words), np.uint64)
        if len(words) >= n:
            runs[n - 1:] = hash_runs(words, n)
        runs[nth < n - 1] = 0
        grams.append(runs)
    return grams, first


def _all(grams: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([grams[0], *(g[g != 0] for g in grams[1:])])


def _pack(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second and so on: bytes that are mostly 0 compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    return _pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the slices of sorted keys for each partition of the key space begin and end."""
    bucket = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(parts + 1, dtype=np.uint64))


def _border(part: int, parts: int) -> int:
    """The least key of a partition of the key space."""
    return -(-(part << 32) // parts) << 32


def lm_scores(docs: DataFrame, *, order: int = ORDER, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_pairs (scored by the pair or a longer run), n_backed_off (by the word
    alone or less), log_score (sum of natural logarithms).

    Words are maximal runs of anything but white space, A-Z made small. With counts over all other rows, a word scores
    by the longest run of at most `order` words that ends in it, lies in its text and is there: count(run) / count(run
    without the word), for the word alone count(word) / all words, times alpha for each word by which the run is
    shorter than the text allows; a word that is nowhere else 1 / (all words + 1) times alpha for each word of the
    longest run that the text allows, alpha^2 at least.

    Null, empty and blank texts have no words and score 0. Rows count once each, repeated ones and those without id
    too. An empty table gives no rows. N-grams are told apart by 64-bit hashes.
    """
    rows = texts(docs, id_col, text_col)
    group_bytes = GROUP_BYTES * 2 // max(order, 2)
    groups = parts_for(rows, part_bytes=group_bytes)
    parts = groups * GROUP_BYTES // PARTITION_BYTES + 1
    # Texts move once: each pass and the scores find a group where it lies.
    held = bucketed(rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")).repartition("g"),
                    "g", "lm-texts")
    dealt = held.table
    passes = min(PASSES if order > 2 else 1, parts)

    def ask(turn: int):
        def run(table: pa.Table) -> pa.Table:
            grams, _ = _grams(table.column("text"), order)
            # The partitions of this pass; every word is counted in the pass that it falls in.
            low, high = (_border(k * parts // passes, parts) for k in (turn, turn + 1))
            own = [g[(g >= np.uint64(low)) & (g <= np.uint64(high - 1))] for g in grams]
            keys, counts = np.unique(_all(own), return_counts=True)
            edges = _parts(keys, parts)
            some = np.flatnonzero(np.diff(edges))
            return pa.table({
                "g": pa.array([table.column("g")[0].as_py()] * len(some), pa.int32()), "part": pa.array(some, pa.int32()),
                "words": pa.array([len(own[0]) if k == 0 else 0 for k in range(len(some))], pa.int64()),
                "keys": pa.array([_pack_keys(keys[edges[k]:edges[k + 1]]) for k in some], pa.binary()),
                "counts": pa.array([_pack(counts[edges[k]:edges[k + 1]].astype(np.uint32)) for k in some], pa.binary())})

        return run

    def total(table: pa.Table) -> pa.Table:
        held = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
        keys, at = np.unique(np.concatenate(held), return_inverse=True)
        counts = np.concatenate([_unpack(c, np.uint32) for c in table.column("counts").to_pylist()])
        sums = np.bincount(at, counts, len(keys)).astype(np.int64)[at]
        ends = np.cumsum([len(h) for h in held])[:-1]
        return pa.table({"g": table.column("g"), "part": table.column("part"), "words": table.column("words"),
                         "totals": pa.array([_pack(s) for s in np.split(sums, ends)], pa.binary())})

    answers = None
    for turn in range(passes):
        got = stage(
            dealt.groupBy("g").applyInArrow(ask(turn), "g int, part int, words long, keys binary, counts binary")
            .groupBy("part").applyInArrow(total, "g int, part int, words long, totals binary"), "ngram-totals")
        answers = got if answers is None else answers.unionByName(got)
    n_all = answers.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, first = _grams(left.column("text"), order)
        n = np.diff(first)
        keys = np.unique(_all(grams))
        by_part = np.argsort(np.asarray(right.column("part")))
        raw = right.column("totals").to_pylist()
        totals = np.concatenate([_unpack(raw[k], np.int64) for k in by_part] or [np.zeros(0, np.int64)])
        doc = np.repeat(np.arange(len(n)), n)

        def others(grams: np.ndarray) -> np.ndarray:
            """How often each n-gram stands in other documents, 0 where there is none."""
            out, there = np.zeros(len(grams), np.int64), np.flatnonzero(grams)
            if len(there):
                code = np.searchsorted(keys, grams[there])
                _, at, own = np.unique(doc[there] * len(keys) + code, return_inverse=True, return_counts=True)
                out[there] = totals[code] - own[at]
            return out

        rest = np.maximum(n_all - n, 0)[doc]
        longest = np.minimum(np.arange(len(doc)) - np.repeat(first[:-1], n) + 1, order)
        value, used, before = alpha ** np.maximum(longest, 2) / (rest + 1), np.zeros(len(doc), np.int64), rest
        for size in range(1, order + 1):
            count = others(grams[size - 1])
            on = count > 0
            value[on] = alpha ** (longest[on] - size) * count[on] / before[on]
            used[on] = size
            before = np.concatenate((np.ones(min(len(count), 1), np.int64), count[:-1]))
        logs = np.concatenate((np.log(value), [0.0]))
        scores = np.where(n > 0, np.add.reduceat(logs, np.minimum(first[:-1], len(logs) - 1)), 0.0)
        hits = np.add.reduceat(np.concatenate((used > 1, [False])).astype(np.int64), first[:-1]) * (n > 0)
        return pa.table({"doc_id": left.column("doc_id"), "n_words": n, "n_pairs": hits, "n_backed_off": n - hits,
                         "log_score": scores})

    scores = stage(dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(score, SCORES), "lm-scores")
    held.drop()
    return scores
