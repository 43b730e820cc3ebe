"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.common import texts
from cohorta.llm.tokens import END_ID, default_path, encoded
from cohorta.session import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """The combination of available lengths with the largest sum that fits: [(length, how many)].

    counts[l] pieces of length l are there. Bit s of a Python integer says whether the sum s can be made; the state
    before each step is kept, so that the combination can be read back. Long pieces come first, and of equal sums the
    one that needs the fewest short pieces is read back.
    """
    reach, steps = 1, []
    fits = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, take = min(int(counts[length]), room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & fits
            left -= take
            take *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return sorted(chosen.items(), reverse=True)


def plan_bins(counts: np.ndarray, room: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for counts[l] pieces of each length l: [(combination, how many bins hold just this one)].

    Minimum bin slack (Gupta and Ho, 1999): the longest piece left opens a bin, the fullest combination of the others
    joins it and is taken away. As long as a combination is still there it is still a fullest one, so it is applied as
    often as it is there: the work depends on the number of distinct lengths, not of pieces.
    """
    counts, bins = counts.copy(), []
    for length in range(room, 0, -1):
        while counts[length]:
            counts[length] -= 1
            chosen = dict(fullest(counts, room - length)) if length < room else {}
            counts[length] += 1
            chosen[length] = chosen.get(length, 0) + 1
            times = min(int(counts[k]) // n for k, n in chosen.items())
            for k, n in chosen.items():
                counts[k] -= n * times
            bins.append((sorted(chosen.items(), reverse=True), times))
    return bins


def cut_documents(docs: DataFrame, room: int, tokenizer_path: str, end_id: int) -> DataFrame:
    """Pieces of at most room ids; a longer document's first piece is the short one. `nth`: place among the pieces of
    this length in its part, a part being what one task has read."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
        end = np.array([end_id], "<u4")
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for row, found in encoded(batch.column(1), tokenizer_path):
                ids = np.concatenate((found, end))
                first = (len(ids) - 1) % room + 1
                edges = [0, *range(first, len(ids) + 1, room)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append((keys[row], k, a, b - a, zlib.crc32(ids[a:b]), part, seen[b - a]))
                    seen[b - a] += 1
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(
                    rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]).astype(
                    {"doc_id": "Int64", "piece": "int32", "part": "int32"}), preserve_index=False)

    return texts(docs).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, *, room: int = 1024, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are encoded where they are read and never move; what is shuffled is one small row per piece. The plan is made
    from the histogram of lengths, at most `room` numbers. A piece's place follows from its number among all pieces of
    its length, which is its number in its part plus a running total over parts, so no task sees a whole length.

    Null or empty text is a piece of the end id alone. Repeated rows are packed as often as they are there, null ids
    too. An empty table gives no rows.
    """
    pieces = stage(cut_documents(docs, room, tokenizer_path or default_path(), end_id), "pieces")
    sizes = stage(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-sizes")
    counts = np.zeros(room + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `room` rows
        counts[row["length"]] = row["n"]

    # Per length: from which number on a combination takes its pieces, how many it takes at once, and where they lie.
    taken, first = np.zeros(room + 1, np.int64), 0
    steps: dict[int, list[tuple[int, int, int, int]]] = {}
    for chosen, times in plan_bins(counts, room):
        offset = 0
        for length, n in chosen:
            steps.setdefault(length, []).append((int(taken[length]), n, first, offset))
            taken[length] += n * times
            offset += n * length
        first += times
    table = {length: np.array(rows, np.int64) for length, rows in steps.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (np.asarray(batch.column(c), np.int64) for c in ("length", "nth"))
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                own = table[int(length[rows[0]])]
                step = own[np.searchsorted(own[:, 0], nth[rows], "right") - 1]
                turn, slot = np.divmod(nth[rows] - step[:, 0], step[:, 1])
                sequence[rows], offset[rows] = step[:, 2] + turn, step[:, 3] + slot * length[rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return pieces.join(base, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("nth")).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
