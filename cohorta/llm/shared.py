"""Which 64-bit keys of a record occur in other records too, without a row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cohorta.session import stage

#: Keys a task gathers before it sends them on, and keys a bucket is meant to receive.
FLUSH_KEYS, BUCKET_KEYS = 1 << 19, 1 << 19
#: Owners need no answer where the task already knows it.
ANSWERED = np.iinfo(np.int64).min

ASKS = "bucket int, known boolean, keys binary, owners binary"
Keys = Iterator[tuple[np.ndarray, np.ndarray]]


def _row(bucket: int, known: bool, keys: np.ndarray, owners: np.ndarray) -> dict:
    return {"bucket": bucket, "known": known, "keys": keys.tobytes(), "owners": owners.tobytes()}


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Packed arrays of all rows end to end, read from Arrow's memory as it lies: the one copy is the result."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(v.as_buffer(), kind) for v in column)])


def shared_keys(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Keys], n_keys: int, *, count: bool) -> DataFrame:
    """(owner, n) or, without count, (owner, keys): the keys of each owner that another owner has as well.

    keys_of turns an Arrow batch of df into (owners, keys) arrays, n_keys in all or so. A task gathers FLUSH_KEYS of
    them and sends one packed row per bucket of the key space. A key that several owners of one flush have is known to
    be shared: its owners are answered on the spot, spread over all buckets, and only the key itself goes to its
    bucket. So a key that a third of all records have reaches its bucket once per flush, not once per record.
    Answers come back packed by parts of the owners, so each owner is one row. A count, or the list of keys, holds a key
    more than once only if the owner itself occurs more than once.
    """
    buckets = int(n_keys // BUCKET_KEYS) + 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            owners, keys = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            low, high = np.minimum.reduceat(owners, start), np.maximum.reduceat(owners, start)
            shared = np.repeat(low != high, np.diff(np.append(start, len(keys))))
            rows = []
            if shared.any():
                # The answered part goes to the buckets in turn, in rows of a bounded size.
                known_keys, known_owners = keys[shared], owners[shared]
                order = np.argsort(known_owners, kind="stable")
                for part in np.array_split(order, len(order) // (1 << 16) + 1):
                    rows.append(_row(turn % buckets, True, known_keys[part], known_owners[part]))
                    turn += 1
            keys, low = keys[start], np.where(low != high, ANSWERED, low)
            bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))  # keys are in order
            rows += [_row(k, False, keys[a:b], low[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            for k in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=pa.schema(
                    [("bucket", pa.int32()), ("known", pa.bool_()), ("keys", pa.binary()), ("owners", pa.binary())]))

        for batch in batches:
            for owners, keys in keys_of(batch):
                held.append((owners, keys))
                size += len(keys)
                if size >= FLUSH_KEYS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def packed(keys: np.ndarray, owners: np.ndarray) -> pa.Table:
        """The answers in one row per part of the owners; a count needs no keys."""
        part = owners.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        part = (part * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((owners, part))
        keys, owners, part = keys[order], owners[order], part[order]
        if count and len(owners):
            start = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
            keys = np.diff(np.append(start, len(owners))).astype(np.uint64)
            owners, part = owners[start], part[start]
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, int)
        spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        return pa.table({"part": pa.array(part[edges[:-1]] if len(part) else [], pa.int32()),
                         "owners": pa.array([owners[i:j].tobytes() for i, j in spans], pa.binary()),
                         "values": pa.array([keys[i:j].tobytes() for i, j in spans], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        known = table.column("known")
        asked, table = table.filter(pc.invert(known)), table.filter(known)
        keys, owners = _flat(asked.column("keys"), np.uint64), _flat(asked.column("owners"), np.int64)
        del asked
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            del order
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            low, high = np.minimum.reduceat(owners, start), np.maximum.reduceat(owners, start)
            # ANSWERED is the smallest owner of all, and stands for two at least.
            ok = np.repeat((low != high) | (low == ANSWERED), np.diff(np.append(start, len(keys))))
            ok &= owners != ANSWERED
            keys, owners = keys[ok], owners[ok]
        return packed(np.concatenate((_flat(table.column("keys"), np.uint64), keys)),
                      np.concatenate((_flat(table.column("owners"), np.int64), owners)))

    def gather(table: pa.Table) -> pa.Table:
        owners, values = _flat(table.column("owners"), np.int64), _flat(table.column("values"), np.uint64)
        order = np.argsort(owners, kind="stable")
        owners, values = owners[order], values[order]
        start = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
        if count:
            return pa.table({"owner": owners[start], "n": np.add.reduceat(values, start).astype(np.int64)})
        raw, ends = values.tobytes(), np.append(start[1:], len(owners))
        return pa.table({"owner": owners[start], "keys": pa.array(
            [raw[8 * i:8 * j] for i, j in zip(start.tolist(), ends.tolist())], pa.binary())})

    answers = df.mapInArrow(ask, ASKS).groupBy("bucket").applyInArrow(answer, "part int, owners binary, values binary")
    return stage(answers.groupBy("part").applyInArrow(
        gather, "owner long, n long" if count else "owner long, keys binary"), "shared")
