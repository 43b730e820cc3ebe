"""Raw token-id files with keyed access: payload shards in id order and a minimal perfect hash over their keys.

A shard is three files. `<name>.ids`: the ids of its documents, end to end, little-endian, 2 bytes each if the
vocabulary fits, else 4. `<name>.rows`: unsigned 64-bit; the first id of each document in the shard, and the shard's
length; then each document's key (signed 64-bit). `<name>.mph`: the index. Keys that hash alike on a level of the
index go to the next one (the levels of Limasset et al., 2017); the rank of a key's bit is its slot, and a slot holds
a fingerprint and the document's place among the rows. A lookup is a few probes, whatever the number of keys.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorta.llm.common import parts_for, texts
from cohorta.llm.tokens import END_ID, default_path, encoded, encoder
from cohorta.session import scratch_path

#: Ids after which a shard is closed; a longer document has a shard of its own.
SHARD_IDS = 8 << 20
NO_KEY = np.iinfo(np.int64).min  # a row without doc_id: stored and counted, not in the index

SHARDS = "part int, shard int, name string, width int, n_rows long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each key (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct keys; None of a key's probes hits another key's bit on the key's level."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.before = [np.concatenate(([0], np.cumsum(b)))[:-1] for b in bits]
        self.base = np.concatenate(([0], np.cumsum([b.sum() for b in bits]))).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 2.0) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = int(spread * len(left)) + 1
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key; -1 for one that surely is not among the keys."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            at = (mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.base[level] + before[at[hit]]
            open_ = open_[~hit]
        return out


def index_bytes(keys: np.ndarray) -> bytes:
    """The index of a shard's keys, given in row order; a key's first row counts."""
    distinct, row = np.unique(keys, return_index=True)
    distinct, row = distinct[distinct != NO_KEY], row[distinct != NO_KEY]
    hashed = PerfectHash.build(distinct)
    place, prints = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
    slot = hashed.slots(distinct)
    place[slot], prints[slot] = row, fingerprints(distinct)
    out = io.BytesIO()
    np.savez(out, place=place, prints=prints, sizes=np.array([len(b) for b in hashed.bits], np.int64),
             bits=np.packbits(np.concatenate([*hashed.bits, np.zeros(0, bool)])))
    return out.getvalue()


class Index:
    """rows(keys): the first row of each key in the shard, -1 if its fingerprint is not there."""

    def __init__(self, raw: bytes):
        held = np.load(io.BytesIO(raw))
        self.place, self.prints, sizes = held["place"], held["prints"], held["sizes"]
        flat = np.unpackbits(held["bits"], count=int(sizes.sum())).astype(bool)
        self.hashed = PerfectHash(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    def rows(self, keys: np.ndarray) -> np.ndarray:
        slot = self.hashed.slots(keys)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == fingerprints(keys[ok])
        out = np.full(len(keys), -1, np.int64)
        out[ok] = self.place[slot[ok]]
        return out


def _put(store: fs.FileSystem, path: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename: a task that runs again leaves the same file whole."""
    own = f"{path}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, path)


def _get(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_file(path) as file:
        return file.read()


def write_token_files(docs: DataFrame, folder: str, *, tokenizer_path: str | None = None, end_id: int = END_ID,
                      shard_ids: int = SHARD_IDS, part_bytes: int = 16 << 20) -> DataFrame:
    """Write the files below folder (shared by all executors) and return the manifest, one row per shard.

    Rows are range-partitioned and sorted by doc_id (nulls first; equal ids by text), each partition encodes its own
    and closes a shard every shard_ids ids, so a task holds one shard. Null or empty text is a document of the end id
    alone. Repeated ids are all stored; the index names the first. An empty table makes no shard. The manifest,
    also kept as <folder>/manifest, has each shard's first id among all (`before`).
    """
    spark, tokenizer_path = docs.sparkSession, tokenizer_path or default_path()
    rows = texts(docs)
    count = parts_for(rows, part_bytes=part_bytes)
    fs.FileSystem.from_uri(folder)[0].create_dir(f"{fs.FileSystem.from_uri(folder)[1]}/shards", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        kind = np.dtype("<u2") if max(encoder(tokenizer_path).largest, end_id) < 1 << 16 else np.dtype("<u4")
        end, shard, keys, ids, held = np.array([end_id], kind), 0, [], [], 0

        def close() -> pa.RecordBatch:
            name = f"{part:08d}-{shard:06d}"
            sizes = np.array([len(i) + 1 for i in ids], np.int64)
            own = np.array(keys, np.int64)
            _put(store, f"{root}/shards/{name}.ids", b"".join(x.tobytes() for i in ids for x in (i, end)))
            _put(store, f"{root}/shards/{name}.rows",
                 np.concatenate(([0], np.cumsum(sizes))).astype("<u8").tobytes() + own.astype("<i8").tobytes())
            _put(store, f"{root}/shards/{name}.mph", index_bytes(own))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "name": [name],
                "width": pa.array([kind.itemsize], pa.int32()), "n_rows": [len(own)], "n_ids": [int(sizes.sum())]})

        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, found in encoded(batch.column(1), tokenizer_path):
                if held and held + len(found) + 1 > shard_ids:
                    yield close()
                    shard, keys, ids, held = shard + 1, [], [], 0
                keys.append(NO_KEY if own[row] is None else own[row])
                ids.append(found.astype(kind))
                held += len(found) + 1
        if held:
            yield close()

    shards = rows.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, SHARDS)
    shards.write.mode("overwrite").parquet(f"{folder}/shards.parquet")
    # One row per shard: the running total is over a table some millions of times smaller than the corpus.
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    spark.read.schema(SHARDS).parquet(f"{folder}/shards.parquet").withColumn(
        "before", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).write.mode("overwrite").parquet(
        f"{folder}/manifest.parquet")
    return spark.read.schema(f"{SHARDS}, before long").parquet(f"{folder}/manifest.parquet")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document back from the files: doc_id, start, n_tokens and the checksum of its ids.

    Each key is looked up through the index of its shard; a row that the index does not name (a repeated id or none)
    is found by its place.
    """
    manifest = spark.read.schema(f"{SHARDS}, before long").parquet(f"{folder}/manifest.parquet")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for s in batch.to_pylist():
                path = f"{root}/shards/{s['name']}"
                raw = _get(store, f"{path}.rows")
                starts = np.frombuffer(raw, "<u8", s["n_rows"] + 1).astype(np.int64)
                keys = np.frombuffer(raw, "<i8", s["n_rows"], 8 * (s["n_rows"] + 1))
                ids = np.frombuffer(_get(store, f"{path}.ids"), f"<u{s['width']}")
                row = Index(_get(store, f"{path}.mph")).rows(keys)
                again = np.concatenate(([False], keys[1:] == keys[:-1])) | (keys == NO_KEY)
                row = np.where(again, np.arange(len(keys)), row)
                if (keys[row] != keys).any():
                    raise ValueError(f"{path}: the index does not fit the payload")
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts[row], starts[row + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=keys == NO_KEY), pa.array(s["before"] + starts[row]),
                     pa.array(starts[row + 1] - starts[row]), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(manifest.count(), 1)
    return manifest.repartition(n, "part", "shard").mapInArrow(read, ROWS)


def lookup(folder: str, name: str, keys: list[int]) -> list[np.ndarray | None]:
    """Ids of single documents of one shard, straight from the files: an index probe and one ranged read each."""
    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/shards/{name}"
    width = store.get_file_info(f"{path}.ids").size
    with store.open_input_file(f"{path}.rows") as rows, store.open_input_file(f"{path}.ids") as payload:
        n = rows.size() // 16  # n + 1 starts and n keys of 8 bytes each
        width //= max(int(np.frombuffer(rows.read_at(8, 8 * n), "<u8")[0]), 1)
        out = []
        for key, row in zip(keys, Index(_get(store, f"{path}.mph")).rows(np.array(keys, np.int64)).tolist()):
            if row < 0 or np.frombuffer(rows.read_at(8, 8 * (n + 1 + row)), "<i8")[0] != key:
                out.append(None)
                continue
            a, b = np.frombuffer(rows.read_at(16, 8 * row), "<u8").tolist()
            out.append(np.frombuffer(payload.read_at((b - a) * width, a * width), f"<u{width}"))
    return out


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write all documents to files in the shared scratch folder and return what is read back from them."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder)
