"""Exact n-gram Jaccard join of whole texts: a size-aware heavy-light join.

Two documents link when 4 * |both| >= 3 * |either| on their sets of word shingles, that is 7 * |both| >= 3 * (|x| + |y|).
Small sets list their subsets of the one size that a partner of a given size must share; equal subsets are links
without a further look (Deng, Tao and Li, 2018). Large sets are posted to inverted lists under their rarest shingles,
and the lists are scanned. The boundary between small and large is where listing costs more than posting.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.llm.common import digest, texts, without
from cohorta.llm.hashing import HASH_BYTES, LOWER, NOT_WHITE, flat_bytes, hash_runs, hash_words, mix, word_spans
from cohorta.llm.shared import shared_keys
from cohorta.llm.tokens import slices
from cohorta.operators.keys import connected_components
from cohorta.session import remove, scratch_path, stage, write

WORDS = 5
#: Sizes up to which listing subsets is considered; the cost decides below it.
LARGEST_SMALL = 16
#: Cost of a posting (sort, scan, verification) in subsets.
POSTING_COST = 4
#: 64-bit words of a sketch, and sets of a list that a task compares with all of it.
SKETCH, LIST = 16, 1024
#: Bounds per posting that the last comparison may look at, and the most rounds that make them fewer before it.
BOUNDS, ROUNDS = 50, 4


def shared_size(n: int, m: int) -> int:
    """How many shingles sets of n and m must share to link."""
    return -(-3 * (n + m) // 7)


def partners(n: int) -> range:
    """Sizes that a set of n can link with."""
    return range(-(-3 * n // 4), 4 * n // 3 + 1)


def subsets(n: int) -> int:
    return sum(comb(n, shared_size(n, m)) for m in partners(n) if shared_size(n, m) <= min(n, m))


def rest(n: np.ndarray | int):
    """Most shingles of a set of n that a partner may lack."""
    return n // 4


def boundary(sizes: dict[int, int]) -> int:
    """The largest size that lists subsets, at the least total cost. sizes: how many sets there are of each size."""

    def cost(b: int) -> int:
        return sum(c * ((subsets(n) if n <= b else 0) + (POSTING_COST * (rest(n) + 1) if 4 * n // 3 > b else 0))
                   for n, c in sizes.items() if n <= 2 * LARGEST_SMALL)

    return min(range(LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


def shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of the shingles) of each text that has a word."""
    for i, j in slices(column, HASH_BYTES):
        flat, offsets = flat_bytes(column.slice(i, j - i))
        flat = LOWER[flat]
        begin, end, first = word_spans(flat, offsets, NOT_WHITE)
        words = hash_words(flat, begin, end)
        runs = hash_runs(words, WORDS)
        for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= WORDS:
                yield i + k, np.unique(runs[a:b - WORDS + 1])
            elif b > a:
                yield i + k, hash_runs(words[a:b], b - a)


def identity(hashes: np.ndarray) -> int:
    """One 64-bit number for a set; equal sets, and for all practical purposes only they, have the same."""
    both = np.array([hashes.sum(dtype=np.uint64), mix(hashes).sum(dtype=np.uint64)]) + np.uint64(len(hashes))
    return int(mix(mix(both[:1]) ^ both[1:]).view(np.int64)[0])


def subset_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each subset of each size that some partner must share; the sizes of both are part of the key."""
    n, out = len(hashes), []
    for m in partners(n):
        need = shared_size(n, m)
        if need <= min(n, m):
            total = [sum(int(hashes[k]) for k in c) for c in combinations(range(n), need)]
            tag = (min(n, m) << 20 | max(n, m)) * 0x9E3779B97F4A7C15
            out += [(t + tag) % (1 << 64) for t in total]
    return mix(np.array(out, np.uint64))


def keys_by_size(hashes: np.ndarray, small: int, extra: int) -> np.ndarray:
    """What a set asks about: its subsets if small, its first shingles in hash order if large or next to large."""
    n, parts = len(hashes), []
    if n <= small:
        parts.append(subset_keys(hashes))
    if 4 * n // 3 > small:
        parts.append(hashes[:rest(n) + 1 + extra])
    return np.concatenate(parts)


def _margin(n):
    """Shingles beyond the necessary prefix: linked sets then share so many more of them."""
    return n // 25


def sketch(lists: pa.ListArray) -> np.ndarray:
    """SKETCH words per set: a bit says whether an odd number of its shingles fall on it. Shingles that two sets share fall
    out of the exclusive or of their sketches, so it has at most as many bits as there are shingles in just one of them."""
    width = 64 * SKETCH
    keys = np.asarray(lists.flatten(), np.int64).view(np.uint64)
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths(), np.int64))
    bits = np.bincount(row * width + (keys % np.uint64(width)).astype(np.int64), minlength=len(lists) * width) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(len(lists), SKETCH)


def sketched(sets: DataFrame) -> DataFrame:
    """(sid, s0, s1, ...): the sketch of each set."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                words = sketch(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(words[:, w].copy()) for w in range(SKETCH))],
                                                 names=["sid", *(f"s{w}" for w in range(SKETCH))])

    return sets.select("sid", "keys").mapInArrow(draw, "sid long, " + ", ".join(f"s{w} long" for w in range(SKETCH)))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with `both`, how many shingles they share, and whether they link."""
    a, b = (sets.select(F.col("sid").alias(c), F.col("keys").alias(f"keys_{c}")) for c in "ab")
    joined = pairs.join(a, "a").withColumn("n_a", F.size("keys_a")).join(b, "b")
    both = F.size(F.array_intersect("keys_a", "keys_b"))
    return stage(joined.select("a", "b", both.alias("both"), (7 * both >= 3 * (F.col("n_a") + F.size("keys_b"))).alias("link")),
                 "compared")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links, its own included).

    1. Equal sets are one set (`sid`), so copies, however many, cost a row each.
    2. Each set asks which of its keys (subsets, or a prefix in hash order a little longer than needed) other sets
       have. Linked sets share a known share of their prefixes; sets below it are done. Those left ask about all their
       shingles, and are done unless three quarters of them are shared.
    3. Small sets left over: an equal subset of sets of the two sizes is a link.
    4. Large sets left over are posted under their rarest shingles. Every list compares its sets with one of them, the
       most central; components grow, and lists that lie in one component are done. Pairs in different components that
       still share a list are compared at the end, unless what is known already, or a sketch, rules a link out: no link is lost.

    Null text and text without words have no shingles and link with nothing. Rows without id link like others; their
    component's id is null if no row of it has one. Rows that repeat an id bear the component of their own text. Empty
    tables give no rows. Sets are compared by 64-bit hashes of shingles.
    """
    known, named = _classes(docs, id_col, text_col)
    # Ids: the smallest of each set, then of each component.
    lowest = named.groupBy("comp").agg(F.min("own").alias("component_id"))
    named = named.join(lowest, "comp").select(F.col("sid").alias("set_id"), "component_id")
    held = known.filter("n > 0")
    return held.join(named, held["sid"] == named["set_id"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        known.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """known(doc_id, n, sid, digest), a row per document, and named(sid, own, comp), a row per set: the smallest id that
    holds it and its component. See jaccard_components for the steps."""
    rows = texts(docs, id_col, text_col)
    marked = rows.withColumn("digest", digest(F.col("text")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sid = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, hashes in shingles(batch.column(1)):
                n[row], sid[row] = len(hashes), identity(hashes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(sid), batch.column(2)],
                                             names=["doc_id", "n", "sid", "digest"])

    known = stage(marked.mapInArrow(measure, "doc_id long, n long, sid long, digest binary"), "set-sizes")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = {r["n"]: r["c"] for r in known.filter(F.col("n").between(1, 2 * LARGEST_SMALL)).groupBy("n").agg(
        F.count_distinct("sid").alias("c")).collect()}  # at most 2 * LARGEST_SMALL rows
    small = boundary(sizes)

    def ask(batch: pa.RecordBatch):
        for _, hashes in shingles(batch.column(1)):
            keys = keys_by_size(hashes, small, _margin(len(hashes)))
            yield np.full(len(keys), identity(hashes), np.int64), keys

    first = shared_keys(rows, ask, int(total * 0.3), count=True).withColumnRenamed("n", "hits")
    # A partner has at least 3/4 of the size, so at least its margin is shared; the prefixes share one key in any case.
    owners = known.filter("n > 0").groupBy("sid", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("row"))
    likely = first.join(owners, first["owner"] == owners["sid"]).filter(
        F.col("hits") > F.floor(F.floor(F.col("n") * 3 / 4) / 25)).select(
        F.col("row.doc_id").alias("own_id"), F.col("row.digest").alias("own_digest"), "sid")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(2), np.int64)
            kept = [(row, h) for row, h in shingles(batch.column(1)) if identity(h) == own[row]]
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(own[row]) for row, _ in kept], pa.int64()),
                     pa.array([h.view(np.int64) for _, h in kept], pa.list_(pa.int64()))], names=["sid", "keys"])

    wanted = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest"))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "likely-sets")
    write(marked.join(likely, wanted).select("doc_id", "text", "sid").mapInArrow(
        full, "sid long, keys array<long>").dropDuplicates(["sid"]), path)
    sets = spark.read.schema("sid long, keys array<long>").parquet(path)

    def ask_all(batch: pa.RecordBatch):
        lists = batch.column(1)
        keys = np.asarray(lists.flatten(), np.int64).view(np.uint64)
        yield np.repeat(np.asarray(batch.column(0), np.int64), np.asarray(lists.value_lengths(), np.int64)), keys

    n_left = sets.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    second = shared_keys(sets, ask_all, n_left, count=True).withColumnRenamed("n", "hits")
    sets = stage(sets.join(second, sets["sid"] == second["owner"]).filter(
        4 * F.col("hits") >= 3 * F.size("keys")).select("sid", "keys"), "near-sets")
    remove(spark, path)  # the sets that are done take no disk from the steps to come
    links = [_small_links(sets, small)] if small else []
    labels = _large_components(sets, small, links)

    return known, owners.select("sid", F.col("row.doc_id").alias("own")).join(labels, "sid", "left").select(
        "sid", "own", F.coalesce("comp", "sid").alias("comp"))


def _small_links(sets: DataFrame, small: int) -> DataFrame:
    """Links (a, b) between small sets: to the first set of each subset that sets of both its sizes list."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, keys in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.asarray(keys.values, np.int64).view(np.uint64)
                for m in partners(len(own)):
                    need = shared_size(len(own), m)
                    if need <= min(len(own), m) and m <= small:
                        both = [sum(int(own[k]) for k in c) % (1 << 64) for c in combinations(range(len(own)), need)]
                        yield pa.RecordBatch.from_pydict({
                            "sid": pa.array([sid] * len(both), pa.int64()), "n": pa.array([len(own)] * len(both), pa.int32()),
                            "low": pa.array([min(len(own), m)] * len(both), pa.int32()),
                            "high": pa.array([max(len(own), m)] * len(both), pa.int32()),
                            "key": np.array(both, np.uint64).view(np.int64)})

    rows = sets.filter(F.size("keys") <= small).mapInArrow(listed, "sid long, n int, low int, high int, key long")
    lists = rows.groupBy("low", "high", "key").agg(
        F.min("sid").alias("a"), F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("c")).filter(
        "c > 1 AND least = low AND most = high")
    return rows.join(lists.select("low", "high", "key", "a"), ["low", "high", "key"]).filter("sid <> a").select(
        "a", F.col("sid").alias("b")).distinct()


def _large_components(sets: DataFrame, small: int, links: list[DataFrame]) -> DataFrame:
    """(sid, comp) from the given links and those among large sets (and small ones next to them).

    Each list compares its sets with one head. What two sets of a list share is at most the smaller of what they share
    with the head, plus the smaller of what they have beyond the head and not alone; only pairs in different components
    that can link by this bound, and by the difference of their sketches, are compared. Where lists are so long that even the bounds would be too many, more
    rounds with other heads let the components grow first.
    """
    vertices = sets.select(F.col("sid").alias("v"))
    large = sets.filter(F.floor(4 * F.size("keys") / 3) > small)
    spread = large.select("sid", F.size("keys").alias("n"), F.explode("keys").alias("key"))
    often = spread.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    own = Window.partitionBy("sid")
    ranked = spread.join(often, "key").select(
        "sid", "n", "key", "df", F.row_number().over(own.orderBy("df", "key")).alias("at"),
        F.avg("df").over(own).alias("central"), F.count(F.when(F.col("df") > 1, 1)).over(own).alias("common"))
    posted = stage(ranked.filter("at <= floor(n / 4) + 1 AND df > 1").select("key", "sid", "n", "central", "common"),
                   "postings")
    n_posted, found, seen = posted.count(), [stage(e, "links") for e in links], None

    def components() -> DataFrame:
        if not found:
            return vertices.select(F.col("v").alias("sid"), F.col("v").alias("comp"))
        edges = found[0]
        for e in found[1:]:
            edges = edges.unionByName(e)
        return stage(connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), vertices).select(
            F.col("v").alias("sid"), "comp"), "components")

    def live(lists: DataFrame) -> DataFrame:
        """Postings of the lists that hold sets of several components."""
        now = lists.drop("comp").join(components(), "sid")
        spans = now.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1")
        return stage(now.join(spans.select("key"), "key", "left_semi"), "live")

    def heads(lists: DataFrame, order) -> DataFrame:
        return lists.groupBy("key").agg(F.max(F.struct(order.alias("o"), "sid")).alias("h")).select(
            "key", F.col("h.sid").alias("head"))

    def compare(pairs: DataFrame) -> DataFrame:
        nonlocal seen
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        facts = compared(pairs, sets)
        seen = facts.select("a", "b") if seen is None else seen.unionByName(facts.select("a", "b"))
        found.append(facts.filter("link").select("a", "b"))
        return facts

    led = posted.join(heads(posted, F.struct("central", "sid")), "key")
    facts = compare(led.filter("sid <> head").select(F.col("sid").alias("x"), F.col("head").alias("y")))
    known = facts.select("a", "b", "both").unionByName(facts.select(F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    led = led.join(known, (F.col("sid") == F.col("a")) & (F.col("head") == F.col("b")), "left").select(
        "key", "sid", "n", "common", F.coalesce("both", "common").alias("both"))
    lists = live(led)
    for turn in range(1, ROUNDS):
        parts = lists.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("c")).groupBy(
            "key").agg((F.pow(F.sum("c"), 2) - F.sum(F.pow("c", 2))).alias("pairs"))
        if (parts.agg(F.sum("pairs")).first()[0] or 0) <= BOUNDS * n_posted:
            break
        led = lists.join(heads(lists, F.struct(F.xxhash64("sid", F.lit(turn)), "sid")), "key")
        compare(led.filter("sid <> head").select(F.col("sid").alias("x"), F.col("head").alias("y")))
        lists = live(lists)
    # A long list is dealt over several tasks: each of its sets as x goes to one, as y to all of them.
    dealt = lists.join(lists.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / LIST).cast("int").alias("parts")), "key")
    drawn = stage(dealt.join(sketched(sets.join(lists.select("sid").distinct(), "sid", "left_semi")), "sid"), "sketched")
    words = [f"s{w}" for w in range(SKETCH)]
    parts = {"x": F.pmod(F.xxhash64("sid"), "parts").cast("int"), "y": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))}
    x, y = (drawn.select("key", parts[s].alias("part"), *[
        F.col(c).alias(f"{c}_{s}") for c in ("sid", "n", "comp", "both", "common", *words)]) for s in "xy")
    # Sets that link differ in at most a seventh of both sizes together, and their sketches in no more.
    differ = " + ".join(f"bit_count({w}_x ^ {w}_y)" for w in words)
    compare(x.join(y, ["key", "part"]).filter("sid_x < sid_y AND comp_x <> comp_y").filter(
        "7 * (least(both_x, both_y) + least(common_x - both_x, common_y - both_y)) >= 3 * (n_x + n_y)").filter(
        f"7 * ({differ}) <= n_x + n_y").select(
        F.col("sid_x").alias("x"), F.col("sid_y").alias("y")))
    return components()


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs of each component, all columns: the one with the smallest id, or where none has an id the one with
    the smallest digest of its text. Rows that link with nothing stay; rows that share id and text go or stay together."""
    known, named = _classes(docs)
    held = known.filter("n > 0").join(named.select("sid", "comp"), "sid").select("doc_id", "digest", "comp")
    best = held.groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("best"),
        F.count(F.lit(1)).alias("c")).filter("c > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))
    return without(docs, held.join(best, "comp").filter(~stays).select("doc_id", "digest"))
