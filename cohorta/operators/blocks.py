"""Distance joins over bounded blocks.

Points are cut into blocks of at most ``BLOCK_ROWS`` points, so no block can be hot: along a sort order, or as the leaves
of a tree of axis splits whose upper levels come from a sample and whose lower levels are exact. Bounding boxes decide,
first for whole partitions and then for blocks, which pairs can matter, and a small array kernel reduces each pair to
per-point values. Pairs of points never become rows.

Blocks meet in tiles. Neighbouring blocks form bands of at most about ``64 sqrt(n)`` points; a tile is a pair of bands, and a block
is sent once to each tile in which it has a pair, not once per pair. With all pairs asked for, a block goes to as many
tiles as there are bands, so what moves grows with the power 1.5 of the number of points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.functions.exprs import box_gap2, box_span2, curve_key
from cohorta.session import cut, parallelism, stage

BLOCK_BITS = 9
BLOCK_ROWS = 1 << BLOCK_BITS
BLOCKS_PER_PART = 256
#: Range partitions at most; their pairs are enumerated, and beyond this the partitions grow instead.
MAX_PARTS = 8192
#: Sampled points per partition from which the upper splits of a tree are made.
SAMPLE_PER_PART = 64
#: Points of a band at most: two bands are held by a task.
BAND_ROWS = 1 << 19
#: Pairs given to a kernel at once, and result rows that are combined at once.
PAIR_CHUNK, COMBINE_ROWS = 32, 1 << 20
_DOUBLES = pa.list_(pa.float64())
_BLOCK_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), _DOUBLES, _DOUBLES, pa.list_(pa.int64()),
                _DOUBLES, pa.list_(_DOUBLES))
_BLOCK_COLUMNS = ("part", "block", "n", "w", "w_min", "lo", "hi", "pid", "wt", "x")
#: Block payload up to which a pair join may broadcast the blocks instead of shuffling them.
BROADCAST_BYTES = 48 << 20


def _place_bits() -> int:
    """Bits of a block number that hold its place within its range partition."""
    return 33 - BLOCK_BITS


@dataclass(frozen=True)
class Blocks:
    table: DataFrame   # one row per block: part, block, n, w, lo[], hi[], pid[], wt[], x[][], carried arrays
    n_parts: int
    n_points: int
    features: tuple

    @property
    def dims(self) -> int:
        return len(self.features)

    @property
    def payload_bytes(self) -> int:
        carried = sum(c not in _BLOCK_COLUMNS for c in self.table.columns)
        return self.n_points * (self.dims + 4 + carried) * 8

    @property
    def n_bands(self) -> int:
        return max(1, round(sqrt(self.n_points) / 64), ceil(self.n_points / BAND_ROWS))

    def bands(self, n_bands: int | None = None) -> DataFrame:
        """(block, band): blocks in order, dealt evenly to n_bands bands of neighbours."""
        spot = self.table.select("block", F.shiftright("block", _place_bits()).alias("slot"),
                                 (F.col("block") % (1 << _place_bits())).alias("place"))
        sizes = spot.groupBy("slot").agg((F.max("place") + 1).alias("size"))  # one row per range partition, <= MAX_PARTS
        before = sizes.select("slot", F.coalesce(F.sum("size").over(
            Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        total = sizes.agg(F.sum("size")).first()[0] or 1
        return spot.join(F.broadcast(before), "slot").select(
            "block", F.floor((F.col("before") + F.col("place")) * (n_bands or self.n_bands) / total).cast("int").alias("band"))

    def heads(self, *extra) -> DataFrame:
        return self.table.select("part", "block", "n", "w", "lo", "hi", *extra)

    def parts(self, **extra) -> DataFrame:
        """One row per range partition; ``extra`` names further aggregates over its blocks."""
        dims = range(self.dims)
        corner = [F.min(F.col("lo")[i]).alias(f"l{i}") for i in dims]
        corner += [F.max(F.col("hi")[i]).alias(f"h{i}") for i in dims]
        return self.table.groupBy("part").agg(
            F.sum("w").alias("w"), *corner, *[agg.alias(name) for name, agg in extra.items()]
        ).select(
            "part", "w", *extra,
            F.array(*[f"l{i}" for i in dims]).alias("lo"), F.array(*[f"h{i}" for i in dims]).alias("hi"))

    def points(self, *carry) -> DataFrame:
        """One row per point with its place; carried arrays come along element by element."""
        zipped = F.arrays_zip("pid", "wt", *carry)
        return self.table.select("part", "block", F.explode(zipped).alias("p")).select(
            "part", "block", "p.pid", F.col("p.wt").alias("w"), *[f"p.{c}" for c in carry])

    def with_arrays(self, values: DataFrame, *names, label: str = "blocks") -> "Blocks":
        """Attach per-point columns (keyed by part, block, pid) as arrays in block order."""
        packed = values.groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("pid", *names))).alias("p")  # bounded by the block size
        ).select("block", *[F.col(f"p.{c}").alias(c) for c in names])
        keep = [c for c in self.table.columns if c not in names]
        return replace(self, table=stage(self.table.select(keep).join(packed, "block"), label))


def _n_parts(points: DataFrame, n_points: int) -> tuple[int, bool]:
    """(range partitions, whether their boxes are a level of their own); few blocks need no coarser level."""
    full = ceil(n_points / BLOCK_ROWS)
    cores = parallelism(points.sparkSession)
    return max(1, min(full, MAX_PARTS, max(cores, ceil(full / BLOCKS_PER_PART)))), full > BLOCKS_PER_PART


def pack(points: DataFrame, features, n_points: int, carry=(), first=()) -> Blocks:
    """Place weighted points (pid, wt, features, carry) in blocks along a curve. ``first`` sorts ahead of the curve key."""
    parts, coarse_level = _n_parts(points, n_points)
    order = [*first, "curve", "pid"]
    # Upper bits: range partition; lower 33 bits: position in it.
    at = F.monotonically_increasing_id()
    coarse = F.shiftright("at", 33).cast("int") if coarse_level else F.lit(0)
    placed = (
        points.select("pid", F.col("wt").cast("double").alias("wt"), *features, *carry,
                      curve_key(features).alias("curve"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", at)
        .withColumns({"part": coarse, "block": F.shiftright("at", BLOCK_BITS)})
    )
    table = placed.groupBy("part", "block").agg(
        F.sort_array(F.collect_list(F.struct("pid", "wt", *features, *carry))).alias("p"),  # <= BLOCK_ROWS
        F.count(F.lit(1)).alias("n"),
        F.sum("wt").alias("w"),
        F.min("wt").alias("w_min"),
        F.array(*[F.min(f) for f in features]).alias("lo"),
        F.array(*[F.max(f) for f in features]).alias("hi"),
    ).select(
        "part", "block", "n", "w", "w_min", "lo", "hi",
        F.col("p.pid").alias("pid"), F.col("p.wt").alias("wt"),
        F.array(*[F.col(f"p.{f}") for f in features]).alias("x"),
        *[F.col(f"p.{c}").alias(c) for c in carry],
    )
    return Blocks(stage(table, "blocks"), parts if coarse_level else 1, n_points, tuple(features))


def _cut(x: np.ndarray, share: float) -> tuple[int, float] | None:
    """(column, value) that leaves about `share` of the rows at or below the value; None if all rows are equal.

    A wide gap in the middle half of a column, such as between codes, is cut first: it parts the boxes by that much.
    Otherwise the widest column is cut at that share, or at the next change of its value.
    """
    m = len(x)
    low, high = max(int(m * share / 2), 1), min(ceil(m * (1 + share) / 2), m - 1)
    line = np.sort(x, axis=0)
    gaps = line[low:high + 1] - line[low - 1:high]
    widest, spread = gaps.max(axis=0), x.std(axis=0)
    if (widest > spread / 2).any():
        col = int(np.argmax(widest))
        return col, float(line[low - 1 + int(np.argmax(gaps[:, col])), col])
    col = int(np.argmax(spread))
    values = line[:, col]
    if values[0] == values[-1]:
        return None
    value = values[min(max(round(m * share) - 1, 0), m - 1)]
    return col, float(value if value < values[-1] else values[np.searchsorted(values, value) - 1])


def _upper_tree(x: np.ndarray, leaves: int) -> np.ndarray:
    """Rows (column, value, lower child, upper child) of a tree with `leaves` leaves; a leaf is (-1, its number, 0, 0)."""
    nodes, numbers = [], iter(range(leaves))

    def grow(rows: np.ndarray, k: int) -> int:
        at = len(nodes)
        nodes.append(None)
        got = _cut(rows, (k // 2) / k) if k > 1 and len(rows) > 1 else None
        if got is None:
            nodes[at] = (-1.0, float(next(numbers)), 0.0, 0.0)
            return at
        side = rows[:, got[0]] <= got[1]
        # Leaves are dealt by the rows that each side really has.
        k_low = min(max(round(k * side.mean()), 1), k - 1)
        nodes[at] = (*got, grow(rows[side], k_low), grow(rows[~side], k - k_low))
        return at

    grow(x, leaves)
    return np.array(nodes)


def _leaf_rows(x: np.ndarray, rows: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Row numbers of each block of one partition, in tree order."""
    todo = [rows]
    while todo:
        rows = todo.pop()
        full = ceil(len(rows) / most)
        got = _cut(x[rows], (full // 2) / full) if full > 1 else None
        if full <= 1:
            yield rows
        elif got is None:  # equal points that differ in id only
            yield from (rows[k:k + most] for k in range(0, len(rows), most))
        else:
            side = x[rows, got[0]] <= got[1]
            todo += [rows[~side], rows[side]]


def pack_tree(points: DataFrame, features, n_points: int, carry=(), bound=None) -> Blocks:
    """Place weighted points (pid, wt, features, carry) in the leaves of a tree of axis splits. Carried columns are doubles;
    ``bound(x, wt, *carry)`` adds an upper bound per point (bound[]) and its maximum over the block (r2).

    The upper splits come from a sample, at most SAMPLE_PER_PART points for each of at most MAX_PARTS partitions; within a
    partition all of its points decide. Placement is a pure function of the points, so a repeated task places alike.
    """
    parts, coarse_level = _n_parts(points, n_points)
    features = list(features)
    flat = points.select("pid", F.col("wt").cast("double").alias("wt"), *features, *carry)
    every = max(n_points // (SAMPLE_PER_PART * parts), 1)
    sample = flat.filter(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0).select("pid", *features).toPandas().sort_values("pid")
    tree = _upper_tree(sample[features].to_numpy(dtype=float), parts)

    @F.pandas_udf("int")
    def leaf_of(*cols: pd.Series) -> pd.Series:
        x = np.column_stack(cols)
        at = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while live.size:
            column = tree[at[live], 0].astype(np.int64)
            live, column = live[column >= 0], column[column >= 0]
            node = tree[at[live]]
            at[live] = np.where(x[live, column] <= node[:, 1], node[:, 2], node[:, 3]).astype(np.int64)
        return pd.Series(tree[at, 1].astype(np.int32))

    names, types = [*_BLOCK_COLUMNS, *carry], [*_BLOCK_TYPES, *[_DOUBLES for _ in carry]]
    most, place_bits = BLOCK_ROWS, _place_bits()
    if bound:
        names, types = [*names, "r2", "bound"], [*types, pa.float64(), _DOUBLES]

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        slot, pid, wt = table.column("slot")[0].as_py(), table.column("pid").to_numpy(), table.column("wt").to_numpy()
        x = np.column_stack([table.column(f).to_numpy() for f in features])
        also = [table.column(c).to_numpy() for c in carry]
        out = {c: [] for c in names}
        for k, rows in enumerate(_leaf_rows(x, np.arange(len(pid)), most)):
            rows = np.sort(rows)
            mine = x[rows]
            values = (slot if coarse_level else 0, (slot << place_bits) + k, len(rows), wt[rows].sum(), wt[rows].min(),
                      mine.min(axis=0), mine.max(axis=0), pid[rows], wt[rows], list(mine.T), *[v[rows] for v in also])
            if bound:
                near = bound(mine.T, wt[rows], *[v[rows] for v in also])
                values += (near.max(), near)
            for c, v in zip(names, values):
                out[c].append(v)
        return pa.table({c: pa.array(out[c], t) for c, t in zip(names, types)})

    table = flat.withColumn("slot", leaf_of(*features)).groupBy("slot").applyInArrow(
        build, "part int, block long, n long, w double, w_min double, lo array<double>, hi array<double>, pid array<long>, "
               "wt array<double>, x array<array<double>>" + "".join(f", {c} array<double>" for c in carry)
               + (", r2 double, bound array<double>" if bound else ""))
    return Blocks(stage(table, "blocks"), parts if coarse_level else 1, n_points, tuple(features))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def _meet(blk: Blocks, half: bool, **extra) -> DataFrame:
    """Partition-level pairs through an equi-join on the partition number."""
    parts = blk.parts(**extra)
    low = F.col("a_part") if half else F.lit(0)
    return _side(parts, "a").withColumn("b_part", F.explode(F.sequence(low, F.lit(blk.n_parts - 1)))).join(
        _side(parts, "b"), "b_part")


def _open(pairs: DataFrame | None, heads: DataFrame, half: bool) -> DataFrame:
    """Replace partition pairs by the block pairs inside them; without pairs, all blocks are in one partition."""
    a, b = _side(heads, "a"), _side(heads, "b")
    if pairs is None:
        out = a.join(b, F.col("a_part") == F.col("b_part"))
    else:
        out = pairs.join(a, "a_part").join(b, "b_part")
    return out.filter(F.col("a_block") <= F.col("b_block")) if half else out


@dataclass(frozen=True)
class RangePairs:
    """Unordered node pairs for a distance range."""
    open: DataFrame            # a_block, b_block: to be decided point by point
    inside: tuple              # (level, pairs) with pairs wholly within the range, keyed a_<level>, b_<level>


def range_pairs(blk: Blocks, eps2: float) -> RangePairs:
    near, within = box_gap2("a", "b", blk.dims) <= eps2, box_span2("a", "b", blk.dims) <= eps2
    inside, top = [], None
    if blk.n_parts > 1:
        top = cut(_meet(blk, half=True).filter(near).select("a_part", "b_part", within.alias("within")))
        inside.append(("part", top.filter("within").select("a_part", "b_part")))
        top = top.filter("NOT within").select("a_part", "b_part")
    low = cut(_open(top, blk.heads(), half=True).filter(near).select("a_block", "b_block", within.alias("within")))
    inside.append(("block", low.filter("within").select("a_block", "b_block")))
    return RangePairs(low.filter("NOT within").select("a_block", "b_block"), tuple(inside))


def bounded_pairs(blk: Blocks, by_weight: bool = False) -> DataFrame:
    """Ordered block pairs (a, b) in which b may hold a point within the bound known for a (column r2).

    With ``by_weight`` the gap is scaled by the smallest Ward factor the two nodes allow.
    """
    gap = box_gap2("a", "b", blk.dims)
    if by_weight:
        # A hair of slack: the factor is applied to sums in another order than in the kernel.
        gap = gap * F.expr("2D * a_w_min * b_w_min / (a_w_min + b_w_min) * (1D - 1e-9D)")
    test = gap <= F.col("a_r2")
    top = None
    if blk.n_parts > 1:
        top = _meet(blk, half=False, r2=F.max("r2"), w_min=F.min("w_min")).filter(test).select("a_part", "b_part")
    return _open(top, blk.heads("r2", "w_min"), half=False).filter(test).select("a_block", "b_block")


#: Block numbers of the second table of a two-sided join start here.
SECOND = 1 << 52


def both_sides(a: Blocks, b: Blocks) -> Blocks:
    """Blocks of two tables as one, for pairs whose b_block is a block of the second."""
    shifted = b.table.withColumn("block", F.col("block") + SECOND)
    return replace(a, table=a.table.unionByName(shifted, allowMissingColumns=True), n_points=a.n_points + b.n_points)


def _two_sided(a: Blocks, b: Blocks, a_extra: dict, near) -> DataFrame:
    """Pairs of block heads (a_*, b_*) of two tables whose partitions are `near`; equi-joins on partition numbers."""
    left, right = _side(a.heads(*a_extra), "a"), _side(b.heads(), "b")
    if a.n_parts == 1 and b.n_parts == 1:  # few blocks: all lie in one partition
        return left.join(right, F.col("a_part") == F.col("b_part"))
    meet = _side(a.parts(**a_extra), "a").withColumn(
        "b_part", F.explode(F.sequence(F.lit(0), F.lit(b.n_parts - 1)))).join(_side(b.parts(), "b"), "b_part")
    return near(meet).select("a_part", "b_part").join(left, "a_part").join(right, "b_part")


def home_pairs(a: Blocks, b: Blocks, need: float) -> DataFrame:
    """(a_block, b_block): for each block of a, the block of b that holds `need` rows within the shortest reach of it.

    The reach, the largest distance between the two boxes, bounds how far the `need` nearest rows can lie. Partitions of b
    are passed over whose gap exceeds the reach of one that holds enough.
    """
    gap, span = box_gap2("a", "b", a.dims), box_span2("a", "b", a.dims)

    def near(meet: DataFrame) -> DataFrame:
        meet = meet.select("a_part", "b_part", gap.alias("gap"), F.when(F.col("b_w") >= need, span).alias("reach"))
        limit = meet.groupBy("a_part").agg(F.min("reach").alias("limit"))
        return meet.join(limit, "a_part").filter("limit IS NULL OR gap <= limit")
    return _two_sided(a, b, {}, near).filter(F.col("b_w") >= need).groupBy("a_block").agg(
        F.min(F.struct(span.alias("s"), F.col("b_block"))).alias("h")).select("a_block", F.col("h.b_block").alias("b_block"))


def reach_pairs(a: Blocks, b: Blocks) -> DataFrame:
    """(a_block, b_block): blocks of b that may hold a point within the bound known for a block of a (column r2)."""
    test = box_gap2("a", "b", a.dims) <= F.col("a_r2")
    return _two_sided(a, b, {"r2": F.max("r2")}, lambda meet: meet.filter(test)).filter(test).select("a_block", "b_block")


def all_pairs(blk: Blocks) -> DataFrame:
    """Every unordered block pair, for sums that need all points."""
    top = _meet(blk, half=True).select("a_part", "b_part") if blk.n_parts > 1 else None
    return _open(top, blk.table.select("part", "block"), half=True).select("a_block", "b_block")


def _tasks(blk: Blocks) -> int:
    cores = parallelism(blk.table.sparkSession)
    return cores if blk.n_points <= 8 * BLOCK_ROWS else 4 * cores


def sums_by(*keys: str, values: tuple) -> Callable[[pa.Table], pa.Table]:
    """Combine result rows of a tile: one per key, with the sums of the values."""
    return lambda t: t.group_by(list(keys)).aggregate([(v, "sum") for v in values]).rename_columns([*keys, *values])


def run_pairs(blk: Blocks, pairs: DataFrame | None, kernel, schema: str, a_cols, b_cols, combine=None) -> DataFrame:
    """Bring both blocks of each pair (a_block, b_block) together and run a kernel on them; without pairs, every
    unordered pair of blocks.

    Below the checked payload size the blocks are broadcast and only pair numbers move; above it they meet in tiles.
    ``combine`` may reduce the rows of a tile before they leave it; the caller aggregates again.
    """
    if blk.payload_bytes <= BROADCAST_BYTES:
        a = _side(blk.table.select("block", *a_cols), "a")
        b = _side(blk.table.select("block", *b_cols), "b")
        pairs = (all_pairs(blk) if pairs is None else pairs).repartition(_tasks(blk), "a_block", "b_block")
        return pairs.join(F.broadcast(a), "a_block").join(F.broadcast(b), "b_block").mapInArrow(kernel, schema)
    return run_tiles(blk, pairs, kernel, schema, a_cols, b_cols, combine)


def run_bands(blk: Blocks, kernel, schema: str, cols) -> DataFrame:
    """Every point meets every other one, tile by tile: the kernel takes the blocks of a tile and the rows of its two bands."""
    return run_tiles(blk, None, kernel, schema, cols, cols, None, True)


def run_tiles(blk: Blocks, pairs: DataFrame | None, kernel, schema: str, a_cols, b_cols, combine=None,
              whole: bool = False) -> DataFrame:
    """The tiles of run_pairs: a task reads the blocks of a tile, then its pairs, and holds no more than one tile.

    With all pairs there are enough bands for several tiles a task, but none of a few blocks only, and more partitions than
    tiles, so that hardly two tiles share one. With given pairs, which crowd in the tiles of neighbours, a tile with more than
    its share is parted by the first block of its pairs. ``whole`` hands the kernel a tile at once (see run_bands).
    """
    cols = list(dict.fromkeys(["block", *a_cols, *b_cols]))
    every = pairs is None
    n_bands = blk.n_bands
    if every:
        n_bands = max(ceil(blk.n_points / BAND_ROWS), min(ceil(sqrt(8 * _tasks(blk))), ceil(blk.n_points / (8 * BLOCK_ROWS))))
    bands = blk.bands(n_bands)
    payload = blk.table.select(*cols)
    none, zero = F.lit(None), F.lit(0).cast("int")
    if every:
        tile = F.struct(F.least("band", "peer").alias("i"), F.greatest("band", "peer").alias("j"), zero.alias("part")).alias("tile")
        rows = payload.join(bands, "block").withColumn("peer", F.explode(F.sequence(F.lit(0), F.lit(n_bands - 1)))).select(
            tile, F.lit(0).alias("kind"), "band", *cols, none.cast("long").alias("a_block"), none.cast("long").alias("b_block"))
        tasks = 2 * n_bands * (n_bands + 1)
    else:
        a, b = (bands.select(F.col("block").alias(f"{p}_block"), F.col("band").alias(f"{p}_band")) for p in "ab")
        tiled = stage(pairs.join(a, "a_block").join(b, "b_block").select(
            F.least("a_band", "b_band").alias("i"), F.greatest("a_band", "b_band").alias("j"), "a_block", "b_block"), "tiled")
        share = max(ceil(tiled.count() / (4 * _tasks(blk))), PAIR_CHUNK)
        sizes = tiled.groupBy("i", "j").agg(F.ceil(F.count(F.lit(1)) / share).alias("parts"))  # at most n_bands squared rows
        part = F.pmod(F.xxhash64("a_block"), "parts").cast("int").alias("part")
        tiled = tiled.join(F.broadcast(sizes), ["i", "j"]).select(F.struct("i", "j", part).alias("tile"), "a_block", "b_block")
        needs = tiled.select("tile", F.explode(F.array("a_block", "b_block")).alias("block")).distinct()
        kinds = {f.name: f.dataType for f in payload.schema.fields}
        rows = needs.join(payload, "block").select(
            "tile", F.lit(0).alias("kind"), zero.alias("band"), *cols, none.cast("long").alias("a_block"),
            none.cast("long").alias("b_block"))
        rows = rows.unionByName(tiled.select(
            "tile", F.lit(1).alias("kind"), zero.alias("band"), *[none.cast(kinds[c]).alias(c) for c in cols],
            "a_block", "b_block"))
        copies = max(needs.count() // max(payload.count(), 1), 1)
        tasks = max(_tasks(blk), ceil(blk.payload_bytes * copies / (64 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, blocks, asked, made, size = None, [], [], [], 0

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if not blocks:
                return
            table = pa.Table.from_batches(blocks).combine_chunks()
            at = {b: k for k, b in enumerate(table.column("block").to_pylist())}
            if every:
                band = table.column("band").to_numpy()
                one, two = (np.flatnonzero(band == t) for t in tile[:2])
                if whole:
                    if one.size and two.size:
                        yield from kernel(table, one, two if tile[0] < tile[1] else None)
                    return
                links = ((x, y) for x in one for y in two if tile[0] < tile[1] or x <= y)
            else:
                links = ((at[a], at[b]) for batch in asked for a, b in zip(
                    batch.column("a_block").to_pylist(), batch.column("b_block").to_pylist()))
            chunk: list = []

            def chunks() -> Iterator[pa.RecordBatch]:
                for link in links:
                    chunk.append(link)
                    if len(chunk) == PAIR_CHUNK:
                        yield meet()
                if chunk:
                    yield meet()

            def meet() -> pa.RecordBatch:
                x, y = (pa.array(v, pa.int64()) for v in zip(*chunk))
                chunk.clear()
                left, right = table.select(["block", *a_cols]).take(x), table.select(["block", *b_cols]).take(y)
                both = [c.combine_chunks() for c in left.columns + right.columns]
                names = [f"a_{c}" for c in left.column_names] + [f"b_{c}" for c in right.column_names]
                return pa.RecordBatch.from_arrays(both, names)

            for out in kernel(chunks()):
                if combine is None:
                    yield out
                    continue
                made.append(out)
                size += out.num_rows
                if size >= COMBINE_ROWS:
                    yield from settle(False)
            yield from settle(True)

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            """Combine what was made; keep it while that makes it much smaller."""
            nonlocal size
            if made:
                got = combine(pa.Table.from_batches(made))
                made.clear()
                if last or 2 * got.num_rows > COMBINE_ROWS:
                    size = 0
                    yield from got.combine_chunks().to_batches()
                else:
                    made.extend(got.combine_chunks().to_batches())
                    size = got.num_rows

        for batch in batches:
            ends = batch.column("tile")
            marks = np.stack([*(ends.field(f).to_numpy() for f in ("i", "j", "part")), batch.column("kind").to_numpy()])
            change = (marks[:, 1:] != marks[:, :-1]).any(axis=0)
            starts = np.flatnonzero(np.concatenate(([True], change, [True])))
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
                name, kind = tuple(marks[:3, low].tolist()), marks[3, low]
                if name != tile:
                    yield from answers()
                    tile, blocks, asked = name, [], []
                (asked if kind else blocks).append(batch.slice(low, high - low))
        yield from answers()

    return rows.repartition(tasks, "tile").sortWithinPartitions("tile", "kind", "block").mapInArrow(run, schema)
