"""Near duplicates among embeddings: a forest of random-projection trees whose splits overlap.

Vectors are compared only within (label, length). Exact copies count as one weighted point. A group that is too large for
one task is split by a tree whose planes are fitted on a bounded sample of each node (``sample_rows`` points); points
near a plane go to both sides, and every point is placed. Inside each cell of such a tree a forest of ``trees`` trees is
grown over all of the cell's points; pairs are compared within leaves by cosine, verified in double precision and
united. A node that planes cannot part (a dense group) stays whole, whatever its size, and is compared in tiles of pairs
of blocks, so that dense groups lose no link. Pairs never become rows: a cell hands back the number of links of each
point and one star of edges per connected part.

Defined results: a vector that is null, empty, zero, or holds a null, NaN or infinite component, and a row without label
link with nothing (0 links, its own component, kept). Rows are the nodes, ids only name them: rows that share an id are
separate rows; a component is named by its smallest id; rows without id get the name of their component, and are kept
only where it has none. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.operators.keys import connected_components
from cohorta.session import stage

#: Depth by which one round of the distributed tree splits a node, and points its planes are fitted on at most.
ROUND_DEPTH, SAMPLE_ROWS = 5, 2048
#: A plane that leaves more than this share of a node on one side does not part it.
STUCK = 0.85
#: Points that are compared at once within a leaf.
TILE = 1024

NODE = ["label", "d", "node"]


def unit_rows(vectors: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """n x d matrix of unit vectors in doubles; components are scaled first, so that no square overflows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), d)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _plane(x: np.ndarray, rng: np.random.Generator, margin: float, tries: int = 8):
    """A random direction, its median and whether it parts the points; of some directions the one with most spread."""
    ways = rng.standard_normal((tries, x.shape[1]))
    ways /= np.linalg.norm(ways, axis=1, keepdims=True)
    at = x @ ways.T
    k = int(at.std(axis=0).argmax())
    middle = float(np.median(at[:, k]))
    share = max((at[:, k] <= middle + margin).mean(), (at[:, k] >= middle - margin).mean())
    return ways[k], middle, share <= STUCK


def leaves(x: np.ndarray, rng: np.random.Generator, leaf_rows: int, margin: float) -> Iterator[np.ndarray]:
    """Row numbers of each leaf of one tree; a node that no plane parts is a leaf of any size."""
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) > leaf_rows:
            way, middle, parts = _plane(x[rows], rng, margin, 1)
            if not parts:
                way, middle, parts = _plane(x[rows], rng, margin)
            if parts:
                at = x[rows] @ way
                todo += [rows[at <= middle + margin], rows[at >= middle - margin]]
                continue
        yield rows


def _linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs have a cosine of at least `least`; those near the limit are summed again pair by pair."""
    cos = a @ b.T
    hit = cos >= least
    i, j = np.nonzero(np.abs(cos - least) < 1e-9)
    hit[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= least
    return hit


def links(x: np.ndarray, sides: np.ndarray | None, trees: int, leaf_rows: int, margin: float, least: float,
          seed: int) -> np.ndarray:
    """Symmetric matrix of the links found by any tree. With sides, only pairs of different sides are wanted."""
    found = np.zeros((len(x), len(x)), bool)

    def compare(rows: np.ndarray):
        parts = [rows[k:k + TILE] for k in range(0, len(rows), TILE)]
        for i, p in enumerate(parts):
            for q in parts[i:]:
                hit = _linked(x[p], x[q], least)
                found[np.ix_(p, q)] |= hit
                found[np.ix_(q, p)] |= hit.T

    if sides is not None:
        compare(np.arange(len(x)))  # two blocks of a node that no plane parts
        found &= sides[:, None] != sides[None, :]
    else:
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            whole = False
            for rows in leaves(x, rng, leaf_rows, margin):
                whole |= len(rows) == len(x)
                compare(rows)
            if whole:  # one leaf holds everything: other trees have nothing to add
                break
    np.fill_diagonal(found, False)
    return found


def _stars(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One star of edges per connected part."""
    todo, u, v = found.any(axis=1), [], []
    while todo.any():
        seed = int(todo.argmax())
        todo[seed] = False
        front = np.array([seed])
        while front.size:
            front = np.flatnonzero(found[front].any(axis=0) & todo)
            todo[front] = False
            u.append(np.full(front.size, seed))
            v.append(front)
    none = np.zeros(0, np.int64)
    return (np.concatenate(u), np.concatenate(v)) if u else (none, none)


def _planes(rows: np.ndarray, depth: int, margin: float, rng: np.random.Generator) -> list:
    """Planes of a subtree in heap order: (way, middle) to part by, False for a dense leaf, None for a plain one."""
    out: list = [None] * (1 << (depth + 1))
    here = {1: rows}
    while here:
        k, x = here.popitem()
        if k >= 1 << depth or len(x) < 16:
            continue
        way, middle, parts = _plane(x, rng, margin)
        out[k] = (way, middle) if parts else False
        if parts:
            at = x @ way
            here[2 * k], here[2 * k + 1] = x[at <= middle + margin], x[at >= middle - margin]
    return out


def _route(x: np.ndarray, planes: list, margin: float) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(heap number, dense, rows) of each leaf of a subtree."""
    todo = [(1, np.arange(len(x)))]
    while todo:
        k, rows = todo.pop()
        plane = planes[k] if k < len(planes) else None
        if plane is None or plane is False:
            yield k, plane is False, rows
            continue
        at = x[rows] @ plane[0]
        todo += [(2 * k, rows[at <= plane[1] + margin]), (2 * k + 1, rows[at >= plane[1] - margin])]


def _margin(d: int, least: float, spill: float) -> float:
    """Linked unit vectors lie at most sqrt(2 - 2 least) apart; on a random direction that shrinks by sqrt(d)."""
    return spill * sqrt(max(2 - 2 * least, 0.0) / d)


def _split(points: DataFrame, cell_rows: int, sample_rows: int, least: float, spill: float) -> tuple[DataFrame, bool]:
    """points with `node`: nodes above cell_rows are parted until they fit or no plane parts them (node < 0)."""
    placed, split = points.withColumn("node", F.lit(1).cast("long")), False
    schema = placed.schema
    while True:
        sizes = placed.filter("node > 0").groupBy(*NODE).agg(F.count(F.lit(1)).alias("rows"))
        over = stage(sizes.filter(F.col("rows") > cell_rows), "forest-over")
        if over.isEmpty():
            return placed, split
        split = True
        order = Window.partitionBy(*NODE).orderBy(F.xxhash64("pt", "node"), "pt")
        sample = placed.join(over, NODE).withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= sample_rows)

        def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            d, node = int(key[1]), int(key[2])
            x = unit_rows(pa.array(pdf["vec"]), d)
            depth = min(ROUND_DEPTH, ceil(log2(pdf["rows"].iloc[0] / cell_rows)))
            rng = np.random.default_rng([node, d])
            planes = _planes(x[np.argsort(pdf["pt"].to_numpy())], depth, _margin(d, least, spill), rng)
            flat = np.concatenate([
                np.concatenate([[1.0, p[1]], p[0]]) if p else np.full(d + 2, 0.0 if p is None else 2.0) for p in planes])
            return pd.DataFrame({"label": [key[0]], "d": [d], "node": [node], "planes": [flat.tobytes()]})

        kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        fitted = stage(sample.select(*NODE, "pt", "vec", "rows").groupBy(*NODE).applyInPandas(
            fit, f"label {kinds['label']}, d int, node long, planes binary"), "forest-planes")

        def move(batches):
            for b in batches:
                t = pa.Table.from_batches([b])
                blobs, out = b.column("planes"), []
                d_of = b.column("d").to_numpy(zero_copy_only=False)
                nodes = b.column("node").to_numpy(zero_copy_only=False)
                keys: dict = {}
                for i in range(b.num_rows):
                    keys.setdefault((d_of[i], nodes[i], blobs[i].as_py()), []).append(i)
                for (d, node, blob), at in keys.items():
                    d, at = int(d), np.array(at)
                    flat = np.frombuffer(blob).reshape(-1, d + 2)
                    planes = [(p[2:], p[1]) if p[0] == 1.0 else (False if p[0] == 2.0 else None) for p in flat]
                    x = unit_rows(b.column("vec").take(pa.array(at)), d)
                    for k, dense, rows in _route(x, planes, _margin(d, least, spill)):
                        deep = k.bit_length() - 1
                        name = (int(node) << deep) | (k - (1 << deep))
                        # A node that stays as it was cannot be parted either.
                        name = -name if dense or k == 1 else name
                        got = t.take(pa.array(at[rows])).drop_columns(["planes"])
                        out.append(got.set_column(got.schema.get_field_index("node"), "node",
                                                  pa.array(np.full(len(rows), name, np.int64))))
                yield from (pa.concat_tables(out).combine_chunks().to_batches() if out else [])

        done = placed.join(over.select(*NODE), NODE, "left_anti").select(*schema.names)
        moved = placed.join(fitted, NODE).select(*schema.names, "planes").mapInArrow(move, schema)
        placed = stage(done.unionByName(moved), "forest-placed")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", *,
                 least: float = 0.93, trees: int = 8, leaf_rows: int = 256, spill: float = 0.6, cell_rows: int = 8192,
                 cell_spill: float = 1.0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; see the module for rows without vector, label or id.

    spill and cell_spill are the half widths of the overlap of splits inside cells and between them, in standard
    deviations of the distance of two just linked vectors on a random direction.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & F.coalesce(
        F.exists("vec", lambda x: x != 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = stage(rows.select("vec_id", "label", F.when(usable, F.col("vec")).alias("vec")).withColumn(
        "digest", F.unhex(F.sha2(F.col("vec").cast("string"), 256))), "forest-rows")
    points = stage(
        rows.filter("vec IS NOT NULL").groupBy("label", "digest").agg(
            F.count(F.lit(1)).alias("wt"), F.min("vec_id").alias("least_id"), F.first("vec").alias("vec"))
        .withColumns({"d": F.size("vec"), "pt": F.monotonically_increasing_id()}), "forest-points")

    placed, split = _split(points.select("pt", "wt", "label", "d", "vec"), cell_rows, sample_rows, least, cell_spill)
    sizes = placed.groupBy(*NODE).agg(F.count(F.lit(1)).alias("rows"))
    # Only nodes that no plane parts are above cell_rows; two of their blocks fill a cell.
    k = F.when(F.col("rows") <= cell_rows, 1).otherwise(F.ceil(F.col("rows") / (cell_rows // 2))).cast("int")
    tiled = placed.join(sizes.select(*NODE, k.alias("k")), NODE).withColumn("side", F.pmod(F.xxhash64("pt"), "k").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumns({
        "i": F.least("side", "other"), "j": F.greatest("side", "other")})
    if split:  # where a point lies in several cells, a pair counts in the first that both are in
        cells = placed.groupBy("pt").agg(F.sort_array(F.collect_set("node")).alias("cells"))
        tiled = tiled.join(cells.filter(F.size("cells") > 1), "pt", "left")
    else:
        tiled = tiled.withColumn("cells", F.lit(None).cast("array<long>"))

    def compare(table: pa.Table) -> pa.Table:
        d, node = table.column("d")[0].as_py(), table.column("node")[0].as_py()
        pt, wt = table.column("pt").to_numpy(), table.column("wt").to_numpy()
        order = np.argsort(pt)
        x = unit_rows(table.column("vec"), d)[order]
        sides = table.column("side").to_numpy()[order] if table.column("i")[0] != table.column("j")[0] else None
        found = links(x, sides, trees, leaf_rows, _margin(d, least, spill), least, abs(node))
        u, v = _stars(found)
        pt, wt = pt[order], wt[order]
        within: dict = {}
        lists = table.column("cells").to_pylist()
        for place, row in enumerate(order.tolist()):
            for cell in lists[row] or ():
                if cell < node:
                    within.setdefault(cell, []).append(place)
        for both in within.values():
            found[np.ix_(both, both)] = False
        count = np.array([int(wt[line].sum()) for line in found], np.int64)
        some = np.flatnonzero(count)
        return pa.table({
            "u": pa.array(np.concatenate([pt[some], pt[u]]), pa.int64()),
            "v": pa.array(np.concatenate([pt[some], pt[v]]), pa.int64()),
            "n": pa.array(np.concatenate([count[some], np.zeros(len(u), np.int64)]), pa.int64())})

    found = stage(tiled.select(*NODE, "i", "j", "pt", "wt", "side", "vec", "cells").groupBy(*NODE, "i", "j").applyInArrow(
        compare, "u long, v long, n long"), "forest-links")
    counts = found.filter("u = v").groupBy(F.col("u").alias("pt")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.filter("u <> v").select("u", "v"), points.select(F.col("pt").alias("v"))).select(
        F.col("v").alias("pt"), "comp")
    slim = points.select("pt", "label", "digest", "wt", "least_id")
    known = slim.join(parts, "pt").join(counts, "pt", "left")
    names = known.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    known = stage(known.join(names, "comp").select(
        "label", "digest", "wt", (F.coalesce("n", F.lit(0)) + F.col("wt") - 1).alias("n_links"), "component_id"), "forest-known")

    # At most a thousand points hold a thousandth of all rows each: they are sent out, so no task gets all of their rows.
    total = known.agg(F.coalesce(F.sum("wt"), F.lit(0))).first()[0]
    often = F.col("wt") * 1000 >= total
    keyed, values = ["label", "digest"], ["n_links", "component_id"]
    plain = rows.select("vec_id", "label", "digest")
    heavy = plain.join(F.broadcast(known.filter(often).select(*keyed, *values)), keyed)
    light = plain.join(F.broadcast(known.filter(often).select(*keyed)), keyed, "left_anti").join(
        known.filter(~often).select(*keyed, *values), keyed, "left")
    out = heavy.unionByName(light)
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
                      ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
