"""Array kernels that run inside tasks on pairs of bounded blocks.

Each factory returns a function for ``DataFrame.mapInArrow``. A row holds two blocks of at most a few
hundred points; a kernel reduces their distances to per-point results, so pairs never become rows.
"""

import numpy as np
import pyarrow as pa


def _vec(batch, name, i):
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def _mat(batch, name, i):
    rows = batch.column(name)[i].values
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


#: Rows of a block whose distances to another block are held at once; small enough for a core's cache.
SLAB = 32
#: Times the error bound of a product below which a distance is taken by differences, so that its root is exact enough.
NEAR = 1e6


def sq_dists(a, b):
    """Squared distances by direct differences, dimension by dimension, so equal points give exactly 0."""
    out = np.zeros((a.shape[1], b.shape[1]))
    for i in range(0, a.shape[1], SLAB):
        part = out[i:i + SLAB]
        for x, y in zip(a[:, i:i + SLAB], b):
            d = x[:, None] - y[None, :]
            d *= d
            part += d
    return out


def _pair_dists(a, b):
    """Squared distances of the points of a to those of b, one by one: the same numbers as in sq_dists."""
    out = np.zeros(a.shape[1])
    for x, y in zip(a, b):
        d = x - y
        d *= d
        out += d
    return out


def _slabs(a, b):
    """(first row, squared distances of some rows of a to all of b, how far they can be off): each by one matrix product."""
    if not a.shape[1] or not b.shape[1]:
        return
    mid = a.mean(axis=1, keepdims=True)
    x, y = a - mid, b - mid
    xx, yy = (x * x).sum(axis=0), (y * y).sum(axis=0)
    # Rounding of the norms, the product and the differences themselves; several times what it can be.
    off = 16 * (len(a) + 8) * np.finfo(float).eps * (xx.max() + yy.max())
    if not np.isfinite(off):
        for i in range(0, a.shape[1], SLAB):
            yield i, sq_dists(a[:, i:i + SLAB], b), 0.0
        return
    left = np.column_stack([x.T, xx, np.ones(len(xx))])
    right = np.vstack([-2 * y, np.ones(len(yy)), yy])
    out = np.empty((min(SLAB, len(left)), right.shape[1]))  # the next product takes the place of the one before
    for i in range(0, len(left), SLAB):
        part = left[i:i + SLAB]
        yield i, np.matmul(part, right, out=out[:len(part)]), off


def _within_slabs(a, b, eps2):
    """(first row, whether each of some rows of a is within reach of each of b); what the product leaves in doubt is settled
    by differences."""
    for i, d2, off in _slabs(a, b):
        hit = d2 <= eps2 + off
        sure = d2 <= eps2 - off
        if np.count_nonzero(hit) != np.count_nonzero(sure):
            r, c = np.nonzero(hit & ~sure)
            hit[r, c] = _pair_dists(a[:, i + r], b[:, c]) <= eps2
        yield i, hit


def within(a, b, eps2):
    """sq_dists(a, b) <= eps2, most of it without the differences."""
    out = np.zeros((a.shape[1], b.shape[1]), bool)
    for i, hit in _within_slabs(a, b, eps2):
        out[i:i + SLAB] = hit
    return out


def _emit(names, columns, types):
    arrays = [
        pa.array(np.concatenate(c) if c else np.empty(0), type=t) for c, t in zip(columns, types)
    ]
    return pa.RecordBatch.from_arrays(arrays, names)


def count_within(eps2):
    def run(batches):
        for b in batches:
            ids, counts = [], []
            for i in range(b.num_rows):
                wa, wb = _vec(b, "a_wt", i).astype(float), _vec(b, "b_wt", i).astype(float)
                na, nb = np.zeros(len(wa)), np.zeros(len(wb))
                for k, hit in _within_slabs(_mat(b, "a_x", i), _mat(b, "b_x", i), eps2):
                    hit = hit.astype(float)
                    na[k:k + SLAB] = hit @ wb
                    nb += wa[k:k + SLAB] @ hit
                ids.append(_vec(b, "a_pid", i))
                counts.append(na)
                if b.column("a_block")[i] != b.column("b_block")[i]:
                    ids.append(_vec(b, "b_pid", i))
                    counts.append(nb)
            yield _emit(["pid", "n"], [ids, counts], [pa.int64(), pa.float64()])
    return run


def count_own(eps2):
    """Per point of a block: the rows of the block within reach, a lower bound of all."""
    def run(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for i in range(b.num_rows):
                x, w = _mat(b, "x", i), _vec(b, "wt", i).astype(float)
                n = np.zeros(len(w))
                for k, hit in _within_slabs(x, x, eps2):
                    n[k:k + SLAB] = hit.astype(float) @ w
                for c, v in zip(out, (np.full(len(w), b.column("part")[i].as_py()), np.full(len(w), b.column("block")[i].as_py()),
                                      _vec(b, "pid", i), w, n)):
                    c.append(v)
            yield _emit(["part", "block", "pid", "w", "n_own"], out,
                        [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])
    return run


def count_open(eps2):
    """Rows of the other block within reach of each point that is not known to be core yet, both ways."""
    def run(batches):
        for b in batches:
            ids, counts = [], []
            for i in range(b.num_rows):
                ways = ("ab", "ba") if b.column("a_block")[i] != b.column("b_block")[i] else ("ab",)
                for own, other in ways:
                    todo = ~_vec(b, f"{own}_core", i).astype(bool)
                    if not todo.any():
                        continue
                    w, n = _vec(b, f"{other}_wt", i).astype(float), np.zeros(np.count_nonzero(todo))
                    for k, hit in _within_slabs(_mat(b, f"{own}_x", i)[:, todo], _mat(b, f"{other}_x", i), eps2):
                        n[k:k + SLAB] = hit.astype(float) @ w
                    ids.append(_vec(b, f"{own}_pid", i)[todo])
                    counts.append(n)
            yield _emit(["pid", "n"], [ids, counts], [pa.int64(), pa.float64()])
    return run


def _local_roots(hit, pid):
    """The smallest id of the component of each point, from which of them are within reach of each other."""
    place = np.arange(len(pid))
    root = pid.copy()
    todo = np.ones(len(pid), bool)
    while todo.any():
        own = np.zeros(len(pid), bool)
        front = place[todo][:1]
        while front.size:
            own[front] = True
            front = np.flatnonzero(hit[front].any(axis=0) & ~own)
        root[own] = pid[own].min()
        todo &= ~own
    return root


def block_roots(eps2):
    """Per block and its core points: the smallest core id that chains of core points within the block lead to."""
    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                core, root = _vec(b, "core", i).astype(bool), _vec(b, "pid", i).copy()
                x = _mat(b, "x", i)[:, core]
                root[core] = _local_roots(within(x, x, eps2), root[core])
                out.append(root)
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(out, pa.list_(pa.int64()))], ["block", "root"])
    return run


class _Forest:
    """Components of numbers, grown by unions; a component is named by its smallest number."""

    def __init__(self):
        self.parent = {}

    def find(self, k):
        top = self.parent.setdefault(k, k)
        while self.parent[top] != top:
            self.parent[top] = self.parent[self.parent[top]]
            top = self.parent[top]
        return top

    def labels(self, numbers):
        kinds, at = np.unique(numbers, return_inverse=True)
        return np.array([self.find(k) for k in kinds.tolist()], np.int64)[at]

    def unite(self, one, other):
        """Whether two components were apart."""
        one, other = self.find(one), self.find(other)
        self.parent[max(one, other)] = min(one, other)
        return one != other


def core_links(eps2):
    """Links between roots (see block_roots) that span the components of all pairs of one call. Distances are taken only
    between core points of different components, and a pair of blocks ends when it has become one."""
    def side(batch, name, i):
        core = _vec(batch, f"{name}_core", i).astype(bool)
        return core, _vec(batch, f"{name}_root", i)[core]

    def run(batches):
        forest = _Forest()
        for b in batches:
            us, vs = [], []
            for i in range(b.num_rows):
                if b.column("a_block")[i] == b.column("b_block")[i]:
                    continue
                (ca, ra), (cb, rb) = side(b, "a", i), side(b, "b", i)
                if not ra.size or not rb.size:
                    continue
                la, lb = forest.labels(ra), forest.labels(rb)
                kinds, sizes = np.unique(np.concatenate([la, lb]), return_counts=True)
                if len(kinds) == 1:
                    continue
                most = kinds[sizes.argmax()]
                xa, xb = _mat(b, "a_x", i)[:, ca], _mat(b, "b_x", i)[:, cb]
                # Points of the largest component need not meet each other.
                for rows, cols in ((la != most, np.ones(len(lb), bool)), (la == most, lb != most)):
                    if not rows.any() or not cols.any():
                        continue
                    own, other = ra[rows], rb[cols]
                    for k, hit in _within_slabs(xa[:, rows], xb[:, cols], eps2):
                        one, two = forest.labels(own[k:k + SLAB]), forest.labels(other)
                        r, c = np.nonzero(hit & (one[:, None] != two[None, :]))
                        for u, v in set(zip(one[r].tolist(), two[c].tolist())):
                            if forest.unite(u, v):
                                us.append([u])
                                vs.append([v])
                        if r.size and len(np.unique(forest.labels(np.concatenate([own, other])))) == 1:
                            break
            yield _emit(["u", "v"], [us, vs], [pa.int64(), pa.int64()])
    return run


def border_reach(eps2):
    """Smallest component among core points in reach, for points that are not core (component -1)."""
    def side(pid, x, comp, other_x, other_comp):
        rim, hub = comp < 0, other_comp >= 0
        if not rim.any() or not hub.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hit = within(x[:, rim], other_x[:, hub], eps2)
        far = np.iinfo(np.int64).max
        best = np.where(hit, other_comp[hub][None, :], far).min(axis=1)
        found = best < far
        return pid[rim][found], best[found]

    def run(batches):
        for b in batches:
            ids, comps = [], []
            for i in range(b.num_rows):
                a = (_vec(b, "a_pid", i), _mat(b, "a_x", i), _vec(b, "a_comp", i))
                c = (_vec(b, "b_pid", i), _mat(b, "b_x", i), _vec(b, "b_comp", i))
                sides = [side(*a, c[1], c[2])]
                if b.column("a_block")[i] != b.column("b_block")[i]:
                    sides.append(side(*c, a[1], a[2]))
                for p, q in sides:
                    ids.append(p)
                    comps.append(q)
            yield _emit(["pid", "comp"], [ids, comps], [pa.int64(), pa.int64()])
    return run


def knn_bound(k):
    """Per point: distance at which the points of its own block reach weight k (an upper bound)."""
    def bound(x, w):
        d2 = sq_dists(x, x)
        order = np.argsort(d2, axis=1, kind="stable")
        grown = np.cumsum(w[order], axis=1)
        at = (grown >= k).argmax(axis=1)
        rows = np.arange(len(w))
        return np.where(grown[:, -1] >= k, d2[rows, order[rows, at]], np.inf)
    return bound


def _within_bounds(a, b, bound):
    """(row of a, row of b, squared distance) where it is within the bound of the row of a."""
    rows, cols, dists = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for i, d2, off in _slabs(a, b):
        r, c = np.divmod(np.flatnonzero(d2 <= bound[i:i + SLAB, None] + off), d2.shape[1])
        r += i
        d = _pair_dists(a[:, r], b[:, c])
        keep = d <= bound[r]
        rows.append(r[keep])
        cols.append(c[keep])
        dists.append(d[keep])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dists)


def nearest_in_pair(k, carry=None):
    """Up to k nearest points of block b for each point of block a, never beyond the known bound; with a carried column
    of b, as whole numbers, if one is named."""
    def run(batches):
        for b in batches:
            src, dst, dist, also = [], [], [], []
            for i in range(b.num_rows):
                r, c, d = _within_bounds(_mat(b, "a_x", i), _mat(b, "b_x", i), _vec(b, "a_bound", i))
                order = np.lexsort((c, d, r))
                r, c, d = r[order], c[order], d[order]
                start = np.searchsorted(r, r, side="left")
                keep = np.arange(r.size) - start < k
                src.append(_vec(b, "a_pid", i)[r[keep]])
                dst.append(_vec(b, "b_pid", i)[c[keep]])
                dist.append(d[keep])
                if carry:
                    also.append(_vec(b, f"b_{carry}", i)[c[keep]].astype(np.int64))
            names, types = ["pid", "npid", "d2"], [pa.int64(), pa.int64(), pa.float64()]
            if carry:
                yield _emit([*names, carry], [src, dst, dist, also], [*types, pa.int64()])
            else:
                yield _emit(names, [src, dst, dist], types)
    return run


def _ward_cost(xa, wa, xb, wb):
    return sq_dists(xa, xb) * _ward_weight(wa[:, None], wb[None, :])


def _ward_weight(wa, wb):
    return 2.0 * (wa * wb) / (wa + wb)


def _cheapest(xa, wa, xb, wb, bound, own=None):
    """(row of a, row of b, cost): the cheapest partner of each row of a where it costs no more than its bound; own names the
    row of b that a row of a itself is. The product leaves few partners, whose costs are taken by differences."""
    rows, cols, costs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    ra, rb = 1 / wa, 1 / wb
    heaviest = 2 / (ra.min(initial=np.inf) + rb.min(initial=np.inf))
    for i, low, off in _slabs(xa, xb):
        part = slice(i, i + SLAB)
        if own is not None:
            low[np.arange(len(low)), own[part]] = np.inf
        low -= off
        low /= ra[part, None] + rb[None, :]
        # Half the least that a partner can cost, against the most that the best one or the bound can.
        most = np.minimum(low.min(axis=1) + off * heaviest, bound[part] / 2)
        at = np.flatnonzero((low <= most[:, None]) & np.isfinite(low))
        if not at.size:
            continue
        r, c = np.divmod(at, low.shape[1])
        r += i
        cost = _pair_dists(xa[:, r], xb[:, c]) * _ward_weight(wa[r], wb[c])
        order = np.lexsort((c, cost, r))
        r, c, cost = r[order], c[order], cost[order]
        first = np.concatenate(([True], r[1:] != r[:-1]))
        first &= (cost <= bound[r]) & np.isfinite(cost)
        rows.append(r[first])
        cols.append(c[first])
        costs.append(cost[first])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(costs)


def ward_bound(x, w, stale):
    """Per cluster that must search: the cheapest partner in its own block (an upper bound); -1 for the others."""
    out = np.full(len(w), -1.0)
    todo = np.flatnonzero(stale)
    if todo.size:
        cost = _ward_cost(x[:, todo], w[todo], x, w)
        cost[np.arange(todo.size), todo] = np.inf
        out[todo] = cost.min(axis=1)
    return out


def ward_nearest():
    """Cheapest partner in block b for each cluster of block a that searches; ties go to the smaller id."""
    def run(batches):
        for b in batches:
            src, dst, price = [], [], []
            for i in range(b.num_rows):
                bound = _vec(b, "a_bound", i)
                todo = np.flatnonzero(bound >= 0)
                r, c, best = _cheapest(
                    _mat(b, "a_x", i)[:, todo], _vec(b, "a_wt", i)[todo], _mat(b, "b_x", i), _vec(b, "b_wt", i), bound[todo],
                    todo if b.column("a_block")[i] == b.column("b_block")[i] else None)
                src.append(_vec(b, "a_pid", i)[todo[r]])
                dst.append(_vec(b, "b_pid", i)[c])
                price.append(best)
            yield _emit(["pid", "npid", "cost"], [src, dst, price], [pa.int64(), pa.int64(), pa.float64()])
    return run


def ward_finish(columns, chunk=512):
    """Finish the last rounds on a bounded number of clusters in one task, with the same table of partners."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        pid = t.column("pid").to_numpy()
        order = np.argsort(pid)
        pid = pid[order]
        w = t.column("wt").to_numpy()[order].astype(float)
        s = np.vstack([t.column(c).to_numpy()[order] for c in columns]) * w
        out = []
        nn, price, stale = np.zeros(len(pid), np.int64), np.zeros(len(pid)), np.ones(len(pid), bool)
        while len(pid) > 1:
            x, todo, place = s / w, np.flatnonzero(stale), np.arange(len(pid))
            for k in range(0, todo.size, chunk):
                r = todo[k:k + chunk]
                cost = _ward_cost(x[:, r], w[r], x, w)
                cost[np.arange(r.size), r] = np.inf
                nn[r] = cost.argmin(axis=1)
                price[r] = cost[np.arange(r.size), nn[r]]
            mutual = nn[nn] == place
            left = np.flatnonzero(mutual & (nn > place))
            if not left.size:  # ties with partners from earlier rounds: all search anew
                stale[:] = True
                continue
            right = nn[left]
            out += zip(price[left].tolist(), pid[left].tolist(), pid[right].tolist(), (w[left] + w[right]).astype(int).tolist())
            s[:, left] += s[:, right]
            w[left] += w[right]
            stale = mutual | mutual[nn]
            keep = np.ones(len(pid), bool)
            keep[right] = False
            nn = (np.cumsum(keep) - 1)[nn][keep]
            pid, w, s, price, stale = pid[keep], w[keep], s[:, keep], price[keep], stale[keep]
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
            ["cost", "lft", "rgt", "size"])
    return run


#: Blocks that a silhouette kernel keeps unpacked.
KEPT_BLOCKS = 256


def distance_sums():
    """Sum of distances from each point of one block to each cluster of the other, and the rows summed, both ways."""
    def unpacked(batch, name, i):
        """pid, x, cluster numbers, rows of each cluster, weights of its points (points x clusters)."""
        kinds, at = np.unique(_vec(batch, f"{name}_cluster", i), return_inverse=True)
        w = np.zeros((len(at), len(kinds)))
        w[np.arange(len(at)), at] = _vec(batch, f"{name}_wt", i)
        return _vec(batch, f"{name}_pid", i), _mat(batch, f"{name}_x", i), kinds, w.sum(axis=0), w

    def run(batches):
        held = {}

        def side(batch, name, i):
            block = batch.column(f"{name}_block")[i].as_py()
            if block not in held:
                if len(held) >= KEPT_BLOCKS:
                    held.clear()
                held[block] = unpacked(batch, name, i)
            return held[block]

        for b in batches:
            ids, cl, sums, rows = [], [], [], []
            for i in range(b.num_rows):
                pa_, xa, ka, na, wa = side(b, "a", i)
                pb, xb, kb, nb, wb = side(b, "b", i)
                sa, sb = np.zeros((len(pa_), len(kb))), np.zeros((len(ka), len(pb)))
                for at, d2, off in _slabs(xa, xb):
                    if off and d2.min() < NEAR * off:
                        r, c = np.nonzero(d2 < NEAR * off)
                        d2[r, c] = _pair_dists(xa[:, at + r], xb[:, c])
                    dist, end = np.sqrt(d2, out=d2), at + len(d2)
                    sa[at:end] = dist @ wb
                    sb += wa[at:end].T @ dist
                parts = [(pa_, sa.T, kb, nb)]
                if b.column("a_block")[i] != b.column("b_block")[i]:
                    parts.append((pb, sb, ka, na))
                for pid, dist, kinds, n in parts:
                    ids.append(np.tile(pid, len(kinds)))
                    cl.append(np.repeat(kinds, len(pid)))
                    sums.append(dist.reshape(-1))
                    rows.append(np.repeat(n, len(pid)))
            yield _emit(["pid", "other", "dist", "n"], [ids, cl, sums, rows],
                        [pa.int64(), pa.int32(), pa.float64(), pa.float64()])
    return run


#: Points of a chunk of a band, rows of it whose distances are held at once, and sums of a tile that are held at once.
CHUNK, STRIP, HELD_SUMS = 512, 128, 1 << 22
#: Result rows of a batch.
OUT_ROWS = 1 << 17
#: Stands for no cluster.
NONE = -(1 << 40)


class _Chunk:
    """Some points of a band, with both factors of the product that gives squared distances."""

    def __init__(self, first, x, mid, w, cell):
        self.first, self.last, self.x = first, first + len(w), x
        y = x - mid
        norm = (y * y).sum(axis=0)
        self.top = norm.max()
        self.left = np.column_stack([y.T, norm, np.ones(len(w))])
        self.right = np.vstack([-2 * y, np.ones(len(w)), norm])
        self.cell, self.end = cell[0], cell[-1] + 1
        self.own = np.zeros((len(w), self.end - self.cell))
        self.own[np.arange(len(w)), cell - self.cell] = w


class _Band:
    """The points of some blocks, sorted by cell: the points that share their cluster in every labelling."""

    def __init__(self, table, rows, labels, mid):
        def every(name):
            return np.concatenate([table.column(name)[i].values.cast(pa.int64()).fill_null(NONE).to_numpy() for i in rows])
        x = np.concatenate([_mat(table, "x", i) for i in rows], axis=1)
        w = np.concatenate([_vec(table, "wt", i) for i in rows])
        lab = np.stack([every(c) for c in labels])
        order = np.lexsort(lab[::-1])
        x, w, self.pid, self.lab = x[:, order], w[order], every("pid")[order], lab[:, order]
        self.mid = x.mean(axis=1, keepdims=True) if mid is None else mid
        step = (self.lab[:, 1:] != self.lab[:, :-1]).any(axis=0)
        cell = np.concatenate(([0], np.cumsum(step)))
        self.cells = self.lab[:, np.concatenate(([True], step))]
        self.chunks = [_Chunk(i, x[:, i:i + CHUNK], self.mid, w[i:i + CHUNK], cell[i:i + CHUNK])
                       for i in range(0, len(w), CHUNK)]


def _extent(chunks):
    """(first point, points, first cell, cells) of chunks in a row."""
    return chunks[0].first, chunks[-1].last - chunks[0].first, chunks[0].cell, chunks[-1].end - chunks[0].cell


def _parted(one, two):
    """Pairs of runs of chunks, halved until the sums between their points and cells may be held; two is None where the
    chunks of one meet each other."""
    todo = [(one, two)]
    while todo:
        one, two = todo.pop()
        (_, n, _, k), (_, m, _, j) = _extent(one), _extent(two or one)
        if n * j + m * k <= HELD_SUMS or len(one) == len(two or one) == 1:
            yield one, two
        elif two is None:
            half = len(one) // 2
            todo += [(one[half:], None), (one[:half], one[half:]), (one[:half], None)]
        elif len(one) >= len(two):
            half = len(one) // 2
            todo += [(one[half:], two), (one[:half], two)]
        else:
            half = len(two) // 2
            todo += [(one, two[half:]), (one, two[:half])]


def _add_dists(p, q, by_point, by_cell, room):
    """Add the distances of chunk p to the cells of chunk q and, unless by_cell is None, of the cells of p to chunk q."""
    off = 16 * (len(p.x) + 8) * np.finfo(float).eps * (p.top + q.top)
    product = np.isfinite(off)
    for i in range(0, len(p.left), STRIP):
        part = p.left[i:i + STRIP]
        if product:
            d2 = np.matmul(part, q.right, out=room[:len(part), :q.right.shape[1]])
            if d2.min() < NEAR * off:
                r, c = np.nonzero(d2 < NEAR * off)
                d2[r, c] = _pair_dists(p.x[:, i + r], q.x[:, c])
        else:
            d2 = sq_dists(p.x[:, i:i + STRIP], q.x)
        dist = np.sqrt(d2, out=d2)
        by_point[i:i + STRIP] += dist @ q.own
        if by_cell is not None:
            by_cell += p.own[i:i + STRIP].T @ dist


def band_sums(labels):
    """Sum of distances from each point of one band of a tile to each cluster of the other, both ways, for several labellings
    of the same points at once: a distance is taken once and added up per cell, and cells are added up to clusters.
    A point without a cluster is left out of that labelling."""
    def told(band, first, n, cells, sums):
        for k in range(len(labels)):
            kinds, at = np.unique(cells[k], return_inverse=True)
            to = np.zeros((len(at), len(kinds)))
            to[np.arange(len(at)), at] = 1
            to, kinds = to[:, kinds != NONE], kinds[kinds != NONE]
            mine = band.lab[k, first:first + n] != NONE
            if not len(kinds) or not mine.any():
                continue
            dist, pid = (sums[mine] @ to).reshape(-1), np.repeat(band.pid[first:first + n][mine], len(kinds))
            other = np.tile(kinds, np.count_nonzero(mine))
            for i in range(0, len(dist), OUT_ROWS):
                end = i + OUT_ROWS
                yield _emit(["pid", "lab", "other", "dist"],
                            [[pid[i:end]], [np.full(len(pid[i:end]), k)], [other[i:end]], [dist[i:end]]],
                            [pa.int64(), pa.int32(), pa.int32(), pa.float64()])

    def run(table, one, two):
        """Sums within a tile of the blocks of a table; one and two are the rows of its bands, two is None for one band."""
        a = _Band(table, one, labels, None)
        b = _Band(table, two, labels, a.mid) if two is not None else a
        room = np.empty((STRIP, CHUNK))
        for left, right in _parted(a.chunks, b.chunks if two is not None else None):
            (s, n, c, k), (t, m, d, j) = _extent(left), _extent(right or left)
            by_a, by_b = np.zeros((n, j)), np.zeros((k, m))
            for i, p in enumerate(left):
                for q in right or left[i:]:
                    _add_dists(p, q, by_a[p.first - s:p.last - s, q.cell - d:q.end - d],
                               None if p is q else by_b[p.cell - c:p.end - c, q.first - t:q.last - t], room)
            if right is None:
                yield from told(a, s, n, a.cells[:, c:c + k], by_a + by_b.T)
            else:
                yield from told(a, s, n, b.cells[:, d:d + j], by_a)
                yield from told(b, t, m, a.cells[:, c:c + k], by_b.T)
    return run


def _columns(batch, names):
    return np.vstack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def cluster_sums(centres, features, chunk=4096):
    """Rows and feature sums of each nearest centre over the rows of this task; ties go to the smaller number."""
    k, d = centres.shape

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((d, k))
        for b in batches:
            x = _columns(b, features)
            for s in range(0, x.shape[1], chunk):
                part = x[:, s:s + chunk]
                at = sq_dists(centres.T, part).argmin(axis=0)
                n += np.bincount(at, minlength=k)
                for j in range(d):
                    sums[j] += np.bincount(at, part[j], minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array(n), *map(pa.array, sums)], ["cluster", "n", *features])
    return run


def anchor_sums(anchors, features, chunk=512):
    """Distance sums from a bounded set of anchors to the rows of this task, by cluster."""
    def run(batches):
        ids, pts = anchors.value
        sums, counts = {}, {}
        for b in batches:
            x = _columns(b, features)
            label = b.column("cluster").to_numpy(zero_copy_only=False)
            for s in range(0, x.shape[1], chunk):
                dist = np.sqrt(sq_dists(pts, x[:, s:s + chunk]))
                lab = label[s:s + chunk]
                for c in np.unique(lab):
                    m = lab == c
                    sums[c] = sums.get(c, 0.0) + dist[:, m].sum(axis=1)
                    counts[c] = counts.get(c, 0) + int(m.sum())
        for c in sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.full(len(ids), c), pa.int32()),
                 pa.array(sums[c], pa.float64()), pa.array(np.full(len(ids), counts[c]), pa.int64())],
                ["id", "other", "dist", "n"])
    return run


def kth_in_pair(k):
    """Per block a and its points: the distance at which the rows of block b reach weight k (a bound for a vote)."""
    def run(batches):
        for b in batches:
            tops, bounds = [], []
            for i in range(b.num_rows):
                d2, w = sq_dists(_mat(b, "a_x", i), _mat(b, "b_x", i)), _vec(b, "b_wt", i)
                order = np.argsort(d2, axis=1, kind="stable")
                at = (np.cumsum(w[order], axis=1) >= k).argmax(axis=1)
                rows = np.arange(len(d2))
                bounds.append(d2[rows, order[rows, at]])
                tops.append(float(bounds[-1].max()))
            yield pa.RecordBatch.from_arrays(
                [b.column("a_block"), pa.array(tops, pa.float64()), pa.array(bounds, pa.list_(pa.float64()))],
                ["block", "r2", "bound"])
    return run


def vote(sample, features, id_col, k, chunk=256):
    """Majority label of the k nearest sample rows; distance ties by id, vote ties by smaller label."""
    def run(batches):
        sid, pts, labels = sample.value
        kinds = np.unique(labels)
        for b in batches:
            x = _columns(b, features)
            out = []
            for s in range(0, x.shape[1], chunk):
                d2 = sq_dists(x[:, s:s + chunk], pts)
                kk = min(k, d2.shape[1])
                cap = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
                r, c = np.nonzero(d2 <= cap[:, None])
                order = np.lexsort((sid[c], d2[r, c], r))
                r, c = r[order], c[order]
                keep = np.arange(r.size) - np.searchsorted(r, r, side="left") < kk
                tally = np.zeros((d2.shape[0], len(kinds)), dtype=int)
                np.add.at(tally, (r[keep], np.searchsorted(kinds, labels[c[keep]])), 1)
                out.append(kinds[tally.argmax(axis=1)])
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()),
                 pa.array(np.concatenate(out) if out else np.empty(0), pa.int32())], [id_col, "cluster"])
    return run
