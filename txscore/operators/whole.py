"""Fits of the tree families over all rows of a fit, however many, inside a task of their own.

A fit's rows come as binned vectors, one byte for each feature, and are spooled in blocks of
``BLOCK`` rows into a scratch file of the task, which is mapped: only the blocks in work need memory.
What a row has besides is its margin or weight (a double) and, while a tree grows, its place (two
integers, for rows in open nodes). A block holds one kind of rows: positive, the other class, or rows
that are only scored; these are led along the trees and count for nothing, so that a cross-validation
needs no stored models.

* ``grow_tree``: a decision tree or a tree of a forest. The open nodes are counted together, level by
  level; more than ``OPEN_NODES`` of them are worked off in groups, and few rows are copied together.
* ``boost``: second-order boosting of the logistic loss, the splits of a level chosen together.
* ``boost_stumps``: SAMME rounds over the row weights (``samme``).

Gains, ties and stopping rules are those of ``growth``, ``ensembles.Grower`` and ``samme``.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from txscore.operators.growth import Plan, weight

#: Rows of a block, and open nodes that are counted together.
BLOCK, OPEN_NODES = 1 << 16, 1 << 13
#: Least weight of a node from which a node's sums may be what its sibling leaves of their parent's.
LEAST_REST = 1e-3
#: Kinds of rows.
POSITIVE, OTHER, ASKED = 0, 1, 2


def vectors(column: pa.BinaryArray, d: int) -> np.ndarray:
    """The byte vectors of a binary column, rows x d."""
    if not len(column):
        return np.zeros((0, d), np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(column), d)


class Rows:
    """The spooled rows of one fit. ``batches``: columns kind (ascending) and bins; the columns
    ``keep`` are held as they are."""

    def __init__(self, batches: Iterable[pa.RecordBatch], d: int, keep: Sequence[str] = ()):
        self.d, self.n, self.blocks, self.kept = d, 0, [], []
        self.file = tempfile.TemporaryFile()
        held: list[np.ndarray] = []
        last = None

        def flush() -> None:
            block = np.concatenate(held)
            held.clear()
            for a in range(0, len(block), BLOCK):
                own = np.ascontiguousarray(block[a:a + BLOCK].T)
                self.blocks.append((last, self.n, own.shape[1]))
                self.file.write(own.tobytes())
                self.n += own.shape[1]

        for batch in batches:
            kind, bins = batch.column("kind").to_numpy(), vectors(batch.column("bins"), d)
            if keep:
                self.kept.append(pa.Table.from_batches([batch]).select(list(keep)))
            for k in np.unique(kind):
                if held and (k != last or sum(map(len, held)) >= BLOCK):
                    flush()
                last = int(k)
                held.append(bins[kind == k])
        if held:
            flush()
        self.file.flush()
        self.codes_file = np.asarray(np.memmap(self.file, np.uint8, "r")) if self.n else np.zeros(0, np.uint8)

    def codes(self, i: int) -> np.ndarray:
        """Features x rows of block ``i``."""
        _, start, m = self.blocks[i]
        return self.codes_file[start * self.d:(start + m) * self.d].reshape(self.d, m)

    def count(self, *kinds: int) -> int:
        return sum(m for k, _, m in self.blocks if k in kinds)

    def scratch(self) -> np.ndarray:
        """A double for each row, zero, in a file."""
        if not self.n:
            return np.zeros(0)
        file = tempfile.TemporaryFile()
        file.truncate(8 * self.n)
        return np.asarray(np.memmap(file, np.float64, "r+"))


class Part:
    """The rows of a block that are in open nodes: places ``at`` in the block's codes, in the order
    positive, other class, only scored; ``node``: the place of the node among the open ones."""

    def __init__(self, codes: np.ndarray, rows: np.ndarray | int, at: np.ndarray, node: np.ndarray, pos: int, fit: int):
        self.codes, self.rows, self.at, self.node, self.pos, self.fit = codes, rows, at, node, pos, fit

    def numbers(self, at: np.ndarray) -> np.ndarray:
        return self.rows + at if isinstance(self.rows, int) else self.rows.take(at)

    def led(self, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Twice the node, plus one where a row goes right."""
        right = self.codes.ravel().take(feature.take(self.node) * self.codes.shape[1] + self.at) > cut.take(self.node)
        return 2 * self.node + right

    def keep(self, alive: np.ndarray, node: np.ndarray) -> None:
        self.pos, self.fit = int(np.count_nonzero(alive[:self.pos])), int(np.count_nonzero(alive[:self.fit]))
        self.at, self.node = self.at[alive], node[alive]

    def cut_out(self, low: int, high: int) -> Part:
        """The rows in the open nodes ``low`` to ``high``."""
        mine = (self.node >= low) & (self.node < high)
        return Part(self.codes, self.rows, self.at[mine], self.node[mine] - low, int(np.count_nonzero(mine[:self.pos])),
                    int(np.count_nonzero(mine[:self.fit])))


def _compact(parts: list[Part]) -> Part:
    """Few rows of several blocks as one block."""
    ends = [(slice(0, p.pos), slice(p.pos, p.fit), slice(p.fit, None)) for p in parts]
    order = [(p, e[i]) for i in range(3) for p, e in zip(parts, ends, strict=True)]
    codes = np.concatenate([p.codes[:, p.at[s]] for p, s in order], axis=1)
    return Part(np.ascontiguousarray(codes), np.concatenate([p.numbers(p.at[s]) for p, s in order]),
                np.arange(codes.shape[1]), np.concatenate([p.node[s] for p, s in order]),
                sum(p.pos for p in parts), sum(p.fit for p in parts))


class _Nodes:
    """Nodes of a tree as they are found."""

    def __init__(self):
        self.size, self.cols = 0, {k: np.zeros(64, t) for k, t in (
            ("feature", np.int64), ("bin", np.int64), ("left", np.int64), ("right", np.int64), ("value", float), ("gain", float))}

    def add(self, value: np.ndarray) -> np.ndarray:
        stop = self.size + len(value)
        if stop > len(self.cols["value"]):
            self.cols = {k: np.concatenate([v, np.zeros(max(len(v), stop), v.dtype)]) for k, v in self.cols.items()}
        for k in ("feature", "bin", "left", "right"):
            self.cols[k][self.size:stop] = -1
        self.cols["value"][self.size:stop] = value
        self.size, first = stop, self.size
        return np.arange(first, stop)

    def split(self, ids: np.ndarray, feature, cut, left, right, gain) -> None:
        for k, v in (("feature", feature), ("bin", cut), ("left", left), ("right", right), ("gain", gain)):
            self.cols[k][ids] = v

    def tree(self, cuts: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
        out = {k: v[:self.size].copy() for k, v in self.cols.items()}
        out["cut"] = np.zeros(self.size)
        for f in range(len(cuts)):
            own = out["feature"] == f
            out["cut"][own] = cuts[f][out["bin"][own]]
        return out


def _tree_splits(parts: list[Part], k: int, n: np.ndarray, pos: np.ndarray, subset: np.ndarray, width: int, plan: Plan,
                 rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin, n, pos left of the cut) of the best cut of each of ``k`` open nodes; the gain is
    -inf where there is none."""
    best = [np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k), np.zeros(k)]
    at_node, whole = np.arange(k), weight(pos, n, plan.criterion)
    for slot in range(subset.shape[1]):
        f = np.ascontiguousarray(subset[:, slot])
        hist, hits = np.zeros(k * width, np.int64), np.zeros(k * width, np.int64)
        for p in parts:
            node, m = p.node[:p.fit], p.codes.shape[1]
            key = node * width
            key += p.codes.ravel().take(f.take(node) * m + p.at[:p.fit])
            hist += np.bincount(key, minlength=k * width)
            if p.pos:
                hits += np.bincount(key[:p.pos], minlength=k * width)
        seen = hist.reshape(k, width) > 0
        ln, lpos = (x.reshape(k, width).cumsum(1).astype(float) for x in (hist, hits))
        rn, rpos = n[:, None] - ln, pos[:, None] - lpos
        ok = (ln >= max(plan.min_leaf, 1)) & (rn >= max(plan.min_leaf, 1))
        if plan.random_cut:  # one of the cuts after a bin that has rows
            dice = np.where(ok & seen, rng.random((k, width)), -1.0)
            ok &= np.arange(width) == dice.argmax(1)[:, None]
            ok &= dice.max(1)[:, None] >= 0
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = whole[:, None] - (weight(lpos, ln, plan.criterion) + weight(rpos, rn, plan.criterion))
        gain = np.where(ok, np.round(gain, 9), -np.inf)
        b = gain.argmax(1)  # the lowest cut
        top = gain[at_node, b]
        better = top > best[0]  # the first feature
        for old, new in zip(best, (top, f, b, ln[at_node, b], lpos[at_node, b]), strict=True):
            old[better] = new[better]
    return tuple(best)


def grow_tree(rows: Rows, cuts: Sequence[np.ndarray], plan: Plan, rng: np.random.Generator,
              score: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """One tree of a plan; its leaf values (the share of positive rows) are added to ``score``, if given."""
    nodes, width = _Nodes(), max(map(len, cuts), default=0) + 1
    n, pos = np.array([float(rows.count(POSITIVE, OTHER))]), np.array([float(rows.count(POSITIVE))])
    parts = []
    for i, (kind, start, m) in enumerate(rows.blocks):
        if kind != ASKED or score is not None:
            parts.append(Part(rows.codes(i), start, np.arange(m), np.zeros(m, np.int64), m * (kind == POSITIVE),
                              m * (kind != ASKED)))

    def opened(n, pos, depth) -> np.ndarray:
        deep = plan.max_depth is not None and depth >= plan.max_depth
        return (n >= max(2, plan.min_split)) & (pos > 0) & (pos < n) & (not deep)

    root = nodes.add(pos / n)
    if not opened(n, pos, 0)[0]:
        for p in parts if score is not None else ():
            score[p.numbers(p.at)] += pos[0] / n[0]
        return nodes.tree(cuts)
    work = [(root, n, pos, 0, parts)]
    while work:
        ids, n, pos, depth, parts = work.pop()
        while len(ids):
            if len(parts) > 1 and sum(len(p.at) for p in parts) <= BLOCK:
                parts = [_compact(parts)]
            if len(ids) > OPEN_NODES:
                spots = [(a, min(a + OPEN_NODES, len(ids))) for a in range(0, len(ids), OPEN_NODES)]
                work += [(ids[a:b], n[a:b], pos[a:b], depth, [p.cut_out(a, b) for p in parts]) for a, b in reversed(spots)]
                break
            k = len(ids)
            if plan.features is None or plan.features >= rows.d:
                subset = np.broadcast_to(np.arange(rows.d), (k, rows.d))
            else:
                subset = np.sort(rng.random((k, rows.d)).argsort(1)[:, :plan.features], axis=1)
            gain, f, b, ln, lpos = _tree_splits(parts, k, n, pos, subset, width, plan, rng)
            split = gain > 1e-9
            kn = np.column_stack([ln, n - ln])[split].ravel()
            kpos = np.column_stack([lpos, pos - lpos])[split].ravel()
            new = nodes.add(kpos / kn)
            nodes.split(ids[split], f[split], b[split], new[::2], new[1::2], gain[split])
            go = opened(kn, kpos, depth + 1)
            child = np.full(2 * k, -1)
            child[np.repeat(split, 2)] = np.where(go, np.cumsum(go) - 1, -1)
            value = np.repeat(pos / n, 2)
            value[np.repeat(split, 2)] = kpos / kn
            for p in parts:
                way = p.led(f, b)
                place = child.take(way)
                alive = place >= 0
                if score is not None:
                    score[p.numbers(p.at[~alive])] += value.take(way[~alive])
                p.keep(alive, place)
            parts = [p for p in parts if len(p.at)]
            ids, n, pos, depth = new[go], kn[go], kpos[go], depth + 1
    return nodes.tree(cuts)


def boost(rows: Rows, cuts: Sequence[np.ndarray], n_estimators: int, max_depth: int, learning_rate: float, gamma: float,
          min_child_weight: float, scale_pos_weight: float, subsample: float, margin: np.ndarray,
          rngs: Iterable[np.random.Generator], lam: float = 1.0) -> Iterator[dict[str, np.ndarray]]:
    """The trees of the boosting rounds, one after the other; ``margin`` (by row, zero at first) follows.

    Of two sibling nodes the one with fewer rows is counted, and the other's sums are the rest of their
    parent's, unless the least weight of a node is so small that rounding could pass for it."""
    least, pairs = max(min_child_weight, 1e-12), 2 * min_child_weight * (1 - 1e-9)
    rest = min_child_weight >= LEAST_REST
    for rng in rngs:
        nodes, parts, total = _Nodes(), [], np.zeros(2)
        for i, (kind, start, m) in enumerate(rows.blocks):
            if kind == ASKED:
                p, p.g, p.h = Part(rows.codes(i), start, np.arange(m), np.zeros(m, np.int64), 0, 0), np.zeros(0), np.zeros(0)
            else:
                drawn = rng.random(m) < subsample
                at = np.concatenate([np.flatnonzero(drawn), np.flatnonzero(~drawn)])
                fit, w, y = int(np.count_nonzero(drawn)), scale_pos_weight if kind == POSITIVE else 1.0, kind == POSITIVE
                q = 1 / (1 + np.exp(-margin[start:start + m].take(at[:fit])))
                p = Part(rows.codes(i), start, at, np.zeros(m, np.int64), 0, fit)
                p.g, p.h = w * (y - q), w * q * (1 - q)
                total += p.g.sum(), p.h.sum()
            parts.append(p)
        ids, depth = nodes.add(total[:1] / max(total[1] + lam, 1e-12)), 0
        if total[1] < pairs or max_depth < 1:
            margin += learning_rate * nodes.cols["value"][0]
            ids = ids[:0]
        else:
            sums = _gradient_sums(parts, cuts, [p.node for p in parts], 1)
        while len(ids):
            k = len(ids)
            gain, f, b, lg, lh, rg, rh = _gradient_splits(sums, k, least, lam)
            split = (0.5 * gain > gamma) & (gain > 1e-10)
            values = np.column_stack([lg / np.maximum(lh + lam, 1e-12), rg / np.maximum(rh + lam, 1e-12)])[split].ravel()
            new = nodes.add(values)
            nodes.split(ids[split], f[split], b[split], new[::2], new[1::2], gain[split])
            depth += 1
            both = np.repeat(split, 2)
            go = both & (np.column_stack([lh, rh]).ravel() >= pairs) & (depth < max_depth)
            child = np.where(go, np.cumsum(go) - 1, -1)
            value = np.repeat(nodes.cols["value"][ids], 2)
            value[both] = values
            value *= learning_rate
            ways = [p.led(f, b) for p in parts]
            opened = np.flatnonzero(go)
            if rest:
                size = sum((np.bincount(way[:p.fit], minlength=2 * k) for p, way in zip(parts, ways, strict=True)), np.zeros(2 * k, int))
                own = np.unique(opened // 2)  # nodes with an open child
                counted = 2 * own + size.reshape(k, 2)[own].argmin(1)
            else:
                counted = opened
            slot = np.full(2 * k, -1)
            slot[counted] = np.arange(len(counted))
            found = _gradient_sums(parts, cuts, [slot.take(way[:p.fit]) for p, way in zip(parts, ways, strict=True)],
                                   len(counted)) if len(opened) else []
            if rest and len(opened):
                place, direct = np.searchsorted(own, opened // 2), (slot[opened] >= 0)[:, None]
                sums = [old and tuple(np.where(direct, x[place], y[opened // 2] - x[place]) for x, y in zip(less, old, strict=True))
                        for less, old in zip(found, sums, strict=True)]
            else:
                sums = found
            for p, way in zip(parts, ways, strict=True):
                node = child.take(way)
                alive = node >= 0
                margin[p.rows + p.at[~alive]] += value.take(way[~alive])
                p.g, p.h = p.g[alive[:p.fit]], p.h[alive[:p.fit]]
                p.keep(alive, node)
            parts = [p for p in parts if len(p.at)]
            ids = new[go[both]]
        yield nodes.tree(cuts)


def _gradient_sums(parts: list[Part], cuts: Sequence[np.ndarray], slots: list[np.ndarray], k: int) -> list:
    """By feature the sums (g, h) of the drawn rows by (slot, bin); rows of slot -1 don't count, a feature
    without cuts has None."""
    out = [np.zeros((2, k * (len(c) + 1))) if len(c) else None for c in cuts]
    for p, slot in zip(parts, slots, strict=True):
        slot = slot[:p.fit]
        some = np.flatnonzero(slot >= 0)
        slot, at, g, h = (x.take(some) for x in (slot, p.at, p.g, p.h)) if len(some) < p.fit else (slot, p.at[:p.fit], p.g, p.h)
        for f, c in enumerate(cuts) if len(some) else ():
            if len(c):
                key = slot * (len(c) + 1)
                key += p.codes[f].take(at)
                out[f][0] += np.bincount(key, g, out[f].shape[1])
                out[f][1] += np.bincount(key, h, out[f].shape[1])
    return [x if x is None else tuple(x.reshape(2, k, -1)) for x in out]


def _gradient_splits(sums: list, k: int, least: float, lam: float) -> list[np.ndarray]:
    """(gain, feature, bin, g and h left, g and h right) of the best cut of each of ``k`` nodes."""
    at_node = np.arange(k)
    best = [np.full(k, -np.inf), *(np.zeros(k, np.int64) for _ in "fb"), *(np.zeros(k) for _ in range(4))]
    for f, own in enumerate(sums):
        if own is None:
            continue
        gs, hs = (x.cumsum(1) for x in own)
        gt, ht = gs[:, -1:], hs[:, -1:]
        gs, hs = gs[:, :-1], hs[:, :-1]  # no split after the last bin
        gr, hr = gt - gs, ht - hs
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gs**2 / (hs + lam) + gr**2 / (hr + lam) - gt**2 / (ht + lam)
        # in single precision, as sums that are a rest differ in the last digits: equal cuts stay equal
        gain = np.where((hs >= least) & (hr >= least), gain, -np.inf).astype(np.float32)
        b = gain.argmax(1)
        top = gain[at_node, b]
        better = top > best[0]
        for old, new in zip(best, (top, np.full(k, f), b, *(x[at_node, b] for x in (gs, hs, gr, hr))), strict=True):
            old[better] = new[better]
    return best


def boost_stumps(rows: Rows, n_rounds: int, learning_rate: float = 1.0) -> list[tuple[int, int, float, float, float]]:
    """``samme.fit_cells`` with a weight for each row: (feature, bin, left vote, right vote, alpha) by round."""
    fit = [i for i, (kind, _, _) in enumerate(rows.blocks) if kind != ASKED]
    n, out, weights = rows.count(POSITIVE, OTHER), [], rows.scratch()
    weights += 1 / max(n, 1)
    last = np.zeros(rows.d, np.int64)
    for i in fit:
        last = np.maximum(last, rows.codes(i).max(axis=1))
    width = int(last.max(initial=0)) + 1
    closed = np.arange(width) >= last[:, None]
    for _ in range(n_rounds if fit else 0):
        sums = np.zeros((2, rows.d, width))  # by kind
        for i in fit:
            kind, start, m = rows.blocks[i]
            codes, w = rows.codes(i), weights[start:start + m]
            for f in range(rows.d):
                sums[kind, f] += np.bincount(codes[f], w, width)
        p, n = sums[POSITIVE].cumsum(1), sums.sum(0).cumsum(1)
        tn, tp = n[:, -1:], p[:, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = p * p / n + (tp - p) ** 2 / (tn - n) - tp * tp / tn
        gain = np.where(closed | (n <= 0), -np.inf, np.round(gain, 12))
        f, b = divmod(int(gain.argmax()), width)
        if not np.isfinite(gain[f, b]):
            break
        sides = (p[f, b], n[f, b]), (tp[f, 0] - p[f, b], tn[f, 0] - n[f, b])
        left, right = (1.0 if 2 * a > c else -1.0 for a, c in sides)
        whole = tn[f, 0]
        error = float(sum(c - a if vote > 0 else a for (a, c), vote in zip(sides, (left, right), strict=True)) / whole)
        if error >= 0.5:
            break
        alpha = learning_rate * math.log((1 - error) / error) if error > 0 else 1.0
        out.append((f, b, left, right, alpha))
        if error <= 0:
            break
        scale = 1 / (whole * (1 - error + error * math.exp(alpha)))
        for i in fit:
            kind, start, m = rows.blocks[i]
            sign = 1.0 if kind == POSITIVE else -1.0
            vote = np.where(np.arange(256) <= b, left, right)
            weights[start:start + m] *= np.where(vote != sign, math.exp(alpha), 1.0).take(rows.codes(i)[f]) * scale
    return out


def stump_scores(rows: Rows, found: Sequence[tuple], share: np.ndarray) -> np.ndarray:
    """Sum of the stumps' votes, weighted by ``share``, for every row."""
    table = np.zeros((rows.d, 256))
    for (f, b, left, right, _), a in zip(found, share.tolist(), strict=True):
        table[f, :b + 1] += a * left
        table[f, b + 1:] += a * right
    out = rows.scratch()
    for i, (_, start, m) in enumerate(rows.blocks):
        codes = rows.codes(i)
        out[start:start + m] = sum((table[f].take(codes[f]) for f in range(rows.d)), np.zeros(m))
    return out
