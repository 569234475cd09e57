"""Tree learners for many (model, seed, fold) fits at once.

All fits bin their features once and then work on histograms of integer sums (row counts and
fixed-point weights, gradients and Hessians), so sums do not depend on how rows are dealt.

* ``forest``: bootstrap by hash-drawn Poisson counts per (row, tree), a hash-drawn feature
  subset per node, Gini or entropy; class weights of the whole table or of each bootstrap.
* ``extra``: extremely randomised trees: one hash-drawn cut per node and feature, uniform
  between the least and largest value in the node; no bootstrap unless asked for.
* ``boost``: best-first histogram boosting on the logistic loss: the leaf of largest gain is
  split next, sibling histograms by subtraction, leaf values -G / (H + l2).
* ``oblivious``: one split per level shared by all leaves, and ordered boosting: the score
  that a row's gradient is taken at comes from rows earlier in a hash permutation only,
  by prefixes that double.

A table of up to ``LOCAL_CELLS`` cells (rows x features, counted first) fits a task as bins
of one byte, so nothing would be gained by adding up histograms across tasks: a task gets a
table's bins once, for one or more fits (for forests, shares of their trees), and takes all
levels there; one Spark job runs all such fits. It grows as many trees at a time as have about
``ENTRIES`` rows in their bags. Fits of more than ``INLINE`` bytes stay in files on the shared
storage, and scoring reads them tree by tree, so neither driver nor task holds a whole forest.
Larger tables stay where they are: each level is one job that adds up histograms per (tree,
node) by partition and then over partitions, and only the chosen splits reach the driver.
Both ways call the same functions on the histograms and choose the same splits; bin edges are
exact quantiles in a task and approximate ones over a large table.
"""

from __future__ import annotations

import heapq
import io
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import open_output, read_shared, scratch_path, ship, stored

LOCAL_CELLS = 1 << 27
ENTRIES = 1 << 20
LEVEL_BYTES = 1 << 22
INLINE = 1 << 18
SCORED_ROWS = 1 << 15
TREES_PER_TASK = 40
SCALE = float(1 << 20)
HELD_BYTES = 1 << 27
REFRESH = 8
CHUNK = 1 << 14
PART = float(1 << 17)  # a sum over a chunk holds the rows and the counts of both classes, each below this
PIECE = 1 << 15
_U = np.uint64


@dataclass(frozen=True)
class Spec:
    """What a learner does; see the module docstring for ``kind``."""

    kind: str = "forest"
    trees: int = 100
    step: float = 0.1
    depth: int = 30
    leaves: int = 31
    leaf_rows: int = 1
    split_rows: int = 2
    leaf_hessian: float = 1e-3
    l2: float = 0.0
    bins: int = 255
    node_features: float | str | None = None  # share, "sqrt", "log2" or a number; None: all
    tree_features: float = 1.0
    rows: float = 1.0  # bootstrap mean of forests, share of rows per round of boosting
    bootstrap: bool = True
    impurity: str = "gini"  # or entropy; for boosting newton or mse
    weights: str | tuple | None = None  # balanced, balanced_subsample or (weight of 0, of 1)
    held_out: float = 0.0


@dataclass
class Tree:
    """Node arrays; ``feature`` is -1 at leaves, rows with bin <= ``cut`` go left."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    stats: list = field(default_factory=lambda: [None])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, left, right) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, a, a + 1
        for stats in (left, right):
            for x, v in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.stats, stats),
                         (self.depth, self.depth[node] + 1)):
                x.append(v)
        return a, a + 1

    def route(self, bins: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        x = bins if of is None else np.ascontiguousarray(bins[of])
        return _route(x, np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.right))


def _route(x, feature, cut, left, right) -> np.ndarray:
    """Leaf of every row, where ``x <= cut`` goes left."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        at = node[rows]
        inner = feature[at] >= 0
        rows, at = rows[inner], at[inner]
        node[rows] = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
    return node


# ------------------------------------------------------------------ hashed draws
def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public-domain constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(*parts) -> np.ndarray:
    """U[0, 1) from integer parts (arrays or numbers); the same wherever it is drawn."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = _mix((np.asarray(p).astype(np.int64).astype(_U) + h) * _U(0x9E3779B97F4A7C15) + _U(1))
    return (h >> _U(11)).astype(np.float64) / float(1 << 53)


def poisson_counts(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson draws by inverting the distribution at uniform numbers."""
    out = np.zeros(len(u), np.int64)
    p = total = np.exp(-mean)
    for k in range(1, 60):
        out += u >= total
        p *= mean / k
        total += p
    return out


def _picked(spec: Spec, n: int) -> int:
    how = spec.node_features
    if how is None:
        return n
    k = {"sqrt": np.sqrt(n), "log2": np.log2(n)}.get(how) if isinstance(how, str) else how * n if how <= 1.0 and isinstance(
        how, float) else how
    return int(max(1, min(n, k)))


def node_features(spec: Spec, seed: int, tree, node: np.ndarray, n: int, allowed: np.ndarray | None = None) -> np.ndarray:
    """The features tried at each node, one row a node."""
    own = np.arange(n) if allowed is None else allowed
    k = _picked(spec, len(own))
    if k == len(own):
        return np.broadcast_to(own, (len(node), k))
    u = _uniform(seed, 1, np.reshape(tree, (-1, 1)), node[:, None], own[None, :])
    return own[np.sort(np.argsort(u, axis=1, kind="stable")[:, :k], axis=1)]


# ------------------------------------------------------------------ bins
def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts per feature: between neighbouring distinct values, or quantiles of many."""
    out = []
    for column in x.T:
        v = np.unique(column[~np.isnan(column)])
        if len(v) <= bins:
            out.append((v[1:] + v[:-1]) / 2)
        else:
            q = np.quantile(column[~np.isnan(column)], np.arange(1, bins) / bins, method="midpoint")
            out.append(np.unique(q[q < v[-1]]))
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8 if max((len(e) for e in edges), default=0) < 256 else np.uint16, order="F")
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="left")
    return out


def _values(edges: list[np.ndarray], width: int) -> np.ndarray:
    """A value for each bin: the middle of its cuts."""
    out = np.zeros((len(edges), width))
    for j, e in enumerate(edges):
        if len(e):
            mid = np.r_[e[0], (e[1:] + e[:-1]) / 2, e[-1]]
            out[j, :len(mid)] = mid
            out[j, len(mid):] = mid[-1]
    return out


# ------------------------------------------------------------------ histograms and splits
def histograms(bins, rows, pos, feats, stats, nodes: int, width: int) -> np.ndarray:
    """Sums of three ``stats`` per (node, stat, tried feature, bin) over ``rows`` at ``pos``."""
    out = np.empty((nodes, 3, feats.shape[1], width))
    base = pos * width
    for j in range(feats.shape[1]):
        at = base + bins[rows, feats[pos, j]]
        for c, s in enumerate(stats):
            out[:, c, j] = np.bincount(at, s, nodes * width).reshape(nodes, width)
    return out


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def _purity(s: np.ndarray, spec: Spec) -> np.ndarray:
    """What a split adds up over its sides, from sums with the stat on axis 1; larger is better."""
    n, a, b = s[:, 0], s[:, 1], s[:, 2]
    if spec.impurity == "newton":
        return _ratio(a * a, b + spec.l2 * SCALE)
    if spec.impurity == "mse":
        return _ratio(a * a, n)
    w = a + b
    if spec.impurity == "entropy":
        return sum(v * np.log2(np.where(v > 0, _ratio(v, w), 1.0)) for v in (a, b))
    return _ratio(a * a + b * b, w)


def random_cuts(hist: np.ndarray, feats: np.ndarray, values: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Mask of the one cut per (node, feature) that lies at share ``u`` of the node's range."""
    some = hist[:, 0] > 0
    width = some.shape[2]
    lo, hi = some.argmax(axis=2), width - 1 - some[:, :, ::-1].argmax(axis=2)
    v = values[feats]
    a, b = np.take_along_axis(v, lo[..., None], 2)[..., 0], np.take_along_axis(v, hi[..., None], 2)[..., 0]
    cut = (v <= (a + u * (b - a))[..., None]).sum(axis=2) - 1
    cut = np.clip(cut, lo, hi - 1)
    return (np.arange(width) == cut[..., None]) & (hi > lo)[..., None]


def best_splits(hist: np.ndarray, spec: Spec, mask: np.ndarray | None = None):
    """Per node: gain, place among the tried features, cut bin, sums left and in all. A node
    that no cut improves has gain 0; ties go to the first feature and the lowest cut."""
    left = np.cumsum(hist, axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    whole = _purity(total, spec)
    gain = _purity(left, spec)
    gain += _purity(right, spec)
    gain -= whole
    ok = (left[:, 0] >= spec.leaf_rows) & (right[:, 0] >= spec.leaf_rows) & (total[:, 0] >= spec.split_rows)
    if spec.kind in ("boost", "oblivious") and spec.leaf_hessian:
        ok &= (left[:, 2] >= spec.leaf_hessian * SCALE) & (right[:, 2] >= spec.leaf_hessian * SCALE)
    if mask is not None:
        ok &= mask
    gain[~(ok & (gain > 1e-12 * np.abs(whole) + 1e-9))] = 0.0
    gain = gain.reshape(len(hist), -1)
    at = gain.argmax(axis=1)
    j, b = np.divmod(at, hist.shape[3])
    own = np.arange(len(hist))
    return gain[own, at], j, b, left[own, :, j, b], total[:, :, 0, 0]


# ------------------------------------------------------------------ forests
def _class_weights(spec: Spec, n0: float, n1: float) -> np.ndarray:
    """Fixed-point weights of the classes, balanced ones from the counts given."""
    if spec.weights is None:
        w = (1.0, 1.0)
    elif isinstance(spec.weights, tuple):
        w = spec.weights
    else:
        w = tuple((n0 + n1) / (2 * n) if n else 0.0 for n in (n0, n1))
    return np.round(np.array(w) * SCALE)


def bootstrap(spec: Spec, seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often each row is in a tree's bootstrap."""
    if not spec.bootstrap:
        return np.ones(len(ids), np.int64)
    return poisson_counts(_uniform(seed, 2, tree, ids), spec.rows)


def _bag_weights(spec: Spec, counts, y, whole) -> np.ndarray:
    """Class weights of one tree: ``whole`` = class counts of the table."""
    if spec.weights == "balanced_subsample":
        return _class_weights(spec, counts[y == 0].sum(), counts[y == 1].sum())
    return _class_weights(spec, *whole)


def forest_trees(bins, y, ids, values, spec: Spec, seed: int, numbers: range, whole) -> list[Tree]:
    """Some trees of a task, all of them a level at a time: an entry is a row of a tree's bag,
    and the entries of a node lie side by side."""
    f, width = bins.shape[1], values.shape[1]
    bins = np.ascontiguousarray(bins)
    trees, weights, bags = [], [], []
    for number in numbers:
        counts = bootstrap(spec, seed, number, ids)
        w = _bag_weights(spec, counts, y, whole)
        rows = np.flatnonzero(counts)
        c, of = counts[rows], y[rows]
        trees.append(Tree())
        trees[-1].stats[0] = np.array([len(rows), c[of == 0].sum() * w[0], c[of == 1].sum() * w[1]], np.float64)
        weights.append(w)
        bags.append((rows, _packed(c, of)))
    if not trees:
        return trees
    weights, numbers = np.array(weights), np.array(list(numbers))
    fronts = [_opened(t, [0], spec) for t in trees]
    base = np.cumsum([0, *map(len, fronts)])
    alive = [i for i, x in enumerate(fronts) if len(x)]
    mass = np.concatenate([bags[i][1] for i in alive] or [np.zeros(0)])
    # the bins travel with their entries, so those of a node are read in one run
    held = bins.take(np.concatenate([bags[i][0] for i in alive] or [np.zeros(0, np.int64)]), axis=0)
    pos = np.repeat(base[:-1][alive], [len(bags[i][0]) for i in alive])
    del bags
    most = int((mass // PART // PART + mass // PART % PART).max(initial=1))
    step = max(1, LEVEL_BYTES // (_picked(spec, f) * (4 if spec.kind == "extra" else width) * 24))
    while base[-1]:
        front = np.concatenate(fronts)
        of = np.repeat(np.arange(len(trees)), [len(x) for x in fronts])
        ends = np.searchsorted(pos, np.arange(len(front)), side="right")
        goes = np.zeros(len(pos), bool)
        found = []
        for a in range(0, len(front), step):
            nodes, own = front[a:a + step], of[a:a + step]
            here = slice(ends[a - 1] if a else 0, ends[a + len(nodes) - 1])
            feats = node_features(spec, seed, numbers[own], nodes, f)
            grow = _random_splits if spec.kind == "extra" else _histogram_splits
            at, flat = pos[here] - a, held[here].ravel()
            found.append(grow(flat, f, at, mass[here], feats, nodes, numbers[own], weights[own], values, spec, seed, most))
            by, cut = found[-1][1], found[-1][2]
            for piece in _pieces(len(at), 1, most):
                p = at[piece]
                goes[here.start + piece.start:here.start + piece.stop] = flat.take(
                    np.arange(piece.start, piece.stop) * f + by.take(p)) > cut.take(p)
        found = [np.concatenate(x) for x in zip(*found)]
        places = []
        for i, t in enumerate(trees):
            own = slice(base[i], base[i + 1])
            place, fronts[i] = apply_level(t, fronts[i], *[x[own] for x in found], spec)
            places.append(place)
        ahead = np.cumsum([0, *map(len, fronts)])
        place = np.concatenate([np.where(p >= 0, p + at, -1) for p, at in zip(places, ahead)])
        after = place.ravel().take(2 * pos + goes)
        stays = after >= 0
        sides = [np.flatnonzero(stays & ~goes), np.flatnonzero(stays & goes)]
        of = [after.take(x) for x in sides]
        many = [np.bincount(x, minlength=ahead[-1]) for x in of]
        # both sides are in the order of their nodes: an entry's new place is the number of those before it
        order = np.empty(len(of[0]) + len(of[1]), np.int64)
        for x, own, others in zip(sides, of, many[::-1]):
            order[np.r_[0, np.cumsum(others)].take(own) + np.arange(len(x))] = x
        held, mass, pos, base = held.take(order, axis=0), mass.take(order), np.repeat(np.arange(ahead[-1]), many[0] + many[1]), ahead
    return trees


def _packed(c: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number an entry: 1, its count if it is of class 0, its count if of class 1."""
    return 1.0 + np.where(y == 0, c * PART, np.where(y == 1, c * (PART * PART), 0.0))


def _unpacked(sums: np.ndarray):
    """Rows and counts of both classes."""
    one = np.floor(sums * (1 / (PART * PART)))
    rest = sums - one * (PART * PART)
    zero = np.floor(rest * (1 / PART))
    return rest - zero * PART, zero, one


def _pieces(n: int, k: int, most: int) -> Iterator[slice]:
    """Runs of entries whose ``k`` features stay in a core's cache and whose counts of at most
    ``most`` add up to less than ``PART``."""
    size = int(max(1, min(max(PIECE // k, 1), (PART - 1) // max(most, 1))))
    return (slice(s, min(s + size, n)) for s in range(0, n, size))


class _Tried:
    """Bins of the features that an entry's node tries, one row a feature; pieces share the room."""

    def __init__(self, flat, feats, size: int):
        self.flat, self.feats = flat, np.ascontiguousarray(feats.T, dtype=np.int64)
        self.at = np.empty(len(self.feats) * size, np.int64)
        self.bins = np.empty(len(self.at), flat.dtype)
        self.mass = np.empty(len(self.at))

    def room(self, n: int):
        return (x[:len(self.feats) * n].reshape(-1, n) for x in (self.at, self.bins, self.mass))

    def __call__(self, piece: slice, f: int, pos) -> np.ndarray:
        at, bins, _ = self.room(len(pos))
        np.take(self.feats, pos, axis=1, out=at, mode="clip")
        at += np.arange(piece.start * f, piece.stop * f, f)
        return np.take(self.flat, at, out=bins, mode="clip")


def _histogram_splits(flat, f: int, pos, mass, feats, nodes, number, weights, values, spec: Spec, seed: int, most: int):
    """Histograms come by pieces of entries: these lie in the order of their nodes, so a piece
    adds to a run of nodes. Sums of integers do not depend on how entries are cut."""
    width, (m, k) = values.shape[1], feats.shape
    hist = None
    pieces = list(_pieces(len(pos), k, most))
    tried = _Tried(flat, feats, max((x.stop - x.start for x in pieces), default=0))
    for piece in pieces:
        p = pos[piece]
        first, n = p[0], p[-1] - p[0] + 1
        bins = tried(piece, f, p)
        at, _, heavy = tried.room(len(p))
        base = (p - first) * (k * width)
        for j in range(k):
            np.add(bins[j], base + j * width, out=at[j])
        heavy[:] = mass[piece]
        sums = np.bincount(at.ravel(), heavy.ravel(), n * k * width)
        if len(pieces) == 1:
            return _sparse_splits(sums, feats, width, weights, spec)
        if hist is None:
            hist = np.zeros((m, 3, k, width))
        for c, x in enumerate(_unpacked(sums.reshape(n, k, width))):
            hist[first:first + n, c] += x
    hist[:, 1:] *= weights[:, :, None, None]
    return level_splits(nodes, feats, hist, values, spec, seed, number)


def _sparse_splits(sums, feats, width: int, weights, spec: Spec):
    """As ``level_splits`` where most bins of a node are empty: a cut at an empty bin parts rows
    as the filled one before it does, and of equal cuts the first is taken."""
    m, k = feats.shape
    cell = np.flatnonzero(sums != 0)
    column = cell // width
    node = column // k
    starts = np.flatnonzero(np.diff(column, prepend=-1))
    upto = [np.cumsum(x) for x in _unpacked(sums.take(cell))]
    run = np.cumsum(np.diff(column, prepend=column[0]) != 0)
    ends = np.r_[starts[1:], len(cell)] - 1
    left, total = np.empty((len(cell), 3)), np.empty((m, 3))
    for c, x in enumerate(upto):
        before = np.where(starts > 0, x.take(starts - 1), 0.0)
        scale = 1.0 if c == 0 else weights[:, c - 1]
        left[:, c] = (x - before.take(run)) * (1.0 if c == 0 else scale.take(node))
        total[:, c] = (x.take(ends) - before)[::k] * scale
    all_of = total.take(node, axis=0)
    right = all_of - left
    whole = _purity(total, spec).take(node)
    gain = _purity(left, spec)
    gain += _purity(right, spec)
    gain -= whole
    ok = (left[:, 0] >= spec.leaf_rows) & (right[:, 0] >= spec.leaf_rows) & (all_of[:, 0] >= spec.split_rows)
    gain[~(ok & (gain > 1e-12 * np.abs(whole) + 1e-9))] = 0.0
    best = np.maximum.reduceat(gain, np.flatnonzero(np.diff(node, prepend=-1)))
    at = np.flatnonzero(gain == best.take(node))
    at = at[np.flatnonzero(np.diff(node.take(at), prepend=-1))]
    return best, feats[np.arange(m), column.take(at) % k], cell.take(at) % width, left[at], total


def _random_splits(flat, f: int, pos, mass, feats, nodes, number, weights, values, spec: Spec, seed: int, most: int):
    """As ``level_splits`` with one drawn cut per node and feature, without histograms."""
    m, k = feats.shape
    first = np.searchsorted(pos, np.arange(m))
    bins = np.empty((k, len(pos)), flat.dtype)
    total, left = np.zeros((m, 3, 1)), np.zeros((m, 3, k))
    pieces = list(_pieces(len(pos), k, most))
    tried = _Tried(flat, feats, max((x.stop - x.start for x in pieces), default=0))
    for piece in pieces:
        p = pos[piece]
        bins[:, piece] = tried(piece, f, p)
        sums = np.bincount(p - p[0], mass[piece])
        total[p[0]:p[-1] + 1, :, 0] += np.stack(_unpacked(sums), axis=1)
    lo, hi = (np.stack([x.reduceat(b, first) for b in bins], axis=1).astype(np.int64) for x in (np.minimum, np.maximum))
    a, z = values[feats, lo], values[feats, hi]
    drawn = a + _uniform(seed, 3, np.reshape(number, (-1, 1)), nodes[:, None], feats) * (z - a)
    cuts = np.empty((m, k), np.int64)
    for x in np.unique(feats):
        own = feats == x
        cuts[own] = np.searchsorted(values[x], drawn[own], side="right") - 1
    cuts = np.clip(cuts, lo, hi - 1)
    ok = hi > lo
    split = np.ascontiguousarray(cuts.T)
    for piece in pieces:
        p = pos[piece]
        n = p[-1] - p[0] + 1
        at, _, heavy = tried.room(len(p))
        np.take(split, p, axis=1, out=at, mode="clip")
        np.multiply(bins[:, piece] <= at, mass[piece], out=heavy)
        base = (p - p[0]) * k
        for j in range(k):
            np.add(base, j, out=at[j])
        sums = np.bincount(at.ravel(), heavy.ravel(), n * k).reshape(n, k)
        left[p[0]:p[-1] + 1] += np.stack(_unpacked(sums), axis=1)
    total[:, 1:] *= weights[:, :, None]
    left[:, 1:] *= weights[:, :, None]
    right = total - left
    whole = _purity(total, spec)
    gain = _purity(left, spec)
    gain += _purity(right, spec)
    gain -= whole
    ok &= (left[:, 0] >= spec.leaf_rows) & (right[:, 0] >= spec.leaf_rows) & (total[:, 0] >= spec.split_rows)
    gain[~(ok & (gain > 1e-12 * np.abs(whole) + 1e-9))] = 0.0
    j, own = gain.argmax(axis=1), np.arange(m)
    return gain[own, j], feats[own, j], cuts[own, j], left[own, :, j], total[:, :, 0]


def level_splits(nodes, feats, hist, values, spec: Spec, seed: int, number):
    """Per node of a level (gain, feature, cut, sums left, sums in all)."""
    mask = None
    if spec.kind == "extra":
        mask = random_cuts(hist, feats, values, _uniform(seed, 3, np.reshape(number, (-1, 1)), nodes[:, None], feats))
    gain, j, b, left, total = best_splits(hist, spec, mask)
    return gain, feats[np.arange(len(nodes)), j], b, left, total


def apply_level(tree: Tree, front, gain, feature, cut, left, total, spec: Spec):
    """Split the nodes that gain. Returns the places of each node's children on the next level
    (-1 where a node or a child stays a leaf) and the nodes of that level."""
    place = np.full((len(front), 2), -1, np.int64)
    at = np.flatnonzero(np.asarray(gain) > 0)
    if not len(at):
        return place, np.zeros(0, np.int64)
    sides = np.stack([left[at], total[at] - left[at]], axis=1).reshape(-1, 3)
    kids = len(tree.feature) + np.arange(2 * len(at))
    depth = []
    for i, kid in zip(at.tolist(), kids[::2].tolist()):
        node = int(front[i])
        tree.feature[node], tree.cut[node], tree.left[node], tree.right[node] = int(feature[i]), int(cut[i]), kid, kid + 1
        depth += [tree.depth[node] + 1] * 2
    for x, v in ((tree.feature, -1), (tree.cut, 0), (tree.left, 0), (tree.right, 0)):
        x.extend([v] * len(kids))
    tree.stats.extend(sides)
    tree.depth.extend(depth)
    go = (np.array(depth) < spec.depth) & (sides[:, 0] >= max(spec.split_rows, 2 * spec.leaf_rows)) & (sides[:, 1:] > 0).all(axis=1)
    place[at] = np.where(go, np.cumsum(go) - 1, -1).reshape(-1, 2)
    return place, kids[go]


def _opened(tree: Tree, nodes, spec: Spec) -> np.ndarray:
    return np.array([k for k in nodes if _open(tree, k, spec)], np.int64)


def _open(tree: Tree, node: int, spec: Spec) -> bool:
    s = tree.stats[node]
    return bool(tree.depth[node] < spec.depth and s[0] >= max(spec.split_rows, 2 * spec.leaf_rows) and s[1] > 0 and s[2] > 0)


def forest_values(tree: Tree) -> np.ndarray:
    s = np.array(tree.stats)
    w = s[:, 1] + s[:, 2]
    return np.where(w > 0, s[:, 2] / np.where(w > 0, w, 1), 0.0)


# ------------------------------------------------------------------ boosting
def _gradients(raw, y, w):
    p = 1.0 / (1.0 + np.exp(-raw))
    return np.round((p - y) * w * SCALE), np.round(np.maximum(p * (1 - p), 1e-6) * w * SCALE)


def baseline(w0: float, w1: float) -> float:
    return float(np.log(max(w1, 1e-9) / max(w0, 1e-9)))


def _whole_histogram(bins, rows, g, h, width: int) -> np.ndarray:
    """Sums of all features' bins over some rows, (1, stat, feature, bin)."""
    f = bins.shape[1]
    if len(rows) > CHUNK:
        return _sums_by_chunk(bins, rows, g, h, width)
    out = np.empty((1, 3, f, width))
    g, h = g[rows], h[rows]
    if len(rows) > 512:
        for j in range(f):
            b = bins[:, j].take(rows).astype(np.int64)
            for c, s in enumerate((None, g, h)):
                out[0, c, j] = np.bincount(b, s, width)
        return out
    at = (bins[rows] + np.arange(f, dtype=np.int64) * width).ravel()
    for c, s in enumerate((None, np.repeat(g, f), np.repeat(h, f))):
        out[0, c] = np.bincount(at, s, f * width).reshape(f, width)
    return out


def _sums_by_chunk(bins, rows, g, h, width: int) -> np.ndarray:
    """As ``_whole_histogram``, over as many rows at a time as stay in a core's cache. The
    addends are integers, so the order does not matter, and where count and Hessian sums
    of a chunk fit one double side by side, one pass takes both."""
    f = bins.shape[1]
    out = np.zeros((1, 3, f, width))
    for s in range(0, len(rows), CHUNK):
        r = rows[s:s + CHUNK]
        run = slice(r[0], r[-1] + 1) if r[-1] - r[0] == len(r) - 1 else r  # ascending and distinct
        a, b = g[run], h[run]
        shift = 2.0 ** np.ceil(np.log2(b.sum() + 1.0))
        packed = len(r) * shift < 2.0 ** 52
        weights = np.stack([a, b + shift] if packed else [a, b, np.ones(len(r))])
        totals = weights.sum(axis=1)
        for j in range(f):
            at = bins[:, j][run] if isinstance(run, slice) else bins[:, j].take(run)
            if at.max() <= 1:  # a flag: the second bin is a product, the first what it leaves
                sums = np.zeros((len(weights), width))
                sums[:, 1] = weights @ at.astype(np.float64)
                sums[:, 0] = totals - sums[:, 1]
            else:
                at = at.astype(np.int64)
                sums = np.stack([np.bincount(at, w, width) for w in weights])
            n = np.floor(sums[1] / shift) if packed else sums[2]
            out[0, 0, j] += n
            out[0, 1, j] += sums[0]
            out[0, 2, j] += sums[1] - n * shift if packed else sums[1]
    return out


def _feature_mask(spec: Spec, seed, number, path, allowed, f):
    """The features that a node, known by its path from the root (1, 2n, 2n + 1), tries."""
    tried = node_features(spec, seed, number, np.array([path]), f, allowed)[0]
    if len(tried) == f:
        return None
    mask = np.zeros((1, f, 1), bool)
    mask[0, tried] = True
    return mask


def tree_columns(spec: Spec, seed: int, number: int, f: int) -> np.ndarray:
    """Features that a boosting round may use."""
    k = max(1, int(np.ceil(spec.tree_features * f)))
    return np.arange(f) if k >= f else np.sort(np.argsort(_uniform(seed, 4, number, np.arange(f)), kind="stable")[:k])


def leafwise_tree(bins, rows, g, h, width: int, spec: Spec, seed: int, number: int, leaf: np.ndarray | None = None) -> Tree:
    """Best-first growth; the smaller child is summed, its sibling is the difference. ``leaf``
    gets the leaf of each of ``rows``."""
    tree = Tree()
    f = bins.shape[1]
    allowed = tree_columns(spec, seed, number, f)
    heap: list = []

    def offer(*nodes):
        nodes = [x for x in nodes if tree.depth[x[0]] < spec.depth and len(x[2]) >= 2 * spec.leaf_rows]
        if not nodes:
            return
        masks = [_feature_mask(spec, seed, number, path, allowed, f) for _, path, *_ in nodes]
        gain, j, b, left, total = best_splits(np.concatenate([x[3] for x in nodes]), spec,
                                              None if masks[0] is None else np.concatenate(masks))
        for i, (node, path, rows, hist) in enumerate(nodes):
            if gain[i] > 0:
                heapq.heappush(heap, (-gain[i], path, node, rows, hist, int(j[i]), int(b[i]), left[i], total[i]))

    root = _whole_histogram(bins, rows, g, h, width)
    tree.stats[0] = root[0, :, 0].sum(axis=1)
    offer((0, 1, rows, root))
    leaves = 1
    while heap and leaves < spec.leaves:
        _, path, node, rows, hist, j, b, left, total = heapq.heappop(heap)
        a, c = tree.split(node, j, b, left, total - left)
        leaves += 1
        if leaves == spec.leaves and leaf is None:
            break
        goes = bins[:, j].take(rows) <= b
        low, high = rows[goes], rows[~goes]
        if leaf is not None:
            leaf[low], leaf[high] = a, c
        if leaves == spec.leaves or max(len(low), len(high)) < 2 * spec.leaf_rows or tree.depth[a] >= spec.depth:
            continue
        if len(low) <= len(high):
            first = _whole_histogram(bins, low, g, h, width)
            second = hist - first
        else:
            second = _whole_histogram(bins, high, g, h, width)
            first = hist - second
        offer((a, 2 * path, low, first), (c, 2 * path + 1, high, second))
    return tree


def boost_values(tree: Tree, spec: Spec) -> np.ndarray:
    s = np.array(tree.stats)
    return -spec.step * s[:, 1] / np.maximum(s[:, 2] + spec.l2 * SCALE, 1e-9 * SCALE)


BLOCKS = 16


def ordered_block(seed: int, ids: np.ndarray) -> np.ndarray:
    """Place of a row's prefix: block k is drawn from [2^-(k+1), 2^-k), so the blocks after it
    hold as many rows as it does, and they are its prefix."""
    u = _uniform(seed, 5, ids)
    return np.minimum(np.floor(-np.log2(np.maximum(u, 2.0 ** -60))).astype(np.int64), BLOCKS - 1)


def best_level(hist: np.ndarray, spec: Spec):
    """The cut that all leaves of an oblivious level share: (gain, feature, bin)."""
    left = np.cumsum(hist, axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    score = (_purity(left, spec) + _purity(right, spec) - _purity(total, spec)).sum(axis=0)
    score[(left[:, 0].sum(axis=0) <= 0) | (right[:, 0].sum(axis=0) <= 0)] = 0.0
    at = int(score.argmax())
    return float(score.flat[at]), *divmod(at, hist.shape[3])


def prefix_values(sums: np.ndarray, spec: Spec) -> np.ndarray:
    """Leaf values (leaf, block) from the blocks that make up each block's prefix."""
    after = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1] - sums
    return -spec.step * after[..., 0] / np.maximum(after[..., 1] + spec.l2 * SCALE, 1e-9 * SCALE)


def _oblivious_tree(path: list[tuple[int, int]], values: np.ndarray) -> Tree:
    """Node arrays of a shared path; ``values`` by leaf number (first split: highest bit)."""
    tree = Tree()
    level = [0]
    for feature, cut in path:
        level = [k for node in level for k in tree.split(node, feature, cut, None, None)]
    tree.stats = [0.0] * len(tree.feature)
    for node, v in zip(level, values):
        tree.stats[node] = v
    return tree


# ------------------------------------------------------------------ fitted models
@dataclass
class TreeModel:
    """Fitted trees as flat arrays; ``proba`` scores a matrix of raw features."""

    kind: str
    start: float
    parts: list  # trees as (feature, cut value, left, right, value), or URIs of files of them

    def each(self) -> Iterator[tuple]:
        for part in self.parts:
            if isinstance(part, str):
                yield from _unpickled(read_shared(part))
            else:
                yield part

    @property
    def trees(self) -> list:
        return list(self.each())

    def proba(self, x: np.ndarray) -> np.ndarray:
        total, n = np.zeros(len(x)), 0
        for feature, cut, left, right, value in self.each():
            total += value[_route(x, feature, cut, left, right)]
            n += 1
        if self.kind in ("forest", "extra"):
            return total / max(n, 1)
        return 1.0 / (1.0 + np.exp(-(self.start + total)))


def _unpickled(data) -> Iterator[tuple]:
    """Trees that were pickled one after the other."""
    stream, size = io.BufferedReader(pa.BufferReader(data)), len(data)
    while stream.tell() < size:
        yield pickle.load(stream)


def _kept(trees: Iterator[tuple], folder: str, name: str) -> tuple[str | None, bytes]:
    """The URI of a file of trees, or, if they are small, the trees themselves, pickled."""
    held, size, out, path = [], 0, None, f"{folder}/{name}-{TaskContext.get().taskAttemptId()}"
    for tree in trees:
        held.append(pickle.dumps(tree))
        size += len(held[-1])
        if size > INLINE:
            out = out or open_output(path)
            out.write(b"".join(held))
            held = []
    if out is None:
        return None, b"".join(held)
    out.write(b"".join(held))
    out.close()
    return path, b""


def _flat(tree: Tree, edges, value: np.ndarray):
    feature = np.array(tree.feature, np.int32)
    cut = np.array([edges[f][b] if f >= 0 and b < len(edges[f]) else np.inf for f, b in zip(tree.feature, tree.cut)])
    return feature, cut, np.array(tree.left, np.int32), np.array(tree.right, np.int32), np.asarray(value, np.float64)


def fit_arrays(x, y, ids, spec: Spec, seed: int, first: int = 0, last: int | None = None) -> TreeModel:
    """A fit within one task; forests may grow the trees [first, last) only."""
    edges = bin_edges(x, spec.bins)
    start, trees = fit_bins(binned(x, edges), edges, y, ids, spec, seed, first, last)
    return TreeModel(spec.kind, start, list(trees))


def fit_bins(bins, edges, y, ids, spec: Spec, seed: int, first: int = 0, last: int | None = None) -> tuple[float, Iterator[tuple]]:
    """What boosting starts from, and the flat trees as they are grown."""
    whole = (float((y == 0).sum()), float((y == 1).sum()))
    if spec.kind in ("forest", "extra"):
        return 0.0, _forest(bins, edges, y, ids, spec, seed, range(first, spec.trees if last is None else last), whole)
    w = (_class_weights(spec, *whole) / SCALE)[y]
    fit = np.ones(len(y), bool)
    if spec.held_out:
        fit = _uniform(seed, 6, ids) >= spec.held_out
    start = baseline(w[fit & (y == 0)].sum(), w[fit & (y == 1)].sum())
    return start, _boosted(bins, edges, y, ids, spec, seed, w, fit, start)


def _width(edges) -> int:
    return max((len(e) for e in edges), default=0) + 1


def _forest(bins, edges, y, ids, spec: Spec, seed: int, numbers: range, whole) -> Iterator[tuple]:
    values = _values(edges, _width(edges))
    at_once = max(1, ENTRIES // max(len(y), 1))
    for a in range(0, len(numbers), at_once):
        for t in forest_trees(bins, y, ids, values, spec, seed, numbers[a:a + at_once], whole):
            yield _flat(t, edges, forest_values(t))


def _boosted(bins, edges, y, ids, spec: Spec, seed: int, w, fit, start: float) -> Iterator[tuple]:
    width = _width(edges)
    bins = np.asfortranarray(bins)
    raw = np.full(len(y), start)
    ordered = raw.copy()
    block = ordered_block(seed, ids) if spec.kind == "oblivious" else None
    losses = []
    for r in range(spec.trees):
        use = fit if spec.rows >= 1.0 else fit & (_uniform(seed, 7, r, ids) < spec.rows)
        rows = np.flatnonzero(use)
        if spec.kind == "oblivious":
            path, leaf = _grow_oblivious(bins, rows, ordered, y, w, width, spec)
            g, h = _gradients(raw, y, w)
            n = 1 << len(path)
            sums = np.stack([np.bincount(leaf[rows], s[rows], n) for s in (g, h)], axis=1)
            value = -spec.step * sums[:, 0] / np.maximum(sums[:, 1] + spec.l2 * SCALE, 1e-9 * SCALE)
            go, ho = _gradients(ordered, y, w)
            cell = leaf * BLOCKS + block
            parts = np.stack([np.bincount(cell[rows], s[rows], n * BLOCKS).reshape(n, BLOCKS) for s in (go, ho)], axis=2)
            ordered += prefix_values(parts, spec)[leaf, block]
            raw += value[leaf]
            tree = _oblivious_tree(path, value)
            yield _flat(tree, edges, np.array(tree.stats))
        else:
            g, h = _gradients(raw, y, w)
            leaf = np.zeros(len(y), np.int64)
            tree = leafwise_tree(bins, rows, g, h, width, spec, seed, r, leaf)
            if len(rows) < len(y):
                others = np.flatnonzero(~use)
                leaf[others] = tree.route(bins, others)
            value = boost_values(tree, spec)
            raw += value.take(leaf)
            yield _flat(tree, edges, value)
        if spec.held_out:
            losses.append(held_out_loss(raw[~fit], y[~fit], w[~fit]))
            if stopped(losses):
                break


def held_out_loss(raw, y, w) -> float:
    return float((w * (np.logaddexp(0, raw) - y * raw)).sum())


def stopped(losses: list, patience: int = 10, tol: float = 1e-7) -> bool:
    """No round of the last ``patience`` is better than what came before."""
    return len(losses) > patience and min(losses[-patience:]) > min(losses[:-patience]) - tol * abs(losses[0])


def _grow_oblivious(bins, rows, raw, y, w, width, spec):
    g, h = _gradients(raw, y, w)
    f = bins.shape[1]
    leaf = np.zeros(len(y), np.int64)
    path, before = [], None
    for _ in range(spec.depth):
        n = 1 << len(path)
        if before is None:
            hist = _leaf_histograms(bins, rows, leaf, 1, g, h, width)
        else:  # of two siblings the smaller is summed, the other is the difference
            many = np.bincount(leaf.take(rows), minlength=n)
            small = 2 * np.arange(n // 2) + (many[1::2] < many[::2])
            place = np.full(n, -1)
            place[small] = np.arange(n // 2)
            at = place.take(leaf)
            part = _leaf_histograms(bins, rows[at.take(rows) >= 0], at, n // 2, g, h, width)
            hist = np.empty((n, 3, f, width))
            hist[small], hist[small ^ 1] = part, before - part
        gain, j, b = 0.0, 0, 0
        for x in range(f):  # ties go to the first feature
            found, _, c = best_level(hist[:, :, x:x + 1], spec)
            if found > gain:
                gain, j, b = found, x, c
        if gain <= 0:
            break
        path.append((j, b))
        leaf = 2 * leaf + (bins[:, j] > b)
        before = hist
    return path, leaf


def _leaf_histograms(bins, rows, leaf, n: int, g, h, width: int) -> np.ndarray:
    """Sums of all features' bins over some rows by leaf, (leaf, stat, feature, bin), by chunks as
    in ``_sums_by_chunk``."""
    f = bins.shape[1]
    out = np.zeros((n, 3, f, width))
    size = max(CHUNK, 2 * n * width)
    for s in range(0, len(rows), size):
        r = rows[s:s + size]
        run = slice(r[0], r[-1] + 1) if r[-1] - r[0] == len(r) - 1 else r  # ascending and distinct
        a, b, base = g[run], h[run], leaf[run] * width
        shift = 2.0 ** np.ceil(np.log2(b.sum() + 1.0))
        packed = len(r) * shift < 2.0 ** 52
        weights = [a, b + shift] if packed else [a, b, np.ones(len(r))]
        for j in range(f):
            at = base + (bins[:, j][run] if isinstance(run, slice) else bins[:, j].take(run))
            sums = [np.bincount(at, v, n * width).reshape(n, width) for v in weights]
            count = np.floor(sums[1] / shift) if packed else sums[2]
            out[:, 0, j] += count
            out[:, 1, j] += sums[0]
            out[:, 2, j] += sums[1] - count * shift if packed else sums[1]
    return out


# ------------------------------------------------------------------ many fits, one job
def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def _run_task(plan, folder: str):
    def run(group: pa.Table) -> pa.Table:
        edges, parts = plan.value[group.column("task")[0].as_py()]
        ids = group.column("ID").to_numpy()
        y = group.column("label").to_numpy().astype(np.int64)
        bins = np.concatenate([_cells(c, edges) for c in group.column("bins").chunks])
        out = []
        for fit, first, last, spec, seed in parts:
            start, trees = fit_bins(bins, edges, y, ids, spec, seed, first, last)
            out.append((fit, first, start, *_kept(trees, folder, f"{fit}-{first}")))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.binary()))],
                        names=["fit", "first", "start", "path", "trees"])
    return run


def _bin_type(edges):
    return np.uint8 if _width(edges) <= 256 else np.uint16


def _cells(rows: pa.Array, edges) -> np.ndarray:
    """Bins of rows that travelled as bytes."""
    offset = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset]
    n = len(rows) * len(edges)
    size = np.dtype(_bin_type(edges)).itemsize
    return np.frombuffer(rows.buffers()[2], np.uint8, n * size, offset).view(_bin_type(edges)).reshape(len(rows), len(edges))


def exact_edges(data: DataFrame, wanted: dict[int, set]) -> dict:
    """``bin_edges`` of every (ds, number of bins), one task a column."""
    def columns(batches):
        for batch in batches:
            ds = batch.column("ds").to_numpy()
            x = _matrix(batch.column("features"))
            for d in np.unique(ds):
                found = [np.unique(c[~np.isnan(c)], return_counts=True) for c in x[ds == d].T]
                yield pa.RecordBatch.from_pydict({
                    "ds": pa.array([int(d)] * len(found), pa.int32()), "j": pa.array(range(len(found)), pa.int32()),
                    "v": [v.tobytes() for v, _ in found], "c": [c.astype(np.int32).tobytes() for _, c in found]})

    def edges(group: pa.Table) -> pa.Table:
        ds, j = group.column("ds")[0].as_py(), group.column("j")[0].as_py()
        v, c = (np.frombuffer(b"".join(group.column(k).to_pylist()), t) for k, t in (("v", np.float64), ("c", np.int32)))
        column = np.repeat(v, c)[:, None]
        bins = sorted(wanted[ds])
        return pa.table({"ds": pa.array([ds] * len(bins), pa.int32()), "j": pa.array([j] * len(bins), pa.int32()),
                         "bins": pa.array(bins, pa.int32()), "e": [bin_edges(column, b)[0].tobytes() for b in bins]})

    out: dict = {}
    parts = data.where(F.col("ds").isin(list(wanted))).select("ds", "features").mapInArrow(columns, "ds int, j int, v binary, c binary")
    for r in parts.groupBy("ds", "j").applyInArrow(edges, "ds int, j int, bins int, e binary").collect():
        out.setdefault((r["ds"], r["bins"]), {})[r["j"]] = np.frombuffer(r["e"], np.float64)
    return {k: [v[j] for j in sorted(v)] for k, v in out.items()}


def _labels(spark, n: int) -> list[int]:
    """``n`` numbers that a shuffle into ``n`` partitions deals one to each."""
    rows = spark.range(max(64, 40 * n)).select(F.col("id").cast("int").alias("id"))
    found = rows.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("to")).agg(F.min("id").alias("id")).collect()
    used = {r["id"] for r in found}
    return [*sorted(used), *(x for x in range(-n, 0))][:n]


def _fit_local(spark, data: DataFrame, fits: list) -> dict[int, TreeModel]:
    """Models of (fit, ds, spec, seed) whose tables fit a task."""
    wanted: dict = {}
    for _, ds, spec, _ in fits:
        wanted.setdefault(ds, set()).add(spec.bins)
    edges = exact_edges(data, wanted)
    sets = sorted(edges)
    parts: list = [[] for _ in sets]
    for k, ds, spec, seed in fits:
        share = TREES_PER_TASK if spec.kind in ("forest", "extra") else spec.trees
        for first in range(0, max(spec.trees, 1), max(share, 1)):
            parts[sets.index((ds, spec.bins))].append((k, first, min(spec.trees, first + share), spec, seed))
    # a task's table travels once for all its parts: no more copies than keep the cluster busy
    most, n = 4 * spark.sparkContext.defaultParallelism, sum(map(len, parts))
    tasks = []
    for i, own in enumerate(parts):
        many = len(own) if n <= most else -(-len(own) * most // n)
        own = sorted(own, key=lambda p: (p[3].kind, p[2] - p[1]), reverse=True)
        tasks += [(i, own[t::many]) for t in range(many)]
    labels = _labels(spark, len(tasks))
    plan = spark.sparkContext.broadcast({label: (edges[sets[i]], own) for label, (i, own) in zip(labels, tasks)})
    cuts = spark.sparkContext.broadcast([(i, ds, edges[ds, bins]) for i, (ds, bins) in enumerate(sets)])

    def to_bins(batches):
        for batch in batches:
            of = batch.column("ds").to_numpy()
            for i, ds, e in cuts.value:
                if (of == ds).any():
                    own = batch.filter(pa.array(of == ds))
                    x = np.ascontiguousarray(binned(_matrix(own.column("features")), e).astype(_bin_type(e)))
                    yield pa.RecordBatch.from_pydict({"set": pa.array([i] * own.num_rows, pa.int32()), "ID": own.column("ID"),
                                                      "label": own.column("label"), "bins": pa.array([r.tobytes() for r in x], pa.binary())})

    of: dict = {}
    for label, (i, _) in zip(labels, tasks):
        of.setdefault(i, []).append(label)
    # one row per table, with the numbers of its tasks: as many as the driver listed
    listed = spark.createDataFrame(list(of.items()), "set int, tasks array<int>")
    rows = data.where(F.col("ds").isin(list(wanted))).mapInArrow(to_bins, "set int, ID long, label long, bins binary").withColumn(
        "label", F.col("label").cast("tinyint"))
    dealt = rows.join(F.broadcast(listed), "set").select(F.explode("tasks").alias("task"), "ID", "label", "bins")
    done = dealt.repartition(len(tasks), "task").groupBy("task").applyInArrow(
        _run_task(plan, scratch_path(spark, "trees")), "fit int, first int, start double, path string, trees binary")
    found: dict = {}
    for r in done.collect():
        found.setdefault(r["fit"], {})[r["first"]] = (r["start"], [r["path"]] if r["path"] else list(_unpickled(bytes(r["trees"]))))
    plan.unpersist()
    cuts.unpersist()
    kinds = {k: spec.kind for k, _, spec, _ in fits}
    return {k: TreeModel(kinds[k], own[0][0], [t for first in sorted(own) for t in own[first][1]]) for k, own in found.items()}


def fit_many(fits: list[tuple[DataFrame, Spec, int]], local_cells: int | None = None) -> list[TreeModel]:
    """Models of ``(rows, spec, seed)`` fits; ``rows`` has (ID long, label, features) and fits
    that share a frame share its scan. Large models stay in files on the shared storage."""
    if not fits:
        return []
    local_cells = LOCAL_CELLS if local_cells is None else local_cells
    frames = list({id(rows): rows for rows, _, _ in fits}.values())
    number = {id(rows): i for i, rows in enumerate(frames)}
    spark = ship(frames[0].sparkSession)
    data = None
    for i, rows in enumerate(frames):
        part = rows.select(F.lit(i).alias("ds"), F.col("ID").cast("long").alias("ID"), F.col("label").cast("long").alias("label"), "features")
        data = part if data is None else data.unionByName(part)
    sizes = {r["ds"]: r["n"] * max(r["f"] or 0, 1) for r in data.groupBy("ds").agg(
        F.count("*").alias("n"), F.max(F.size("features")).alias("f")).collect()}
    out: list = [None] * len(fits)
    small, large = [], []
    for k, (rows, spec, seed) in enumerate(fits):
        ds = number[id(rows)]
        if ds not in sizes:
            raise ValueError("a learner needs rows to fit")
        if sizes[ds] > local_cells:
            large.append(k)
        else:
            small.append((k, ds, spec, seed))
    if small:
        for k, model in _fit_local(spark, data, small).items():
            out[k] = model
    for k in large:
        out[k] = fit_large(*fits[k])
    return out


def add_proba(df: DataFrame, model: TreeModel, features: str = "features", out: str = "proba") -> DataFrame:
    """``out``: the model's probability of class 1; the model travels as one broadcast."""
    shared = ship(df.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def scored(held):
            p = shared.value.proba(np.concatenate(held))
            return (pd.Series(x) for x in np.split(p, np.cumsum([len(x) for x in held])[:-1]))
        held, n = [], 0
        for x in batches:
            if not len(x):
                yield pd.Series([], dtype=float)
                continue
            held.append(np.stack([np.asarray(v, np.float64) for v in x]))
            n += len(x)
            if n >= SCORED_ROWS:
                yield from scored(held)
                held, n = [], 0
        if held:
            yield from scored(held)

    return df.withColumn(out, score(features))


# ------------------------------------------------------------------ tables beyond one task
def large_edges(rows: DataFrame, f: int, bins: int) -> list[np.ndarray]:
    """Cuts from one pass of approximate quantiles; features of few values get theirs exactly."""
    col = [F.col("features")[j] for j in range(f)]
    number = rows.agg(*[F.approx_count_distinct(c).alias(str(j)) for j, c in enumerate(col)]).first()
    few = [j for j in range(f) if number[str(j)] <= 2 * bins]
    many = [j for j in range(f) if j not in few]
    values: dict = {j: [] for j in few}
    if few:
        pairs = F.array(*[F.struct(F.lit(j).alias("j"), col[j].alias("v")) for j in few])
        for r in rows.select(F.inline(pairs)).where("v IS NOT NULL AND NOT isnan(v)").distinct().collect():
            values[r["j"]].append(r["v"])
    cuts = [float(q) for q in np.arange(1, bins) / bins]
    found = rows.agg(*[F.percentile_approx(F.when(~F.isnan(col[j]), col[j]), cuts, 10_000).alias(str(j)) for j in many]).first() if many else {}
    out = []
    for j in range(f):
        v = np.unique(np.array(values[j] if j in values else found[str(j)] or [], np.float64))
        if j in values and len(v) <= bins:
            out.append((v[1:] + v[:-1]) / 2)
        else:
            out.append(np.unique(np.quantile(v, cuts, method="midpoint")) if j in values else v[:-1])
    return out


_SPLIT = "tree int, node long, gain double, feature int, cut int, l array<double>, t array<double>"


def _sum_parts(group: pa.Table) -> np.ndarray:
    total = None
    for b in group.column("hist"):
        h = np.frombuffer(b.as_py(), np.float64)
        total = h.copy() if total is None else total + h
    return total


def _added(group: pa.Table) -> pa.Table:
    return pa.table({"tree": group.column("tree")[:1], "node": group.column("node")[:1],
                     "hist": pa.array([_sum_parts(group).tobytes()], pa.binary())})


def _partial(data: DataFrame, sums) -> DataFrame:
    """(tree, node, hist) added up per partition by ``sums(batch, add)``, then over 64 salts."""
    def run(batches):
        held: dict = {}

        def add(key, hist):
            held[key] = held[key] + hist if key in held else hist
        for batch in batches:
            if batch.num_rows:
                sums(batch, add)
        for (tree, node), hist in held.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()),
                                              "hist": pa.array([np.ascontiguousarray(hist).tobytes()], pa.binary())})
    parts = data.mapInArrow(run, "tree int, node long, hist binary").withColumn("salt", F.spark_partition_id() % 64)
    return parts.groupBy("tree", "node", "salt").applyInArrow(_added, "tree int, node long, hist binary")


def _unpack(batch, f: int):
    bins = np.frombuffer(b"".join(x.as_py() for x in batch.column("bins")), np.uint16).reshape(batch.num_rows, f)
    return bins, batch.column("y").to_numpy(), batch.column("ID").to_numpy()


def fit_large(rows: DataFrame, spec: Spec, seed: int) -> TreeModel:
    """The same fit by one job per level over a table that stays distributed."""
    spark = ship(rows.sparkSession)
    f = rows.select(F.size("features").alias("f")).first()["f"]
    edges = large_edges(rows, f, spec.bins)
    width = max((len(e) for e in edges), default=0) + 1

    def to_bins(batches):
        for batch in batches:
            x = binned(_matrix(batch.column("features")), edges).astype(np.uint16)
            yield pa.RecordBatch.from_pydict({"ID": batch.column("ID"), "y": batch.column("label"),
                                              "bins": pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())})

    data = stored(rows.select(F.col("ID").cast("long").alias("ID"), F.col("label").cast("long").alias("label"), "features").mapInArrow(
        to_bins, "ID long, y long, bins binary"), "tree-bins")
    counts = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.count("*").alias("n")).collect()}
    whole = (float(counts.get(0, 0)), float(counts.get(1, 0)))
    if spec.kind in ("forest", "extra"):
        return _large_forest(spark, data, edges, f, width, spec, seed, whole)
    return _large_boost(spark, data, edges, f, width, spec, seed, whole)


def _large_forest(spark, data, edges, f, width, spec, seed, whole) -> TreeModel:
    values = _values(edges, width)

    def bags(batch, add):
        _, y, ids = _unpack(batch, f)
        for t in range(spec.trees):
            c = bootstrap(spec, seed, t, ids)
            add((t, 0), np.array([((c > 0) & (y == k)).sum() for k in (0, 1)] + [c[y == k].sum() for k in (0, 1)], np.float64))

    bag = {r["tree"]: np.frombuffer(r["hist"], np.float64) for r in _partial(data, bags).groupBy("tree", "node").applyInArrow(
        _added, "tree int, node long, hist binary").collect()}
    trees, weights = [], []
    for t in range(spec.trees):
        w = _class_weights(spec, *(bag[t][2:] if spec.weights == "balanced_subsample" else whole))
        weights.append(w)
        trees.append(Tree())
        trees[t].stats[0] = np.array([bag[t][:2].sum(), bag[t][2] * w[0], bag[t][3] * w[1]])
    fronts = [_opened(t, [0], spec) for t in trees]
    k = _picked(spec, f)
    at_once = max(1, HELD_BYTES // (k * width * 24))
    while any(len(x) for x in fronts):
        todo = [(t, x[a:a + at_once]) for t, x in enumerate(fronts) for a in range(0, len(x), at_once)]
        splits: dict = {}
        while todo:  # as many nodes a job as a task may hold histograms of
            now, n = [], 0
            while todo and (not now or n + len(todo[0][1]) <= at_once):
                now.append(todo.pop(0))
                n += len(now[-1][1])
            shared = spark.sparkContext.broadcast((now, {t: trees[t] for t, _ in now}, weights))

            def sums(batch, add, shared=shared):
                bins, y, ids = _unpack(batch, f)
                now, grown, weights = shared.value
                for t, nodes in now:
                    c = bootstrap(spec, seed, t, ids)
                    node = grown[t].route(bins)
                    place = np.full(len(grown[t].feature), -1, np.int64)
                    place[nodes] = np.arange(len(nodes))
                    pos = place[node]
                    r = np.flatnonzero((c > 0) & (pos >= 0))
                    stats = [np.ones(len(r)), np.where(y[r] == 0, c[r] * weights[t][0], 0.0), np.where(y[r] == 1, c[r] * weights[t][1], 0.0)]
                    feats = node_features(spec, seed, t, nodes, f)
                    hist = histograms(bins, r, pos[r], feats, stats, len(nodes), width)
                    for i in np.unique(pos[r]):
                        add((t, int(nodes[i])), hist[i])

            def choose(group):
                t, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
                nodes = np.array([node])
                feats = node_features(spec, seed, t, nodes, f)
                hist = _sum_parts(group).reshape(1, 3, k, width)
                gain, feature, cut, left, total = level_splits(nodes, feats, hist, values, spec, seed, t)
                return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int64()), "gain": gain,
                                 "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32()),
                                 "l": pa.array([left[0].tolist()]), "t": pa.array([total[0].tolist()])})

            for r in _partial(data, sums).groupBy("tree", "node").applyInArrow(choose, _SPLIT).collect():
                splits[r["tree"], r["node"]] = r
            shared.unpersist()
        for t, front in enumerate(fronts):
            if len(front):
                got = [splits[t, int(x)] for x in front]
                _, fronts[t] = apply_level(trees[t], front, np.array([r["gain"] for r in got]), [r["feature"] for r in got],
                                           [r["cut"] for r in got], np.array([r["l"] for r in got]), np.array([r["t"] for r in got]), spec)
    return TreeModel(spec.kind, 0.0, [_flat(t, edges, forest_values(t)) for t in trees])


def _simulated(known: dict, spec: Spec):
    """Best-first growth over the splits known by path: the tree, the paths of its nodes, and
    those of leaves that may still be split but are not known."""
    tree, path = Tree(), [1]
    tree.stats[0] = known[1][4] if 1 in known else None
    missing, heap, leaves = [], [], 1

    def offer(node, p):
        s = tree.stats[node]
        if p not in known:
            if s is None or tree.depth[node] < spec.depth and s[0] >= 2 * spec.leaf_rows:
                missing.append((node, p))
        elif known[p][0] > 0:
            heapq.heappush(heap, (-known[p][0], p, node))

    offer(0, 1)
    while heap and leaves < spec.leaves:
        _, p, node = heapq.heappop(heap)
        _, j, b, left, total = known[p]
        a, c = tree.split(node, j, b, left, total - left)
        path += [2 * p, 2 * p + 1]
        leaves += 1
        if leaves < spec.leaves:
            offer(a, 2 * p)
            offer(c, 2 * p + 1)
    return tree, missing


def _large_boost(spark, data, edges, f, width, spec, seed, whole) -> TreeModel:
    class_w = _class_weights(spec, *whole) / SCALE
    kept = lambda ids: _uniform(seed, 6, ids) >= spec.held_out if spec.held_out else np.ones(len(ids), bool)

    def totals(batch, add):
        _, y, ids = _unpack(batch, f)
        k = kept(ids)
        add((0, 0), np.array([(k & (y == c)).sum() for c in (0, 1)], np.float64))

    def gather(sums) -> dict:
        rows = _partial(scored, sums).groupBy("tree", "node").applyInArrow(_added, "tree int, node long, hist binary").collect()
        return {r["node"]: np.frombuffer(r["hist"], np.float64) for r in rows}

    scored = data
    n = gather(totals)[0] * class_w
    start = baseline(*n)
    scored = stored(data.withColumns({"raw": F.lit(start), "ordered": F.lit(start)}), "tree-scores")
    out, fresh, losses = [], [], []

    def current(batch, fresh):
        """Bins, labels, ids and scores of a batch, with the rounds since the last writing."""
        bins, y, ids = _unpack(batch, f)
        raw, ordered = batch.column("raw").to_numpy().copy(), batch.column("ordered").to_numpy().copy()
        for kind, tree, value, prefix in fresh:
            if kind == "path":
                leaf = _leaf_of(bins, tree)
                ordered += prefix[leaf, ordered_block(seed, ids)]
            else:
                leaf = tree.route(bins)
            raw += value[leaf]
        return bins, y, ids, raw, ordered

    def used(ids, r):
        k = kept(ids)
        return k if spec.rows >= 1.0 else k & (_uniform(seed, 7, r, ids) < spec.rows)

    for r in range(spec.trees):
        state = spark.sparkContext.broadcast(list(fresh))
        if spec.kind == "oblivious":
            path: list = []
            for _ in range(spec.depth):
                def level(batch, add, path=tuple(path), r=r, state=state):
                    bins, y, ids, _, ordered = current(batch, state.value)
                    rows = np.flatnonzero(used(ids, r))
                    g, h = _gradients(ordered, y, class_w[y])
                    leaf = _leaf_of(bins, path)
                    for x in np.unique(leaf[rows]):
                        add((0, int(x)), _whole_histogram(bins, rows[leaf[rows] == x], g, h, width)[0])
                hist = gather(level)
                gain, j, b = best_level(np.stack([hist[x].reshape(3, f, width) for x in sorted(hist)]), spec)
                if gain <= 0:
                    break
                path.append((j, b))

            def leaves(batch, add, path=tuple(path), r=r, state=state):
                bins, y, ids, raw, ordered = current(batch, state.value)
                rows = np.flatnonzero(used(ids, r))
                leaf, block, n = _leaf_of(bins, path)[rows], ordered_block(seed, ids)[rows], 1 << len(path)
                parts = [np.bincount(leaf * BLOCKS + block, s[rows], n * BLOCKS).reshape(n, BLOCKS)
                         for x in (raw, ordered) for s in _gradients(x, y, class_w[y])]
                add((0, 0), np.stack(parts, axis=2))
            parts = gather(leaves)[0].reshape(1 << len(path), BLOCKS, 4)
            sums = parts[..., :2].sum(axis=1)
            value = -spec.step * sums[:, 0] / np.maximum(sums[:, 1] + spec.l2 * SCALE, 1e-9 * SCALE)
            fresh.append(("path", tuple(path), value, prefix_values(parts[..., 2:], spec)))
            tree = _oblivious_tree(path, value)
            out.append(_flat(tree, edges, np.array(tree.stats)))
        else:
            known: dict = {}
            allowed = tree_columns(spec, seed, r, f)
            while True:
                tree, missing = _simulated(known, spec)
                if not missing:
                    break

                def nodes(batch, add, tree=tree, missing=tuple(missing), r=r, state=state):
                    bins, y, ids, raw, _ = current(batch, state.value)
                    at = tree.route(bins)
                    use = used(ids, r)
                    g, h = _gradients(raw, y, class_w[y])
                    for node, p in missing:
                        rows = np.flatnonzero(use & (at == node))
                        if len(rows):
                            add((0, p), _whole_histogram(bins, rows, g, h, width)[0])
                for p, hist in gather(nodes).items():
                    gain, j, b, left, total = best_splits(hist.reshape(1, 3, f, width), spec, _feature_mask(spec, seed, r, p, allowed, f))
                    known[p] = (gain[0], int(j[0]), int(b[0]), left[0], total[0])
            value = boost_values(tree, spec)
            fresh.append(("tree", tree, value, None))
            out.append(_flat(tree, edges, value))
        if spec.held_out:
            shared = spark.sparkContext.broadcast(list(fresh))

            def loss(batch, add, shared=shared):
                _, y, ids, raw, _ = current(batch, shared.value)
                v = ~kept(ids)
                add((0, 0), np.array([held_out_loss(raw[v], y[v], class_w[y[v]])]))
            losses.append(float(gather(loss)[0][0]))
            if stopped(losses):
                break
        if len(fresh) >= REFRESH:
            shared = spark.sparkContext.broadcast(list(fresh))

            def write(batches, shared=shared):
                for batch in batches:
                    *_, raw, ordered = current(batch, shared.value)
                    yield pa.RecordBatch.from_arrays([batch.column("ID"), batch.column("y"), batch.column("bins"), pa.array(raw),
                                                      pa.array(ordered)], names=["ID", "y", "bins", "raw", "ordered"])
            scored = stored(scored.mapInArrow(write, "ID long, y long, bins binary, raw double, ordered double"), "tree-scores")
            fresh = []
    return TreeModel(spec.kind, start, out)


def _leaf_of(bins: np.ndarray, path) -> np.ndarray:
    leaf = np.zeros(len(bins), np.int64)
    for j, b in path:
        leaf = 2 * leaf + (bins[:, j] > b)
    return leaf
