"""Decision trees for many models in one pass: forests, and boosting of all classes together.

``fit_trees`` takes any number of jobs (a forest or a boosted model, with its train rows) and grows them
side by side. Nodes of up to ``LOCAL_ROWS`` rows are finished in one task by exact splits: a job that small
needs one shuffle for all its trees, and all such jobs of a sweep, of cross-validation folds or of a model
comparison share it. Larger nodes are split over the cluster: every pass over the rows adds up, for all
open nodes of all trees, the statistics per feature and quantile bin in each task, the tasks' sums are added
per node, and the best bin edge splits the node. Once its parts are small enough they are finished likewise.

A forest's rows are weighted by Poisson draws from a hash of key and tree, so a row has the same weight
wherever it is processed. A node looks at ``sqrt(features)`` random features, and at more until one can
split it. Boosting is of second order: gradients of all classes come from one softmax per round
(one sigmoid for two classes); a split's gain and a leaf's weight are Newton's, with an L1 and an L2 term.
Trees grow level by level, or leaf by leaf (the leaf with the largest gain next) where ``leaves`` bounds them.
There is no limit on the depth unless one is asked for, and a node of fewer than ``min_split`` rows is a leaf.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from textforge.session import materialize

#: Rows and stored numbers of a node that one task finishes; trees of a task; bins per feature beyond that.
LOCAL_ROWS, LOCAL_NUMBERS = 1 << 15, 1 << 22
TREES_PER_TASK, BINS = 25, 32
OPEN_BYTES = 128 << 20  # sums that a task gathers in one pass
UNITS = 256  # trees of a large forest that grow together
SCORE_ROWS = 1024  # rows that are scored at once, as a matrix of the features that a model uses
TABLE_ROWS, TABLE_NUMBERS = 1 << 20, 1 << 24  # of a forest whose tasks each read all rows themselves
COLUMN_CELLS, COLUMN_NUMBERS = 1 << 23, 1 << 21  # rows x classes that are boosted by columns; entries of a task's columns
HISTOGRAM = 1 << 20  # nodes x bins that are summed at once
PIECE = 1 << 15  # entries that a split is looked for at once, to stay in the processor's cache


@dataclass(frozen=True)
class Rule:
    """How a tree grows. ``newton`` tells boosting from a forest's Gini impurity."""

    newton: bool = False
    max_depth: int | None = None
    leaves: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    min_hessian: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    features: int | None = None  # random features per node; None: all
    width: int = 0  # number of all features

    def score(self, s: np.ndarray) -> np.ndarray:
        """What a node with these sums (rows x statistics) is worth; a split gains the difference."""
        if self.newton:
            g = np.sign(s[:, 0]) * np.maximum(np.abs(s[:, 0]) - self.l1, 0.0)
            return g * g / np.maximum(s[:, 1] + self.l2, 1e-300)
        weight = np.maximum(s.sum(1), 1e-300)
        return (s * s).sum(1) / weight

    def worth(self, s: np.ndarray) -> np.ndarray:
        """The same for sums that lie in rows of their own (statistics x nodes)."""
        if self.newton:
            g = np.maximum(np.abs(s[0]) - self.l1, 0.0) if self.l1 else s[0]
            return g * g / np.maximum(s[1] + self.l2, 1e-300)
        return (s * s).sum(0) / np.maximum(s.sum(0), 1e-300)

    def leaf(self, s: np.ndarray) -> np.ndarray:
        if self.newton:
            g = math.copysign(max(abs(s[0]) - self.l1, 0.0), s[0])
            return np.array([-g / max(s[1] + self.l2, 1e-300)])
        return s / max(s.sum(), 1e-300)


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` is -1 for a leaf, and rows with at most the threshold go left."""

    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self, value: np.ndarray) -> int:
        for column, x in zip((self.feature, self.threshold, self.left, self.right), (-1, 0.0, -1, -1)):
            column.append(x)
        self.value.append(value)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, threshold: float, left: int, right: int) -> None:
        self.feature[node], self.threshold[node], self.left[node], self.right[node] = feature, threshold, left, right

    def graft(self, node: int, other: Tree) -> None:
        """Puts another tree in the place of a leaf."""
        shift = len(self.feature) - 1  # the other's root takes the leaf's place
        at = lambda i: node if i == 0 else i + shift if i > 0 else -1
        for i in range(len(other.feature)):
            own = node if i == 0 else self.add(other.value[i])
            self.value[own] = other.value[i]
            self.split(own, other.feature[i], other.threshold[i], at(other.left[i]), at(other.right[i]))

    def leaves_of(self, rows: Sparse) -> np.ndarray:
        """The leaf of every row."""
        used = self.used()
        return self.leaves_in(used, rows.dense(used))

    def used(self) -> np.ndarray:
        feature = np.asarray(self.feature)
        return np.unique(feature[feature >= 0])

    def leaves_in(self, used: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """The leaf of every row of a matrix that has the ``used`` features."""
        feature, threshold = np.asarray(self.feature), np.asarray(self.threshold)
        left, right = np.asarray(self.left), np.asarray(self.right)
        at, node = np.searchsorted(used, np.maximum(feature, 0)), np.zeros(len(dense), np.int64)
        while len(open_ := np.flatnonzero(feature[node] >= 0)):
            here = node[open_]
            low = dense[open_, at[here]] <= threshold[here]
            node[open_] = np.where(low, left[here], right[here])
        return node

    def values(self) -> np.ndarray:
        """A row per node."""
        return np.asarray(self.value).reshape(len(self.feature), -1)

    def packed(self) -> Tree:
        """The same with arrays in the place of lists, for trees that are done."""
        kinds = (np.int32, float, np.int32, np.int32)
        columns = (np.array(c, k) for c, k in zip((self.feature, self.threshold, self.left, self.right), kinds))
        return Tree(*columns, self.values())


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)


class Sparse:
    """Rows as runs of (feature, number); numbers that are 0 are left out."""

    def __init__(self, idx: list, val: list):
        sizes = np.array([len(v) for v in val], np.int64)
        i = np.concatenate([np.empty(0, np.int64), *(np.arange(len(v)) if x is None else x for x, v in zip(idx, val))])
        self._hold(sizes, i, np.concatenate([np.empty(0), *val]).astype(float))

    @classmethod
    def of_lists(cls, idx: pa.ChunkedArray, val: pa.ChunkedArray) -> Sparse:
        """Of two list columns, without an object per row."""
        out = cls.__new__(cls)
        sizes = np.concatenate([np.empty(0, np.int64), *(c.value_lengths().to_numpy(zero_copy_only=False) for c in val.chunks)])
        i, v = (np.concatenate([np.empty(0, k), *(c.flatten().to_numpy(zero_copy_only=False) for c in x.chunks)]) for x, k in ((idx, np.int32), (val, float)))
        out._hold(sizes.astype(np.int64), i, v)
        return out

    def _hold(self, sizes: np.ndarray, i: np.ndarray, v: np.ndarray) -> None:
        kind = np.int32 if len(v) > LOCAL_NUMBERS else np.int64  # many rows: less memory rather than time
        row, some = np.repeat(np.arange(len(sizes), dtype=kind), sizes), v != 0
        self.n, self.idx, self.val, self.row = len(sizes), i[some].astype(kind), v[some], row[some]
        self.sizes = np.bincount(self.row, minlength=self.n)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def rank(self, width: int = 0) -> None:
        """Puts all entries in the order of feature and number as well: ``f, v, r``, r being the row."""
        order = np.lexsort((self.val, self.idx))
        self.place = np.empty(len(order), self.row.dtype)
        self.place[order] = np.arange(len(order))
        self.f, self.v, self.r = self.idx[order], self.val[order], self.row[order]
        self.counts = np.bincount(self.idx, minlength=max(width, 1))  # entries of each feature
        self.firsts = np.cumsum(self.counts) - self.counts
        self.positive = not (self.val < 0).any()
        self.inside, self.number = np.zeros(self.n, bool), np.zeros(self.n)  # scratch

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Places of the rows' entries in that order."""
        own = _ranges(self.begins[rows], self.sizes[rows])
        if 8 * len(own) < len(self.f):
            return np.sort(self.place[own])
        some = np.zeros(self.n, bool)
        some[rows] = True
        return np.flatnonzero(some[self.r])

    def entries_of(self, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Those of some features, by columns or by rows, whichever are shorter."""
        features = np.sort(features)
        if self.counts[features].sum() < 2 * self.sizes[rows].sum():
            own = _ranges(self.firsts[features], self.counts[features])
            self.inside[rows] = True
            own = own[self.inside[self.r[own]]]
            self.inside[rows] = False
            return own
        own = _ranges(self.begins[rows], self.sizes[rows])
        some = np.zeros(len(self.counts), bool)
        some[features] = True
        return np.sort(self.place[own[some[self.idx[own]]]])

    def pieces(self, entries: np.ndarray) -> list[np.ndarray]:
        """The entries at so many places, cut between features."""
        ends = [np.searchsorted(entries, self.firsts[self.f[entries[lo]]]) for lo in range(PIECE, len(entries), PIECE)]
        ends = [0, *ends, len(entries)]
        return [entries[lo:hi] for lo, hi in zip(ends, ends[1:]) if lo < hi] or [entries]

    def dense(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, max(1, len(features))))
        if len(features):
            at = np.minimum(np.searchsorted(features, self.idx), len(features) - 1)
            hit = features[at] == self.idx
            out[self.row[hit], at[hit]] = self.val[hit]
        return out

    def column(self, rows: np.ndarray, feature: int) -> np.ndarray:
        own = slice(self.firsts[feature], self.firsts[feature] + self.counts[feature])
        self.number[self.r[own]] = self.v[own]
        out = self.number[rows]
        self.number[self.r[own]] = 0.0
        return out


def choose(f: np.ndarray, v: np.ndarray, s: np.ndarray, total: np.ndarray, rule: Rule, edges: bool = False):
    """The best split: gain, feature, threshold, statistics of the left part; None if there is none.

    ``f, v, s`` are features, numbers and statistics, the last of which counts rows; what a feature's
    entries lack to ``total`` has the number 0. They come in the order of feature and number. With
    ``edges`` a number stands for a bin that it ends.
    """
    if not len(f):
        return None
    starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
    lacking = total - np.add.reduceat(s, starts)
    open_ = lacking[:, -1] > 0.5
    if open_.any():  # zeros go behind the feature's negative numbers
        at = (starts + np.add.reduceat((v < 0).astype(np.int64), starts))[open_]
        f, v, s = np.insert(f, at, f[starts][open_]), np.insert(v, at, 0.0), np.insert(s, at, lacking[open_], axis=0)
        starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
    sums = np.cumsum(s, axis=0)
    before = np.repeat(sums[starts] - s[starts], np.diff(np.append(starts, len(f))), axis=0)
    cut = np.flatnonzero((f[1:] == f[:-1]) & (v[1:] > v[:-1]))
    low = (sums - before)[cut]
    high = total - low
    good = (low[:, -1] >= rule.min_leaf) & (high[:, -1] >= rule.min_leaf)
    if rule.newton:
        good &= (low[:, 1] >= rule.min_hessian) & (high[:, 1] >= rule.min_hessian)
    gain = rule.score(low[:, :-1]) + rule.score(high[:, :-1]) - rule.score(total[None, :-1])
    gain = np.where(good, gain, -np.inf)
    if not len(gain) or not gain.max() > (1e-10 if rule.newton else -np.inf):
        return None
    at = int(gain.argmax())
    i = cut[at]
    middle = v[i] if edges else (v[i] + v[i + 1]) / 2
    return float(gain[at]), int(f[i]), float(middle if middle < v[i + 1] else v[i]), low[at]


def choose_positive(f: np.ndarray, v: np.ndarray, s: np.ndarray, total: np.ndarray, n: int, rule: Rule):
    """``choose`` for numbers above 0, so that zeros come first: the same split, and which entries can
    split a part of the node (None: all). ``s`` has a row per statistic, and ``n`` rows are in the node."""
    starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1]))) if len(f) else np.empty(0, np.int64)
    sizes, sums, kept = np.diff(np.append(starts, len(f))), np.cumsum(s, axis=1), None
    # Above a cut lie entries of the feature only: too few of them are too few in every part of the node.
    enough = sizes >= rule.min_leaf
    if rule.newton and rule.min_hessian > 0:
        enough &= np.add.reduceat(s[1], starts) >= rule.min_hessian * (1 - 1e-9) if len(f) else True
    if sizes[~enough].sum() * 4 > len(f):
        kept = np.repeat(enough, sizes)
        f, v, s, sizes = f[kept], v[kept], s[:, kept], sizes[enough]
        starts, sums = np.cumsum(sizes) - sizes, np.cumsum(s, axis=1)
    if not len(f):
        return None, kept
    high = np.repeat(sums[:, starts + sizes - 1], sizes, axis=1)
    high -= sums
    high += s
    above = np.repeat(starts + sizes, sizes) - np.arange(len(f))
    good = np.empty(len(f), bool)
    good[1:] = v[1:] > v[:-1]
    good[starts] = sizes < n
    if rule.min_leaf > 1:
        good &= (above >= rule.min_leaf) & (n - above >= rule.min_leaf)
    low = total[:, None] - high
    if rule.newton:
        good &= (low[1] >= rule.min_hessian) & (high[1] >= rule.min_hessian)
    gain = rule.worth(low)
    gain += rule.worth(high)
    gain[~good] = -np.inf
    at = int(gain.argmax())
    best = float(gain[at] - rule.worth(total[:, None])[0])
    if not best > (1e-10 if rule.newton else -np.inf):
        return None, kept
    before = v[at - 1] if at and f[at - 1] == f[at] else 0.0
    middle = (before + v[at]) / 2
    return (best, int(f[at]), float(middle if middle < v[at] else before), np.append(low[:, at], n - above[at])), kept


def _drawn_entries(rows: Sparse, own: np.ndarray, rule: Rule, rng) -> np.ndarray:
    """Places of the entries that ``_drawn`` takes from a node's; the rest are looked at only if those can't split it."""
    state = rng.bit_generator.state
    at = rows.entries_of(own, rng.choice(rule.width, min(rule.features, rule.width), replace=False))
    if len(at):
        f, v = rows.f[at], rows.v[at]
        starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
        ends = np.append(starts[1:], len(f)) - 1
        if ((ends - starts + 1 < len(own)) | (v[starts] < v[ends])).any():
            return at
    rng.bit_generator.state = state
    at = rows.entries(own)
    return at[_drawn(rows.f[at], rows.v[at], len(own), np.ones(len(at)), rule, rng)]


def _drawn(f: np.ndarray, v: np.ndarray, count: float, counts: np.ndarray, rule: Rule, rng) -> np.ndarray:
    """Which entries belong to the node's random features: at least one that can split it."""
    starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1]))) if len(f) else np.empty(0, np.int64)
    if not len(starts):
        return np.zeros(0, bool)
    ends = np.append(starts[1:], len(f)) - 1
    held = np.add.reduceat(counts, starts)
    varied = f[starts][(held < count - 0.5) | (v[starts] < v[ends])]
    if not len(varied):
        return np.zeros(len(f), bool)
    chosen = np.zeros(rule.width, bool)
    chosen[rng.choice(rule.width, min(rule.features, rule.width), replace=False)] = True
    if not chosen[varied].any():
        chosen[varied[rng.integers(len(varied))]] = True
    return chosen[f]


def grow(rows: Sparse, at: np.ndarray, stats: np.ndarray, rule: Rule, rng, depth: int = 0) -> tuple[Tree, np.ndarray]:
    """A tree on the rows ``at`` whose root lies at ``depth``, and the leaf of each of them."""
    tree, where = Tree(), np.zeros(len(at), np.int64)
    if not hasattr(rows, "place"):
        rows.rank(rule.width)
    columns = np.ascontiguousarray(stats.T)
    counted = None if rows.positive else np.concatenate((stats, np.ones((len(stats), 1))), 1)

    def best(own: np.ndarray, deep: int, entries: np.ndarray | None):
        """The split, and the entries that can matter below it (None where features are drawn)."""
        n = len(own)
        if n < rule.min_split or n < 2 * rule.min_leaf or rule.max_depth is not None and deep >= rule.max_depth:
            return None, None
        total = columns.take(at[own], 1).sum(1)
        if not rule.newton and np.count_nonzero(total) < 2:
            return None, None  # pure
        some = entries if rule.features is None else _drawn_entries(rows, at[own], rule, rng)
        if not rows.positive:
            return choose(rows.f[some], rows.v[some], counted[rows.r[some]], np.append(total, n), rule), entries
        split, parts = None, []
        for piece in rows.pieces(some):
            found, kept = choose_positive(rows.f[piece], rows.v[piece], columns.take(rows.r[piece], 1), total, n, rule)
            split = found if split is None or found and found[0] > split[0] else split
            parts.append(piece if kept is None else piece[kept])
        return split, None if entries is None else np.concatenate(parts)

    def add(own: np.ndarray) -> int:
        node = tree.add(rule.leaf(stats[at[own]].sum(0)))
        where[own] = node
        return node

    everything = np.arange(len(at))
    begin = rows.entries(at) if rule.features is None else None
    queue = [(0.0, add(everything), everything, depth, None, begin)]
    if rule.leaves is not None:
        split, begin = best(everything, depth, begin)
        queue = [(-split[0], 0, everything, depth, split, begin)] if split else []
    n_leaves = 1
    while queue and (rule.leaves is None or n_leaves < rule.leaves):
        _, node, own, deep, split, entries = heapq.heappop(queue) if rule.leaves is not None else queue.pop()
        if split is None:
            split, entries = best(own, deep, entries)
        if split is None:
            continue
        low = rows.column(at[own], split[1]) <= split[2]
        parts, sides = (own[low], own[~low]), (None, None)
        children = [add(part) for part in parts]
        tree.split(node, split[1], split[2], *children)
        n_leaves += 1
        if entries is not None:
            rows.inside[at[parts[0]]] = True
            left = rows.inside[rows.r[entries]]
            rows.inside[at[parts[0]]] = False
            sides = entries[left], entries[~left]
        for child, part, side in zip(children, parts, sides):
            if rule.leaves is None:
                queue.append((0.0, child, part, deep + 1, None, side))
                continue
            next_, side = best(part, deep + 1, side)
            if next_:
                heapq.heappush(queue, (-next_[0], child, part, deep + 1, next_, side))
    return tree, where


@dataclass(frozen=True)
class Job:
    """One model to fit: ``rows`` has key, label (0..K-1), weight and features."""

    rows: DataFrame
    kind: str  # random_forest or boosted_trees
    n_classes: int
    trees: int
    rule: Rule
    rate: float = 1.0
    curvature: float = 1.0  # factor of the second derivative
    prior: bool = False  # boosting starts from the classes' shares
    seed: int = 42

    @property
    def outputs(self) -> int:
        """Trees per round of boosting."""
        return 1 if self.n_classes == 2 else self.n_classes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def draws(hashes: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1, from the key's hash."""
    number = _mix(hashes.astype(np.uint64) ^ _mix(np.array([(tree + 1) * 1_000_003 + seed], np.uint64)))
    return np.searchsorted(_POISSON, (number >> np.uint64(11)).astype(float) * 2.0**-53, "right")


def gradients(margins: np.ndarray, label: np.ndarray, weight: np.ndarray, curvature: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss by class; one column for two classes."""
    p = shares(margins)
    if margins.shape[1] == 1:
        p, y = p[:, 1:], (label == 1)[:, None]
        curvature = 1.0
    else:
        y = label[:, None] == np.arange(margins.shape[1])
    return (p - y) * weight[:, None], np.maximum(curvature * p * (1 - p), 1e-16) * weight[:, None]


def shares(margins: np.ndarray) -> np.ndarray:
    both = np.concatenate((np.zeros_like(margins), margins), 1) if margins.shape[1] == 1 else margins
    e = np.exp(both - both.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def start(counts: np.ndarray, job: Job) -> np.ndarray:
    """Margins before the first tree, from the classes' weights."""
    if not job.prior:
        return np.zeros(job.outputs)
    share = np.maximum(counts, 1e-12) / max(counts.sum(), 1e-12)
    return np.array([math.log(share[1] / share[0])]) if job.outputs == 1 else np.log(share)


TREE = "job int, tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
_UNIT_ROWS = ("unit", "hash", "label", "weight", "idx", "val")
_NAMES = ["job", "tree", "feature", "threshold", "left", "right", "value"]


def _as_rows(job: int, numbers: list[int], trees: list[Tree]) -> pa.Table:
    columns = [
        pa.array([job] * len(trees), pa.int32()),
        pa.array(numbers, pa.int32()),
        *(pa.array([getattr(t, n) for t in trees], pa.list_(k)) for n, k in (("feature", pa.int32()), ("threshold", pa.float64()), ("left", pa.int32()), ("right", pa.int32()))),
        pa.array([t.values().ravel() for t in trees], pa.list_(pa.float64())),
    ]
    return pa.Table.from_arrays(columns, names=_NAMES)


def _of_row(r, outputs: int) -> Tree:
    return Tree([*r.feature], [*r.threshold], [*r.left], [*r.right], [*np.array(r.value).reshape(-1, outputs)])


def _trees_of(table: DataFrame, outputs: int) -> list[Tree]:
    """A model's trees in their order, as arrays."""
    found = table.select(*_NAMES[1:]).toArrow().sort_by("tree")
    columns = []
    for name in _NAMES[2:]:
        parts = [c for c in found[name].chunks if len(c)]
        columns.append([x for c in parts for x in np.split(c.flatten().to_numpy(), np.cumsum(c.value_lengths().to_numpy())[:-1])])
    return [Tree(f, t, lo, hi, v.reshape(-1, outputs)) for f, t, lo, hi, v in zip(*columns)]


def _table_rows(group: pa.Table) -> tuple[Sparse, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of their hashes: features, hashes, labels, weights."""
    group = group.sort_by([("hash", "ascending"), ("label", "ascending")])
    return Sparse.of_lists(group["idx"], group["val"]), *(group[c].to_numpy() for c in ("hash", "label", "weight"))


def forest_stats(label, weight, drawn, n_classes: int) -> np.ndarray:
    return (label[:, None] == np.arange(n_classes)) * (weight * drawn)[:, None]


@dataclass(frozen=True)
class Unit:
    """What one task grows from all rows of a job: some trees of a forest, or a whole boosted model."""

    job: int
    lo: int
    hi: int


def _units(jobs: list[Job], numbers: list[int], per_task: int) -> list[Unit]:
    """Boosted models first, as they take longest."""
    order = sorted(numbers, key=lambda i: jobs[i].kind == "random_forest")
    step = lambda j: per_task if j.kind == "random_forest" else max(1, j.trees)
    return [Unit(i, lo, min(jobs[i].trees, lo + step(jobs[i]))) for i in order for lo in range(0, jobs[i].trees, step(jobs[i]))]


_BLOCK = "job int, hash binary, label binary, weight binary, size binary, idx binary, val binary"


def _packed_rows(batches):
    """Rows by the batch: tasks that read all of them need no more than to copy it."""
    for batch in batches:
        for job in batch["job"].unique().to_pylist():
            own = batch.filter(pc.equal(batch["job"], job))
            numbers = [own[c].to_numpy() for c in ("hash", "label", "weight")]
            numbers.append(own["val"].value_lengths().to_numpy(zero_copy_only=False))
            numbers += [own[c].flatten().to_numpy(zero_copy_only=False) for c in ("idx", "val")]
            blobs = [pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip(numbers, _BLOCK_KINDS)]
            yield pa.record_batch([pa.array([job], pa.int32()), *blobs], names=["job", *_BLOCK_NAMES])


_BLOCK_NAMES, _BLOCK_KINDS = ("hash", "label", "weight", "size", "idx", "val"), (np.int64, float, float, np.int32, np.int32, float)


def _unpacked_rows(parts: list[pa.RecordBatch]) -> tuple[Sparse, np.ndarray, np.ndarray, np.ndarray]:
    """``_table_rows`` of packed rows."""
    read = lambda c, k: np.concatenate([np.frombuffer(x.as_buffer(), k) for p in parts for x in p[c]])
    hashes, label, weight, size, idx, val = (read(c, k) for c, k in zip(_BLOCK_NAMES, _BLOCK_KINDS))
    order = np.lexsort((label, hashes))
    entries = _ranges((np.cumsum(size, dtype=np.int64) - size)[order], size[order])
    rows = Sparse.__new__(Sparse)
    rows._hold(size[order].astype(np.int64), idx[entries], val[entries])
    return rows, hashes[order], label[order], weight[order]


def _grown_units(jobs: list[Job], units: list[Unit], packed: bool = False):
    """A partition has the rows of one unit, with its number."""
    plain = [replace(j, rows=None) for j in jobs]

    def grown(unit: Unit, parts: list[pa.RecordBatch]) -> pa.Table:
        number, job = unit.job, plain[unit.job]
        rows, hashes, label, weight = _unpacked_rows(parts) if packed else _table_rows(pa.Table.from_batches(parts))
        made, numbers = [], []
        if job.kind == "random_forest":
            for t in range(unit.lo, unit.hi):
                drawn = draws(hashes, t, job.seed)
                stats = forest_stats(label, weight, drawn, job.n_classes)
                made.append(grow(rows, np.flatnonzero(drawn), stats, job.rule, np.random.default_rng([job.seed, t]))[0].packed())
                numbers.append(t)
        else:
            counts = np.bincount(label.astype(int), weight, job.n_classes)
            margins = np.tile(start(counts, job), (rows.n, 1))
            for t in range(job.trees):
                g, h = gradients(margins, label, weight, job.curvature)
                for c in range(job.outputs):
                    rng = np.random.default_rng([job.seed, t, c])
                    tree, leaf = grow(rows, np.arange(rows.n), np.stack([g[:, c], h[:, c]], 1), job.rule, rng)
                    margins[:, c] += job.rate * tree.values()[leaf, 0]
                    made.append(tree.packed())
                    numbers.append(t * job.outputs + c)
        return _as_rows(number, numbers, made)

    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            for number in batch["unit"].unique().to_pylist():
                own = batch.filter(pc.equal(batch["unit"], number))
                parts.setdefault(number, []).append(own.drop_columns(["unit"]))
        for number in sorted(parts):
            yield from grown(units[number], parts.pop(number)).to_batches()

    return run


# Larger jobs: nodes over the cluster


def _batch(batch: pa.RecordBatch) -> tuple[Sparse, np.ndarray, np.ndarray, np.ndarray, list]:
    named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    idx, val = (named[c].to_pandas().tolist() for c in ("idx", "val"))
    margins = np.array(named["margins"].to_pylist()) if "margins" in named else None
    return Sparse(idx, val), *(named[c].to_numpy() for c in ("hash", "label", "weight")), margins


def _stats_of(job: Job, unit: int, hashes, label, weight, margins) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of all rows for one tree, and which rows it has."""
    if job.kind == "random_forest":
        drawn = draws(hashes, unit, job.seed)
        return forest_stats(label, weight, drawn, job.n_classes), drawn > 0
    g, h = gradients(margins, label, weight, job.curvature)
    return np.stack([g[:, unit], h[:, unit]], 1), np.ones(len(label), bool)


def _features_of(job: Job, unit: int, node: int) -> np.ndarray:
    """The node's random features, as ``_drawn`` takes them first."""
    rule = job.rule
    return np.sort(np.random.default_rng([job.seed, unit, node]).choice(rule.width, min(rule.features, rule.width), replace=False))


def _drawn_sums(job: Job, sent, open_: set[tuple[int, int]]):
    """``_sums`` over the nodes' random features only."""

    def run(batches):
        trees, edges_f, edges_v = sent.value
        places, found, allowed = {}, {}, {}
        for unit in trees:
            nodes = sorted(n for u, n in open_ if u == unit)
            mask = allowed[unit] = np.zeros((len(nodes), job.rule.width), bool)
            for i, node in enumerate(nodes):
                own = _features_of(job, unit, node)
                mask[i, own] = True
                lo, hi = (np.searchsorted(edges_f, own, side) for side in ("left", "right"))
                places[unit, node] = _ranges(lo, hi - lo)
                found[unit, node] = np.zeros((len(places[unit, node]) + 1, job.n_classes + 1))
        for batch in batches:
            rows, *facts = _batch(batch)
            at = _bin(edges_v, np.searchsorted(edges_f, rows.idx, "left"), np.searchsorted(edges_f, rows.idx, "right"), rows.val)
            for unit, tree in trees.items():
                stats, has = _stats_of(job, unit, *facts)
                nodes = sorted(n for u, n in open_ if u == unit)
                number = np.full(len(tree.feature), -1)
                number[nodes] = np.arange(len(nodes))
                mine = np.where(has, number[tree.leaves_of(rows)], -1)
                counted = np.concatenate((stats, np.ones((rows.n, 1))), 1)
                some = np.flatnonzero(allowed[unit].any(0)[rows.idx])
                some = some[(mine[rows.row[some]] >= 0) & allowed[unit][mine[rows.row[some]], rows.idx[some]]]
                for i, node in enumerate(nodes):
                    total, own = found[unit, node], some[mine[rows.row[some]] == i]
                    place = np.searchsorted(places[unit, node], at[own])
                    for c in range(total.shape[1]):
                        total[:-1, c] += np.bincount(place, counted[rows.row[own], c], len(total) - 1)
                    total[-1] += counted[mine == i].sum(0)
        found = {x: total for x, total in found.items() if total[-1, -1]}
        there = {x: np.flatnonzero(total[:, -1]) for x, total in found.items()}
        columns = [
            pa.array([u for u, _ in found], pa.int32()),
            pa.array([n for _, n in found], pa.int32()),
            pa.array([np.append(places[x], len(edges_v))[there[x]].astype(np.int64).tobytes() for x in found], pa.binary()),
            pa.array([total[there[x]].tobytes() for x, total in found.items()], pa.binary()),
        ]
        yield pa.record_batch(columns, names=["unit", "node", "places", "sums"])

    return run


def _sums(job: Job, sent, open_: set[tuple[int, int]]):
    """Per task: statistics of each open node by bin, as positions in the list of bin edges (-1: the node)."""

    def run(batches):
        trees, edges_f, edges_v = sent.value
        found: dict[tuple[int, int], np.ndarray] = {}
        width = (job.n_classes if job.kind == "random_forest" else 2) + 1
        for batch in batches:
            rows, *facts = _batch(batch)
            at = np.searchsorted(edges_f, rows.idx, "left")
            last = np.searchsorted(edges_f, rows.idx, "right")
            at = _bin(edges_v, at, last, rows.val)
            for unit, tree in trees.items():
                stats, has = _stats_of(job, unit, *facts)
                leaf = tree.leaves_of(rows)
                counted = np.concatenate((stats, np.ones((rows.n, 1))), 1)
                for node in [n for u, n in open_ if u == unit]:
                    mine = has & (leaf == node)
                    total = found.setdefault((unit, node), np.zeros((len(edges_v) + 1, width)))
                    own = mine[rows.row]
                    np.add.at(total, at[own], counted[rows.row[own]])
                    total[-1] += counted[mine].sum(0)
        units, nodes, places, sums = [], [], [], []
        for (unit, node), total in found.items():
            there = np.flatnonzero(total[:, -1])
            units.append(unit)
            nodes.append(node)
            places.append(there.astype(np.int64).tobytes())
            sums.append(total[there].tobytes())
        yield pa.record_batch([pa.array(units, pa.int32()), pa.array(nodes, pa.int32()), pa.array(places, pa.binary()), pa.array(sums, pa.binary())], names=["unit", "node", "places", "sums"])

    return run


def _bin(edges: np.ndarray, lo: np.ndarray, hi: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Binary search of each number among its feature's edges."""
    lo, hi = lo.copy(), np.maximum(hi - 1, lo)  # the last edge is the greatest number
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        up = open_ & (edges[mid] < v)
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    return lo


def _node_split(job: Job, sent):
    """Adds the tasks' sums of a node and chooses its split."""

    def run(group: pa.Table) -> pa.Table:
        _, edges_f, edges_v = sent.value
        unit, node = group["unit"][0].as_py(), group["node"][0].as_py()
        width = (job.n_classes if job.kind == "random_forest" else 2) + 1
        total = np.zeros((len(edges_v) + 1, width))
        for places, sums in zip(group["places"], group["sums"]):
            total[np.frombuffer(places.as_buffer(), np.int64)] += np.frombuffer(sums.as_buffer(), float).reshape(-1, width)
        there = np.flatnonzero(total[:-1, -1])
        f, v, s, whole = edges_f[there], edges_v[there], total[there], total[-1]
        if job.rule.features is not None:
            some = _drawn(f, v, whole[-1], s[:, -1], job.rule, np.random.default_rng([job.seed, unit, node]))
            f, v, s = f[some], v[some], s[some]
        split = choose(f, v, s, whole, job.rule, edges=True) if whole[-1] >= job.rule.min_split else None
        gain, feature, threshold, low = split or (0.0, -1, 0.0, whole)
        columns = [[unit], [node], [gain], [feature], [threshold], [low.tolist()], [whole.tolist()]]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["unit", "node", "gain", "feature", "threshold", "low", "whole"])

    return run


def _to_finish(job: Job, sent, small: set[tuple[int, int]]):
    """Rows of small nodes with their statistics, once per tree that has them."""

    def run(batches):
        trees = sent.value[0]
        for batch in batches:
            rows, *facts = _batch(batch)
            for unit, tree in trees.items():
                stats, has = _stats_of(job, unit, *facts)
                leaf = tree.leaves_of(rows)
                mine = np.flatnonzero(has & np.isin(leaf, [n for u, n in small if u == unit]))
                some = batch.select(["hash", "idx", "val"]).take(pa.array(mine))
                own = [pa.array([unit] * len(mine), pa.int32()), pa.array(leaf[mine].astype(np.int32)), *some.columns, pa.array(stats[mine].tolist(), pa.list_(pa.float64()))]
                yield pa.record_batch(own, names=["unit", "node", "hash", "idx", "val", "stats"])

    return run


def _finish(job: Job, depths: dict):
    def run(group: pa.Table) -> pa.Table:
        unit, node = group["unit"][0].as_py(), group["node"][0].as_py()
        group = group.sort_by([("hash", "ascending")]).combine_chunks()
        rows = Sparse(*(group[c].to_pandas().tolist() for c in ("idx", "val")))
        rule = replace(job.rule, leaves=depths[unit, node][1]) if job.rule.leaves else job.rule
        stats = np.array(group["stats"].to_pylist())
        tree, _ = grow(rows, np.arange(rows.n), stats, rule, np.random.default_rng([job.seed, unit, node]), depths[unit, node][0])
        return _as_rows(node, [unit], [tree])

    return run


def _grow_over_cluster(rows: DataFrame, job: Job, units: list[int], edges: tuple, local: int) -> dict[int, Tree]:
    """Trees of one large job; only bin sums, splits and finished subtrees leave the executors."""
    context = rows.sparkSession.sparkContext
    outputs = job.n_classes if job.kind == "random_forest" else 1
    trees = {u: Tree() for u in units}
    for tree in trees.values():
        tree.add(np.zeros(outputs))
    depth = {(u, 0): 0 for u in units}
    open_, small, n_leaves = {(u, 0) for u in units}, set(), dict.fromkeys(units, 1)
    unsplit = set()  # nodes that their random features can't split: all are looked at
    while open_:
        drawn = job.rule.features is not None and len(open_) > len(unsplit)
        n_edges = min(len(edges[0]), job.rule.features * (BINS + 1)) if drawn else len(edges[0])
        at_once = max(1, OPEN_BYTES // (8 * (n_edges + 1) * (outputs + 2)))
        some = set(sorted(open_ - unsplit if drawn else open_, key=lambda x: (depth[x], x))[:at_once])
        now = {u: trees[u] for u, _ in some}
        sent = context.broadcast((now, *edges))
        parts = rows.mapInArrow((_drawn_sums if drawn else _sums)(job, sent, some), "unit int, node int, places binary, sums binary")
        found = parts.groupBy("unit", "node").applyInArrow(
            _node_split(job, sent), "unit int, node int, gain double, feature int, threshold double, low array<double>, whole array<double>"
        ).collect()
        open_ -= some
        unsplit -= some
        for r in sorted(found, key=lambda r: (-r.gain, r.unit, r.node)):  # of a tree's nodes, the best first
            tree, low, whole = trees[r.unit], np.array(r.low), np.array(r.whole)
            tree.value[r.node] = job.rule.leaf(whole[:-1])
            deep = depth[r.unit, r.node]
            full = job.rule.leaves is not None and n_leaves[r.unit] >= job.rule.leaves
            if full or job.rule.max_depth is not None and deep >= job.rule.max_depth:
                continue
            if r.feature < 0:
                if drawn:
                    open_.add((r.unit, r.node))
                    unsplit.add((r.unit, r.node))
                continue
            n_leaves[r.unit] += 1
            children = [tree.add(job.rule.leaf(s[:-1])) for s in (low, whole - low)]
            tree.split(r.node, r.feature, r.threshold, *children)
            for child, s in zip(children, (low, whole - low)):
                depth[r.unit, child] = deep + 1
                (small if s[-1] <= local else open_).add((r.unit, child))
    if small:
        sent = context.broadcast((trees, *edges))
        room = {u: (job.rule.leaves or 0) - n for u, n in n_leaves.items()}
        n_small = {u: sum(x == u for x, _ in small) for u in units}
        depths = {x: (depth[x], 1 + max(0, room[x[0]]) // n_small[x[0]]) for x in small}
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
        routed = rows.mapInArrow(
            _to_finish(job, sent, small), f"unit int, node int, hash long, idx {kinds['idx']}, val {kinds['val']}, stats array<double>"
        )
        for r in routed.groupBy("unit", "node").applyInArrow(_finish(job, depths), TREE).collect():
            trees[r.tree].graft(r.job, _of_row(r, outputs))
    return trees


def _edges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bin edges of every feature: quantiles of its numbers that are not 0, the greatest last."""
    entries = rows.select(F.inline(F.arrays_zip(F.col("idx").alias("f"), F.col("val").alias("v")))).where("v <> 0")
    at = [i / BINS for i in range(1, BINS + 1)]  # 0 is an edge as well
    cuts = entries.groupBy("f").agg(F.array_union(F.percentile_approx("v", at, 1000), F.array(F.lit(0.0))).alias("cuts")).orderBy("f").collect()
    f = np.concatenate([np.empty(0, np.int64), *(np.full(len(r.cuts), r.f) for r in cuts)]).astype(np.int64)
    return f, np.concatenate([np.empty(0), *(np.sort(r.cuts) for r in cuts)])


def _with_margins(rows: DataFrame, trees: dict[int, Tree], rate: float) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(trees)
    names = rows.columns

    def run(batches):
        for batch in batches:
            own, *_, margins = _batch(batch)
            for c, tree in sent.value.items():
                margins[:, c] += rate * tree.values()[tree.leaves_of(own), 0]
            columns = [batch.column(n) for n in names if n != "margins"]
            yield pa.record_batch([*columns, pa.array(margins.tolist(), pa.list_(pa.float64()))], names=[*(n for n in names if n != "margins"), "margins"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "margins")
    return materialize(rows.mapInArrow(run, f"{kept}, margins array<double>"), "boost-margins")


def _large_job(rows: DataFrame, job: Job, counts: np.ndarray, local: int) -> list[Tree]:
    edges, plain = _edges(rows), replace(job, rows=None)
    if job.kind == "random_forest":
        trees = {}
        for lo in range(0, job.trees, UNITS):
            trees |= _grow_over_cluster(rows, plain, [*range(lo, min(job.trees, lo + UNITS))], edges, local)
        return [trees[t] for t in range(job.trees)]
    begin, out = F.array(*(F.lit(float(x)) for x in start(counts, job))), []
    rows = rows.withColumn("margins", begin)
    for _ in range(job.trees):
        made = _grow_over_cluster(rows, plain, [*range(job.outputs)], edges, local)
        rows = _with_margins(rows, made, job.rate)
        out += [made[c] for c in range(job.outputs)]
    return out


# Large boosted jobs: columns over the cluster


class Features:
    """Some features of all rows, each entry as a bin's number with its row, in the order of rows.

    A bin has equal or neighbouring numbers of a feature of one sign; bins come in the order of feature and number.
    """

    KIND = "group int, bin binary, row binary, feature binary, least binary, most binary"

    def __init__(self, bin: np.ndarray, row: np.ndarray, feature: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.bin, self.row, self.feature, self.least, self.most = bin, row.astype(np.intp), feature, least, most
        self.begin, self.end = (np.searchsorted(feature, feature, side) for side in ("left", "right"))
        self.positive = least > 0
        # A cut parts a bin and those farther from 0 from the rest: at its threshold.
        before = np.append(0.0, most[:-1])
        before[self.begin == np.arange(len(feature))] = 0.0
        after = np.append(least[1:], 0.0)
        after[self.end == np.arange(len(feature)) + 1] = 0.0
        low, high = np.where(self.positive, np.maximum(before, 0.0), most), np.where(self.positive, least, np.minimum(after, 0.0))
        middle = (low + high) / 2
        self.threshold = np.where(middle < high, middle, low)

    @classmethod
    def of_entries(cls, f: np.ndarray, v: np.ndarray, r: np.ndarray) -> Features:
        order = np.lexsort((r, v, f))
        f, v, r = f[order], v[order], r[order]
        n, first = len(f), lambda x: np.concatenate((np.ones(min(1, n), bool), x))
        side = first((f[1:] != f[:-1]) | ((v[1:] > 0) != (v[:-1] > 0)))  # a feature's numbers of one sign
        begin = np.flatnonzero(side)
        size = np.diff(np.append(begin, n))
        run = np.maximum.accumulate(np.where(first((v[1:] != v[:-1])) | side, np.arange(n), 0))  # equal numbers
        code = (run - np.repeat(begin, size)) * BINS // np.repeat(size, size)
        start = side | first(code[1:] != code[:-1])
        firsts, bins = np.flatnonzero(start), (np.cumsum(start) - 1).astype(np.int32)
        lasts = np.append(firsts[1:], n) - 1
        back = np.argsort(r, kind="stable")
        return cls(bins[back], r[back], f[firsts], v[firsts], v[lasts]) if n else cls(bins, r, f, v, v)

    @classmethod
    def of_row(cls, r) -> Features:
        kinds = (np.int32, np.int32, np.int32, float, float)
        return cls(*(np.frombuffer(r[c], k) for c, k in zip(("bin", "row", "feature", "least", "most"), kinds)))

    def as_row(self, group: int) -> pa.RecordBatch:
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (self.bin, self.row.astype(np.int32), self.feature, self.least, self.most)]
        return pa.record_batch([pa.array([group], pa.int32()), *blobs], names=["group", "bin", "row", "feature", "least", "most"])

    def splits(self, node: np.ndarray, stats: np.ndarray, totals: np.ndarray, rule: Rule) -> list[tuple]:
        """Node, gain and bin of the best cut of each node that has one.

        ``node`` has the rows' node (-1: none), ``stats`` a row per statistic, ``totals`` the nodes' sums
        (statistics, rows).
        """
        width, found = len(self.feature), []
        if not width:
            return found
        at_once = max(1, HISTOGRAM // width)
        counted = rule.min_leaf > 1 or rule.min_hessian <= 0
        for lo in range(0, len(totals), at_once):
            whole = totals[lo : lo + at_once]
            first = np.where((node >= lo) & (node < lo + len(whole)), node - np.int64(lo), len(whole)) * width  # of other rows: behind all
            bin, rows, size = self.bin, self.row, len(whole) * width
            place = first.take(rows)
            if len(totals) > at_once:
                some = np.flatnonzero(place < size)
                place, bin, rows = place[some], bin[some], rows[some]
            place += bin
            far, near = [], []
            for i, x in enumerate([*stats, None] if counted else stats):
                own = np.bincount(place, None if x is None else x.take(rows), size)[:size].reshape(len(whole), width)
                sums = np.zeros((len(whole), width + 1))
                np.cumsum(own, axis=1, out=sums[:, 1:])
                side = sums[:, self.end] - sums[:, :-1]
                if not self.positive.all():
                    side = np.where(self.positive, side, sums[:, 1:] - sums[:, self.begin])
                far.append(side)
                near.append(whole[:, i, None] - side)
            gain = rule.worth(far[:2])
            gain += rule.worth(near[:2])
            good = (far[1] >= rule.min_hessian) & (near[1] >= rule.min_hessian)
            if counted:
                good &= (far[2] >= max(1, rule.min_leaf)) & (near[2] >= max(1, rule.min_leaf))
            gain[~good] = -np.inf
            best = gain.argmax(1)
            gains = gain[np.arange(len(whole)), best] - rule.worth(whole.T[:2])
            found += [(lo + int(k), float(gains[k]), int(best[k])) for k in np.flatnonzero(gains > 1e-10)]
        return found

    def right(self, node: np.ndarray, splits: list[tuple], n_nodes: int) -> np.ndarray:
        """Which rows go right by the nodes' cuts."""
        lo, hi = np.zeros(n_nodes + 1, np.int32), np.zeros(n_nodes + 1, np.int32)  # bins far from 0; none of no node
        below = np.zeros(n_nodes + 1, bool)
        for k, _, cut in splits:
            up = self.positive[cut]
            lo[k], hi[k], below[k] = (cut, self.end[cut], False) if up else (self.begin[cut], cut + 1, True)
        far = self.row[(self.bin >= lo[node].take(self.row)) & (self.bin < hi[node].take(self.row))]
        right = below[node]
        right[far] = ~right[far]
        return right


def _cut_columns(starts: dict[int, int], groups: int):
    """Entries by group of features, with the numbers of their rows."""

    def run(batches):
        for batch in batches:
            at, rows = batch["at"].to_numpy(), Sparse.of_lists(*(pa.chunked_array([batch[c]]) for c in ("idx", "val")))
            number = (at & _IN_PART) + np.array([starts[x] for x in (at >> 33).tolist()], np.int64)
            to = rows.idx % groups
            order = np.argsort(to, kind="stable")
            for g, own in zip(*_runs(to[order], order)):
                blobs = [pa.array([x[own].astype(k).tobytes()], pa.binary()) for x, k in ((rows.idx, np.int32), (rows.val, float), (number[rows.row], np.int32))]
                yield pa.record_batch([pa.array([g], pa.int32()), *blobs], names=["group", "f", "v", "r"])

    return run


_IN_PART = (1 << 33) - 1


def _runs(sorted_: np.ndarray, what: np.ndarray) -> tuple[list, list]:
    """The different numbers of a sorted array, and their parts of another."""
    firsts = np.flatnonzero(np.concatenate((np.ones(min(1, len(sorted_)), bool), sorted_[1:] != sorted_[:-1])))
    return sorted_[firsts].tolist(), np.split(what, firsts[1:]) if len(firsts) else []


def _bin_columns(batches):
    parts: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            own = (np.frombuffer(r[c], k) for c, k in (("f", np.int32), ("v", float), ("r", np.int32)))
            parts.setdefault(r["group"], []).append(tuple(own))
    for g, own in parts.items():
        yield Features.of_entries(*(np.concatenate(x) for x in zip(*own))).as_row(g)


def _column_splits(rule: Rule, stats, open_):
    """Best splits of the open nodes of all classes by a task's columns, and the rows that go right."""

    def run(parts):
        for part in parts:
            own = Features.of_row(part)
            for c, (node, totals) in enumerate(open_.value):
                splits = own.splits(node, stats.value[c], totals, rule) if len(totals) else []
                if splits:
                    told = [(k, gain, int(own.feature[cut]), float(own.threshold[cut])) for k, gain, cut in splits]
                    yield c, told, np.packbits(own.right(node, splits, len(totals))).tobytes()

    return run


def _boost_by_columns(rows: DataFrame, job: Job, counts: np.ndarray, numbers: int) -> list[Tree]:
    """A large boosted model, level by level, split between quantile bins. A task has some features of all rows.

    Rows have many features, so what tasks would have to add up per node and number is far more than what they
    tell each other here: the best splits, and a bit per row and class for the side it goes to. Rows' labels,
    margins and nodes are kept on the driver, for ``COLUMN_CELLS`` rows x classes at most.
    """
    context = rows.sparkSession.sparkContext
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(_IN_PART)
    sizes = {r.part: r.n for r in rows.groupBy(part).agg((F.max(place) + 1).alias("n")).collect()}
    starts, n = {}, 0
    for x in sorted(sizes):
        starts[x], n = n, n + sizes[x]
    groups = max(1, min(context.defaultParallelism, numbers // (COLUMN_NUMBERS >> 4)), -(-numbers // COLUMN_NUMBERS))
    kind = "group int, f binary, v binary, r binary"
    cut = rows.select("at", "idx", "val").mapInArrow(_cut_columns(starts, groups), kind).repartitionById(groups, "group")
    columns = materialize(cut.mapInArrow(_bin_columns, Features.KIND), "tree-columns")
    columns = columns.rdd.map(Row.asDict).persist(StorageLevel.MEMORY_AND_DISK)  # of a file: what an executor loses is read again
    facts = rows.select("at", "label", "weight").toArrow()
    at = facts["at"].to_numpy()
    own = (at & _IN_PART) + np.array([starts[x] for x in (at >> 33).tolist()], np.int64)
    label, weight = np.zeros(n), np.zeros(n)
    label[own], weight[own] = facts["label"].to_numpy(), facts["weight"].to_numpy()
    margins, rule, out = np.tile(start(counts, job), (n, 1)), job.rule, []
    for _ in range(job.trees):
        stats = np.stack(gradients(margins, label, weight, job.curvature)).transpose(2, 0, 1).copy()  # class, statistic, row
        sent, trees = context.broadcast(stats), [Tree() for _ in range(job.outputs)]
        where = np.zeros((job.outputs, n), np.int32)
        fresh = [[t.add(np.zeros(1))] for t in trees]
        depth = 0
        while any(fresh):
            open_ = []
            for c, tree in enumerate(trees):
                sums = np.stack([np.bincount(where[c], x, len(tree.feature)) for x in (*stats[c], None)], 1)
                for node in fresh[c]:
                    tree.value[node] = rule.leaf(sums[node, :2])
                deep = rule.max_depth is not None and depth >= rule.max_depth
                fresh[c] = [x for x in fresh[c] if not deep and sums[x, 2] >= max(rule.min_split, 2 * rule.min_leaf)]
                number = np.full(len(tree.feature), -1, np.int16 if len(fresh[c]) < 1 << 15 else np.int32)
                number[fresh[c]] = np.arange(len(fresh[c]))
                open_.append((number[where[c]], sums[fresh[c]]))
            if not any(fresh):
                break
            asked = context.broadcast(open_)
            heard = columns.mapPartitions(_column_splits(rule, sent, asked)).collect()
            asked.destroy()
            fresh, depth = [_split_level(t, fresh[c], open_[c][0], where[c], [h[1:] for h in heard if h[0] == c]) for c, t in enumerate(trees)], depth + 1
        sent.destroy()
        for c, tree in enumerate(trees):
            margins[:, c] += job.rate * tree.values()[where[c], 0]
            out.append(tree.packed())
    columns.unpersist()
    return out


def _split_level(tree: Tree, nodes: list[int], number: np.ndarray, where: np.ndarray, heard: list) -> list[int]:
    """Splits nodes by the best that any task found, moves their rows, and returns the children."""
    best: dict[int, tuple] = {}
    for task, (splits, _) in enumerate(heard):
        for k, gain, feature, threshold in splits:
            best[k] = min(best.get(k, (math.inf,)), (-gain, feature, threshold, task))
    child = np.full((2, len(nodes) + 1), -1, np.int32)  # the last for rows of no open node
    won = np.full(len(nodes) + 1, -1)
    for k, (_, feature, threshold, task) in sorted(best.items()):
        value = tree.value[nodes[k]]
        child[:, k] = tree.add(value), tree.add(value)
        tree.split(nodes[k], feature, threshold, *child[:, k].tolist())
        won[k] = task
    right = np.zeros(len(where), np.int8)
    for task, (_, bits) in enumerate(heard):
        if (won == task).any():
            right |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(where)).view(np.int8) & (won[number] == task)
    to = child[right, number]
    np.copyto(where, to, where=to >= 0)
    return child[:, :-1][child[:, :-1] >= 0].tolist()


def _entries(features: str, df: DataFrame) -> tuple[Column, Column]:
    if isinstance(df.schema[features].dataType, VectorUDT):
        parts = F.unwrap_udt(F.col(features))
        whole = F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1))
        return F.coalesce(parts["indices"], whole, F.array().cast("array<int>")), parts["values"]
    values = F.col(features).cast("array<double>")
    return F.coalesce(F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)), F.array().cast("array<int>")), values


def _size(features: str, df: DataFrame) -> Column:
    if isinstance(df.schema[features].dataType, VectorUDT):
        parts = F.unwrap_udt(F.col(features))
        return F.coalesce(parts["size"], F.size(parts["values"]))
    return F.size(features)


def fit_trees(jobs: list[Job], key: str = "key") -> list[TreeModel]:
    """Fits all jobs; those whose rows fit in a task share one shuffle."""
    spark = jobs[0].rows.sparkSession
    whole, widths = None, []
    for i, job in enumerate(jobs):
        idx, val = _entries("features", job.rows)
        part = job.rows.select(
            F.lit(i).alias("job"), F.xxhash64(key).alias("hash"), F.col("label").cast("double").alias("label"),
            F.col("weight").cast("double").alias("weight"), idx.alias("idx"), val.alias("val"), _size("features", job.rows).alias("width"),
        )
        whole = part if whole is None else whole.unionByName(part)
    whole = materialize(whole.withColumn("at", F.monotonically_increasing_id()), "tree-rows")
    facts = {
        (r.job, int(r.label)): r
        for r in whole.groupBy("job", "label").agg(
            F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"), F.sum(F.size("val").cast("long")).alias("numbers"), F.max("width").alias("width")
        ).collect()
    }
    ready, small, alone = [], [], []
    for i, job in enumerate(jobs):
        own = [f for (j, _), f in facts.items() if j == i]
        n, numbers, width = sum(f.n for f in own), sum(f.numbers for f in own), max((f.width for f in own), default=0)
        rule = job.rule
        if rule.features is not None:
            rule = replace(rule, features=max(1, int(math.sqrt(width))), width=width)
        ready.append(replace(job, rule=rule))
        widths.append((n, numbers))
        if n <= LOCAL_ROWS and numbers <= LOCAL_NUMBERS:
            small.append(i)
        elif job.kind == "random_forest" and n <= TABLE_ROWS and numbers <= TABLE_NUMBERS:
            alone.append(i)
    trees: list[list[Tree] | DataFrame] = [[] for _ in jobs]
    if small:
        units = _units(ready, small, TREES_PER_TASK)
        of = {i: [u for u, unit in enumerate(units) if unit.job == i] for i in small}
        of = F.array(*(F.array(*(F.lit(u) for u in of.get(i, []))).cast("array<int>") for i in range(len(jobs))))
        rows = whole.where(F.col("job").isin(small)).withColumn("unit", F.explode(F.get(of, F.col("job"))))
        rows = rows.select(*_UNIT_ROWS).repartitionById(max(1, len(units)), "unit")  # a task each, however their keys hash
        made = materialize(rows.mapInArrow(_grown_units(ready, units), TREE), "trees")
        for i in small:
            trees[i] = made.where(F.col("job") == i)
    if alone:
        slots = spark.sparkContext.defaultParallelism
        per_task = min(2 * TREES_PER_TASK, max(5, math.ceil(sum(ready[i].trees for i in alone) / slots)))
        blocks = whole.where(F.col("job").isin(alone)).select("job", "hash", "label", "weight", "idx", "val")
        blocks = materialize(blocks.mapInArrow(_packed_rows, _BLOCK), "tree-blocks")
        units = _units(ready, alone, per_task)
        of = lambda job, u: blocks.where(F.col("job") == job).select(F.lit(u).alias("unit"), *_BLOCK_NAMES)
        parts = of(-1, -1)  # has no rows and several partitions: a union of single partitions only would be one task
        for u, unit in enumerate(units):  # every task reads the job's rows, nothing is shuffled or copied
            parts = parts.union(of(unit.job, u).coalesce(1))
        made = materialize(parts.mapInArrow(_grown_units(ready, units, packed=True), TREE), "trees")
        for i in alone:
            trees[i] = made.where(F.col("job") == i)
    for i, job in enumerate(ready):
        if i not in small and i not in alone:
            n, numbers = widths[i]
            local = max(1, min(LOCAL_ROWS, LOCAL_NUMBERS * n // max(1, numbers)))
            counts = np.array([facts[i, c].weight if (i, c) in facts else 0.0 for c in range(job.n_classes)])
            rows = whole.where(F.col("job") == i).drop("job", "width")
            if job.kind == "boosted_trees" and job.rule.leaves is None and n * job.outputs <= COLUMN_CELLS:
                trees[i] = _boost_by_columns(rows, replace(job, rows=None), counts, numbers)
            else:
                trees[i] = [t.packed() for t in _large_job(rows.drop("at"), job, counts, local)]
    out = []
    for i, job in enumerate(ready):
        counts = np.array([facts[i, c].weight if (i, c) in facts else 0.0 for c in range(job.n_classes)])
        begin = start(counts, job).tolist() if job.kind == "boosted_trees" else []
        out.append(TreeModel(trees[i], job.kind, job.n_classes, job.rate, begin))
    return out


class TreeModel:
    """A forest's or a boosted model's trees. ``score`` adds ``probability`` and ``prediction``."""

    def __init__(self, trees: list[Tree] | DataFrame, kind: str, n_classes: int, rate: float, begin: list[float]):
        self._trees, self.kind, self.n_classes, self.rate, self.begin = trees, kind, n_classes, rate, begin

    @property
    def trees(self) -> list[Tree]:
        """Read anew from their table, so that the driver holds one model's trees at a time."""
        if isinstance(self._trees, list):
            return self._trees
        return _trees_of(self._trees, self.n_classes if self.kind == "random_forest" else 1)

    def held(self) -> TreeModel:
        return TreeModel(self.trees, self.kind, self.n_classes, self.rate, self.begin)

    def probabilities(self, rows: Sparse) -> np.ndarray:
        trees = self.trees
        used = np.unique(np.concatenate([np.empty(0, np.int64), *(t.used() for t in trees)]))
        dense = rows.dense(used)
        if self.kind == "random_forest":
            total = np.zeros((rows.n, self.n_classes))
            for tree in trees:
                total += tree.values()[tree.leaves_in(used, dense)]
            return total / max(1, len(trees))
        margins = np.tile(np.array(self.begin), (rows.n, 1))
        for i, tree in enumerate(trees):
            margins[:, i % len(self.begin)] += self.rate * tree.values()[tree.leaves_in(used, dense), 0]
        return shares(margins)

    def score(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(self.held())

        def probability(idx: pa.Array, val: pa.Array) -> pa.Array:
            i, v = idx.to_pandas().tolist(), val.to_pandas().tolist()
            parts = [sent.value.probabilities(Sparse(i[lo : lo + SCORE_ROWS], v[lo : lo + SCORE_ROWS])) for lo in range(0, len(v), SCORE_ROWS)]
            return pa.array([x for p in parts for x in p.tolist()], pa.list_(pa.float64()))

        idx, val = _entries("features", df)
        scored = df.withColumn("probability", F.arrow_udf(probability, "array<double>")(idx, val))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        trees = self._trees
        if isinstance(trees, list):
            trees = spark.createDataFrame(_as_rows(0, [*range(len(trees))], trees), TREE)
        trees.withColumn("job", F.lit(0)).write.mode("overwrite").parquet(f"{path}/trees")

    def note(self) -> dict:
        return {"kind": self.kind, "n_classes": self.n_classes, "rate": self.rate, "begin": self.begin}

    @classmethod
    def load(cls, spark: SparkSession, path: str, note: dict) -> TreeModel:
        return cls(spark.read.schema(TREE).parquet(f"{path}/trees"), note["kind"], note["n_classes"], note["rate"], note["begin"])
