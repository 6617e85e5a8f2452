"""Tree models on binned features, each grown by one task on all training rows; tasks share out trees, folds and feature sets.

Features become the numbers of at most 256 bins: where a column has no more values
than that, splits are those of the values themselves. Training rows are read in
pieces, and rows with the same bins and class become one cell. A task holds the
cells of one feature set, a byte per column, and the cell of every row (4 bytes),
from which the rows of a bootstrap are drawn; no row is left out.

Forests of a task grow together, level by level, as many trees at a time as have
``TOGETHER`` cells: (tree, cell) pairs carry the node they are in, class weights per
node and bin come from one count or sort, and all nodes of a level choose their
splits at once, a part of them at a time where they hold many cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

BINS = 256
#: Cells of the trees that grow together at most, unless a single tree has more.
TOGETHER = 1_000_000
#: Class weights that are held at once while a level chooses its splits.
WEIGHTS = 4_000_000
#: Bootstrap draws made at once.
DRAWN = 1 << 20

Pieces = Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]]


class Distinct:
    """Distinct values in order and how often they came; they are merged once as many are held as were merged before."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.merged = 0, DRAWN

    def add(self, values: np.ndarray) -> None:
        self.held.append(np.unique(values, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size > 2 * self.merged:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held) > 1:
            values, place = np.unique(np.concatenate([v for v, _ in self.held]), return_inverse=True)
            # whole numbers below 2 ** 53, so sums of doubles are exact
            counts = np.bincount(place, np.concatenate([c for _, c in self.held]), len(values)).astype(np.int64)
            self.held, self.size, self.merged = [(values, counts)], len(values), max(DRAWN, len(values))
        return self.held[0] if self.held else (np.empty(0), np.empty(0, np.int64))


def bin_edges(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Borders between the bins of a column with these values: halfway between values, or at quantiles of its rows."""
    if len(values) > BINS:
        if np.isnan(values[-1]):
            values = values[-1:]
        else:
            wanted = np.rint((counts.sum() - 1) * np.linspace(0, 1, BINS)).astype(np.int64)
            values = np.unique(values[np.searchsorted(counts.cumsum(), wanted, side="right")])
    return (values[1:] + values[:-1]) / 2.0


class Cells(NamedTuple):
    """Training rows by bins and class."""

    columns: tuple[int, ...]
    edges: list[np.ndarray]
    classes: np.ndarray
    #: bins and class of each cell
    codes: np.ndarray
    y: np.ndarray
    #: cell of each row
    place: np.ndarray

    def copies(self) -> np.ndarray:
        return np.bincount(self.place, minlength=len(self.y))

    def drawn(self, draw: np.random.Generator) -> np.ndarray:
        """How often each cell comes in as many draws with replacement as there are rows."""
        n, found, most = len(self.place), np.zeros(len(self.y), np.int64), max(DRAWN, len(self.y))
        for first in range(0, n, most):
            found += np.bincount(self.place[draw.integers(0, n, min(most, n - first))], minlength=len(self.y))
        return found


def gather(pieces: Pieces, columns: tuple[int, ...]) -> Cells:
    """Cells of all rows (features, labels); the pieces are read three times: for the bins, the cells, and the cell of each row."""
    values, labels, keys = [Distinct() for _ in columns], Distinct(), Distinct()
    for x, label in pieces():
        labels.add(label)
        for c, distinct in zip(columns, values, strict=True):
            distinct.add(x[:, c])
    edges = [bin_edges(*distinct.merge()) for distinct in values]
    classes, many = labels.merge()
    sizes = [len(e) + 1 for e in edges]

    def packed() -> Iterator[np.ndarray]:
        for x, label in pieces():
            yield _pack(to_bins(x[:, list(columns)], edges), np.searchsorted(classes, label), sizes, len(classes))

    for key in packed():
        keys.add(key)
    cells, _ = keys.merge()
    place, first = np.empty(int(many.sum()), np.int32 if len(cells) < 2**31 else np.int64), 0
    for key in packed():
        place[first : first + len(key)] = np.searchsorted(cells, key)
        first += len(key)
    return Cells(columns, edges, classes, *_unpack(cells, sizes, len(classes)), place)


def _pack(codes: np.ndarray, y: np.ndarray, sizes: list[int], k: int) -> np.ndarray:
    """One key for each row: a number if all fit one, else its bytes."""
    if np.prod([float(size) for size in [*sizes, k]]) < 2.0**62:
        key = np.zeros(len(y), np.int64)
        for j, size in enumerate(sizes):
            key = key * size + codes[:, j]
        return key * k + y
    parts = np.hstack([codes.astype(np.uint8), y.astype(">u4")[:, None].view(np.uint8)])
    return np.ascontiguousarray(parts).view(f"S{parts.shape[1]}").ravel()


def _unpack(keys: np.ndarray, sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    if keys.dtype.kind == "S":
        parts = keys.view(np.uint8).reshape(len(keys), -1)
        return np.ascontiguousarray(parts[:, :-4]), np.ascontiguousarray(parts[:, -4:]).view(">u4").ravel().astype(np.int64)
    rest, y = np.divmod(keys.astype(np.int64), max(k, 1))
    codes = np.zeros((len(keys), len(sizes)), np.uint8)
    for j in range(len(sizes) - 1, -1, -1):
        rest, codes[:, j] = np.divmod(rest, sizes[j])
    return codes, y


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)


@dataclass
class Forest:
    """Nodes of many trees: the first ones are the roots; children of a node are ``left`` and ``left + 1``.

    Leaves keep the classes they have, and their shares, one after the other: ``ends`` says up to where.
    """

    columns: tuple[int, ...]
    edges: list[np.ndarray]
    classes: np.ndarray
    roots: int
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    ends: np.ndarray
    of: np.ndarray
    share: np.ndarray

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Class shares of the leaves, summed over trees."""
        codes = to_bins(x[:, list(self.columns)], self.edges)
        total = np.zeros((len(x), len(self.classes)))
        row = np.arange(len(x))
        for root in range(self.roots):
            node = np.full(len(x), root)
            inner = self.left[node] > 0
            while inner.any():
                here = node[inner]
                node[inner] = self.left[here] + (codes[row[inner], self.feature[here]] > self.bin[here])
                inner = self.left[node] > 0
            ends = self.ends[node]
            many = ends - np.where(node > 0, self.ends[node - 1], 0)
            at = np.repeat(ends - many.cumsum(), many) + np.arange(many.sum())
            total[np.repeat(row, many), self.of[at]] += self.share[at]
        return total


class Voting(NamedTuple):
    """Several forests as one."""

    forests: list[Forest]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.forests[0].classes[sum(f.votes(x) for f in self.forests).argmax(axis=1)]


def grow_forest(x: np.ndarray, label: np.ndarray, columns: tuple[int, ...], trees: range, seed: int, max_depth: int, bootstrap: bool) -> Forest:
    """``grow`` on rows that are at hand."""
    return grow(gather(lambda: [(x, label)], columns), trees, seed, max_depth, bootstrap)


def together(cells: Cells, trees: range) -> list[range]:
    """The trees in runs that grow together."""
    most = max(1, TOGETHER // max(len(cells.y), 1))
    return [trees[a : a + most] for a in range(0, len(trees), most)]


def grow(cells: Cells, trees: range, seed: int, max_depth: int, bootstrap: bool) -> Forest:
    """Gini trees; with ``bootstrap`` each on a draw of its own with sqrt(columns) choices per split, else on all rows and columns."""
    codes, y, classes = cells.codes, cells.y, cells.classes
    d = codes.shape[1]
    k = len(classes)
    tries = max(1, int(np.sqrt(d))) if bootstrap else d
    draws = [np.random.default_rng([seed, t]) for t in trees]
    weights = [cells.drawn(g) if bootstrap else cells.copies() for g in draws]
    row = np.concatenate([np.flatnonzero(w) for w in weights])
    weight = np.concatenate([w[w > 0] for w in weights]).astype(np.float64)
    node = np.repeat(np.arange(len(draws)), [np.count_nonzero(w) for w in weights])
    del weights
    tree, ids = np.arange(len(draws)), np.arange(len(draws))
    feature, cut, left, many, of, share = [], [], [], [], [], []
    made = len(draws)
    for depth in range(max_depth + 1):
        counts = np.bincount(node * k + y[row], weight, len(ids) * k).reshape(len(ids), k)
        split_feature, split_bin = np.zeros(len(ids), np.int16), np.full(len(ids), -1, np.int16)
        open_ = (counts > 0).sum(axis=1) > 1
        if depth < max_depth and open_.any():
            keep = open_[node]
            number = np.cumsum(open_) - 1
            row, weight, node = row[keep], weight[keep], number[node[keep]]
            chances = np.concatenate([draws[t].random((c, d)) for t, c in zip(*np.unique(tree[open_], return_counts=True), strict=True)])
            split_feature[open_], split_bin[open_] = _best_splits(codes, y, k, row, weight, node, counts[open_], chances.argsort(axis=1), tries)
        splits = split_bin >= 0
        child = np.zeros(len(ids), np.int64)
        child[splits] = made + 2 * np.arange(splits.sum())
        feature.append(split_feature)
        cut.append(split_bin)
        left.append(child)
        counts[splits] = 0.0
        at, which = np.nonzero(counts)
        many.append(np.bincount(at, minlength=len(ids)))
        of.append(which.astype(np.int16 if k < 2**15 else np.int64))
        share.append(counts[at, which] / counts.sum(axis=1)[at])
        if not splits.any():
            break
        made += 2 * int(splits.sum())
        whose = np.flatnonzero(open_)[node]
        keep = splits[whose]
        row, weight, whose = row[keep], weight[keep], whose[keep]
        place = np.cumsum(splits) - 1
        node = 2 * place[whose] + (codes[row, split_feature[whose]] > split_bin[whose])
        tree, ids = np.repeat(tree[splits], 2), np.arange(2 * int(splits.sum()))
    narrow = np.int32 if made < 2**31 // max(k, 1) else np.int64
    ends = np.concatenate(many).cumsum().astype(narrow)
    return Forest(cells.columns, cells.edges, classes, len(draws), np.concatenate(feature), np.concatenate(cut), np.concatenate(left).astype(narrow), ends, np.concatenate(of), np.concatenate(share))


def _best_splits(codes, y, k, row, weight, node, counts, order, tries):
    """Feature and bin of each node's best split among its first ``tries`` features, or the next one that can split it."""
    nodes = len(counts)
    best_feature, best_bin = np.zeros(nodes, np.int64), np.full(nodes, -1)
    # nodes in parts of some WEIGHTS / k cells
    ends = np.bincount(node, minlength=nodes).cumsum()
    part = (ends - 1) // max(1, WEIGHTS // k)
    borders = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for low, high in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        mine = slice(None) if high - low == nodes else (node >= low) & (node < high)
        best_feature[low:high], best_bin[low:high] = _best_of(codes, y, k, row[mine], weight[mine], node[mine] - low, counts[low:high], order[low:high], tries)
    return best_feature, best_bin


def _best_of(codes, y, k, row, weight, node, counts, order, tries):
    nodes, bins = len(counts), int(codes.max()) + 1
    best, best_feature, best_bin = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.full(nodes, -1)
    for j in range(order.shape[1]):
        asks = np.ones(nodes, bool) if j < tries else best_bin < 0
        if not asks.any():
            break
        mine = slice(None) if asks.all() else asks[node]
        at, rows = node[mine], row[mine]
        key = at * bins + codes[rows, order[at, j]]
        if nodes * bins * k <= 16 * len(at):
            weights = np.bincount(key * k + y[rows], weight[mine], nodes * bins * k).reshape(nodes * bins, k)
            group = np.flatnonzero(weights.any(axis=1))
            weights = weights[group]
        else:
            group, inverse = np.unique(key, return_inverse=True)
            weights = np.bincount(inverse * k + y[rows], weight[mine], len(group) * k).reshape(len(group), k)
        owner = group // bins
        below = weights.cumsum(axis=0)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        start = np.repeat(first, np.diff(np.append(first, len(group))))
        below = below - (below[start] - weights[start])
        above = counts[owner] - below
        some = above.sum(axis=1) > 0.5
        score = np.full(len(group), -np.inf)
        score[some] = (below[some] ** 2).sum(axis=1) / below[some].sum(axis=1) + (above[some] ** 2).sum(axis=1) / above[some].sum(axis=1)
        top = np.maximum.reduceat(score, first)
        hit = np.flatnonzero((score == np.repeat(top, np.diff(np.append(first, len(group))))) & some)
        who, where = np.unique(owner[hit], return_index=True)
        hit = hit[where]
        better = score[hit] > best[who]
        who, hit = who[better], hit[better]
        best[who], best_bin[who] = score[hit], group[hit] % bins
        best_feature[who] = order[who, j]
    return best_feature, best_bin


@dataclass
class Boosted:
    """A sum of small trees; node i's children are 2i + 1 and 2i + 2, leaves are listed after all levels."""

    columns: tuple[int, ...]
    edges: list[np.ndarray]
    start: float
    depth: int
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    regression: bool

    def score(self, x: np.ndarray) -> np.ndarray:
        codes = to_bins(x[:, list(self.columns)], self.edges)
        total = np.full(len(x), self.start)
        for feature, cut, leaf in zip(self.feature, self.bin, self.leaf, strict=True):
            total += leaf[_leaf_of(codes, feature, cut, self.depth)]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Rounded half to even, or 1 where 1 is likelier than 0."""
        return np.round(self.score(x)) + 0.0 if self.regression else (self.score(x) > 0).astype(np.float64)


def _leaf_of(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    node = np.zeros(len(codes), np.int64)
    row = np.arange(len(codes))
    for _ in range(depth):
        node = 2 * node + 1 + (codes[row, feature[node]] > cut[node])
    return node - (2**depth - 1)


def boost(x: np.ndarray, label: np.ndarray, columns: tuple[int, ...], rounds: int, depth: int, rate: float, regression: bool) -> Boosted:
    """``boost_cells`` on rows that are at hand."""
    return boost_cells(gather(lambda: [(x, label)], columns), rounds, depth, rate, regression)


def boost_cells(cells: Cells, rounds: int, depth: int, rate: float, regression: bool) -> Boosted:
    """Squared loss on the label, or logistic loss on labels 0 and 1.

    Sums go over rows in their order, so that rounding, which decides between equally good splits, is the same on every run.
    """
    codes, label = cells.codes[cells.place], cells.classes[cells.y][cells.place]
    mean = label.mean() if len(label) else 0.0
    start = mean if regression else float(np.log(max(mean, 1e-12) / max(1.0 - mean, 1e-12)))
    score = np.full(len(label), start)
    features, cuts, leaves = [], [], []
    constant = len(cells.classes) < 2
    for _ in range(0 if constant else rounds):
        chance = score if regression else 1.0 / (1.0 + np.exp(-score))
        rest = label - chance
        bend = np.ones(len(label)) if regression else chance * (1.0 - chance)
        feature, cut = _grow_small(codes, rest, depth)
        at = _leaf_of(codes, feature, cut, depth)
        top, bottom = np.bincount(at, rest, 2**depth), np.bincount(at, bend, 2**depth)
        leaf = rate * np.divide(top, bottom, out=np.zeros(2**depth), where=bottom > 1e-150)
        score = score + leaf[at]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    made, inner = len(features), 2**depth - 1
    return Boosted(cells.columns, cells.edges, start, depth, np.array(features, np.int64).reshape(made, inner), np.array(cuts, np.int64).reshape(made, inner), np.array(leaves).reshape(made, inner + 1), regression)


def _grow_small(codes: np.ndarray, target: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squares tree of few levels; a node without a useful split sends all rows to its first child."""
    feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, BINS)
    node = np.zeros(len(codes), np.int64)
    row = np.arange(len(codes))
    bins = int(codes.max(initial=0)) + 1
    for level in range(depth):
        first, width = 2**level - 1, 2**level
        local = node - first
        sums, counts = np.bincount(local, target, width), np.bincount(local, minlength=width)
        plain = np.divide(sums**2, counts, out=np.zeros(width), where=counts > 0)
        best = plain + 1e-10 * np.maximum(plain, 1e-10)
        for f in range(codes.shape[1]):
            key = local * bins + codes[:, f]
            below = np.bincount(key, target, width * bins).reshape(width, bins).cumsum(axis=1)
            many = np.bincount(key, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
            above, rest = sums[:, None] - below, counts[:, None] - many
            score = np.where((many > 0) & (rest > 0), below**2 / np.maximum(many, 1) + above**2 / np.maximum(rest, 1), -np.inf)
            at = score.argmax(axis=1)
            top = score[np.arange(width), at]
            better = top > best
            best = np.where(better, top, best)
            feature[first : first + width][better] = f
            cut[first : first + width][better] = at[better]
        node = 2 * node + 1 + (codes[row, feature[node]] > cut[node])
    return feature, cut
