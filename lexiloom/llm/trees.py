"""Gradient-boosted trees on a small matrix, flattened into node arrays.

Trees are grown level by level on binned features with the logistic loss.
Features may be constrained: +1, the score may only rise with the feature; -1,
only fall. A split that breaks its feature's sign is not taken, and below a
split on a constrained feature the values of either side stay on their side of
the midpoint, so the whole tree is monotonic.

Scoring walks all rows through a tree at once: one array lookup for each level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees end to end. A leaf points to itself, so that every row takes ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, least_rows: int = 10, smooth: float = 1.0) -> Forest | None:
    """A forest for labels 0 and 1, or None where one of them is absent."""
    if len(np.unique(y)) < 2:
        return None
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], 1)
    share = y.mean()
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(v: float) -> int:
        n = len(feature)
        for column, item in zip((feature, threshold, left, right, value), (0, 0.0, n, n, v)):
            column.append(item)
        return n

    def best(rows: np.ndarray, low: float, high: float):
        """(gain, feature, bin, left value, right value) of the best allowed split."""
        g, h, top = gradient[rows], hessian[rows], None
        g_all, h_all = g.sum(), h.sum()
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            b = binned[rows, f]
            size = len(edges) + 1
            gl, hl, nl = (np.bincount(b, w, size).cumsum()[:-1] for w in (g, h, None))
            gr, hr, nr = g_all - gl, h_all - hl, len(rows) - nl
            vl, vr = (np.clip(-a / (c + smooth), low, high) for a, c in ((gl, hl), (gr, hr)))
            # The gain of the values as they are clipped.
            gain = -(gl * vl + (hl + smooth) * vl**2 / 2) - (gr * vr + (hr + smooth) * vr**2 / 2)
            gain[(nl < least_rows) | (nr < least_rows) | ((vr - vl) * signs[f] < 0)] = -np.inf
            k = int(gain.argmax())
            if top is None or gain[k] > top[0]:
                top = (gain[k], f, k, vl[k], vr[k])
        own = np.clip(-g_all / (h_all + smooth), low, high)
        floor = -(g_all * own + (h_all + smooth) * own**2 / 2)
        return top if top and top[0] > floor + 1e-9 else None

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        gradient, hessian = chance - y, chance * (1 - chance)
        roots.append(add(0.0))
        open_nodes = [(roots[-1], np.arange(len(y)), -np.inf, np.inf)]
        for _ in range(depth):
            deeper = []
            for node, rows, low, high in open_nodes:
                split = best(rows, low, high) if len(rows) >= 2 * least_rows else None
                if split is None:
                    continue
                _, f, k, vl, vr = split
                feature[node], threshold[node] = f, float(cuts[f][k])
                left[node], right[node] = add(rate * vl), add(rate * vr)
                goes, middle = binned[rows, f] <= k, (vl + vr) / 2
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(
                    int(signs[f]), ((low, high), (low, high)))
                deeper += [(left[node], rows[goes], *bounds[0]), (right[node], rows[~goes], *bounds[1])]
            open_nodes = deeper
        made = Forest(*map(np.array, (feature, threshold, left, right, value)), np.array(roots[-1:]), depth, 0.0)
        margin = margin + made.margin(x)
    return Forest(*map(np.array, (feature, threshold, left, right, value)), np.array(roots), depth, start)
