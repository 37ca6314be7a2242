"""Gradient-boosted trees in numpy: fitted on a bounded sample, scored as flat node arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Forest(NamedTuple):
    """All trees end to end; a leaf points to itself on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row; every tree walks all rows at once, level by level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.scores(x)))


def best_split(
    bins: np.ndarray,
    gradient: np.ndarray,
    curvature: np.ndarray,
    bounds: tuple[float, float],
    signs: np.ndarray,
    bin_count: int,
    penalty: float,
    least: float,
):
    """(gain, feature, bin, left value, right value) of the best allowed split, or None."""
    total_g, total_h = gradient.sum(), curvature.sum()
    whole = total_g**2 / (total_h + penalty)
    best = None
    for f in range(bins.shape[1]):
        g = np.cumsum(np.bincount(bins[:, f], gradient, bin_count))[:-1]
        h = np.cumsum(np.bincount(bins[:, f], curvature, bin_count))[:-1]
        left = np.clip(-g / (h + penalty), *bounds)
        right = np.clip(-(total_g - g) / (total_h - h + penalty), *bounds)
        gain = g**2 / (h + penalty) + (total_g - g) ** 2 / (total_h - h + penalty) - whole
        allowed = (h >= least) & (total_h - h >= least) & ((right - left) * signs[f] >= 0)
        gain = np.where(allowed, gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (gain[k], f, k, float(left[k]), float(right[k]))
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bin_count: int = 64,
    penalty: float = 1.0,
    least: float = 4.0,
) -> Forest:
    """Logistic boosting.  signs: +1 or -1 where the score must rise or fall with a feature.

    A split on a constrained feature is taken only if its sides' values are in order, and both
    subtrees stay on their side of the middle, so the whole score is monotone.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, bin_count) / bin_count)) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    rate_of_ones = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    score = np.full(len(y), base)
    nodes: list[list] = []
    roots = []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        gradient, curvature = p - y, p * (1 - p)
        value = np.clip(-gradient.sum() / (curvature.sum() + penalty), -4, 4)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), len(nodes), value])
        level = [(roots[-1], np.arange(len(y)), (-4.0, 4.0))]
        for _ in range(depth):
            below = []
            for node, rows, bounds in level:
                found = best_split(
                    bins[rows], gradient[rows], curvature[rows], bounds, signs, bin_count, penalty, least
                )
                if found is None or found[2] >= len(cuts[found[1]]):
                    continue
                _, f, k, left, right = found
                middle = (left + right) / 2
                low, high = bounds
                sides = {0: (bounds, bounds), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
                nodes[node][:4] = [f, cuts[f][k], len(nodes), len(nodes) + 1]
                inside = bins[rows, f] <= k
                for own, side, v in ((rows[inside], sides[0], left), (rows[~inside], sides[1], right)):
                    nodes.append([0, np.inf, len(nodes), len(nodes), v])
                    below.append((len(nodes) - 1, own, side))
            level = below
        tree = np.array([[n[4]] for n in nodes[roots[-1] :]])[:, 0] * rate
        for n, v in zip(nodes[roots[-1] :], tree, strict=True):
            n[4] = v
        built = flatten(nodes, [roots[-1]], depth, 0.0)
        score += built.scores(x)
    return flatten(nodes, roots, depth, base)


def flatten(nodes: list[list], roots: list[int], depth: int, base: float) -> Forest:
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Forest(
        feature.astype(np.int64),
        threshold.astype(float),
        left.astype(np.int64),
        right.astype(np.int64),
        value.astype(float),
        np.array(roots, np.int64),
        depth,
        base,
    )
