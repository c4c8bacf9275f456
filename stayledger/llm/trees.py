"""Small regression and decision trees on the driver, for tables with a documented bound on their rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    """A leaf has ``feature`` -1; rows with ``value <= cut`` go left."""

    value: float
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int, bins: int = 32) -> Node:
    """Least-squares tree; on 0/1 targets the same splits as by Gini impurity."""
    node = Node(float(y.mean()))
    if depth == 0 or len(y) < 2 * least or np.ptp(y) == 0:
        return node
    best = (1e-12, -1, 0.0)
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        cuts = cuts[cuts < x[:, j].max()]
        if not len(cuts):
            continue
        place = np.searchsorted(cuts, x[:, j], side="left")
        n = np.cumsum(np.bincount(place, minlength=len(cuts) + 1))[:-1]
        s = np.cumsum(np.bincount(place, weights=y, minlength=len(cuts) + 1))[:-1]
        ok = (n >= least) & (len(y) - n >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, s**2 / n + (y.sum() - s) ** 2 / (len(y) - n) - y.sum() ** 2 / len(y), 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), j, float(cuts[k]))
    if best[1] < 0:
        return node
    go = x[:, best[1]] <= best[2]
    node.feature, node.cut = best[1], best[2]
    node.left = grow(x[go], y[go], depth - 1, least, bins)
    node.right = grow(x[~go], y[~go], depth - 1, least, bins)
    return node


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    go = x[:, node.feature] <= node.cut
    out = np.empty(len(x))
    out[go], out[~go] = predict(node.left, x[go]), predict(node.right, x[~go])
    return out


def decide(node: Node, row: list[float]) -> float:
    while node.feature >= 0:
        node = node.left if row[node.feature] <= node.cut else node.right
    return node.value


def paths(node: Node, so_far: tuple = ()) -> list[tuple]:
    """Conjunctions of all nodes below the root: tuples of (feature, is_at_most, cut)."""
    if node.feature < 0:
        return [so_far] if so_far else []
    own = [so_far] if so_far else []
    left = paths(node.left, (*so_far, (node.feature, True, node.cut)))
    return own + left + paths(node.right, (*so_far, (node.feature, False, node.cut)))
