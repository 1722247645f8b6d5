"""Forests of BK-trees over 64-bit fingerprints, built and searched in whole numpy levels.

A node's children are keyed by their Hamming distance to it. For a query at distance d from a
node, only children on edges d - r to d + r can lead to fingerprints within r.
"""

from __future__ import annotations

import numpy as np

EDGE = 65  # distances are 0 to 64
#: (query, node) pairs that are looked at together: bounds the memory of a search.
FRONTIER = 1 << 20


class Forest:
    """One tree for each tree id; fingerprints within a tree are distinct."""

    def __init__(self, tree: np.ndarray, fingerprint: np.ndarray):
        """``tree``: ascending ids 0..n-1; ``fingerprint``: uint64, in the same order."""
        self.fingerprint = fingerprint
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else tree
        parent = self.roots[tree] if len(tree) else tree
        left = np.setdiff1d(np.arange(len(tree)), self.roots, assume_unique=True)
        edges, nodes = [], []
        while len(left):
            distance = np.bitwise_count(fingerprint[left] ^ fingerprint[parent[left]])
            edge = parent[left] * EDGE + distance
            found, first, of = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(found)
            nodes.append(left[first])
            parent[left] = left[first][of]
            left = np.delete(left, first)
        edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
        order = np.argsort(edge, kind="stable")
        self.edges = edge[order]
        self.children = np.concatenate(nodes)[order] if nodes else np.empty(0, np.int64)

    def search(self, tree: np.ndarray, query: np.ndarray, radius: int):
        """Yield arrays (query number, node) of the pairs within ``radius``."""
        todo = [(np.arange(len(query)), self.roots[tree])] if len(query) else []
        while todo:
            of, node = todo.pop()
            if len(of) > FRONTIER:
                half = len(of) // 2
                todo += [(of[half:], node[half:]), (of[:half], node[:half])]
                continue
            distance = np.bitwise_count(query[of] ^ self.fingerprint[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield of[near], node[near]
            low = np.searchsorted(self.edges, node * EDGE + np.maximum(distance - radius, 0))
            high = np.searchsorted(
                self.edges, node * EDGE + np.minimum(distance + radius, EDGE - 1), "right"
            )
            for of, node in self._follow(of, low, high - low):
                todo.append((of, node))

    def _follow(self, of, low, count):
        """The children on the edges ``low`` to ``low + count``, in parts of bounded size."""
        live = count > 0
        of, low, count = of[live], low[live], count[live]
        ends = np.cumsum(count)
        start = 0
        while start < len(of):
            base = ends[start] - count[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + FRONTIER, "right")))
            n = count[start:stop]
            step = np.arange(ends[stop - 1] - base) - np.repeat(ends[start:stop] - n - base, n)
            yield np.repeat(of[start:stop], n), self.children[np.repeat(low[start:stop], n) + step]
            start = stop


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the components of the links a - b.

    At most one link per node, however many links tie a group together.
    """
    names, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[: len(a)], number[len(a) :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(names))
    return names[far], names[label[far]]
