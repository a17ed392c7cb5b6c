"""BK-trees over fingerprints by their Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class BKTree:
    """A BK-tree over distinct fingerprints, as one node after the other would be inserted."""

    def __init__(self, prints: np.ndarray, members: np.ndarray | None = None):
        members = np.arange(len(prints)) if members is None else members
        self.prints, self.node, self.children = prints, int(members[0]), {}
        rest = members[1:]
        if len(rest):
            apart = np.bitwise_count(prints[rest] ^ prints[self.node])
            for distance in np.unique(apart).tolist():
                self.children[distance] = BKTree(prints, rest[apart == distance])

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, places of the queries within the radius of it), following edges within the radius only."""
        todo = [(self, np.arange(len(queries)))]
        while todo:
            tree, asked = todo.pop()
            apart = np.bitwise_count(queries[asked] ^ self.prints[tree.node]).astype(np.int64)
            hits = asked[apart <= radius]
            if len(hits):
                yield tree.node, hits
            for distance, child in tree.children.items():
                on = asked[np.abs(apart - distance) <= radius]
                if len(on):
                    todo.append((child, on))
