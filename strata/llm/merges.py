"""Merge-order (BPE) segmentation as a forward pass over prefixes.

A segmentation is the one that merging yields exactly when every adjacent pair
of pieces is one that merging would leave apart.  So each prefix of a word has
one last piece, it follows from the last pieces of shorter prefixes, and a
forward pass (as in Viterbi's algorithm, with this test in place of a sum of
scores) finds it without looking at what comes behind.
"""

from __future__ import annotations

import heapq

NEVER = 1 << 60
MOST_PAIRS = 200_000  # answers remembered


def merge_all(symbols: list[str], rank) -> list[str]:
    """Reference merging: again and again the adjacent pair of least rank, the
    leftmost of equals.  ``rank(a, b)`` is None where a pair does not merge."""
    parts: list[str | None] = list(symbols)
    nxt = [*range(1, len(parts)), -1]
    prv = [*range(-1, len(parts) - 1)]
    heap = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j >= 0 and (r := rank(parts[i], parts[j])) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if parts[i] != a or j < 0 or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [p for p in parts if p is not None]


class MergeTable:
    """The merges ``(a, b) -> rank`` of a vocabulary, each piece having one
    last merge; pieces are numbered by rank, single symbols by need."""

    def __init__(self, merges: dict[tuple[str, str], int]):
        self.rank = merges
        self.last: dict[str, tuple[str, str]] = {}
        for (a, b), r in merges.items():
            self.last[a + b] = (a, b)
        self.order = {a + b: r for (a, b), r in merges.items()}
        self.known: dict[tuple[str, str], bool] = {}

    def apart(self, a: str, b: str) -> bool:
        """Whether merging the symbols of ``a + b`` ends in ``[a, b]``.

        Goes back through the merges on either side of the border, latest
        first; a pair across the border that would have merged earlier than
        the merge undone last shows that the border would not have held.
        """
        key = (a, b)
        out = self.known.get(key)
        if out is None:
            if len(self.known) >= MOST_PAIRS:
                self.known.clear()
            out = self.known[key] = self._apart(a, b)
        return out

    def _apart(self, a: str, b: str) -> bool:
        rank, last, order = self.rank.get, self.last, self.order
        limit = (NEVER, 0)  # the time of the merge undone last; on its left side or right
        while True:
            r = rank((a, b))
            # equal ranks merge from the left: a left part's own merge comes before the
            # border pair, a right part's own merge behind it
            if r is not None and (r, 1) < limit:
                return False
            ra, rb = order.get(a, -1), order.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb or (ra == rb and rb < 0):
                limit, a = (ra, 0), last[a][1]
            else:
                limit, b = (rb, 2), last[b][0]
