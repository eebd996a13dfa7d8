"""Byte-pair merging with a heap over linked symbols."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from typing import Any


SHIFT = 32  # of the left id in a pair's key


def merged(ids: Sequence[int], rank: Callable[[int, int], int], made: Sequence[int]) -> list[int]:
    """`ids` after all merges: lowest rank first, then leftmost, in n log n steps.

    rank(left << SHIFT | right, -1) gives a pair's rank or -1, made[rank] the id that it becomes.
    """
    n = len(ids)
    ids = list(ids)
    own = [rank(a << SHIFT | b, -1) for a, b in zip(ids, ids[1:])]  # the rank of the pair that begins here  # noqa: B905
    heap = [r << 32 | i for i, r in enumerate(own) if r >= 0]
    if not heap:
        return ids
    heapq.heapify(heap)
    own.append(-1)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        top = pop(heap)
        i, r = top & 0xFFFFFFFF, top >> 32
        if own[i] != r:
            continue
        j = right[i]
        ids[i] = new = made[r]
        ids[j] = own[j] = -1
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            own[i] = r = rank(new << SHIFT | ids[k], -1)
            if r >= 0:
                push(heap, r << 32 | i)
        else:
            own[i] = -1
        h = left[i]
        if h >= 0:
            own[h] = r = rank(ids[h] << SHIFT | new, -1)
            if r >= 0:
                push(heap, r << 32 | h)
    return [x for x in ids if x >= 0]


class Recent(dict):
    """A memo of bounded size: two generations, of which the older goes when the younger is full."""

    def __init__(self, make: Callable[[Any], Any], most: int = 100_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
