"""Kept half-open ranges by length and start, to find the first kept one that overlaps a range enough."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort


#: So many kept ranges are looked through one by one.
FEW = 16


class _Sorted:
    """(start, end, place) tuples by start, in blocks that know their least place."""

    def __init__(self, block: int = 128):
        self.block, self.blocks, self.firsts, self.least = block, [[]], [], [float("inf")]

    def add(self, item: tuple[int, int, int]) -> None:
        k = max(0, bisect_right(self.firsts, item) - 1) if self.firsts else 0
        own = self.blocks[k]
        insort(own, item)
        self.least[k] = min(self.least[k], item[2])
        if not self.firsts:
            self.firsts = [item]
        else:
            self.firsts[k] = own[0]
        if len(own) > self.block:
            cut = len(own) // 2
            self.blocks[k : k + 1] = [own[:cut], own[cut:]]
            self.firsts[k : k + 1] = [own[0], own[cut]]
            self.least[k : k + 1] = [min(x[2] for x in part) for part in self.blocks[k : k + 2]]

    def between(self, low: int, high: int):
        """The tuples with low <= start < high."""
        k = max(0, bisect_right(self.firsts, (low,)) - 1)
        while k < len(self.firsts) and (self.firsts[k][0] < high):
            own = self.blocks[k]
            yield from own[bisect_left(own, (low,)) : bisect_left(own, (high,))]
            k += 1

    def least_between(self, low: int, high: int, below: float) -> float:
        """The least place under `below` of those with low <= start < high; whole blocks count at once."""
        k = max(0, bisect_right(self.firsts, (low,)) - 1)
        while k < len(self.firsts) and self.firsts[k][0] < high:
            own = self.blocks[k]
            if self.least[k] < below:
                if own[0][0] >= low and own[-1][0] < high:
                    below = self.least[k]
                else:
                    below = min([below, *(x[2] for x in own[bisect_left(own, (low,)) : bisect_left(own, (high,))])])
            k += 1
        return below


class Kept:
    """Ranges that were kept, of which no two overlap by `percent` of the shorter.

    Ranges of like lengths (within a factor of two) are sorted by start. Those that lie inside a range asked for surely
    overlap it enough, and are a stretch of that order; at both of its edges only as many can lie as fit beside each other.
    So a question costs the logarithm of what is kept, not all of it.
    """

    def __init__(self, percent: int):
        self.percent, self.classes, self.names, self.few = percent, {}, [], []

    def add(self, name, start: int, end: int) -> None:
        if len(self.names) < FEW:
            self.few.append((start, end))
        self.classes.setdefault((end - start).bit_length(), _Sorted()).add((start, end, len(self.names)))
        self.names.append(name)

    def first(self, start: int, end: int):
        """The first range kept that shares `percent` of the shorter with [start, end); None if none does."""
        found, length = float("inf"), end - start
        if self.percent <= 0:
            return self.names[0] if self.names else None
        if len(self.names) <= FEW:
            return next((name for name, (a, b) in zip(self.names, self.few) if 100 * max(0, min(b, end) - max(a, start)) >= self.percent * min(b - a, length)), None)
        for bits, own in self.classes.items():
            most = (1 << bits) - 1  # the longest of the class
            inside = end - most + 1  # those that start before, from `start` on, end inside
            if self.percent <= 100 and inside > start:
                found = own.least_between(start, inside, found)
                edges = ((start - most, start), (inside, end))
            else:
                edges = ((start - most, end),)
            for low, high in edges:
                for a, b, place in own.between(low, high):
                    if place < found and 100 * max(0, min(b, end) - max(a, start)) >= self.percent * min(b - a, length):
                        found = place
        return None if found == float("inf") else self.names[found]
