"""Byte-pair merging of one symbol sequence: a heap of candidate pairs over a doubly linked list."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from types import ModuleType

import pyarrow as pa


class Memo(dict):
    """A bounded cache that computes what is missing.

    When it is full it becomes the old generation, from which whatever is still asked for moves back.
    """

    def __init__(self, make: Callable, room: int = 200_000):
        super().__init__()
        self.make, self.room = make, room
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value


def once_per_worker(key: tuple, make: Callable):
    """What ``make`` gives, built once in a Python process: Spark reuses its workers from task to task."""
    held = sys.modules.setdefault("_tallywork_held", ModuleType("_tallywork_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def trim() -> None:
    """Give memory that is free back to the system: Spark keeps a worker for other tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


GONE, UNKNOWN = 0xFFFF, 0xFFFE  # numbers no vocabulary entry has


def pair(a: int, b: int) -> int:
    """Key of a pair of symbol numbers."""
    return a << 16 | b


def merge(symbols: list[int], ranks: dict[int, int], made: list[int]) -> tuple[list[int], int]:
    """Symbol numbers after all merges, and how many merges took place.

    ``ranks`` has the rank of each pair that merges and ``made`` the symbol that each rank makes. The lowest
    rank goes first and, among equal ranks, the leftmost pair. A heap entry holds a rank and a place; it is
    stale, and skipped, when the pair now at that place has another rank or is gone.
    """
    n = len(symbols)
    bits = n.bit_length()
    rank_of, mask = ranks.get, (1 << bits) - 1
    heap = [
        r << bits | i
        for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
        if (r := rank_of(a << 16 | b)) is not None
    ]
    if not heap:
        return symbols, 0
    heapify(heap)
    symbols = [*symbols, GONE]  # stands after the last symbol and, as number -1, before the first
    before, after = list(range(-1, n)), list(range(1, n + 2))
    merged = 0
    while heap:
        entry = heappop(heap)
        left = entry & mask
        right = after[left]
        rank = entry >> bits
        if rank_of(symbols[left] << 16 | symbols[right]) != rank:
            continue
        symbols[left] = a = made[rank]
        symbols[right] = GONE
        after[left] = beyond = after[right]
        before[beyond] = left
        merged += 1
        if (r := rank_of(a << 16 | symbols[beyond])) is not None:
            heappush(heap, r << bits | left)
        prior = before[left]
        if (r := rank_of(symbols[prior] << 16 | a)) is not None:
            heappush(heap, r << bits | prior)
    return [s for s in symbols if s != GONE], merged
