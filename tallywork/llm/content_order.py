"""A coarse order of texts by content, in which lexical neighbours stand close together.

A text becomes its BM25 weights, projected to DIM random signs and scaled to length one. A tree of two-means
splits puts alike vectors into the same leaf, and sibling leaves next to each other.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

DIM = 64
DEPTH = 48
SLACK = 0.3
_TERMS = 1 << 16  # terms projected at a time


def signs(entries: int = 1 << 16) -> np.ndarray:
    """Rows of -1 and 1, the same in every process."""
    return (np.random.Generator(np.random.PCG64(5)).integers(0, 2, (entries, DIM), np.int8) * 2 - 1).astype(np.float32)


def sketches(terms: list[np.ndarray], weights: list[np.ndarray], projection: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text, and the least of its scattered terms (near copies mostly share it)."""
    out = np.zeros((len(terms), DIM), np.float32)
    least = np.zeros(len(terms), np.int64)
    scattered = np.random.Generator(np.random.PCG64(6)).permutation(len(projection))
    first = held = 0
    for i, own in enumerate(terms):
        held += len(own)
        if held < _TERMS and i + 1 < len(terms):
            continue
        part = slice(first, i + 1)
        flat, starts = np.concatenate(terms[part]), np.cumsum([0] + [len(t) for t in terms[part]])[:-1]
        out[part] = np.add.reduceat(projection[flat] * np.concatenate(weights[part]).astype(np.float32)[:, None], starts)
        least[part] = np.minimum.reduceat(scattered[flat], starts)
        first, held = i + 1, 0
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9), least


class Tree(NamedTuple):
    """Inner node k sends a vector to ``right[k]`` if its product with ``normal[k]`` is above ``bound[k]``, else
    to ``left[k]``. Children below zero are leaves, numbered -1, -2, ... from left to right; ``depth`` is that of
    the node which parts a leaf from the one before it."""

    normal: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the leaf of each vector, from 0."""
        at = np.full(len(vectors), 0 if len(self.normal) else -1)
        while len(open_ := np.flatnonzero(at >= 0)):
            node = at[open_]
            up = np.einsum("ij,ij->i", vectors[open_], self.normal[node]) > self.bound[node]
            at[open_] = np.where(up, self.right[node], self.left[node])
        return -1 - at


def _split(x: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Normal and bound between two means, begun along the direction of largest spread."""
    centred = x - x.mean(axis=0)
    spread = centred.T @ centred
    if np.trace(spread) <= 1e-6 * len(x):
        return None
    up = centred @ np.linalg.eigh(spread)[1][:, -1] > 0
    for _ in range(8):
        if up.all() or not up.any():
            return None
        high, low = x[up].mean(axis=0), x[~up].mean(axis=0)
        normal, bound = high - low, float((high @ high - low @ low) / 2)
        now = x @ normal > bound
        if (now == up).all():
            break
        up = now
    return normal, bound


def grow(vectors: np.ndarray, weights: np.ndarray, most: float) -> Tree:
    """A tree over the given vectors whose leaves weigh at most ``most``, equal vectors and depth aside."""
    normals: list[np.ndarray] = []
    bounds: list[float] = []
    children: list[list[int]] = []
    parted: list[int] = []
    above = 0
    todo = [(np.arange(len(vectors)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        above = depth - 1 if side else above
        made = None
        if len(rows) > 1 and depth < DEPTH and weights[rows].sum() > most:
            made = _split(vectors[rows])
        up = vectors[rows] @ made[0] > made[1] if made else None
        if made is None or up.all() or not up.any():
            parted.append(above)
            name = -len(parted)
        else:
            name = len(normals)
            normals.append(made[0])
            bounds.append(made[1])
            children.append([0, 0])
            # the left side is taken first, so leaves are numbered in order
            todo += [(rows[up], depth + 1, name, 1), (rows[~up], depth + 1, name, 0)]
        if parent >= 0:
            children[parent][side] = name
    both = np.array(children, np.int64).reshape(-1, 2)
    normal = np.array(normals, np.float32).reshape(-1, vectors.shape[1])
    return Tree(normal, np.array(bounds, np.float32), both[:, 0], both[:, 1], np.array(parted))


def cut(tree: Tree, keys: np.ndarray, tokens: np.ndarray, parts: int) -> np.ndarray:
    """The rows of ``keys`` (one column per row of text, leaves first) at which each of ``parts`` parts but the first begins.

    A cut may move by SLACK of a part to where the tree parts the texts nearest to its root.
    """
    order = np.lexsort(keys[::-1])
    begin = np.cumsum(tokens[order]) - tokens[order]
    part = tokens.sum() / parts
    leaf = keys[0, order]
    edges = np.flatnonzero(leaf[1:] != leaf[:-1]) + 1
    at = []
    for want in part * np.arange(1, parts):
        low, high = np.searchsorted(begin[edges], [want - SLACK * part, want + SLACK * part])
        if low < high:
            near = edges[low:high]
            # leaves without texts hide no higher node: the least depth since the leaf before counts
            depth = [tree.depth[leaf[e - 1] + 1 : leaf[e] + 1].min() for e in near]
            at.append(min(zip(depth, np.abs(begin[near] - want), near))[2])
        elif (k := int(np.searchsorted(begin, want))) < len(order):
            at.append(k)
    return keys[:, order[np.unique(np.asarray(at, np.int64))]]


def place(keys: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of cuts at or before each row of ``keys``."""
    k = cuts.shape[1]
    both = np.concatenate([cuts, keys], axis=1)
    order = np.lexsort(np.concatenate([np.repeat([0, 1], [k, keys.shape[1]])[None, :], both[::-1]]))
    passed = np.empty(both.shape[1], np.int64)
    passed[order] = np.cumsum(order < k)
    return passed[k:]
