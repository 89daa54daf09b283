"""Words and word n-grams of whole texts as 64-bit hashes, in numpy.

A word is a run of anything but ASCII white space (``[\\x20\\x09-\\x0D]``). Hashes depend on the bytes
alone, so they are equal on every executor. A word hash is a sum of bytes times one fixed 64-bit odd
number per position, then mixed; two given different words collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: bytes of text hashed at a time; bounds the temporary arrays whatever the length of a text
BLOCK = 1 << 20

_SPACES = (9, 10, 11, 12, 13, 32)
_STEPS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x + np.uint64(_STEPS[0])
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_STEPS[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_STEPS[2])
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    return mix(np.arange(n, dtype=np.uint64)) | np.uint64(1)


def _hash_block(data: bytes, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of code points and start of each word of a block that starts and ends between words."""
    raw = np.frombuffer(data, np.uint8)
    gap = gaps[raw]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    first, last = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), first
    size = last - first
    at = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(at, size)
    inked = raw[~gap]
    chars = np.add.reduceat(((inked & 0xC0) != 0x80).astype(np.int64), at)
    terms = inked.astype(np.uint64) + np.uint64(1)
    terms *= _factors(int(size.max()))[place]
    return mix(np.add.reduceat(terms, at) ^ (size.astype(np.uint64) << np.uint64(40))), chars, first


def gaps_of(*bytes_: int) -> np.ndarray:
    """The table of bytes that stand between words; the ASCII white space must be among them."""
    out = np.zeros(256, bool)
    out[list(bytes_)] = True
    return out


_GAP = gaps_of(*_SPACES)


def _blocks(data: bytes) -> Iterator[bytes]:
    """Cut long data at white space."""
    at = 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[at:end]
        at = end


def words_of(
    texts: Iterable[str | None], lower: bool = False, gaps: np.ndarray = _GAP
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and code points of each word, text by text; short texts share one pass. None counts as empty.

    ``lower`` turns A-Z to a-z first and leaves every other letter as it is. ``gaps`` says which bytes part words.
    """
    held: list[bytes] = []
    total = 0

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not held:
            return
        hashes, chars, first = _hash_block(b"\n".join(held), gaps)
        starts = np.cumsum([0] + [len(d) + 1 for d in held])
        cuts = np.searchsorted(first, starts)
        for i in range(len(held)):
            yield hashes[cuts[i] : cuts[i + 1]], chars[cuts[i] : cuts[i + 1]]

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        data = data.lower() if lower else data
        if len(data) > BLOCK:
            yield from flush()
            held, total = [], 0
            made = [_hash_block(part, gaps) for part in _blocks(data)]
            yield np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
            continue
        held.append(data)
        total += len(data)
        if total >= BLOCK:
            yield from flush()
            held, total = [], 0
    yield from flush()


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words; empty when there are fewer."""
    k = len(words) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(k, np.uint64)
    for i, factor in enumerate(_factors(n + 1)[1:]):
        out += words[i : i + k] * factor
    return mix(out)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles; with fewer words the whole sequence counts as one."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return ngrams(mix(words + np.uint64(len(words))), len(words))
    return np.unique(ngrams(words, n))
