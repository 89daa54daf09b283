"""Encoding of many texts at once for packing: pieces are cut, told apart, merged and put together in numpy.

It gives the ids of ``bpe.WordBpe`` and shares its vocabulary and its rules for cutting a text into pieces. White
space separates chunks that never influence one another. In plain words, which hold Latin letters, digits and signs
only, pieces begin where the kind of character changes, and lower case is a table; any other word is left whole and
cut by ``WordBpe``. Pieces are compared by hash, and those not at hand are merged together: each step merges the
lowest-ranked, leftmost pair of every piece that still has one.

What is kept from block to block is bounded in bytes, and ``release`` frees it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np

from .bpe import WordBpe
from .merges import GONE
from .words import mix

BLOCK = 1 << 20  # characters encoded at a time
PIECES = 1_000_000  # pieces kept from block to block, some 34 bytes each
ROWS = 8192  # pieces merged at a time
WIDE = 48  # bytes; longer pieces are rare and merged one by one
_NONE = np.uint32(0xFFFFFFFF)

_PLAIN = 0x250  # code points below may be plain
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each plain code point; the last entry stands for all others."""
    kind, lower = np.full(_PLAIN + 1, _ODD, np.uint8), np.arange(_PLAIN + 1, dtype=np.uint32)
    for i in range(_PLAIN):
        c = chr(i)
        low = c.lower()
        group = unicodedata.category(c)[0]
        if i in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
            kind[i] = _SPACE
        elif len(low) == 1 and ord(low) < _PLAIN and unicodedata.normalize("NFC", c) == c and c not in "'<" and not 0x1C <= i <= 0x1F:
            kind[i] = _LETTER if group == "L" else _DIGIT if group == "N" else _SIGN
            lower[i] = ord(low)
    return kind, lower


_KIND, _LOWER = _tables()


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (``size`` numbers) for each entry, one after the other."""
    some = size > 0
    first, size = first[some], size[some]
    out = np.ones(int(size.sum()), np.int64)
    if len(first):
        ends = np.cumsum(size)
        out[0] = first[0]
        out[ends[:-1]] = first[1:] - (first[:-1] + size[:-1] - 1)
    return np.cumsum(out, out=out)


def _utf8(points: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of plain code points, and bytes per piece, given where the pieces begin."""
    two = points >= 0x80
    size = 1 + two.astype(np.int64)
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = np.where(two, 0x80 | points & 0x3F, points)
    out[(end - 2)[two]] = 0xC0 | points[two] >> 6
    return out, np.add.reduceat(size, heads) if len(heads) else np.zeros(0, np.int64)


class BatchBpe:
    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.inner, self.last = np.array(bpe.inner, np.uint32), np.array(bpe.last, np.uint32)
        keys = np.array(list(bpe.ranks), np.uint32)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], np.array(list(bpe.ranks.values()), np.uint32)[order]
        # where the keys of each left symbol begin
        self.begin = np.searchsorted(self.keys, np.arange(1 << 16, dtype=np.uint32) << np.uint32(16))
        self.made = np.array(bpe.made, np.uint32)
        self.release()

    def release(self) -> None:
        """Forget all pieces."""
        # by hash of a piece: a second hash, and place and number of its ids among ``ids``
        self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.many, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << np.uint32(16) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def _merge_rows(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces (rows) given as bytes one after the other, and how many ids each has."""
        n, wide = len(size), int(size.max())
        ids = np.full((n, wide + 1), GONE, np.uint32)
        ids[np.arange(wide + 1)[None, :] < size[:, None]] = self.inner[raw]
        ids[np.arange(n), size - 1] = self.last[raw[np.cumsum(size) - 1]]
        many = size.copy()
        rows, now = np.arange(n), ids.copy()
        rank = self._ranks(now[:, :-1], now[:, 1:])
        place = np.arange(wide + 1)[None, :]
        while True:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            going = best != _NONE
            if not going.all():
                ids[rows[~going]] = now[~going]
                rows, now, rank, at, best = rows[going], now[going], rank[going], at[going], best[going]
                if not len(rows):
                    return ids, many
            each = np.arange(len(rows))
            now[each, at] = self.made[best]
            # what stands behind the merged pair moves one place to the left
            shift = np.minimum(place + (place > at[:, None]), wide)
            now = np.take_along_axis(now, shift, axis=1)
            now[:, wide] = GONE
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], wide - 1), axis=1)
            rank[:, wide - 1] = _NONE
            many[rows] -= 1
            rank[each, at] = self._ranks(now[each, at], now[each, at + 1])
            some = at > 0
            rank[each[some], at[some] - 1] = self._ranks(now[each[some], at[some] - 1], now[each[some], at[some]])

    def _merged(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces given as bytes one after the other, in the order of the pieces, and how many each has."""
        begin = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")  # of similar length, so that the rows are well filled
        told, many = [], np.zeros(len(size), np.int64)
        short = int(np.searchsorted(size[order], WIDE, "right"))
        for a in range(0, short, ROWS):
            some = order[a : min(a + ROWS, short)]
            ids, many[some] = self._merge_rows(raw[_expanded(begin[some], size[some])], size[some])
            told.append(ids[np.arange(ids.shape[1])[None, :] < many[some][:, None]].astype(np.uint16))
        for i in order[short:].tolist():
            piece = raw[begin[i] : begin[i] + size[i]].tobytes().decode()
            told.append(np.frombuffer(self.bpe._merge_piece(piece), np.uint16))
            many[i] = len(told[-1])
        flat = np.concatenate(told) if told else np.zeros(0, np.uint16)
        at = np.empty(len(size), np.int64)
        at[order] = np.cumsum(many[order]) - many[order]
        return flat[_expanded(at, many)], many

    def _cut(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points (lower case, but for odd words), and start, length and oddness of each piece."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        table = np.minimum(points, _PLAIN)
        kind = _KIND[table]
        inked = kind != _SPACE
        if (odd := kind == _ODD).any():
            word = np.cumsum(np.diff(inked.view(np.int8), prepend=0) > 0)  # number of the word, from 1, that began last
            whole = np.zeros(int(word[-1]) + 1, bool)
            whole[word[odd]] = True
            odd = whole[word] & inked
            kind[odd] = _ODD
        low = np.where(odd, points, _LOWER[table])
        start = inked.copy()
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        first = np.flatnonzero(start)
        stop = np.append(start, True) | np.append(~inked, True)
        ends = np.flatnonzero(stop[1:] & inked) + 1
        return low, first, ends - first, odd[first]

    def _block(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a block, the start of each of its pieces, and the place in the ids where each begins (and the end)."""
        low, first, size, odd = self._cut(text)
        if not len(first):
            return np.zeros(0, np.uint16), first, np.zeros(1, np.int64)
        heads = np.cumsum(size) - size
        inked = low[_expanded(first, size)]
        place = np.arange(len(inked), dtype=np.int32) - np.repeat(heads.astype(np.int32), size)
        terms = inked.astype(np.uint64) + np.uint64(1)
        factors = mix(np.arange(int(size.max()), dtype=np.uint64))
        tail = (size.astype(np.uint64) << np.uint64(1) | odd.astype(np.uint64)) << np.uint64(32)
        hashes = mix(np.add.reduceat(terms * (factors | np.uint64(1))[place], heads) ^ tail)
        checks = np.add.reduceat(terms * (mix(factors) | np.uint64(1))[place], heads)
        del terms, place, inked
        own, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        check = checks[example]
        at = np.minimum(np.searchsorted(self.hash, own), max(len(self.hash) - 1, 0))
        known = self.hash[at] == own if len(self.hash) else np.zeros(len(own), bool)
        if (check[which] != checks).any() or (self.check[at[known]] != check[known]).any():
            raise ValueError("two pieces with one hash")
        begin, many = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        begin[known], many[known] = self.at[at[known]], self.many[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            self._learn(text, low, first[example], size[example], odd[example], fresh, begin, many)
            to = np.searchsorted(self.hash, own[fresh])
            self.hash, self.check = np.insert(self.hash, to, own[fresh]), np.insert(self.check, to, check[fresh])
            self.at, self.many = np.insert(self.at, to, begin[fresh]), np.insert(self.many, to, many[fresh])
        length = many[which]
        ids = self.ids[_expanded(begin[which], length)]
        if len(self.hash) > PIECES:  # only the pieces of this block stay
            self.ids = self.ids[_expanded(begin, many)]
            self.hash, self.check, self.many, self.at = own, check, many, np.cumsum(many) - many
        return ids, first, np.concatenate([[0], np.cumsum(length)])

    def _learn(self, text: str, low: np.ndarray, first: np.ndarray, size: np.ndarray, odd: np.ndarray, fresh: np.ndarray, begin: np.ndarray, many: np.ndarray) -> None:
        """Add the ids of new pieces; ``begin`` and ``many`` are filled in."""
        plain = fresh[~odd[fresh]]
        if len(plain):
            points = low[_expanded(first[plain], size[plain])]
            ids, many[plain] = self._merged(*_utf8(points, np.cumsum(size[plain]) - size[plain]))
            begin[plain] = len(self.ids) + np.cumsum(many[plain]) - many[plain]
            self.ids = np.concatenate([self.ids, ids])
        if len(rest := fresh[odd[fresh]]):
            told = [self.bpe._told(text[a : a + n]) for a, n in zip(first[rest].tolist(), size[rest].tolist())]
            many[rest] = np.fromiter(map(len, told), np.int64, len(told)) // 2
            begin[rest] = len(self.ids) + np.cumsum(many[rest]) - many[rest]
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(told), np.uint16)])

    def packed(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as unsigned 16-bit numbers in the machine's byte order; None counts as empty."""
        held: list[str] = []
        size = 0

        def told() -> Iterator[bytes]:
            ids, first, places = self._block("\n".join(held))
            starts = np.cumsum([0, *(len(d) + 1 for d in held)])
            cuts = places[np.searchsorted(first, starts)]
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                yield ids[a:b].tobytes()

        for text in texts:
            text = text or ""
            if size and size + len(text) > BLOCK:
                yield from told()
                held, size = [], 0
            if len(text) > BLOCK:
                yield b"".join(self._block(part)[0].tobytes() for part in _parts(text))
                continue
            held.append(text)
            size += len(text) + 1
        if held:
            yield from told()


def _parts(text: str) -> Iterator[str]:
    """Cut a long text at white space."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and text[end] not in "\t\n\x0b\x0c\r ":
            end += 1
        yield text[at:end]
        at = end
