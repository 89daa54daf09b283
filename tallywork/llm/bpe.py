"""BPE encoding and decoding with a word-level vocabulary in the JSON format of ``tokenizers``.

White space separates chunks that never influence one another, so each distinct chunk is merged once
per task and kept in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .merges import UNKNOWN, Memo, merge, once_per_worker, pair

DEFAULT = "word_bpe_49k.json"


def vocabulary_file(name: str = DEFAULT) -> str:
    """Place of a public vocabulary; its package is only needed on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str | None = None) -> bytes:
    with open(path or vocabulary_file(), "rb") as file:
        return file.read()


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder for one vocabulary: NFC, lower case, white space dropped, word ends marked."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.words = {i: w for w, i in self.ids.items()} | {i: w for w, i in self.special.items()}
        if max(self.words) >= UNKNOWN:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {pair(self.ids[a], self.ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        end = model["end_of_word_suffix"]
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]
        self.pieces = regex.compile(pattern["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.space = regex.compile(r"\p{White_Space}+")
        # what str.split() takes for white space although Unicode does not
        self.odd = regex.compile("[\x1c-\x1f]")
        letters = _byte_letters()
        self.inner = [self.ids[letters[b]] for b in range(256)]
        self.last = [self.ids[letters[b] + end] for b in range(256)]
        self.piece = Memo(self._merge_piece, 300_000)
        self.chunk = Memo(self._pack_chunk, 500_000)
        self.told = Memo(self._tell_chunk, 300_000)

    def _merge_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        symbols = list(map(self.inner.__getitem__, data))
        symbols[-1] = self.last[data[-1]]
        return array("H", merge(symbols, self.ranks, self.made)[0]).tobytes()

    def _pack_chunk(self, chunk: str) -> bytes:
        if chunk in self.special:
            return array("H", [self.special[chunk]]).tobytes()
        return b"".join(map(self.piece.__getitem__, self.pieces_of(chunk)))

    def _told(self, text: str) -> bytes:
        """Packed ids of a text, without the caches."""
        out = []
        for chunk in self.chunks(text):
            if chunk in self.special:
                out.append(array("H", [self.special[chunk]]).tobytes())
            else:
                out += map(self._merge_piece, self.pieces_of(chunk))
        return b"".join(out)

    def pieces_of(self, chunk: str) -> list[str]:
        """The parts of a chunk that are merged on their own."""
        if not chunk.isascii():
            # each letter on its own: no final form of sigma
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        plain = chunk.lower()
        return [plain] if plain.isalpha() else self.pieces.findall(plain)

    def _tell_chunk(self, chunk: str) -> tuple[str, str]:
        ids = array("H", self._pack_chunk(chunk))
        return " ".join(map(str, ids)), self.decode(ids)

    def chunks(self, text: str) -> list[str]:
        """Independent parts of a text, special strings on their own."""
        out = []
        for part in self.specials.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif self.odd.search(part):
                out += [c for c in self.space.split(part) if c]
            else:
                out += part.split()
        return out

    def packed(self, text: str | None) -> bytes:
        """Ids as unsigned 16-bit numbers in the machine's byte order."""
        return b"".join(map(self.chunk.__getitem__, self.chunks(text or "")))

    def encode(self, text: str | None) -> list[int]:
        return list(array("H", self.packed(text)))

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in order; the vocabulary names no decoder, so a space joins them."""
        return " ".join(map(self.words.__getitem__, ids))

    def strings(self, text: str | None) -> tuple[str, str]:
        """Decimal ids joined by spaces, and the decoded text."""
        told = [t for t in map(self.told.__getitem__, self.chunks(text or "")) if t[0]]
        return " ".join([t[0] for t in told]), " ".join([t[1] for t in told])


def encoder(data: bytes) -> WordBpe:
    return once_per_worker(("word_bpe", len(data), zlib.crc32(data)), lambda: WordBpe(data))


def encoded(text: Column, path: str | None = None) -> Column:
    """Array of ids of a text column; NULL counts as empty."""
    data = read_vocabulary(path)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(data)
        for batch in batches:
            yield pd.Series([bpe.encode(t) for t in batch], dtype=object)

    return run(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """Text of an array of ids; NULL stays NULL."""
    data = read_vocabulary(path)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(data)
        for batch in batches:
            yield pd.Series([None if x is None else bpe.decode(list(x)) for x in batch], dtype=object)

    return run(ids)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per input row.

    NULL and empty texts have no tokens; the digests are then those of the empty string. Rows are
    independent, so ids may be NULL or repeated. Special strings inside a text become their own id.
    """
    data = read_vocabulary(path)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(data)
        for batch in batches:
            rows = []
            for text in batch:
                ids, back = bpe.strings(text)
                rows.append((
                    ids.count(" ") + 1 if ids else 0,
                    hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
                ))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    made = docs.select(F.col(f"`{id_col}`"), run(F.col(f"`{text_col}`")).alias("__made"))
    return made.select(f"`{id_col}`", "__made.*")
