"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector, drawn by a rule from its code point. A letter n-gram is the
product of its letters' vectors, each rotated by its place (binding of permuted vectors); a text is the
sum of its n-grams (bundling). A language's prototype is the sum over its training texts. A text gets
the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from .words import mix

DIMENSIONS = 1024
N = 3
UNKNOWN = "und"
_BITS = 21  # of a code point
ROOM = 60_000  # n-gram vectors kept by a task
CODES = 1_000_000  # n-grams summed at a time while learning


class Letters:
    """Sums of n-gram vectors of texts."""

    def __init__(self, dimensions: int, n: int = N):
        self.d, self.n = dimensions, n
        self.other = regex.compile(r"\P{L}+")
        self.codes = np.zeros(0, np.uint64)
        self.rows = np.zeros((0, dimensions), np.int8)

    def grams(self, text: str) -> np.ndarray:
        """Code of each letter n-gram of the lower-cased text; one blank stands for all else."""
        plain = self.other.sub(" ", text.lower())
        if not plain.strip():
            return np.zeros(0, np.uint64)
        points = np.frombuffer(f" {plain.strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        k = max(len(points) - self.n + 1, 0)
        codes = np.zeros(k, np.uint64)
        for i in range(self.n):
            codes = (codes << np.uint64(_BITS)) | points[i : i + k]
        return codes

    def _letter(self, points: np.ndarray) -> np.ndarray:
        """A +1/-1 vector per code point."""
        words = -(-self.d // 64)
        seeds = mix(points.astype(np.uint64))[:, None] + np.arange(words, dtype=np.uint64)[None, :]
        bits = np.unpackbits(mix(seeds).astype("<u8").view(np.uint8), axis=1)[:, : self.d]
        return (bits.astype(np.int8) << 1) - 1

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The bound vector of each n-gram code."""
        mask = np.uint64((1 << _BITS) - 1)
        out = np.ones((len(codes), self.d), np.int8)
        for i in range(self.n):
            shift = np.uint64(_BITS * (self.n - 1 - i))
            points, where = np.unique((codes >> shift) & mask, return_inverse=True)
            out *= np.roll(self._letter(points), self.n - 1 - i, axis=1)[where]
        return out

    def known(self, codes: np.ndarray) -> np.ndarray:
        """Rows of the kept vectors for sorted distinct codes; new ones are made and kept."""
        at = np.searchsorted(self.codes, codes)
        found = at < len(self.codes)
        found[found] = self.codes[at[found]] == codes[found]
        if not found.all():
            fresh = codes[~found]
            if len(self.codes) + len(fresh) > ROOM:
                return self.vectors(codes)
            place = np.searchsorted(self.codes, fresh)
            self.codes = np.insert(self.codes, place, fresh)
            self.rows = np.insert(self.rows, place, self.vectors(fresh), axis=0)
            at = np.searchsorted(self.codes, codes)
        return self.rows[at]

    def bundle(self, codes: np.ndarray) -> np.ndarray:
        """Sum of the vectors of all n-grams, in slices that bound the memory."""
        grams, counts = np.unique(codes, return_counts=True)
        total = np.zeros(self.d, np.float64)
        kind = np.float32 if len(codes) < 1 << 23 else np.float64  # sums of whole numbers stay exact
        for i in range(0, len(grams), 4096):
            part = self.known(grams[i : i + 4096]).astype(kind)
            total += counts[i : i + 4096].astype(kind) @ part
        return total


def fit(examples: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per language: (lang, prototype array<double>), from every example with a language."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = Letters(dimensions)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                held, size = [], 0
                for text in [*part["text"], None]:
                    if text is not None:
                        held.append(letters.grams(text))
                        size += len(held[-1])
                    if size and (text is None or size >= CODES):
                        sums[lang] = sums.get(lang, 0) + letters.bundle(np.concatenate(held))
                        held, size = [], 0
        rows = [(lang, i, v) for lang, total in sums.items() for i, v in enumerate(total)]
        yield pd.DataFrame(rows, columns=["lang", "i", "v"])

    parts = (
        examples.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
        .where("lang is not null and text is not null")
        .mapInPandas(partial, "lang string, i int, v double")
    )
    places = parts.groupBy("lang", "i").agg(F.sum("v").alias("v"))
    return places.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("prototype")
    )


def predict(
    docs: DataFrame, model: list[tuple[str, list[float]]], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) per input row for a fitted model: one (language, prototype) per language.

    Equal cosines go to the alphabetically first language. Texts that are NULL or have no letter, and
    all texts when nothing was learned, get ``und`` and 0. Only the text is looked at.
    """
    model = sorted((lang, list(p)) for lang, p in model)
    langs = [lang for lang, _ in model]
    unit = np.array([p for _, p in model] or [[0.0]], np.float64)
    if langs:
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = Letters(unit.shape[1])
        for batch in batches:
            rows = []
            for text in batch:
                codes = letters.grams(text) if isinstance(text, str) and langs else ()
                if not len(codes):
                    rows.append((UNKNOWN, 0.0))
                    continue
                total = letters.bundle(codes)
                cosines = unit @ (total / max(np.linalg.norm(total), 1e-12))
                best = int(np.argmax(cosines))
                rows.append((langs[best], float(min(max(cosines[best], 0.0), 1.0))))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    made = docs.select(F.col(f"`{id_col}`"), run(F.col(f"`{text_col}`")).alias("__made"))
    return made.select(f"`{id_col}`", "__made.*")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from three quarters of the labelled rows, predict all.

    A row is held out of learning when crc32 of its id as text leaves 2 by 4; a row without id is never
    held out and never learned from. The model (one vector per language) is all that reaches the driver.
    """
    rest = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4
    examples = docs.where((rest != 2) & F.col(f"`{lang_col}`").isNotNull())
    model = [(r["lang"], r["prototype"]) for r in fit(examples, text_col, lang_col).collect()]
    made = predict(docs, model, id_col, text_col)
    return made.select(f"`{id_col}`", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
