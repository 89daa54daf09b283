"""Quality rules: how much of a text lies inside n-grams and lines that it repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .words import ngrams, words_of

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, dup_line_chars bigint, worst_ngram int, worst_ngram_share double, kept boolean"
)
# Largest share of a text's word characters inside duplicated n-grams, by n, and of its characters inside
# duplicated lines. Wider than the published limits for web pages, since one repeated line of a short
# document is no fault.
NGRAM_SHARE = {5: 0.25, 6: 0.25, 7: 0.25, 8: 0.25, 9: 0.25, 10: 0.25}
LINE_SHARE = 0.25
SYMBOL_SHARE = 0.2  # symbols per word
SYMBOLS = "#*$%&|<>"
# Largest share of a text's words inside runs that say the same 1 to 4 words again at once (the repeats are counted,
# the first time is not). Clean labelled texts have at most 0.09 for single words and 0.04 for longer ones.
STUTTER_SHARE = {1: 0.2, 2: 0.2, 3: 0.2, 4: 0.2}
# The same as NGRAM_SHARE for windows that occur three times or more, where longer ones weigh more.
THRICE_SHARE = {5: 0.2, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
BASE_NGRAM = 5
MIN_WORDS = 10
BASE_PERCENT = 20


def repeated_words(words: np.ndarray, n: int, times: int = 2) -> np.ndarray:
    """Mask of the words inside n-word windows that occur ``times`` or more, the first one included."""
    inside = np.zeros(len(words), bool)
    grams = ngrams(words, n)
    if len(grams) < times:
        return inside
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[times - 1 :] == ranked[: len(ranked) - times + 1]
    if not same.any():
        return inside
    often = np.zeros(len(grams), bool)
    for k in range(times):
        often[order[k : k + len(same)][same]] = True
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often)
    step[at] += 1
    step[at + n] -= 1
    return np.cumsum(step[:-1]) > 0


def stuttered_words(words: np.ndarray, n: int) -> int:
    """How many words lie in ``n``-word blocks equal to the block just before them."""
    if len(words) < 2 * n:
        return 0
    same = np.concatenate([[0], np.cumsum(words[n:] == words[:-n])])
    again = np.flatnonzero(same[n:] - same[:-n] == n)  # block starting at again + n
    step = np.zeros(len(words) + 1, np.int64)
    step[again + n] += 1
    step[again + 2 * n] -= 1
    return int((np.cumsum(step[:-1]) > 0).sum())


def measure(
    text: str | None, words: np.ndarray, sizes: np.ndarray, ngram_share: dict[int, float], line_share: float
) -> tuple:
    """The row of FIELDS for one text, its word hashes and their code points."""
    text = text or ""
    chars, n_words = int(sizes.sum()), len(sizes)
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            if line in seen:
                dup_lines += 1
                dup_chars += len(line)
            else:
                seen.add(line)
    symbols = sum(map(text.count, SYMBOLS))
    base = repeated_words(words, BASE_NGRAM)
    repeat = int(base.sum())
    failed = n_words < MIN_WORDS or 100 * repeat > BASE_PERCENT * n_words
    worst, share, over = 0, 0.0, False
    for n in sorted(ngram_share):
        inside = base if n == BASE_NGRAM else repeated_words(words, n)
        if not inside.any():
            break  # a repeated longer window would repeat this one too
        part = float(sizes[inside].sum()) / chars
        over |= part > ngram_share[n]
        if part / ngram_share[n] > (share / ngram_share[worst] if worst else 0):
            worst, share = n, part
    if not failed and repeat:
        for n, most in THRICE_SHARE.items():
            inside = repeated_words(words, n, 3)
            if not inside.any():
                break
            over |= float(sizes[inside].sum()) / chars > most
    over = over or any(stuttered_words(words, n) > most * n_words for n, most in STUTTER_SHARE.items())
    kept = not failed and not over and dup_chars <= line_share * len(text) and symbols <= SYMBOL_SHARE * n_words
    return n_words, chars, symbols, dup_lines, repeat, failed, dup_chars, worst, share, kept


def repetition(
    text: Column, ngram_share: dict[int, float] | None = None, line_share: float = LINE_SHARE
) -> Column:
    """Struct of FIELDS for a text column.

    ``kept`` is false below MIN_WORDS words, above BASE_PERCENT of the words in repeated 5-word windows,
    above a limit of ``ngram_share`` (or of THRICE_SHARE, for windows that occur three times or more), above
    a limit of STUTTER_SHARE for runs of 1 to 4 words said again at once, above ``line_share`` of all characters in lines equal to an earlier
    line (the first one is not counted), or above SYMBOL_SHARE symbols per word. NULL and empty texts have no words and are not kept.
    Any length of text is measured whole; rows are independent, so repeated rows get equal results.
    """
    limits = dict(sorted((ngram_share or NGRAM_SHARE).items()))

    @F.pandas_udf(FIELDS)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(",")]
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            rows = [measure(t, *w, limits, line_share) for t, w in zip(texts, words_of(texts))]
            yield pd.DataFrame(rows, columns=names)

    return measured.asNondeterministic()(text)  # evaluated once, never pushed through a filter


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: the id and FIELDS."""
    made = docs.select(F.col(f"`{id_col}`"), repetition(F.col(f"`{text_col}`"), **limits).alias("__made"))
    return made.select(f"`{id_col}`", "__made.*")


def keep_clean(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    flag = "__kept"
    while flag in docs.columns:
        flag += "_"
    marked = docs.withColumn(flag, repetition(F.col(f"`{text_col}`"), **limits))
    return marked.where(F.col(f"{flag}.kept")).drop(flag)
