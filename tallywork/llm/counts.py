"""Token counts for a sentencepiece BPE vocabulary, without making any ids.

The count of a text is its number of initial symbols less the number of merges. No piece of such a
vocabulary has a space mark after another letter, so no merge crosses the place before a run of space
marks: the parts between those places are counted on their own, each distinct one once per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from .bpe import read_vocabulary, vocabulary_file
from .merges import UNKNOWN, Memo, merge, once_per_worker, pair

DEFAULT = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"


def piece_scores(data: bytes) -> dict[str, float]:
    """Ordinary pieces of a model file and how late each is merged. The file's library is needed on the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    odd = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    return {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size()) if not odd(i)}


class PieceCounter:
    def __init__(self, data: bytes | dict[str, float]):
        self.scores = data if isinstance(data, dict) else piece_scores(data)
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece of this vocabulary crosses a word boundary")
        self.number = {p: i for i, p in enumerate(self.scores.keys() | {c for p in self.scores for c in p})}
        if len(self.number) >= UNKNOWN:
            raise ValueError("this vocabulary needs more than 16 bits")
        # every way to make a piece of two symbols; a symbol is a letter or a piece
        ranked = sorted(self.scores, key=self.scores.__getitem__)
        self.made = [self.number[p] for p in ranked]
        self.ranks = {
            pair(self.number[p[:i]], self.number[p[i:]]): rank
            for rank, p in enumerate(ranked)
            for i in range(1, len(p))
            if p[:i] in self.number and p[i:] in self.number
        }
        self.parts = regex.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.part = Memo(self._count_part, 300_000)
        self.word = Memo(lambda word: self._count_part(SPACE + word), 600_000)

    def _count_part(self, part: str) -> int:
        # a letter outside the vocabulary counts as its bytes
        initial = sum(1 if c in self.scores else len(c.encode("utf-8", "surrogatepass")) for c in part)
        _, merges = merge([self.number.get(c, UNKNOWN) for c in part], self.ranks, self.made)
        return initial - merges

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.split(" ")
        if SPACE in text or "" in words:
            whole = SPACE + text.replace(" ", SPACE)
            return sum(map(self.part.__getitem__, self.parts.findall(whole)))
        return sum(map(self.word.__getitem__, words))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, path: str | None = None
) -> DataFrame:
    """UTF-8 bytes, tokens and whether they exceed ``limit``, one row per input row.

    NULL and empty texts have no bytes and no tokens. Begin, end and special tokens are not counted;
    strings that look like them are ordinary text.
    """
    data = read_vocabulary(path or vocabulary_file(DEFAULT))
    name, scores = ("pieces", len(data), zlib.crc32(data)), piece_scores(data)

    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = once_per_worker(name, lambda: PieceCounter(scores))
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    text = F.col(f"`{text_col}`")
    made = docs.select(
        F.col(f"`{id_col}`"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        run(text).alias("n_tokens"),
    )
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
