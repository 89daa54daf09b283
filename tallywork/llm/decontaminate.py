"""Benchmark passages in a training corpus, found with one FM-index per shard of documents.

1. Each task cuts its documents into shards of about a million words and writes an index for each; a document that
   is longer than a shard is cut, with as many words on both sides of a cut as a phrase may miss.
2. The benchmark becomes phrases (windows of its items), in blocks of bounded size. Each block goes to all tasks in
   turn, which search it backwards in their indexes, locate what they find and merge it to spans.
3. Spans and items of a document meet in one small aggregate. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .fm_index import FmIndex
from .store import Keep, scratch, written
from .words import gaps_of, words_of

WINDOW = 10  # words
SHARD_WORDS = 1 << 20
QUERY_WORDS = 1 << 20  # words of phrases that every task gets at once: 8 MB
PIECE = 4096  # words of an item that stay together in a block
FOUND = 1 << 20  # occurrences located at a time

#: whatever is neither a letter nor a digit in ASCII; all else belongs to words
GAPS = gaps_of(*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))

_INDEX = (
    "shard bigint, doc array<bigint>, doc_id array<string>, words array<bigint>, first array<bigint>, size array<bigint>,"
    " vocabulary binary, counts binary, levels binary, marks binary, kept binary"
)
_DOCS = ("doc", "doc_id", "words", "first", "size")


def _index_row(shard: int, docs: list[tuple], hashes: list[np.ndarray]) -> tuple:
    flat = np.concatenate([np.append(h, np.uint64(0)) for h in hashes])
    ends = np.cumsum([len(h) + 1 for h in hashes]) - 1
    inked = np.ones(len(flat), bool)
    inked[ends] = False
    vocabulary, symbols = np.unique(flat[inked], return_inverse=True)
    sequence = np.zeros(len(flat), np.int64)
    sequence[inked] = symbols + 1
    levels, counts, marks, kept = FmIndex.parts(sequence, len(vocabulary) + 1)
    told = [list(c) for c in zip(*docs)]
    blobs = (vocabulary.astype("<u8"), counts.astype("<i4"), levels.astype("<u8"), marks.astype("<u8"), kept.astype("<i4"))
    return shard, *told, *(b.tobytes() for b in blobs)


def build(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = WINDOW, shard_words: int = SHARD_WORDS, keep: Keep = written
) -> DataFrame:
    """A table, written by ``keep``, with one row per shard: its documents (or parts of them) and its FM-index.

    Words are runs of ASCII letters and digits and of all letters beyond ASCII, A-Z as a-z, told apart by 64 bits of
    hash. Phrases of up to ``longest`` words are found wherever they are. A NULL text has no words; ids may be NULL
    or repeated, since every row has a number of its own; an empty table gives an empty index.
    """
    step = max(1, shard_words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 36
        shard, docs, held, size = number, [], [], 0

        def row() -> pd.DataFrame:
            return pd.DataFrame([_index_row(shard, docs, held)], columns=[c.split()[0] for c in _INDEX.split(", ")])

        for batch in batches:
            for name, (hashes, _) in zip(batch["id"], words_of(batch["text"].tolist(), lower=True, gaps=GAPS)):
                for first in range(0, max(1, len(hashes)), step):
                    part = hashes[first : first + step + longest - 1]
                    docs.append((number, name, len(hashes), first, len(part)))
                    held.append(part)
                    size += len(part) + 1
                    if size >= shard_words:
                        yield row()
                        shard, docs, held, size = shard + 1, [], [], 0
                number += 1
        if docs:
            yield row()

    # ids travel as text, since pandas turns whole numbers with NULLs into floats
    plain = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return keep(plain.mapInPandas(run, _INDEX), "fm-index")


def _phrases(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (item, words): pieces of items that hold each of their windows, as packed hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, (words, _) in zip(batch["item"], words_of(batch["text"].tolist(), lower=True, gaps=GAPS)):
                for first in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE):
                    rows.append((item, words[first : first + PIECE + window - 1].astype("<u8").tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["item", "words"])

    plain = items.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInPandas(run, "item string, words binary").distinct()


def _blocks(items: DataFrame, item_col: str, text_col: str, window: int, query_words: int, keep: Keep) -> Iterator[pd.DataFrame]:
    """The pieces of all items in blocks of at most ``query_words`` words, or one piece."""
    pieces = keep(_phrases(items, item_col, text_col, window), "phrases").withColumn("n", F.length("words") / 8)
    total = pieces.agg(F.sum("n"), F.max("n")).first()
    if not total[0]:
        return
    parts = -(-int(total[0]) // query_words)
    while True:
        dealt = pieces.withColumn("part", F.pmod(F.xxhash64("item", "words"), F.lit(parts)))
        if parts == 1 or dealt.groupBy("part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= max(query_words, total[1]):
            break
        parts *= 2
    for part in range(parts):
        yield dealt.where(F.col("part") == part).select("item", "words").toPandas()


class _Queries:
    """Distinct phrases of one length, and the items (numbers) that each comes from."""

    def __init__(self, words: list[np.ndarray], items: list[np.ndarray]):
        flat, owner = np.concatenate(words), np.concatenate(items)
        both = np.unique(np.concatenate([flat, owner.astype(np.uint64)[:, None]], axis=1), axis=0)
        new = np.ones(len(both), bool)
        new[1:] = (both[1:, :-1] != both[:-1, :-1]).any(axis=1)
        self.items, self.starts = both[:, -1].astype(np.int64), np.append(np.flatnonzero(new), len(both))
        # few words make many phrases
        self.words, place = np.unique(both[new, :-1], return_inverse=True)
        self.phrases = place.reshape(-1, both.shape[1] - 1)

    def symbols(self, vocabulary: np.ndarray) -> np.ndarray:
        """The phrases by the numbers of their words in a shard, from 1; 0 stands for a word that it does not have."""
        at = np.minimum(np.searchsorted(vocabulary, self.words), len(vocabulary) - 1)
        return np.where(vocabulary[at] == self.words, at + 1, 0)[self.phrases]


def _queries(block: pd.DataFrame, window: int) -> tuple[list[_Queries], list[str]]:
    names = sorted(set(block["item"]))
    number = {name: i for i, name in enumerate(names)}
    by_length: dict[int, tuple[list, list]] = {}
    for item, data in zip(block["item"], block["words"]):
        words = np.frombuffer(data, "<u8")
        made = np.lib.stride_tricks.sliding_window_view(words, min(window, len(words)))
        phrases, owners = by_length.setdefault(made.shape[1], ([], []))
        phrases.append(made)
        owners.append(np.full(len(made), number[item]))
    return [_Queries(*held) for held in by_length.values()], names


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (``size`` numbers) for each entry, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def _hits(row, queries: list[_Queries]) -> tuple[np.ndarray, np.ndarray] | None:
    """Which words of a shard's sequence are hit, and distinct (part of a document, item)."""
    vocabulary = np.frombuffer(row.vocabulary, "<u8")
    if not len(vocabulary):
        return None
    index, edges, pairs = None, None, []
    heads = np.cumsum([0, *(s + 1 for s in row.size)])[:-1]
    for asked in queries:
        symbols = asked.symbols(vocabulary)
        known = np.flatnonzero((symbols > 0).all(axis=1))
        if not len(known):
            continue
        if index is None:
            counts, marks = np.frombuffer(row.counts, "<i4").astype(np.int64), np.frombuffer(row.marks, "<u8")
            index = FmIndex(np.frombuffer(row.levels, "<u8").reshape(-1, len(marks)), counts, marks, np.frombuffer(row.kept, "<i4"))
            edges = np.zeros(index.n + 1, np.int64)
        first, end = index.search(symbols[known])
        size = end - first
        known, first, size = known[size > 0], first[size > 0], size[size > 0]
        length, todo = asked.phrases.shape[1], np.cumsum(size)
        for low in range(0, int(todo[-1]) if len(todo) else 0, FOUND):
            # the occurrences low .. low + FOUND of all phrases together
            a = np.maximum(low - (todo - size), 0)
            some = np.minimum(low + FOUND - (todo - size), size) - a
            mine = some > 0
            a, some = a[mine], some[mine]
            place = index.locate(_expanded(first[mine] + a, some))
            np.add.at(edges, place, 1)
            np.add.at(edges, place + length, -1)
            part = np.searchsorted(heads, place, "right") - 1
            met = np.unique(np.stack([part, np.repeat(known[mine], some)]), axis=1)
            many = asked.starts[met[1] + 1] - asked.starts[met[1]]
            pairs.append(np.unique(np.stack([np.repeat(met[0], many), asked.items[_expanded(asked.starts[met[1]], many)]]), axis=1))
    return (np.cumsum(edges[:-1]) > 0, np.unique(np.concatenate(pairs, axis=1), axis=1)) if pairs else None


def search(index: DataFrame, block: pd.DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, begins, ends, items) of every part of a document with a phrase of the block: merged spans of words of
    the whole document, and the items whose phrases occur."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, names = _queries(block, window)
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (found := _hits(row, queries)) is None:
                    continue
                hit, (part, item) = found
                turn = np.diff(hit.astype(np.int8), prepend=0, append=0)
                begin, end = np.flatnonzero(turn > 0), np.flatnonzero(turn < 0)
                heads = np.cumsum([0, *(s + 1 for s in row.size)])[:-1]
                whose = np.searchsorted(heads, begin, "right") - 1
                rows = []
                for p in np.unique(part).tolist():
                    shift, mine = int(row.first[p]) - int(heads[p]), whose == p
                    some = [names[i] for i in item[part == p]]
                    rows.append((row.doc[p], (begin[mine] + shift).tolist(), (end[mine] + shift).tolist(), some))
                yield pd.DataFrame(rows, columns=["doc", "begins", "ends", "items"])

    return index.mapInPandas(run, "doc bigint, begins array<bigint>, ends array<bigint>, items array<string>")


def report(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, query_words: int = QUERY_WORDS,
) -> DataFrame:
    """One row per document: (id, n_words, n_hit, n_items, items_sha256, contaminated, spans).

    A phrase is ``window`` consecutive words of an item, or a shorter item as a whole; items without words have
    none. ``spans`` are the merged (begin, end) in words of all its occurrences, ``n_hit`` the words in them. Items
    are told apart by id (NULL as an empty name). NULL texts have no words; repeated rows are reported one by one;
    an empty benchmark finds nothing and an empty table gives no rows.
    """
    with scratch(docs.sparkSession, "decontaminate") as keep:
        index = build(docs, id_col, text_col, window, shard_words, keep)
        blocks = _blocks(benchmark, item_col, item_text_col, window, query_words, keep)
        found = [search(index, block, window) for block in blocks]
        told = written(_told(index, found), "leaks")
    return told.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumnRenamed("doc_id", id_col)


def _told(index: DataFrame, found: list[DataFrame]) -> DataFrame:
    """What was found in all blocks and parts, beside every document."""
    rows = index.select(F.explode(F.arrays_zip(*_DOCS)).alias("d")).where("d.first = 0").select("d.doc", "d.doc_id", F.col("d.words").alias("n_words"))
    if not found:
        found = [index.sparkSession.createDataFrame([], "doc bigint, begins array<bigint>, ends array<bigint>, items array<string>")]
    met = reduce(DataFrame.unionAll, found).groupBy("doc").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("begins", "ends")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # spans of several blocks or parts may overlap: each begins where all before it have ended
    merged = F.expr("""
        aggregate(spans, named_struct('n', 0L, 'end', -1L, 'spans', cast(array() AS array<struct<begin: bigint, end: bigint>>)), (held, s) ->
          named_struct(
            'n', held.n + greatest(0L, s.ends - greatest(s.begins, held.end)), 'end', greatest(s.ends, held.end),
            'spans', CASE WHEN s.begins > held.end THEN concat(held.spans, array(named_struct('begin', s.begins, 'end', s.ends)))
                          ELSE concat(slice(held.spans, 1, size(held.spans) - 1),
                                      array(named_struct('begin', element_at(held.spans, -1).begin, 'end', greatest(s.ends, held.end)))) END))
    """)
    met = met.select("doc", merged.alias("m"), "items")
    n_hit = F.coalesce("m.n", F.lit(0)).cast("bigint")
    return rows.join(met, "doc", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("m.spans", F.expr("cast(array() AS array<struct<begin: bigint, end: bigint>>)")).alias("spans"),
    )
