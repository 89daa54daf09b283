"""Packing texts into windows of fixed size with lexical neighbours side by side.

Texts are put in an order by content (``content_order.py``), which is cut into shards of about equal tokens, so
the neighbours of a text mostly lie in its shard however many shards there are. A shard has a BM25 inverted
index over its texts, weighted with the document frequencies of the whole corpus. The next unused text seeds a window; the index
returns the unused texts nearest to it, which fill the window in that order. The text that no longer fits is
cut and its rest opens the next window, so only the last window of a shard is not full.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import content_order
from .batch_bpe import BatchBpe
from .bpe import WordBpe, read_vocabulary
from .merges import once_per_worker, trim
from .store import written

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 18
K1, B = 1.2, 0.75
RANGES = 1 << 11  # parts of the order that are cut from the driver
SAMPLE = 1 << 15  # texts that the order is learnt from
FAN = 256  # parts that each of these, and each of theirs, is cut into while it is more than a shard
GROUP_SAMPLE = 1 << 13  # texts that the order of such a part is learnt from
TASK_SHARDS = 256  # shards that pass through a task while they are cut
_DEALT = "doc_id string, ids binary, salt bigint, row bigint, group bigint"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END) -> DataFrame:
    """Rows (doc_id as text, doc_tokens, ids) of all texts, and rows (term, docs): in how many texts of a task
    each id occurs. The ids are unsigned 16-bit numbers, the end id included."""
    data = read_vocabulary(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = once_per_worker(("batch_bpe", len(data), zlib.crc32(data)), lambda: BatchBpe(WordBpe(data)))
        last = np.array([end], np.uint16).tobytes()
        counts = np.zeros(1 << 16, np.int64)
        try:
            for batch in batches:
                ids = [made + last for made in bpe.packed(batch["text"].tolist())]
                for text in ids:
                    counts[np.unique(np.frombuffer(text, np.uint16))] += 1
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"], "doc_tokens": [len(x) // 2 for x in ids], "ids": ids, "term": None, "docs": None,
                })
        finally:
            bpe.release()
            trim()
        terms = np.flatnonzero(counts)
        yield pd.DataFrame({"doc_id": None, "doc_tokens": None, "ids": None, "term": terms, "docs": counts[terms]})

    # ids travel as text, since pandas turns whole numbers with NULLs into floats
    plain = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInPandas(run, "doc_id string, doc_tokens bigint, ids binary, term int, docs bigint")


def bm25(ids: np.ndarray, idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a text and their BM25 weights in it."""
    own, tf = np.unique(ids, return_counts=True)
    return own, idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))


class Index:
    """BM25 over the texts of one shard."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        self.terms = []
        terms, owners, weights = [], [], []
        for i, ids in enumerate(texts):
            own, weight = bm25(ids, idf, mean)
            self.terms.append(own)
            terms.append(own)
            owners.append(np.full(len(own), i, np.int32))
            weights.append(weight)
        flat = np.concatenate(terms)
        order = np.argsort(flat, kind="stable")
        self.owners, self.weights = np.concatenate(owners)[order], np.concatenate(weights)[order]
        self.starts = np.searchsorted(flat[order], np.arange((1 << 16) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Score of every text of the shard for the terms of one of them."""
        begin, end = self.starts[self.terms[seed]], self.starts[self.terms[seed].astype(np.int64) + 1]
        size = end - begin
        at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
        return np.bincount(self.owners[at], self.weights[at], minlength=len(self.terms))


def fill(texts: list[np.ndarray], index: Index, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(text, start, length, sequence, offset) of every piece, in order."""
    out, unused = [], np.ones(len(texts), bool)
    rest: tuple[int, int] | None = None
    sequence = following = 0
    while True:
        if rest is None:
            while following < len(texts) and not unused[following]:
                following += 1
            if following == len(texts):
                return out
            rest, unused[following] = (following, 0), False
        seed, room = rest[0], window
        near: Iterator[int] = iter(())
        asked = False
        while room:
            if rest is None:
                if not asked:
                    open_ = np.flatnonzero(unused)
                    near = iter(open_[np.argsort(-index.scores(seed)[open_], kind="stable")].tolist()) if len(open_) else near
                    asked = True
                if (text := next(near, None)) is None:
                    break
                rest, unused[text] = (text, 0), False
            text, start = rest
            length = min(room, len(texts[text]) - start)
            out.append((text, start, length, sequence, window - room))
            room -= length
            rest = (text, start + length) if start + length < len(texts[text]) else None
        sequence += 1


def _sketches(ids: list[bytes], idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    made = [bm25(np.frombuffer(b, np.uint16), idf, mean) for b in ids]
    projection = once_per_worker("signs", content_order.signs)
    return content_order.sketches([m[0] for m in made], [m[1] for m in made], projection)


def _keys(tree: content_order.Tree, vectors: np.ndarray, least: np.ndarray, group: pd.DataFrame) -> np.ndarray:
    # a run of one leaf and term is told apart by hash, and equal rows by their place
    return np.stack([tree.leaves(vectors), least, group["salt"].to_numpy(np.int64), group["row"].to_numpy(np.int64)])


def _sketched(texts: DataFrame, share: int, idf: np.ndarray, mean: float) -> DataFrame:
    """The vectors of about ``share`` in 2**20 of the texts, with the group they are in."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors, least = _sketches(batch["ids"].tolist(), idf, mean)
                tokens = batch["ids"].str.len() // 2
                yield pd.DataFrame({
                    "group": batch["group"], "salt": batch["salt"], "row": batch["row"], "least": least, "tokens": tokens,
                    "vector": [v.tobytes() for v in vectors],
                })

    picked = texts.where(F.pmod(F.xxhash64(F.lit("pick"), "group", "salt", "row"), F.lit(1 << 20)) < share)
    return picked.mapInPandas(sketch, "group bigint, salt bigint, row bigint, least bigint, tokens bigint, vector binary")


def _learned(seen: pd.DataFrame, parts: int) -> tuple[content_order.Tree, np.ndarray]:
    """An order learnt from some texts, and where it is cut into ``parts`` parts of about equal tokens."""
    seen = seen.sort_values(["salt", "row"], kind="stable")
    vectors = np.frombuffer(b"".join(seen["vector"]), np.float32).reshape(-1, content_order.DIM)
    tokens = seen["tokens"].to_numpy(np.int64)
    tree = content_order.grow(vectors, tokens, tokens.sum() / parts / 4)
    return tree, content_order.cut(tree, _keys(tree, vectors, seen["least"].to_numpy(np.int64), seen), tokens, parts)


def _first_level(texts: DataFrame, n: int, parts: int, idf: np.ndarray, mean: float) -> DataFrame:
    """``texts`` in ``parts`` groups of the order by content, of about equal tokens.

    The order is learnt from at most about SAMPLE texts, of which 64 numbers each reach the driver.
    """
    tree, cuts = _learned(_sketched(texts, min(1 << 20, (SAMPLE << 20) // n), idf, mean).toPandas(), parts)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keys = _keys(tree, *_sketches(batch["ids"].tolist(), idf, mean), batch)
                yield batch.assign(group=content_order.place(keys, cuts))

    return texts.mapInPandas(deal, _DEALT)


def _next_level(texts: DataFrame, n: int, groups: int, tasks: int, shard_tokens: int, idf: np.ndarray, mean: float) -> DataFrame:
    """Each group cut into at most FAN groups by an order of its own, learnt from about GROUP_SAMPLE of its texts.

    The orders never leave the executors: the one of a group is a row that comes before the group's texts in each
    of the ``tasks`` tasks that they are dealt to.
    """
    sizes = texts.groupBy("group").agg(F.sum(F.length("ids") / 2).alias("all"))
    parts = F.least(F.lit(FAN), F.greatest(F.lit(1), F.round(F.col("all") / shard_tokens))).cast("int").alias("parts")
    seen = _sketched(texts, min(1 << 20, (GROUP_SAMPLE * groups << 20) // n), idf, mean)
    seen = seen.join(sizes.select("group", parts), "group").where("parts > 1")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        tree, cuts = _learned(group, int(group["parts"].iloc[0]))
        return pd.DataFrame({"group": group["group"].iloc[:1], "ids": [pickle.dumps((tuple(tree), cuts))]})

    orders = seen.groupBy("group").applyInPandas(learn, "group bigint, ids binary")
    orders = orders.select(
        F.lit(None).cast("string").alias("doc_id"), "ids", F.lit(0).cast("bigint").alias("salt"), F.lit(-1).cast("bigint").alias("row"), "group",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tasks - 1).cast("bigint"))).alias("task"),
    )
    both = orders.unionByName(texts.withColumn("task", F.pmod("salt", F.lit(tasks))))
    both = both.repartition("group", "task").sortWithinPartitions("group", "task", "row")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, tree, cuts = None, None, None
        for batch in batches:
            for group, part in batch.groupby("group", sort=False):
                if group != now:
                    now, tree = group, None
                if (order := part["row"].to_numpy() < 0).any():
                    parts, cuts = pickle.loads(part["ids"].to_numpy()[order][-1])
                    tree = content_order.Tree(*parts)
                    part = part[~order]
                if not len(part):
                    continue
                place = 0 if tree is None else content_order.place(_keys(tree, *_sketches(part["ids"].tolist(), idf, mean), part), cuts)
                yield part.assign(group=group * FAN + place)[["doc_id", "ids", "salt", "row", "group"]]

    return both.mapInPandas(deal, _DEALT)


def _sharded(texts: DataFrame, n: int, shards: int, shard_tokens: int, idf: np.ndarray, mean: float) -> DataFrame:
    """``texts`` with their shard as ``group``: cut once into RANGES parts at most, and these again until each is a shard."""
    texts = texts.withColumn("group", F.lit(0).cast("bigint"))
    if shards == 1:
        return texts
    groups = min(shards, RANGES)
    texts = _first_level(texts, n, groups, idf, mean)
    while groups < shards:
        texts = written(texts, "dealt")
        texts = _next_level(texts, n, groups, max(1, shards // groups // TASK_SHARDS), shard_tokens, idf, mean)
        groups *= FAN
    return texts


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END,
    window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: (id, start, length, doc_tokens, sequence_id, offset, ids).

    ``ids`` are the ids of the piece as little-endian unsigned 32-bit numbers. Every id of every text lies in
    exactly one piece; a sequence has no gaps. NULL and empty texts consist of the end id. Rows with equal or
    NULL ids are packed like any others. The number of shards grows with the tokens; a text longer than a
    shard is still one row. A task packs one shard at a time, however many there are. Document frequencies, one
    number per entry of the vocabulary, two totals, and the vectors of at most about SAMPLE texts reach the driver.
    """
    made = written(encode(docs, id_col, text_col, path, end), "encoded")
    encoded = made.where("ids is not null").select("doc_id", "doc_tokens", "ids")
    total = encoded.agg(F.count(F.lit(1)).alias("n"), F.sum("doc_tokens").alias("tokens")).first()
    n, tokens = total["n"], total["tokens"] or 0
    found = np.zeros(1 << 16)
    # no more rows than the vocabulary has entries
    for row in made.where("term is not null").groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        found[row["term"]] = row["docs"]
    idf = np.log1p((n - found + 0.5) / (found + 0.5)).astype(np.float32)
    mean = tokens / max(n, 1)
    shards = max(1, -(-tokens // shard_tokens))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "ids"], kind="stable")
        texts = [np.frombuffer(b, np.uint16) for b in group["ids"]]
        shard, ids = int(group["group"].iloc[0]), group["doc_id"].tolist()
        rows = [
            (ids[t], start, length, len(texts[t]), (shard << 32) + seq, offset, texts[t][start : start + length].astype("<u4").tobytes())
            for t, start, length, seq, offset in fill(texts, Index(texts, idf, mean), window)
        ]
        del texts, group
        trim()
        return pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    texts = encoded.select("doc_id", "ids", F.xxhash64("doc_id", "ids").alias("salt"), F.monotonically_increasing_id().alias("row"))
    pieces = _sharded(texts, n, shards, shard_tokens, idf, mean).groupBy("group").applyInPandas(
        run, "doc_id string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
    kind = docs.schema[id_col].dataType
    return pieces.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumnRenamed("doc_id", id_col)


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum instead of the ids themselves."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
