"""Phrases that occur together, from suffix trees cut at a depth and parted by word prefixes.

The words of a language form one text, in which a piece ends at punctuation. Its suffix tree, three words deep, is
never built whole:

1. One pass counts the words. Words below the threshold end a piece as well, since no phrase that counts holds one.
2. Prefixes are grouped so that a group has about BUDGET occurrences: a word's suffixes go to one group, those of a
   word that is too frequent are told apart by the second word, and those of too frequent pairs by the third.
3. Each task turns its text into suffixes with their counts, one packed block per group. A group merges its blocks
   into the leaves of its subtree in order, and the total of the leaves below a node is the count of its phrase.

Which words are rare, and which words and pairs too frequent for one group, is known to every task as a bitmap of
fixed size. A word whose bit is set by another one only costs some work: its suffixes are kept though it is rare,
or spread though it is not.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import Keep, scratch, written
from .words import mix

DEPTH = 3  # words of the longest phrase
LEAST = 10  # occurrences of a phrase that counts
SHARE = 50  # percent of a phrase's occurrences inside a longer one that make it part of that
TOP = 2000
BUDGET = 1 << 22  # occurrences that a group may have
FLUSH = 1 << 20  # words turned into suffixes at a time
FILTER = 1 << 23  # bits of each bitmap
BLOCK = 1 << 20  # bytes of a text cut into words at a time

_CUT = b"\n"
_PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _CUT * 10 + b" ")
_PAGE = 32768  # bits that Spark packs into one bitmap


def _words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in a few lists, with _CUT where a piece ends."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().translate(_PLAIN)
    at = 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            ends = [e for e in (data.find(b" ", end), data.find(_CUT, end)) if e >= 0]
            end = min(ends, default=len(data))
        yield [w for w in data[at:end].replace(_CUT, b" \n ").split(b" ") if w]
        at = end


def _word_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def told() -> Iterator[pd.DataFrame]:
            for lang, counter in held.items():
                counter.pop(_CUT, None)
                yield pd.DataFrame({"lang": lang, "word": list(counter), "n": list(counter.values())})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                counter = held.setdefault(lang, Counter())
                for words in _words(text):
                    counter.update(words)
            if sum(map(len, held.values())) > FLUSH:
                yield from told()
        yield from told()

    counted = texts.mapInPandas(run, "lang string, word binary, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _slot(lang: Column, *words: Column) -> Column:
    """The bit of a prefix; ``_Known`` computes the same."""
    parts = [lang.cast("binary")]
    for word in words:
        parts += [F.lit(b"\0"), word]
    return F.crc32(F.concat(*parts)) % FILTER


def _bitmap(slots: DataFrame) -> np.ndarray:
    """Whether each of FILTER bits is named in the column ``slot``; at most FILTER / 8 bytes reach the driver."""
    one = F.col("slot") + 1  # Spark's bitmaps count from 1
    pages = slots.groupBy(F.bitmap_bucket_number(one).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
    out = np.zeros(FILTER, bool)
    for row in pages.collect():
        low = (row["page"] - 1) * _PAGE
        out[low : low + _PAGE] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
    return out


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits).view(bool)


class _Known(dict):
    """Numbers of the words of one language, from 1; 0 stands for rare words and the end of a piece."""

    def __init__(self, lang: str, often: np.ndarray):
        super().__init__({_CUT: 0})
        self.begin, self.often = zlib.crc32(b"\0", zlib.crc32(lang.encode("utf-8", "surrogatepass"))), often
        self.words, self.marks = [b""], [0]

    def __missing__(self, word: bytes) -> int:
        mark = zlib.crc32(word, self.begin)
        number = 0
        if self.often[mark % FILTER]:
            number = len(self.words)
            self.words.append(word)
            self.marks.append(mark)
        self[word] = number
        return number

    def pair_slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        tails = [b"\0" + w for w in self.words]
        marks = self.marks
        return np.fromiter((zlib.crc32(tails[y], marks[x]) % FILTER for x, y in zip(a.tolist(), b.tolist())), np.int64, len(a))


class _Text:
    """The words of one language that a task holds at a time, as numbers."""

    def __init__(self, lang: str, often: np.ndarray):
        self.lang, self.often = lang, often
        self.carry: list[bytes] = []
        self._reset()

    def _reset(self) -> None:
        self.known = _Known(self.lang, self.often)
        first = list(map(self.known.__getitem__, self.carry))
        self.parts, self.size = [np.array(first, np.int64)], len(first)

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        self.size += len(words)
        self.carry = (self.carry + words[-DEPTH:])[1 - DEPTH :]

    def end(self) -> None:
        self.add([_CUT] * (DEPTH - 1))

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, _Known]:
        """Distinct suffixes, one row of DEPTH numbers each with 0 behind the end, and how often each occurs.

        The last words are left for next time, when it is known what follows them.
        """
        flat = np.concatenate(self.parts)
        n = max(0, len(flat) - (DEPTH - 1))
        key, going = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(DEPTH):
            now = np.where(going, flat[k : k + n], 0)
            going = now > 0
            key = key << 21 | now
        key, many = np.unique(key[key > 0], return_counts=True)
        known = self.known
        self._reset()
        mask = (1 << 21) - 1
        return np.stack([key >> 21 * (DEPTH - 1 - k) & mask for k in range(DEPTH)], axis=1), many, known


def _texts(batches: Iterator[pd.DataFrame], often: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray, _Known]]:
    """(language, suffixes, counts, words) of about FLUSH words at a time."""
    held: dict[str, _Text] = {}

    def told(some: list[_Text]) -> Iterator[tuple]:
        for text in some:
            suffixes, many, known = text.suffixes()
            if len(many):
                yield text.lang, suffixes, many, known

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            mine = held.setdefault(lang, _Text(lang, often))
            for words in _words(text):
                mine.add(words)
                if mine.size >= FLUSH:
                    yield from told([mine])
            mine.end()
        if sum(t.size for t in held.values()) >= FLUSH:
            yield from told(list(held.values()))
            held.clear()
    yield from told(list(held.values()))


def _pair_counts(texts: DataFrame, often: np.ndarray, crowded: np.ndarray) -> DataFrame:
    """(slot, n): how often the pairs in each slot occur that begin with a crowded word."""
    sent = [np.packbits(b) for b in (often, crowded)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, crowded = map(_unpacked, sent)
        for _, suffixes, many, known in _texts(batches, often):
            first = crowded[np.array(known.marks) % FILTER][suffixes[:, 0]] & (suffixes[:, 1] > 0)
            pairs, place = np.unique(suffixes[first, 0] << 21 | suffixes[first, 1], return_inverse=True)
            if len(pairs):
                slots = known.pair_slots(pairs >> 21, pairs & ((1 << 21) - 1))
                yield pd.DataFrame({"slot": slots, "n": np.bincount(place, many[first]).astype(np.int64)})

    return texts.mapInPandas(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))


def _blocks(texts: DataFrame, often: np.ndarray, crowded: np.ndarray, crowded_pairs: np.ndarray, groups: int) -> DataFrame:
    """(group, lang, reach, words, leaves): suffixes and their counts, numbered by the words of the block.

    ``reach`` is how many words of a suffix say which group it is in.
    """
    sent = [np.packbits(b) for b in (often, crowded, crowded_pairs)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, crowded, crowded_pairs = map(_unpacked, sent)
        for lang, suffixes, many, known in _texts(batches, often):
            marks = np.array(known.marks, np.uint64)
            reach = np.where(crowded[(marks % np.uint64(FILTER)).astype(np.int64)][suffixes[:, 0]], 2, 1)
            spread = np.flatnonzero((reach == 2) & (suffixes[:, 1] > 0))
            pairs, place = np.unique(suffixes[spread, 0] << 21 | suffixes[spread, 1], return_inverse=True)
            if len(pairs):
                over = crowded_pairs[known.pair_slots(pairs >> 21, pairs & ((1 << 21) - 1))]
                reach[spread[over[place]]] = 3
            deal = mix(marks[suffixes[:, 0]])
            for k in range(1, DEPTH):
                deal = np.where(reach > k, mix(deal + marks[suffixes[:, k]]), deal)
            group = (deal % np.uint64(groups)).astype(np.int64) * DEPTH + reach - 1
            order = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.diff(group[order], prepend=-1)).tolist() + [len(order)]
            words = np.array(known.words, object)
            rows = []
            for a, b in zip(edges, edges[1:]):
                mine = order[a:b]
                own, place = np.unique(suffixes[mine], return_inverse=True)
                leaves = np.concatenate([place.reshape(-1, DEPTH) + (own[0] > 0), many[mine, None]], axis=1)
                names = b" ".join(words[own[own > 0]].tolist())
                rows.append((int(group[mine[0]]) // DEPTH, lang, int(reach[mine[0]]), names, leaves.astype("<u4").tobytes()))
            for i in range(0, len(rows), 512):
                yield pd.DataFrame(rows[i : i + 512], columns=["group", "lang", "reach", "words", "leaves"])

    return texts.mapInPandas(run, "group bigint, lang string, reach int, words binary, leaves binary")


def _subtree(words: list[bytes], leaves: list[bytes], reach: int, least: int) -> pd.DataFrame:
    """(phrase, size, n) of the nodes of a group's subtree that count, and of all that other groups have a part of."""
    number: dict[bytes, int] = {b"": 0}
    told = []
    for names, data in zip(words, leaves):
        local = np.array([0, *(number.setdefault(w, len(number)) for w in names.split(b" "))], np.int64)
        rows = np.frombuffer(data, "<u4").reshape(-1, DEPTH + 1).astype(np.int64)
        rows[:, :DEPTH] = local[rows[:, :DEPTH]]
        told.append(rows.astype(np.uint32))
    flat = np.concatenate(told)
    del told
    flat = flat[np.lexsort([flat[:, k] for k in reversed(range(DEPTH))])]
    names = np.array(list(number), object)
    new = np.zeros(len(flat), bool)
    new[0] = True
    made = []
    for depth in range(1, DEPTH + 1):
        # a node begins where one of its words differs from the leaf before
        new[1:] |= flat[1:, depth - 1] != flat[:-1, depth - 1]
        starts = np.flatnonzero(new)
        total = np.add.reduceat(flat[:, DEPTH].astype(np.int64), starts)
        nodes = flat[starts, :depth]
        wanted = nodes[:, -1] > 0
        if depth >= reach:
            wanted &= total >= least
        nodes, total = nodes[wanted], total[wanted]
        phrase = names[nodes[:, 0]]
        for k in range(1, depth):
            phrase = phrase + b" " + names[nodes[:, k]]
        made.append(pd.DataFrame({"phrase": phrase, "size": depth, "n": total}))
    return pd.concat(made)


def _phrases(texts: DataFrame, words: DataFrame, least: int, budget: int, keep: Keep) -> DataFrame:
    """(lang, phrase, size, n) of all phrases of up to DEPTH words that occur ``least`` times or more."""
    slot = _slot(F.col("lang"), F.col("word"))
    frequent = words.where(F.col("n") >= least).withColumn("slot", slot)
    often = _bitmap(frequent.select("slot"))
    total = frequent.agg(F.sum("n")).first()[0] or 0
    most = max(least, budget // 4)
    crowded = _bitmap(frequent.where(F.col("n") > most).select("slot"))
    pairs = np.zeros(FILTER, bool)
    if crowded.any():
        pairs = _bitmap(_pair_counts(texts, often, crowded).where(F.col("n") > most).select("slot"))
    blocks = _blocks(texts, often, crowded, pairs, max(1, -(-2 * total // budget)))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        made = []
        for (lang, reach), part in group.groupby(["lang", "reach"]):
            made.append(_subtree(part["words"].tolist(), part["leaves"].tolist(), reach, least).assign(lang=lang))
        return pd.concat(made)[["lang", "phrase", "size", "n"]]

    nodes = blocks.groupBy("group").applyInPandas(grow, "lang string, phrase binary, size int, n bigint")
    merged = nodes.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return keep(merged.withColumn("phrase", F.col("phrase").cast("string")), "phrases")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, share: int = SHARE,
    top: int = TOP, budget: int = BUDGET,
) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A-Z count as a-z; texts are cut at ``.,;:!?`` and line ends and, inside, at blanks and tabs. ``a``, ``l`` and
    ``r`` are the occurrences of a phrase of 2 or 3 words and of its first and second part, ``n`` those of all words
    of the language. The score is 1000000 a a / (l r), rounded down, of the cut where it is least (the first of
    equal ones). Phrases with fewer than ``least`` occurrences do not count, and those that lie in a longer one in
    ``share`` percent of their occurrences or more are left out. Equal scores rank by ``a``, then by phrase. A NULL
    language counts as ``und``, a NULL text as empty; repeated rows count each; an empty table gives no rows.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    with scratch(docs.sparkSession, "collocations") as keep:
        words = keep(_word_counts(texts), "words")
        phrases = _phrases(texts, words, least, budget, keep)
        sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
        return written(_ranked(phrases, sizes, share, top), "collocations")


def _ranked(phrases: DataFrame, sizes: DataFrame, share: int, top: int) -> DataFrame:
    parts = F.split("phrase", " ")
    joined = lambda a, n: F.array_join(F.slice(parts, a, n), " ")
    cut = lambda k, rest: F.struct(F.lit(k).alias("k"), joined(1, k).alias("first"), joined(k + 1, rest).alias("rest"))
    cuts = F.when(F.col("size") == 2, F.array(cut(1, 1))).otherwise(F.array(cut(1, 2), cut(2, 1)))
    asked = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "size", "a", "c.*")
    count = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    asked = asked.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"])
    whole = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    # 38 digits hold the products as long as no phrase occurs more than 10 ** 16 times
    above = (whole["a"] * whole["a"]).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    asked = asked.withColumn("above", above.cast("decimal(38,0)")).withColumn("below", (whole["l"] * whole["r"]).cast("decimal(38,0)"))
    asked = asked.withColumn("score", F.expr("above div below"))
    least = asked.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    scored = least.select("lang", "phrase", "size", "a", "m.l", "m.r", "m.score")
    inside = phrases.where(f"size = {DEPTH}").select("lang", F.col("n").alias("longer"), F.explode(F.array(joined(1, 2), joined(2, 2))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = scored.join(inside, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {share} * a")
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the first of each of many shares of a language, then the first of these
    share_of = F.pmod(F.xxhash64("phrase"), F.lit(int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    part = free.withColumn("part", share_of)
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by))).where(F.col("rank") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    best = best.join(sizes, "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
