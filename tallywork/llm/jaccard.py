"""N-gram Jaccard self-join with token-combination prefixes.

The tokens of a text are its distinct n-word shingles. Two sets with Jaccard similarity of at least t share
all but floor((1 - t) n) tokens of either, so any token order gives prefixes that must share something. The
order is by document frequency, rarest first: tokens of a single set come first and need not be indexed at
all. Rare tokens are indexed alone. Frequent tokens are dealt to groups by their hash and indexed as pairs
within a group; a group with c of them counts for c - 1 towards the prefix, which is extended accordingly.

1. One pass takes each text's set size and fingerprint; equal sets are one set from then on. Tokens that are
   so common that their postings would crowd one task are found here (at most HOT of them).
2. A second pass sends the tokens of each set that come first by hash, some 3 in 10, with 12 bytes each whatever
   the number of hash ranges. Similar sets share a known number of them; a set that shares fewer with all others
   together has no partner and is done.
3. All postings of the other sets go to hash ranges as packed blocks, one per range and batch.
   A range counts each token's sets and answers with the tokens that several sets share. Sets with too few shared
   tokens can have no partner.
4. Prefix signatures of the remaining sets form buckets. In a bucket, members are verified against its leader,
   and verified links are contracted to components. Buckets that still hold several components form clusters,
   in which the sets outside the largest component are compared with all others, block by block. Nothing is
   left out: every candidate pair is verified or lies within one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallywork.operators.tables import spread_join

from .components import components
from .merges import trim
from .store import Keep, scratch, written
from .words import mix, shingle_set, words_of

N = 5
PERCENT = 80
HOT = 1 << 17  # tokens known to every task, 1 MB; a token is one only if it makes up that part of all tokens
MIN_HOT = 16
RARE = 16  # sets; tokens of more are indexed in pairs
RANGE_TOKENS = 1_500_000  # postings that one range should hold
BATCH_TOKENS = 600_000  # tokens packed at a time
STAR_ROUNDS = 1
BLOCK = 512  # sets compared with as many others at a time
COLUMNS = 4096  # tokens looked at together when blocks are compared
_KEY = 12  # bytes of a set's fingerprint
_TAG = 6  # of them in the first tokens' postings; sets that agree in these go on unseen
_MARKS = 26  # bits; a bitmap of 8 MB at most tells which texts go on, and a few more when it is crowded
_LOW = np.uint64((1 << 48) - 1)
_MOST = 65535
_BITS = 30  # of a range's number


def _deal(keys: np.ndarray) -> np.ndarray:
    """A number below 2**32 for each set, by its key."""
    return np.ascontiguousarray(keys[:, :4]).view("<u4").ravel().astype(np.int64)


def slack(n, percent: int = PERCENT):
    """Most tokens of a set of n that a similar set may lack."""
    return n - (-(-n * percent // 100))


def _reach(n, percent: int = PERCENT):
    return np.minimum(n - slack(n, percent), slack(n, percent) // 2 + 8)


def firsts(n, percent: int = PERCENT):
    """How many tokens of a set of n, first by hash, are looked at before all others."""
    return slack(n, percent) + _reach(n, percent)


def needed(n, percent: int = PERCENT):
    """How many of its first tokens a set of n shares at least with the first ones of any similar set.

    At most slack(n) tokens of a set come before its k-th common one and are not common, so the k-th common token
    is among the first slack(n) + k, in either set. A similar set has n - slack(n) tokens or more.
    """
    return _reach(n - slack(n, percent), percent)


def similar(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (a + b - common)


def _sets(batches: Iterator[pd.DataFrame], n: int) -> Iterator[tuple[list, list[np.ndarray], list[bytes]]]:
    """(ids, token sets, fingerprints) of about BATCH_TOKENS tokens at a time."""
    ids, sets, keys, size = [], [], [], 0
    for batch in batches:
        texts = [t if isinstance(t, str) else None for t in batch["text"]]
        for i, (words, _) in zip(batch["id"], words_of(texts, lower=True)):
            made = shingle_set(words, n)
            ids.append(i)
            sets.append(made)
            keys.append(hashlib.blake2b(made.tobytes(), digest_size=_KEY).digest())
            size += len(made)
            if size >= BATCH_TOKENS:
                yield ids, sets, keys
                ids, sets, keys, size = [], [], [], 0
    if ids:  # Arrow cannot tell the kind of an empty column of text
        yield ids, sets, keys


def _survey(texts: DataFrame, n: int) -> DataFrame:
    """Rows (id, mark, size, key) of all texts, and (token, sets) of tokens that are common within a batch."""

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": list(zip(batch["id"], batch["mark"])), "text": batch["text"]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for names, sets, keys in _sets(named(batches), n):
            ids, marks = zip(*names)
            yield pd.DataFrame({
                "id": ids, "mark": marks, "size": [len(s) for s in sets], "key": keys, "token": None, "sets": None,
            })
            once = dict(zip(keys, sets))
            if once:
                tokens, many = np.unique(np.concatenate(list(once.values())), return_counts=True)
                common = many >= max(2, len(tokens) // HOT)
                yield pd.DataFrame({
                    "id": None, "mark": None, "size": None, "key": None,
                    "token": tokens[common].view(np.int64), "sets": many[common].astype(np.int64),
                })
            del names, ids, marks, sets, keys, once
        trim()

    return texts.mapInPandas(run, "id string, mark bigint, size bigint, key binary, token bigint, sets bigint")


def _is_in(hot: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(tokens), bool)
    at = np.searchsorted(hot, tokens)
    return hot[np.minimum(at, len(hot) - 1)] == tokens


def _packed(numbers: np.ndarray) -> np.ndarray:
    """The last six bytes of each number, first to last."""
    return np.ascontiguousarray(numbers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:])


def _unpacked(parts: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.int64)


def _first_postings(texts: DataFrame, n: int, percent: int, bits: int, hot: np.ndarray) -> DataFrame:
    """Blocks (range, tags, tokens): the first tokens of all sets, each with the tag of its set.

    The order is by the whole hash and the range by its last bits, so ranges are even. Ranges from 2**bits on hold
    the number of hot tokens among the first ones of a set, dealt by its tag.
    """
    ranges = 1 << bits

    def blocks_of(place: np.ndarray, tags: np.ndarray, told: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(place, kind="stable")
        place, tags, told = place[order], _packed(tags[order]), told[order]
        edges = np.flatnonzero(np.diff(place, prepend=-1)).tolist() + [len(place)]
        for a, b in zip(edges, edges[1:]):
            yield int(place[a]), tags[a:b].tobytes(), told[a:b].tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets, names in _sets(batches, n):
            once = {k: s[: firsts(len(s), percent)] for k, s in zip(names, sets) if len(s) >= 4}
            if not once:
                continue
            tags = _unpacked(pd.Series([k[:_TAG] for k in once]))
            many = np.array([len(s) for s in once.values()])
            tokens, owner = np.concatenate(list(once.values())), np.repeat(np.arange(len(tags), dtype=np.int32), many)
            del sets, names, once
            known = _is_in(hot, tokens)
            place, rest = (tokens & np.uint64(ranges - 1)).astype(np.int64)[~known], _packed(tokens[~known] >> np.uint64(bits))
            rows = list(blocks_of(place, tags[owner[~known]], rest))
            if known.any():
                hits = np.bincount(owner[known], minlength=len(tags))
                has = hits > 0
                rows += blocks_of(ranges + tags[has] % ranges, tags[has], hits[has].astype("<u4"))
            del tokens, owner, known, place, rest
            for i in range(0, len(rows), 1024):
                yield pd.DataFrame(rows[i : i + 1024], columns=["range", "tags", "tokens"])
            del rows
        trim()

    return texts.mapInPandas(run, "range bigint, tags binary, tokens binary")


def _first_shared(postings: DataFrame, bits: int) -> DataFrame:
    """Rows (tag, shared): how many of the first tokens in a range a set shares with another one."""
    ranges = 1 << bits

    def count(group: pd.DataFrame) -> pd.DataFrame:
        tags = _unpacked(group["tags"])
        if int(group["range"].iloc[0]) >= ranges:
            hits = np.frombuffer(b"".join(group["tokens"]), "<u4").astype(np.int64)
            tags, first = np.unique(tags, return_index=True)
            return pd.DataFrame({"tag": tags, "shared": hits[first]})
        tokens = _unpacked(group["tokens"])
        del group
        order = np.lexsort((tags, tokens))
        tags, tokens = tags[order], tokens[order]
        del order
        # each set once, though several batches may hold it
        keep = (np.diff(tokens, prepend=-1) != 0) | (np.diff(tags, prepend=-1) != 0)
        tags, tokens = tags[keep], tokens[keep]
        runs = np.diff(np.flatnonzero(np.diff(tokens, prepend=-1)), append=len(tokens))
        tags, shared = np.unique(tags[np.repeat(runs > 1, runs)], return_counts=True)
        del tokens, keep, runs
        trim()
        return pd.DataFrame({"tag": tags, "shared": shared})

    return postings.groupBy("range").applyInPandas(count, "tag bigint, shared bigint")


def _promising(
    texts: DataFrame, sets: DataFrame, n: int, percent: int, hot: np.ndarray, range_bits: Callable[[int], int], keep: Keep,
) -> DataFrame:
    """(mark, size) of the sets whose first tokens leave room for a similar set."""

    def lacks(n: Column) -> Column:  # as slack()
        return F.floor(n * (100 - percent) / 100)

    def reach(n: Column) -> Column:  # as _reach()
        return F.least(n - lacks(n), F.floor(lacks(n) / 2) + 8)

    size = F.col("size")
    tag = F.conv(F.hex(F.substring("key", 1, _TAG)), 16, 10).cast("bigint")
    sized = sets.where("size >= 4").select("mark", "size", tag.alias("tag"), reach(size - lacks(size)).alias("need"))
    bits = range_bits(sized.agg(F.sum(lacks(size) + reach(size))).first()[0] or 0)
    counted = _first_shared(_first_postings(texts, n, percent, bits, hot), bits)
    shared = keep(counted.groupBy("tag").agg(F.sum("shared").alias("shared")), "first-shared")
    twins = sized.groupBy("tag").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    told = sized.join(shared, "tag", "left").join(twins, "tag", "left")
    return keep(told.where("shared >= need or sets > 1").select("mark", "size"), "promising")


def _marked(promising: DataFrame, many: int) -> np.ndarray:
    """A bitmap of the marks in 64-bit words, of 16 to 32 bits for each as long as it stays within 2**_MARKS bits."""
    bits = min(_MARKS, max(10, (16 * many).bit_length()))
    at = promising.select(F.expr(f"mark & {(1 << bits) - 1}").alias("at"))
    words = at.groupBy(F.expr("shiftright(at, 6)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def _postings(texts: DataFrame, n: int, bits: int, hot: np.ndarray, marked: np.ndarray) -> DataFrame:
    """Blocks (range, keys, sizes, tokens): the sets with tokens in a range, and these tokens, of the marked texts.

    Ranges from 2**bits on hold the hot tokens of sets, dealt by the key of the set.
    """
    ranges, shift = 1 << bits, np.uint64(64 - bits)

    def block(at: int, keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray, tokens: np.ndarray) -> tuple:
        raw = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)
        raw = raw if at >= ranges else raw[:, :6]
        both = np.stack([sizes, counts], axis=1).astype("<u4")
        return at, keys.tobytes(), both.tobytes(), np.ascontiguousarray(raw).tobytes()

    def blocks_of(place: np.ndarray, owner: np.ndarray, tokens: np.ndarray, keys: np.ndarray, sizes: np.ndarray):
        order = np.argsort(place, kind="stable")
        place, owner, tokens = place[order], owner[order], tokens[order]
        edges = np.flatnonzero(np.diff(place, prepend=-1)).tolist() + [len(place)]
        for a, b in zip(edges, edges[1:]):
            mine = owner[a:b]
            starts = np.flatnonzero(np.diff(mine, prepend=-1))
            who = mine[starts]
            yield block(int(place[a]), keys[who], sizes[who], np.diff(starts, append=b - a), tokens[a:b])

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["mark"].to_numpy(np.int64) & (64 * len(marked) - 1)
            yield batch[marked[at >> 6] >> (at & 63) & 1 == 1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets, names in _sets(chosen(batches), n):
            once = {k: s for k, s in zip(names, sets) if len(s) >= 4}  # smaller sets are similar to equal ones only
            if not once:
                continue
            keys = np.frombuffer(b"".join(once), np.uint8).reshape(-1, _KEY)
            sizes = np.array([len(s) for s in once.values()], np.int64)
            tokens, owner = np.concatenate(list(once.values())), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            known = _is_in(hot, tokens)
            rest = ~known
            place = (tokens >> shift).astype(np.int32)
            rows = list(blocks_of(place[rest], owner[rest], tokens[rest], keys, sizes))
            if known.any():
                deal = _deal(keys)
                rows += blocks_of(ranges + deal[owner[known]] % ranges, owner[known], tokens[known], keys, sizes)
            del sets, names, once, tokens, owner, place, known, rest
            for i in range(0, len(rows), 1024):
                yield pd.DataFrame(rows[i : i + 1024], columns=["range", "keys", "sizes", "tokens"])
            del rows
        trim()

    return texts.mapInPandas(run, "range bigint, keys binary, sizes binary, tokens binary")


def _shared(postings: DataFrame, bits: int) -> DataFrame:
    """Blocks (bundle, keys, sizes, tokens, sets): for the sets of a bundle, the tokens that each shares in one
    range and the number of sets of each token. Sets are dealt to bundles by their key.

    A token goes on as the first 16 bits (or as many as say its range) and the last 48 of its hash."""
    ranges, head = 1 << bits, min(bits, 16)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        at = int(group["range"].iloc[0])
        keys = np.frombuffer(b"".join(group["keys"]), np.uint8).reshape(-1, _KEY)
        both = np.frombuffer(b"".join(group["sizes"]), "<u4").reshape(-1, 2).astype(np.int64)
        raw = np.frombuffer(b"".join(group["tokens"]), np.uint8).reshape(-1, 8 if at >= ranges else 6)
        del group
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, : raw.shape[1]] = raw
        tokens = wide.view("<u8").ravel()
        del raw
        # each set once, though several batches may hold it
        _, first = np.unique(np.ascontiguousarray(keys).view(f"V{_KEY}").ravel(), return_index=True)
        keep = np.zeros(len(keys), bool)
        keep[first] = True
        owner, wanted = np.repeat(np.arange(len(keys), dtype=np.int32), both[:, 1]), np.repeat(keep, both[:, 1])
        owner, tokens = owner[wanted], tokens[wanted]
        del wide, wanted
        if at >= ranges:
            many = np.full(len(tokens), _MOST, np.int64)
            tokens = ((tokens >> np.uint64(64 - head)) << np.uint64(48)) | (tokens & _LOW)
        else:
            order = np.argsort(tokens)
            tokens, owner = tokens[order], owner[order]
            starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
            runs = np.diff(starts, append=len(tokens))
            many = np.repeat(runs, runs)
            more = many > 1
            tokens, owner, many = tokens[more] | np.uint64(at >> (bits - head) << 48), owner[more], many[more]
        bundle = (_deal(keys) % ranges)[owner]
        order = np.lexsort((owner, bundle))
        tokens, owner, many, bundle = tokens[order], owner[order], many[order], bundle[order]
        many = np.minimum(many, _MOST).astype("<u2")
        edges = np.flatnonzero(np.diff(bundle, prepend=-1)).tolist() + [len(bundle)]
        rows = []
        for a, b in zip(edges, edges[1:]):
            mine = owner[a:b]
            starts = np.flatnonzero(np.diff(mine, prepend=-1))
            who = mine[starts]
            counts = np.stack([both[who, 0], np.diff(starts, append=b - a)], axis=1).astype("<u4")
            told = keys[who].tobytes(), counts.tobytes(), tokens[a:b].astype("<u8").tobytes(), many[a:b].tobytes()
            rows.append((int(bundle[a]), *told))
        del tokens, owner, many, bundle, order, keys, both
        trim()
        return pd.DataFrame(rows, columns=["bundle", "keys", "sizes", "tokens", "sets"])

    return postings.groupBy("range").applyInPandas(count, "bundle bigint, keys binary, sizes binary, tokens binary, sets binary")


def _alive(answers: DataFrame, percent: int) -> DataFrame:
    """(key, size, shared, tokens, sets) of the sets that share enough tokens to be similar to another one."""

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint8).reshape(-1, _KEY)
        both = np.frombuffer(b"".join(group["sizes"]), "<u4").reshape(-1, 2).astype(np.int64)
        tokens = np.frombuffer(b"".join(group["tokens"]), "<u8")
        sets = np.frombuffer(b"".join(group["sets"]), "<u2")
        _, first, place = np.unique(keys.view(f"V{_KEY}").ravel(), return_index=True, return_inverse=True)
        owner = np.repeat(place, both[:, 1])
        size, shared = both[first, 0], np.bincount(owner, minlength=len(first))
        alive = 100 * shared >= percent * size
        wanted = alive[owner]
        owner, tokens, sets = owner[wanted], tokens[wanted], sets[wanted]
        order = np.argsort(owner, kind="stable")
        tokens, sets = tokens[order], sets[order]
        who = np.flatnonzero(alive)
        ends = np.cumsum(shared[who])
        del group, owner, wanted, order
        trim()
        return pd.DataFrame({
            "key": [keys[first[w]].tobytes() for w in who],
            "size": size[who],
            "shared": shared[who],
            "tokens": [tokens[b - n : b].tobytes() for b, n in zip(ends, shared[who])],
            "sets": [sets[b - n : b].tobytes() for b, n in zip(ends, shared[who])],
        })

    return answers.groupBy("bundle").applyInPandas(gather, "key binary, size bigint, shared bigint, tokens binary, sets binary")


def level_of(n: int) -> int:
    return n.bit_length() - 1


def signatures(n: int, tokens: np.ndarray, sets: np.ndarray, percent: int = PERCENT, rare: int = RARE) -> np.ndarray:
    """Signatures of a set of n tokens of which ``tokens`` are shared, each by so many ``sets``.

    Two similar sets have a signature in common. Rare tokens are signatures of their own. Pairs are made for
    the size level of the set and, where a similar set may be on the next level, for that one too.
    """
    need = slack(n, percent) + 1 - (n - len(tokens))
    if need <= 0 or n < 4:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, sets))
    tokens = tokens[order]
    single = int(np.count_nonzero(sets <= rare))
    out = [mix(tokens[: min(single, need)])]
    if single < need:
        often = tokens[single:]
        for level in {level_of(n), level_of(n * 100 // percent)}:
            groups = max(1, (1 << level) // 8)
            group = mix(often ^ np.uint64(0x5BD1E995)) % np.uint64(groups)
            _, first = np.unique(group, return_index=True)
            weight = np.ones(len(often), np.int64)
            weight[first] = 0
            end = int(np.searchsorted(np.cumsum(weight), need - single)) + 1
            by_group = np.argsort(group[:end], kind="stable")
            held, place = often[by_group], group[by_group]
            for lag in range(1, end):
                same = place[lag:] == place[:-lag]
                if not same.any():
                    break
                a, b = held[:-lag][same], held[lag:][same]
                out.append(mix(mix(np.minimum(a, b) + np.uint64(level)) + np.maximum(a, b)))
    return np.unique(np.concatenate(out))


def _buckets(records: DataFrame, percent: int, rare: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [], 0
            for row in batch.itertuples(index=False):
                tokens = np.frombuffer(row.tokens, "<u8")
                sets = np.frombuffer(row.sets, "<u2")
                held.append((row.set, row.size, row.shared, signatures(row.size, tokens, sets, percent, rare)))
                size += len(held[-1][3])
                if size >= 200_000:
                    yield frame(held)
                    held, size = [], 0
            yield frame(held)

    def frame(held: list) -> pd.DataFrame:
        many = [len(h[3]) for h in held]
        made = {c: np.repeat(np.array([h[i] for h in held], np.int64), many) for i, c in enumerate(("set", "size", "shared"))}
        sigs = np.concatenate([h[3] for h in held]) if held else np.zeros(0, np.uint64)
        return pd.DataFrame({"sig": sigs.view(np.int64), **made})

    return records.mapInPandas(run, "sig bigint, set bigint, size bigint, shared bigint")


def _may(a_size: Column, b_size: Column, a_shared: Column, b_shared: Column, percent: int) -> Column:
    """Whether sets of these sizes, with so many shared tokens, can be similar."""
    common = F.least(a_shared, b_shared)
    return 100 * common >= percent * (a_size + b_size - common)


def _verified(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Common tokens are shared tokens, so those suffice."""

    @F.pandas_udf("boolean")
    def check(a: pd.Series, b: pd.Series, a_size: pd.Series, b_size: pd.Series) -> pd.Series:
        def one(x, y, m, n):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = np.concatenate([x, y])
            both.sort()
            return similar(int(np.count_nonzero(both[1:] == both[:-1])), m, n, percent)

        return pd.Series([one(*row) for row in zip(a, b, a_size, b_size)], dtype=bool)

    def side(name: str) -> DataFrame:
        return records.select(
            F.col("set").alias(name), F.col("tokens").alias(f"{name}_tokens"), F.col("size").alias(f"{name}_size")
        )

    held = pairs.join(side("b"), "b").join(side("a"), "a")
    return held.where(check("a_tokens", "b_tokens", "a_size", "b_size")).select("a", "b")


def _beside(members: DataFrame, few: DataFrame) -> DataFrame:
    """Members of buckets with the row of their bucket; a crowded bucket is spread by its size."""
    return spread_join(members, few, ["sig"], members.select("sig", F.lit(1).alias("one")), "one")


def _labelled(buckets: DataFrame, labels: DataFrame, keep: Keep) -> DataFrame:
    """Members of the buckets that still hold several components."""
    told = buckets.join(labels, buckets["set"] == labels["id"], "left").select(
        *buckets.columns, F.coalesce("component", "set").alias("component")
    )
    told = keep(told, "members")
    mixed = told.groupBy("sig").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return _beside(told, mixed.where("least < most").select("sig"))


def _labels(buckets: DataFrame, records: DataFrame, percent: int, rounds: int, keep: Keep) -> DataFrame:
    """(id, component) of all sets that a chain of similar sets joins to another."""
    labels = records.sparkSession.createDataFrame([], "id bigint, component bigint")

    def joined(fresh: DataFrame) -> DataFrame:
        # what is known so far goes in as stars, which settle at once
        if fresh.isEmpty():
            return labels
        stars = labels.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        return keep(components(stars.union(fresh), keep), "components")

    left = buckets.withColumn("component", F.col("set"))
    many = left.groupBy("sig").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("sig")
    left = keep(left.join(many, "sig"), "buckets")
    for _ in range(rounds):
        if left.isEmpty():
            return labels
        lead = left.groupBy("sig").agg(F.min(F.struct("set", "size", "shared", "component")).alias("lead"))
        told = _beside(left, keep(lead, "leaders"))
        pairs = told.where(
            (F.col("set") > F.col("lead.set"))
            & (F.col("component") != F.col("lead.component"))
            & _may(F.col("size"), F.col("lead.size"), F.col("shared"), F.col("lead.shared"), percent)
        ).select(F.col("lead.set").alias("a"), F.col("set").alias("b"))
        fresh = keep(_verified(keep(pairs.distinct(), "pairs"), records, percent), "links")
        labels = joined(fresh)
        # a leader has met all others of its bucket
        rest = told.where(F.col("set") > F.col("lead.set")).select(*buckets.columns)
        left = keep(_labelled(rest, labels, keep).select(*buckets.columns, "component"), "buckets")
    return labels if left.isEmpty() else joined(keep(_settled(left, records, percent, keep), "links"))


def _settled(left: DataFrame, records: DataFrame, percent: int, keep: Keep) -> DataFrame:
    """Links between the components that still meet in a bucket, all pairs of them looked at.

    Buckets with members in common form a cluster. Only pairs outside the cluster's largest component matter:
    its other members are cut into blocks of BLOCK sets, and each block meets every block of the cluster. Two
    blocks are compared as a whole by a product of 0/1 matrices, and no more links than sets come out.
    """
    lead = left.groupBy("sig").agg(F.min("set").alias("a"))
    clusters = components(left.join(lead, "sig").select("a", F.col("set").alias("b")).distinct(), keep)
    members = left.select("set", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), F.col("set") == F.col("id"))
    members = keep(members.select("set", F.col("component").alias("part"), "cluster"), "clusters")
    sizes = members.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n"))
    totals = keep(
        sizes.groupBy("cluster").agg(F.max(F.struct("n", "part")).alias("major"), F.sum("n").alias("n")).select(
            "cluster", F.col("major.part").alias("major"),
            F.ceil((F.col("n") - F.col("major.n")) / BLOCK).cast("int").alias("minor_blocks"),
            F.ceil(F.col("major.n") / BLOCK).cast("int").alias("major_blocks"),
        ),
        "cluster-sizes",
    )
    deal = lambda n: F.pmod(F.xxhash64("set"), F.col(n)).cast("int")
    minor = F.col("part") != F.col("major")
    placed = members.join(totals, "cluster").withColumn(
        "block", F.when(minor, deal("minor_blocks")).otherwise(F.col("minor_blocks") + deal("major_blocks"))
    )
    last = F.when(minor, F.col("minor_blocks") + F.col("major_blocks")).otherwise(F.col("minor_blocks")) - 1
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "set", "part"
    )
    told = met.join(records.select("set", "size", "tokens"), "set")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets, size = group["set"].to_numpy(np.int64), group["size"].to_numpy(np.int64)
        tokens = [np.frombuffer(t, "<u8") for t in group["tokens"]]
        flat = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        column = np.cumsum(np.diff(flat, prepend=flat[:1]) != 0)
        common = np.zeros((len(sets), len(sets)), np.float32)
        for low in range(0, int(column[-1]) + 1, COLUMNS):
            a, b = np.searchsorted(column, (low, low + COLUMNS))
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[owner[a:b], column[a:b] - low] = 1
            common += has @ has.T
        near = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        # sets of one component are joined already
        _, label = np.unique(group["part"].to_numpy(np.int64), return_inverse=True)
        near |= label[:, None] == label[None, :]
        label = np.arange(len(sets))
        while True:
            least = np.where(near, label[None, :], len(sets)).min(axis=1)
            if (least == label).all():
                break
            label = least
        return pd.DataFrame({"a": sets[label], "b": sets})[label != np.arange(len(sets))]

    return told.groupBy("cluster", "x", "y").applyInPandas(compare, "a bigint, b bigint")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, n: int = N, percent: int = PERCENT,
    hot: int = HOT, rare: int = RARE, range_tokens: int = RANGE_TOKENS, rounds: int = STAR_ROUNDS, least_bits: int = 4,
) -> DataFrame:
    """One row per input row: (id, size, key, component, component_id); components are numbers of their own."""
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    survey = written(_survey(texts, n), "survey")
    # ids travel as text, since pandas turns whole numbers with NULLs into floats
    kind = docs.schema[id_col].dataType
    rows = survey.where("key is not null").select(F.col("id").cast(kind).alias("id"), "size", "key", "mark")
    with scratch(docs.sparkSession, "jaccard") as keep:
        sets = rows.where("size > 0").groupBy("key", "size").agg(F.min("id").alias("least"), F.min("mark").alias("mark"))
        sets = keep(sets.withColumn("set", F.monotonically_increasing_id()), "sets")
        total = sets.agg(F.sum("size")).first()[0] or 0
        common = survey.where("token is not null").groupBy("token").agg(F.sum("sets").alias("sets"))
        # at most ``hot`` tokens can make up that part of all tokens each
        often = common.where(F.col("sets") >= max(MIN_HOT, total // hot + 1)).select("token")
        known = np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))

        def range_bits(tokens: int) -> int:
            return min(_BITS, max(least_bits, (tokens // range_tokens).bit_length()))

        promising = _promising(texts, sets, n, percent, known, range_bits, keep)
        many, left = promising.agg(F.count(F.lit(1)), F.sum("size")).first()
        bits = range_bits(left or 0)
        alive = _alive(_shared(_postings(texts, n, bits, known, _marked(promising, many)), bits), percent)
        records = keep(alive.join(sets.select("key", "set"), "key").drop("key"), "records")
        buckets = keep(_buckets(records, percent, rare), "signatures")
        labels = _labels(buckets, records, percent, rounds, keep)

        named = sets.join(labels, sets["set"] == labels["id"], "left").select(
            "key", "least", F.coalesce("component", "set").alias("component")
        )
        named = keep(named, "named")
        least = keep(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
        told = written(named.join(least, "component").select("key", "component", "component_id"), "components")
    return rows.drop("mark").join(told, "key", "left")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id).

    A-Z count as a-z; shingles are runs of ``n`` words, a shorter text is one shingle, and a text without words
    (or NULL) has none and is linked with nothing. The component is named by its smallest id; rows with equal
    sets are always linked, repeated rows among them. A NULL id never names a component unless there is no
    other. Sets are told apart by 96-bit fingerprints and tokens by 64 bits of hash (at least 52 in the join).
    """
    return _grouped(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, **options) -> DataFrame:
    """One row of each component, that of the smallest id, with all its columns; texts without words all stay."""
    made = written(_grouped(docs, id_col, text_col, n, **options), "near-copies")
    # a NULL id comes last; of rows with one id the least set stays
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = made.where("size > 0").groupBy("component").agg(F.min(rank).alias("first"))
    first = written(first.select("first.id", "first.key"), "firsts")
    per_id = made.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") == 0).alias("stay"))
    stay = first.groupBy("id").agg(F.count(F.lit(1)).alias("first"))
    per_id = per_id.join(stay.withColumnRenamed("id", "__id"), F.col("id").eqNullSafe(F.col("__id")), "left")
    per_id = per_id.select(F.col("id").alias("__id"), "n", (F.col("stay") + F.coalesce("first", F.lit(0))).alias("stay"))
    odd = written(per_id.where("n > stay"), "dropped")
    same = docs[id_col].eqNullSafe(F.col("__id"))
    mixed = odd.where("stay > 0").select("__id")
    rest = docs.join(odd.select("__id"), same, "left_anti")
    if mixed.isEmpty():
        return rest

    @F.pandas_udf("binary")
    def key_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = pd.DataFrame({"id": None, "text": batch})
            yield pd.Series([k for _, _, keys in _sets(iter([texts]), n) for k in keys], dtype=object)

    # an id that stands for several rows, of which some stay
    keyed = docs.join(mixed, same, "left_semi").withColumn("__key", key_of(F.col(f"`{text_col}`")))
    blank = made.where("size = 0").select(F.col("id").alias("__id"), F.col("key").alias("__set")).distinct()
    heads = first.select(F.col("id").alias("__id"), F.col("key").alias("__set"))
    once = keyed.dropDuplicates([id_col, "__key"])

    def among(rows: DataFrame, named: DataFrame) -> DataFrame:
        found = rows[id_col].eqNullSafe(named["__id"]) & (rows["__key"] == named["__set"])
        return rows.join(named, found, "left_semi").drop("__key")

    return rest.unionByName(among(once, heads)).unionByName(among(keyed, blank))
