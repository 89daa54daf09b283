"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from tallywork.llm import jaccard
from tallywork.llm.components import components
from tallywork.llm.store import scratch

from .helpers import corpus, table, words


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k), i)) for k, (i, s) in enumerate(sets)), key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"hot": 3000, "rare": 3}, {"rare": 1, "rounds": 0, "range_tokens": 500}, {"rounds": 2}])
def test_same_as_all_pairs(spark, options, monkeypatch):
    monkeypatch.setattr(jaccard, "MIN_HOT", 4)
    monkeypatch.setattr(jaccard, "BATCH_TOKENS", 700)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    rows = corpus()
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 60
    assert told(jaccard.groups(table(spark, rows), **options)) == want


def test_null_and_repeated_ids(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(None, text), (7, text), (7, text), (3, text + " end"), (None, "alone here"), (9, None), (9, "")]
    assert told(jaccard.groups(table(spark, rows))) == sorted(
        [(None, 22, 3), (7, 22, 3), (7, 22, 3), (3, 23, 3), (None, 1, None), (9, 0, 9), (9, 0, 9)], key=str
    )


def test_more_ranges_than_sixteen_bits_name(spark):
    base = " ".join(words(random.Random(2), 24))
    rows = [(i, f"{base} {'x' * i}") for i in range(4)] + [(9, "a b c d e f g h i"), (8, "a b c d e f g h i j"), (7, None)]
    for hot in (jaccard.HOT, 1):
        got = jaccard.groups(table(spark, rows), least_bits=18, hot=hot)
        assert told(got) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    df = jaccard.groups(table(spark, []))
    assert df.columns == ["doc_id", "n_shingles", "component_id"] and df.count() == 0


def test_one_of_each_group_stays(spark):
    rows = corpus(8)
    docs = table(spark, rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in brute(rows) if i == c)


def test_similar_sets_share_a_signature():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(4, 400)
        x = np.array(rng.sample(range(1 << 40), n), np.uint64)
        y = np.concatenate([x[: n - rng.randrange(0, n // 9 + 1)], np.array(rng.sample(range(1 << 41, 1 << 42), rng.randrange(0, n // 9 + 1)), np.uint64)])
        both = np.intersect1d(x, y)
        if not jaccard.similar(len(both), len(x), len(y)):
            continue
        df = {int(t): rng.choice([2, 3, 20, 30, 500]) for t in both}
        made = []
        for s in (x, y):
            shared = np.array([t for t in s.tolist() if t in df], np.uint64)
            made.append(set(jaccard.signatures(len(s), shared, np.array([df[int(t)] for t in shared])).tolist()))
        assert made[0] & made[1]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")
    with scratch(spark, "chain") as keep:
        got = {tuple(r) for r in components(links, keep).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)}


def test_words_do_not_depend_on_blocks(monkeypatch):
    from tallywork.llm import words as w

    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randrange(0, 300))) + rng.choice(["", " ", "\n"]) for _ in range(30)] + [None, "é" * 500]
    whole = [h.tolist() for h, _ in w.words_of(texts)]
    monkeypatch.setattr(w, "BLOCK", 64)
    assert [h.tolist() for h, _ in w.words_of(texts)] == whole
    assert [c.tolist() for _, c in w.words_of(["né oui\tx"])] == [[2, 3, 1]]


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(4)
    a, b, c, d, e = (" ".join(words(rng, 60, 10**6)) for _ in range(5))
    rows = [(1, a), (2, a + " x"), (2, b), (3, c), (3, c + " x"), (3, c), (None, d), (None, d + " x"), (None, e), (None, ""), (None, ""), (4, "")]
    rows += [(None, b + " y"), (9, e + " y")]
    got = jaccard.keep_one(table(spark, rows)).collect()
    left = sorted(((r.doc_id, r.text) for r in got), key=str)
    groups = {x: [(i, t) for i, t in left if t.startswith(x)] for x in (a, b, c, d, e)}
    assert groups[a] == [(1, a)] and groups[b] == [(2, b)] and groups[e] == [(9, e + " y")]
    assert [i for i, _ in groups[c]] == [3] and [i for i, _ in groups[d]] == [None]
    assert sorted((i for i, t in left if not t), key=str) == [4, None, None] and len(left) == 8


def test_no_empty_batch_of_sets(monkeypatch):
    import pandas as pd

    texts = pd.DataFrame({"id": ["1", "2", "3"], "text": ["a b c d e f", None, "g h"]})
    monkeypatch.setattr(jaccard, "BATCH_TOKENS", 1)
    made = list(jaccard._sets(iter([texts]), 5))
    assert [ids for ids, _, _ in made] == [["1"], ["2", "3"]] and [len(s) for _, s, _ in made] == [1, 2]
    assert list(jaccard._sets(iter([]), 5)) == []


def _sent(spark, monkeypatch, rows, **options):
    """Bytes of the blocks that go to hash ranges, and the result."""
    sent = []

    def weighed(inner):
        def run(postings, *args):
            held = [c for c, kind in postings.dtypes if kind == "binary"]
            sent.append(sum(len(v) for row in postings.select(*held).collect() for v in row))
            return inner(postings, *args)

        return run

    for name in ("_first_shared", "_shared"):
        if hasattr(jaccard, name):
            monkeypatch.setattr(jaccard, name, weighed(getattr(jaccard, name)))
    got = told(jaccard.groups(table(spark, rows), **options))
    return sum(sent), got


def test_postings_do_not_grow_with_the_ranges(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(words(rng, 200, 10**6)) for _ in range(60)]
    texts += [texts[0] + " x", texts[1], "y " + texts[2]]
    rows = list(enumerate(texts))
    want = sorted(brute(rows), key=str)
    tokens = sum(n for _, n, _ in want)
    for bits in (4, 12):
        size, got = _sent(spark, monkeypatch, rows, least_bits=bits)
        monkeypatch.undo()
        assert got == want
        assert size < 8 * tokens


def test_a_similar_set_shares_enough_first_tokens():
    rng = random.Random(6)
    seen = 0
    for _ in range(2000):
        both, x_only, y_only = rng.randrange(3, 400), rng.randrange(0, 100), rng.randrange(0, 100)
        if not jaccard.similar(both, both + x_only, both + y_only):
            continue
        seen += 1
        # what is not common comes first, or anywhere
        least = rng.choice([1, 0])
        order = {t: (least * (t < both), rng.random()) for t in range(both + x_only + y_only)}
        x = sorted([*range(both), *range(both, both + x_only)], key=order.get)
        y = sorted([*range(both), *range(both + x_only, both + x_only + y_only)], key=order.get)
        met = len(set(x[: jaccard.firsts(len(x))]) & set(y[: jaccard.firsts(len(y))]))
        assert met >= jaccard.needed(len(x)) and met >= jaccard.needed(len(y))
    assert seen > 300


@pytest.mark.parametrize("sizes", [(120, 96), (400, 330), (60, 50)])
def test_a_shorter_partner_is_found(spark, sizes):
    # a set and a part of it, whose first tokens are fewer; nothing else is shared
    rows = []
    for k in range(12):
        long = words(random.Random(k), sizes[0] + 4, 10**7)
        rows += [(2 * k, " ".join(long)), (2 * k + 1, " ".join(long[: sizes[1] + 4]))]
    want = sorted(brute(rows), key=str)
    assert {c for _, _, c in want} == set(range(0, 24, 2))
    assert told(jaccard.groups(table(spark, rows))) == want


def test_sets_of_one_tag_go_on_unseen(spark):
    sets = [(b"same--one---", 50, 1), (b"same--two---", 90, 2), (b"other-three-", 50, 3)]
    sets = spark.createDataFrame([(bytearray(k), size, mark) for k, size, mark in sets], "key binary, size bigint, mark bigint")
    texts = spark.createDataFrame([], "id string, text string, mark bigint")
    with scratch(spark, "tags") as keep:
        got = jaccard._promising(texts, sets, 5, 80, np.zeros(0, np.uint64), lambda tokens: 4, keep).collect()
    assert sorted(tuple(r) for r in got) == [(1, 50), (2, 90)]


def test_the_bitmap_holds_every_mark(spark):
    marks = [0, 63, 64, -1, -(1 << 63), (1 << 63) - 1, 12345678901]
    bits = jaccard._marked(spark.createDataFrame([(m, 5) for m in marks], "mark bigint, size bigint"), len(marks))
    at = np.array(marks) & (64 * len(bits) - 1)
    assert ((bits[at >> 6] >> (at & 63)) & 1).all()
    assert sum(int(w).bit_count() for w in bits.view(np.uint64)) == len(set(at.tolist()))
