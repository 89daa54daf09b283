"""Packing and the whole pipeline, against brute force."""

import random
import zlib

import numpy as np
import pytest
from tallywork.llm import blocks, bpe, jaccard, packing, queries, repetition, secret_scan

from .helpers import corpus, table, words
from .test_jaccard import brute


def check_pieces(pieces, texts, window=packing.WINDOW):
    """Every id of every text once, and sequences without gaps."""
    own = bpe.WordBpe(bpe.read_vocabulary())
    left = sorted(tuple([*own.encode(t), 1]) for t in texts)
    rows = {}
    for p in pieces:
        rows.setdefault(p.doc_id, []).append(p)
    made = []
    for parts in rows.values():
        parts.sort(key=lambda p: p.start)
        whole = [x for p in parts for x in np.frombuffer(p.ids, "<u4").tolist()]
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert all(p.doc_tokens == len(whole) and p.length > 0 for p in parts)
        made.append(tuple(whole))
    assert sorted(made) == left
    held = {}
    for p in pieces:
        held.setdefault(p.sequence_id, []).append(p)
    sizes = []
    for parts in held.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        sizes.append(sum(p.length for p in parts))
    assert max(sizes) <= window
    return sizes


@pytest.mark.parametrize("shard_tokens", [1 << 18, 4000])
def test_every_token_once(spark, shard_tokens):
    rng = random.Random(2)
    texts = [" ".join(words(rng, rng.randrange(0, 300))) for _ in range(60)] + [None, "", "<|endoftext|>", " ".join(words(rng, 9000))]
    docs = table(spark, list(enumerate(texts)))
    pieces = packing.pack(docs, shard_tokens=shard_tokens).collect()
    sizes = check_pieces(pieces, texts)
    shards = len({p.sequence_id >> 32 for p in pieces})
    assert sum(s < packing.WINDOW for s in sizes) <= shards and (shards > 3) == (shard_tokens == 4000)


def test_neighbours_share_windows(spark):
    rng = random.Random(3)
    topics = [["".join(rng.choice("abcdefghijklmnopqrstuvwx"[3 * k : 3 * k + 3]) for _ in range(6)) for _ in range(20)] for k in range(8)]
    rows = [(i, " ".join(rng.choice(topics[i % 8]) for _ in range(30))) for i in range(200)]
    pieces = packing.pack(table(spark, rows), window=1024).collect()
    near = {}
    for p in pieces:
        near.setdefault(p.sequence_id, []).append(p.doc_id % 8)
    same = sum(max(map(v.count, v)) for v in near.values()) / len(pieces)
    assert same > 0.6


@pytest.mark.parametrize("ranges", [1 << 11, 5])
def test_shards_hold_the_neighbours(spark, monkeypatch, ranges):
    """The nearest texts by brute-force BM25 over all texts lie in the seed's shard, copies among them."""
    monkeypatch.setattr(packing, "RANGES", ranges, raising=False)
    if ranges == 5:  # three levels
        monkeypatch.setattr(packing, "FAN", 3)
        monkeypatch.setattr(packing, "TASK_SHARDS", 2)
    rng = random.Random(9)
    common = words(rng, 40)
    topics = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40)] for _ in range(60)]
    texts = [" ".join(rng.choice(topics[i % 60] if rng.random() < 0.6 else common) for _ in range(60)) for i in range(900)]
    texts += texts[:60]
    pieces = packing.pack(table(spark, list(enumerate(texts))), shard_tokens=4000).collect()
    check_pieces(pieces, texts)
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces}
    assert len(set(shard.values())) > 20
    held = {}
    for p in pieces:
        held[p.sequence_id >> 32] = held.get(p.sequence_id >> 32, 0) + p.length
    assert max(held.values()) < 3 * 4000
    own = bpe.WordBpe(bpe.read_vocabulary())
    ids = [np.array([*own.encode(t), 1], "<u2") for t in texts]
    found = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=1 << 16)
    idf = np.log1p((len(ids) - found + 0.5) / (found + 0.5))
    index = packing.Index(ids, idf, sum(map(len, ids)) / len(ids))
    same = []
    for seed in range(0, 960, 7):
        near = [i for i in np.argsort(-index.scores(seed), kind="stable")[:6].tolist() if i != seed][:5]
        same += [shard[i] == shard[seed] for i in near]
    assert np.mean(same) > 0.6
    assert np.mean([shard[i] == shard[900 + i] for i in range(60)]) > 0.9


def test_one_text_many_times_fills_many_shards(spark):
    """A run of one key is cut like any other, whether or not its rows have ids."""
    pieces = packing.pack(table(spark, [(None, "one text that comes again")] * 2000), shard_tokens=1000).collect()
    held = {}
    for p in pieces:
        held[p.sequence_id >> 32] = held.get(p.sequence_id >> 32, 0) + p.length
    assert len(held) > 5 and max(held.values()) < 3000


def test_checksums_and_odd_ids(spark):
    docs = table(spark, [(None, "a b"), (None, "c"), (4, "d e f"), (4, "d e f")])
    pieces = packing.pack(docs)
    rows = pieces.collect()
    told = packing.digests(pieces).collect()
    assert sorted(r.ids_crc32 for r in told) == sorted(zlib.crc32(r.ids) for r in rows)
    assert sum(r.doc_tokens for r in rows) == 3 + 2 + 4 + 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack(table(spark, [])).count() == 0


def test_scores_are_bm25():
    texts = [np.array(t, "<u2") for t in ([1, 2, 2, 3], [2, 3, 3], [5], [1, 1, 1, 1, 2])]
    idf = np.linspace(0.1, 3, 1 << 16).astype(np.float32)
    index = packing.Index(texts, idf, 3.25)
    for seed in range(4):
        want = [
            sum(
                idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(x) / 3.25))
                for t in set(texts[seed].tolist()) if (n := x.tolist().count(t))
            )
            for x in texts
        ]
        assert index.scores(seed) == pytest.approx(want, rel=1e-5)


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    rng = random.Random(12)
    rows = corpus(12)
    rows += [(1000 + i, " ".join(words(rng, 40)) + f' token = "{i:06x}' + "ab12" * 9 + '" end') for i in range(5)]
    docs = table(spark, rows).select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("bigint").alias("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns
    stages = [s for s, _ in corpus_pipeline.STAGES]
    assert stages == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "secret_scans", "packing"]

    from tallywork.llm.words import words_of

    clean = [(i, t) for i, t in rows if next(repetition.measure(t, *w, repetition.NGRAM_SHARE, repetition.LINE_SHARE) for w in words_of([t]))[-1]]
    first = {}
    for i, t in sorted(clean):
        first.setdefault(" ".join(t.split()), (i, t))
    one = [(i, t) for (i, t), (_, _, c) in zip(sorted(first.values()), sorted(brute(sorted(first.values())))) if i == c]
    want = sorted((i, secret_scan.redact(t)) for i, t in one)
    assert sorted((r.doc_id, r.text) for r in left.collect()) == want
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r.doc_id for r in pieces.select("doc_id").collect()}) == [i for i, _ in want]
    own = bpe.WordBpe(bpe.read_vocabulary())
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(own.encode(t)) + 1 for _, t in want)


def test_registered_queries():
    from __spark_entry__ import oracle_sql, queries as registered

    names = list(registered())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    from check import compare, oracle
    from conftest import SMALL

    assert compare(queries.QUERIES[name](spark, SMALL), oracle(SMALL), queries.ORACLES[name]) is None
