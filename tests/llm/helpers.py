"""Small tables for the text operators, with columns whose names the operators use inside."""

import random

CLASH = ["id", "key", "size", "row", "name", "level", "ids", "set", "tokens", "component", "w", "h", "kept", "__made", "end"]
SCHEMA = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASH)
EMPTY = [None, "", " \n\t ", "!", "\x00", "one", "one two", "ß", "你好"]


def table(spark, rows):
    """documents with extra columns from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, *("x" for _ in CLASH)) for i, t in rows], SCHEMA).repartition(3)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def edited(rng, text, share):
    return [f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in text]


def corpus(seed=5):
    """Copies, near copies, a chain of near copies, texts around one passage, odd and empty ones."""
    rng = random.Random(seed)
    texts = list(EMPTY)
    for _ in range(6):
        base = words(rng, rng.randrange(30, 160))
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05):
            texts.append(" ".join(edited(rng, base, share)))
    base = words(rng, 120)
    for i in range(25):  # each a few words further on
        texts.append(" ".join(base[i * 2 :] + words(rng, i * 2, 10**6)))
    passage = words(rng, 70)
    for _ in range(25):  # mostly one passage, but no near copies
        texts.append(" ".join(passage + words(rng, rng.randrange(10, 60), 10**6)))
    group = words(rng, 80)
    for _ in range(40):
        texts.append(" ".join(edited(rng, group, 0.012)))
    texts += [" ".join(words(rng, n)) for n in (1, 3, 4, 5, 6, 7, 8, 9, 9, 12, 5000)] + ["a b c d e f g h", "A B c d e f g h", "a b c d e f g h i"]
    texts += ["a a a a a a a a", "a  a a a\na a a"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))
