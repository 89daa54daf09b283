"""What the methods themselves decide, against plain versions written without their code paths."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from tallywork.llm import language, packing, repetition

from .helpers import CLASH, EMPTY, corpus, table, words

# --- quality rules ----------------------------------------------------------------------------


def plain_verdict(text):
    """The quality verdict by word lists and sets."""
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    chars = sum(map(len, w))

    def covered(n, times):
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        many = Counter(grams)
        return {j for i, g in enumerate(grams) if many[g] >= times for j in range(i, i + n)}

    share = lambda places: sum(len(w[i]) for i in places) / chars
    if len(w) < 10 or 100 * len(covered(5, 2)) > 20 * len(w):
        return True, False
    if any(share(covered(n, 2)) > most for n, most in repetition.NGRAM_SHARE.items()):
        return False, False
    if any(share(covered(n, 3)) > most for n, most in repetition.THRICE_SHARE.items()):
        return False, False
    for n, most in repetition.STUTTER_SHARE.items():
        again = {j for i in range(n, len(w) - n + 1) if w[i : i + n] == w[i - n : i] for j in range(i, i + n)}
        if len(again) > most * len(w):
            return False, False
    lines, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            repeated += len(line) if line in lines else 0
            lines.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return False, repeated <= repetition.LINE_SHARE * len(text) and symbols <= repetition.SYMBOL_SHARE * len(w)


def test_quality_verdict(spark):
    rng = random.Random(21)
    texts = [*EMPTY, *(t for _, t in corpus(21)[:60])]
    for _ in range(300):
        w = words(rng, rng.randrange(8, 90))
        for _ in range(rng.randrange(4)):
            at, n = rng.randrange(len(w)), rng.choice([1, 2, 3, 4, 6, 8, 11])
            w[at:at] = w[at : at + n] * rng.randrange(1, 4)
        line = " ".join(words(rng, rng.randrange(3, 9)))
        text = rng.choice([" ", "\n", "  "]).join(w) + ("\n" + line) * rng.randrange(4) + " #" * rng.randrange(20) * rng.randrange(2)
        texts.append(text)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.assess(table(spark, rows)).collect()}
    want = {i: plain_verdict(t) for i, t in rows}
    assert got == want
    assert 40 < sum(kept for _, kept in want.values()) < len(rows) - 40
    assert sum(not failed and not kept for failed, kept in want.values()) >= 3


# --- language ---------------------------------------------------------------------------------


def plain_profile(text, letters):
    """The sum of the bound vectors of all letter trigrams, one by one."""
    cut = re.sub(r"[^\W\d_]+", lambda m: m[0], text.lower())
    cut = " " + re.sub(r" +", " ", "".join(c if c.isalpha() else " " for c in cut)).strip() + " "
    total = np.zeros(letters.d)
    if not cut.strip():
        return total
    for i in range(len(cut) - 2):
        bound = np.ones(letters.d)
        for k, c in enumerate(cut[i : i + 3]):
            vector = letters._letter(np.array([ord(c)], np.uint64))[0].astype(float)
            bound *= np.roll(vector, 2 - k)
        total += bound
    return total


def test_language_profiles(spark):
    rng = random.Random(5)
    sounds = {"aa": ["lo", "ra", "mi"], "bb": ["sch", "ung", "ein"], "cc": ["que", "eau", "ment"]}
    rows = []
    for i in range(120):
        lang = rng.choice(list(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 12)))
        rows.append((i, text + rng.choice(["", "!", " 12", " É"]), lang if rng.random() < 0.8 else None))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 !", "cc"), (203, "é" * 3, None), (None, "lora", "aa")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string").repartition(3)
    got = {r.doc_id: r for r in language.identify(df).collect()}
    letters = language.Letters(language.DIMENSIONS)
    sums = {}
    for i, text, lang in rows:
        if lang and text is not None and i is not None and __import__("zlib").crc32(str(i).encode()) % 4 != 2:
            sums[lang] = sums.get(lang, 0) + plain_profile(text, letters)
    for i, text, _ in rows:
        profile = plain_profile(text or "", letters)
        if not profile.any():
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        near = {lang: p @ profile / max(np.linalg.norm(p) * np.linalg.norm(profile), 1e-12) for lang, p in sums.items()}
        best = max(near.values())
        assert got[i].score == pytest.approx(min(max(best, 0.0), 1.0), abs=1e-6)
        assert near[got[i].lang_pred] == pytest.approx(best, abs=1e-9)


def test_equal_cosines_go_to_the_first_language(spark):
    df = table(spark, [(1, "abc abc"), (2, "zzz")])
    same = [("bb", [1.0] * 64), ("aa", [1.0] * 64)]
    assert {r.lang_pred for r in language.predict(df, same).collect()} == {"aa"}


def test_language_of_a_very_long_text(spark):
    df = table(spark, [(1, "lora mi " * 200_000)])
    got = language.identify(df.withColumn("lang", __import__("pyspark").sql.functions.lit("aa"))).first()
    assert got.lang_pred == "aa"


# --- packing ----------------------------------------------------------------------------------


def plain_fill(texts, scores, window):
    """The greedy filling by lists: seed, then its unused neighbours by falling score, the last one cut."""
    unused, out, sequence = list(range(len(texts))), [], 0
    rest = None
    while unused or rest:
        if rest is None:
            rest = (unused.pop(0), 0)
        seed, room, near = rest[0], window, None
        while room:
            if rest is None:
                near = sorted(unused, key=lambda t: -scores[seed][t]) if near is None else near
                if not near:
                    break
                unused.remove(near[0])
                rest = (near.pop(0), 0)
            text, start = rest
            length = min(room, len(texts[text]) - start)
            out.append((text, start, length, sequence, window - room))
            room -= length
            rest = (text, start + length) if start + length < len(texts[text]) else None
        sequence += 1
    return out


@pytest.mark.parametrize("window", [7, 64, 1000])
def test_greedy_filling(window):
    rng = random.Random(window)
    for _ in range(20):
        texts = [np.array([rng.randrange(2, 40) for _ in range(rng.randrange(0, 50))] + [1], np.uint16) for _ in range(rng.randrange(1, 30))]
        idf = np.linspace(0.1, 3, 1 << 16).astype(np.float32)
        index = packing.Index(texts, idf, float(np.mean([len(t) for t in texts])))
        scores = [index.scores(i) for i in range(len(texts))]
        assert packing.fill(texts, index, window) == plain_fill(texts, scores, window)


def test_clashing_names_and_missing_ids(spark):
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASH if c != "ids")
    rows = [(None, "a b c"), (None, None), (3, "")]
    df = spark.createDataFrame([(*r, *("x" for c in CLASH if c != "ids")) for r in rows], schema)
    told = packing.digests(packing.pack(df)).collect()
    assert sorted((r.doc_id is None, r.doc_tokens) for r in told) == [(False, 1), (True, 1), (True, 4)]
    assert packing.digests(packing.pack(df.limit(0))).count() == 0
    assert repetition.assess(df).count() == 3 and repetition.assess(df.limit(0)).count() == 0
