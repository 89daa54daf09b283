"""Operators in plain Spark expressions: block naming, license scan, chat format."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from tallywork.llm import blocks, chat, licenses

from .helpers import corpus, table, words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- exact dedup ------------------------------------------------------------------------------


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_groups(rows):
    same = {}
    for i, t in rows:
        same.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = same[norm(t)]
        real = [x for x in ids if x is not None]
        out.append((i, min(real) if real else None, len(ids), sha(norm(t))))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"size": 7}, {"size": 5, "digest": lambda b: F.length(b) % 3}])
def test_groups_of_equal_texts(spark, options):
    rng = random.Random(9)
    base = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(0, 60))) for _ in range(40)]
    rows = list(enumerate([*base, *base[:25], *(b.replace(" ", " \t") for b in base[:9]), None, "", " ", "\n", "é" * 30]))
    rows += [(None, base[0]), (None, "only here"), (3, base[3]), (3, base[3])]
    got = blocks.groups(table(spark, rows), **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_groups(rows)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_dedup_keeps_one_of_each(spark):
    rows = corpus(3) + [(100, corpus(3)[0][1]), (5000, corpus(3)[4][1])]
    docs = table(spark, rows)
    kept = blocks.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted({norm(t) for _, t in rows})


def test_dedup_of_nothing(spark):
    assert blocks.groups(table(spark, [])).count() == 0 and blocks.drop_copies(table(spark, [])).count() == 0


# --- licenses ---------------------------------------------------------------------------------


def brute_license(text):
    w = re.findall(licenses.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSED = [
    "Released under the MIT License.", "CC-BY-NC cc by nc CC BY NC-4.0", "under the mit\nlicense under the MIT license", "under the mit", "cc by",
    "Licensed under the Apache License, Version 2.0.", "éUNDER the mit license", "under the mİt license", "apache license version 2 apache license version 2",
    "the mit license under cc by", None, "", "!!", "This work is licensed under the GNU General Public License, version 3.",
]


def test_license_base_columns(spark):
    rng = random.Random(2)
    bits = "under the mit license apache license version 2 cc by nc released x é".split()
    rows = list(enumerate(LICENSED + [" ".join(rng.choice(bits) for _ in range(60)) for _ in range(60)])) + [(0, "cc by nc"), (None, "cc by nc")]
    made = licenses.scan(table(spark, rows))
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan(licenses.scan(spark.range(1).selectExpr("id doc_id", "'x' text"))))
    got = sorted((tuple(r)[:6] for r in made.collect()), key=str)
    assert got == sorted(((i, *brute_license(t)) for i, t in rows), key=str)


def test_license_method_finds_altered_texts(spark):
    grant = next(t for t in licenses.TEMPLATES if t.startswith("permission is hereby"))
    w = grant.split()
    cut = " ".join(w[:9] + ["really"] + w[9:18] + w[19:])
    far = " ".join(w[:6]) + " " + " ".join(words(random.Random(1), 50)) + " " + " ".join(w[-6:])
    rows = [(1, grant), (2, "x y " + cut.upper() + " z"), (3, far), (4, LICENSED[-1]), (5, "nothing here")]
    got = {r.doc_id: r for r in licenses.scan(table(spark, rows)).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "mit", "", "gpl-3", ""]
    assert got[1].n_base == 0 and got[1].score == 1.0 and 0 < got[2].score <= 1 and got[5].score == 0


def brute_labels(text):
    """Spans by a plain scan: places of a template's windows on diagonals close together, then the letters."""
    w = re.findall(licenses.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    labels, score = set(), 0.0
    for template, label in licenses.TEMPLATES.items():
        t = template.split()
        n = len(t) - licenses.K + 1
        need = max(2, round(licenses.COVERAGE * n))
        for d in range(-len(t), len(w)):
            met = lambda e: {p for p in range(n) if 0 <= e + p and w[e + p : e + p + licenses.K] == t[p : p + licenses.K]}  # noqa: B023, E731
            if not met(d):
                continue
            places = set().union(*(met(d + k) for k in range(licenses.SLACK + 1)))
            seen = " ".join(w[max(d, 0) : max(d, 0) + len(t) + min(d, 0) + licenses.SLACK])
            off = edits(seen, template) - max(len(seen) - len(template), 0)
            if len(places) >= need and off <= (1 - licenses.COVERAGE) * len(template):
                labels.add(label)
                score = max(score, min(1.0, len(places) * licenses.COVERAGE / need))
    return labels, score


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_license_labels_against_a_plain_scan(spark):
    rng = random.Random(12)
    rows = [
        (0, "licensed under the " * 4), (1, "released under the released under the"), (2, "the terms of the " * 6),
        (3, "under the terms of the gnu " * 30), (4, "this work is licensed under the " * 9 + "gnu"),
    ]
    for i in range(60):
        w = rng.choice(list(licenses.TEMPLATES)).split()
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice([[], ["really"], ["very", "much"], [w[at]], w[max(at - 3, 0) : at]])
        rows.append((10 + i, " ".join(words(rng, rng.randrange(9)) + w * rng.choice([1, 1, 2]) + words(rng, rng.randrange(9)))))
    got = {r.doc_id: r for r in licenses.scan(table(spark, rows)).collect()}
    for i, text in rows:
        labels, score = brute_labels(text)
        base = set(filter(None, got[i].base_labels.split(",")))
        assert set(filter(None, got[i].labels.split(","))) == labels | base, text
        assert got[i].score == pytest.approx(1.0 if base else score), text
    assert [got[i].labels for i in range(5)] == [""] * 5
    assert sum(got[i].labels != "" for i in range(10, 70)) > 30


def test_license_in_a_long_text(spark):
    grant = next(iter(licenses.TEMPLATES))
    text = "the " * 100_000 + grant + " under the" * 50_000
    got = licenses.scan(table(spark, [(1, text)])).first()
    assert (got.n_words, got.n_base, got.first_word, got.labels) == (200_000 + len(grant.split()), 1, 100_001, "mit")


def test_license_of_nothing(spark):
    assert licenses.scan(table(spark, [])).count() == 0


# --- chat -------------------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "~1 ~0 ~~ <s>", "<", "[INST", "</s", "", None, " a\n", "<<s></s>/s>", "~"]


def brute_chat(rows):
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, _, r, t in ts if r == "assistant")
        out.append((conv, len(ts), sha("".join(f"{r}\n{t}\n" for _, _, r, t in ts)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_chat_reads_back_what_it_wrote(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "</s>x"]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "a"), (50, None, "user", "x"), (50, None, "user", "x"), (51, 1, "assistant", "b"), (51, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1)).withColumn("segments", F.lit(2))
    made = chat.digests(chat.conversations(df))
    assert not re.search("Python|Pandas|Arrow", plan(made))
    assert sorted((tuple(r)[:5] for r in made.collect()), key=str) == brute_chat(rows)
    assert chat.conversations(df.where("false")).count() == 0


def test_chat_machine_and_mask(spark):
    talk = {
        1: ["system", "user", "assistant", "user", "assistant"], 2: ["user", "user", "assistant"], 3: ["user"], 4: ["assistant", "user"],
        5: ["user", "assistant", "system"], 6: ["user", "assistant"],
    }
    rows = [(c, i, r, f"{r}{i}</s>") for c, rs in talk.items() for i, r in enumerate(rs)]
    got = {r.conv_id: r for r in chat.conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert {c: r.bad_turn for c, r in got.items()} == {1: None, 2: 1, 3: 1, 4: 0, 5: 2, 6: None}
    assert got[6].formatted == "<s>[INST] user [/INST]user0~1</s><s>[INST] assistant [/INST]assistant1~1</s>" and got[6].valid
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert [s.text for s in got[1].segments if s.loss] == ["assistant2~1", "assistant4~1"]
