"""Collocations, conversation repair and decontamination against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tallywork.llm import collocations, decontaminate, fm_index, repair

from .helpers import CLASH, table, words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- FM-index ---------------------------------------------------------------------------------


def segments(rng, entries, n):
    """Random segments, copies and long runs of one symbol, each closed by 0."""
    some = [[rng.randrange(1, entries) for _ in range(rng.randrange(0, 40))] for _ in range(n)]
    some += [some[0]] * 3 + [[1] * 50, [1] * 33, [], [1, 2] * 30]
    rng.shuffle(some)
    return [x for s in some for x in [*s, 0]]


@pytest.mark.parametrize("entries", [2, 3, 9, 70])
def test_index_finds_what_a_scan_finds(entries):
    rng = random.Random(entries)
    entries = max(entries, 3)
    flat = segments(rng, entries, 12)
    symbols = np.array(flat)
    unique = [(x, i) if x == 0 else (x, 0) for i, x in enumerate(flat)]
    assert fm_index.suffix_order(symbols).tolist() == sorted(range(len(flat)), key=lambda i: unique[i:])
    levels, counts, marks, kept = fm_index.FmIndex.parts(symbols, entries)
    index = fm_index.FmIndex(levels, counts, marks, kept)
    for m in (1, 2, 5, 10):
        phrases = [flat[i : i + m] for i in range(len(flat) - m) if 0 not in flat[i : i + m]][:60]
        phrases += [[rng.randrange(1, entries) for _ in range(m)] for _ in range(20)]
        first, end = index.search(np.array(phrases))
        for p, a, b in zip(phrases, first, end):
            want = [i for i in range(len(flat) - m + 1) if flat[i : i + m] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# --- decontamination --------------------------------------------------------------------------


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_leaks(rows, items, window):
    phrases = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - window + 1, min(len(w), 1))):
            phrases.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for doc, text in rows:
        w, hit, found = plain_words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if (names := phrases.get(tuple(w[i : i + m]))) is not None:
                    hit.update(range(i, i + m))
                    found |= names
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit), spans))
    return sorted(out, key=str)


def leak_rows(rng):
    passages = [words(rng, n, 60) for n in (3, 9, 10, 11, 25, 60)]
    rows = [(1, None), (2, ""), (3, "!?"), (4, "Één woord"), (None, "w1"), (None, None)]
    for i in range(60):
        text = words(rng, rng.randrange(0, 80), 60)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)[: rng.randrange(5, 61)]
        rows.append((rng.randrange(50), rng.choice([" ", ", ", "\n", "-"]).join(text)))
    rows += [rows[20]] * 4 + [(99, " ".join(words(rng, 700, 60) + passages[5] + words(rng, 300, 60)))]
    items = [(i, " ".join(p).upper()) for i, p in enumerate(passages)]
    items += [(7, " ".join(passages[5][:30])), (7, "une autre"), (8, None), (9, "..."), (None, "Één"), (11, " ".join(passages[4])), items[3]]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"shard_words": 40, "query_words": 30}, {"window": 4, "shard_words": 300}])
def test_leaks(spark, options):
    rows, items = leak_rows(random.Random(8))
    bench = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id bigint, text string, doc string, part string")
    got = decontaminate.report(table(spark, rows), bench, **options).collect()
    made = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, [list(s) for s in r.spans]) for r in got]
    assert sorted(made, key=str) == brute_leaks(rows, items, options.get("window", 10))


def test_many_occurrences_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FOUND", 7)
    monkeypatch.setattr(decontaminate, "PIECE", 5)
    rows, items = leak_rows(random.Random(3))
    items += [(30, "w1"), (31, "w1 w2"), (32, "w3")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.report(table(spark, rows), bench).collect()
    made = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, [list(s) for s in r.spans]) for r in got]
    assert sorted(made, key=str) == brute_leaks(rows, items, 10)


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = decontaminate.report(table(spark, [(1, "a b")]), none).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.spans) for r in got] == [(1, 2, 0, sha(""), [])]
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.report(table(spark, []), bench).count() == 0


# --- collocations -----------------------------------------------------------------------------


def brute_collocations(rows, least, share, top):
    count, total = {}, Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        f = count.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in some.items():
            if any(p in (q[:2], q[1:]) and 100 * b >= share * a for q, b in some.items() if len(q) > len(p)):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, left, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, r, total[lang], -score))
    return sorted(out)


def talk(rng, n):
    rows = [(None, None), ("a", ""), ("b", " ,\t. \n"), ("a", "one"), (None, "Ünd SO weiter"), ("only", None)]
    for _ in range(n):
        text = []
        for _ in range(rng.randrange(1, 60)):
            text.append(rng.choice(["the", "of the", "the big", "New York", "new york city", "x y z", "ÄÖ ß", f"w{rng.randrange(300)}"]))
            text.append(rng.choice([" ", " ", " ", "\t", ", ", ".", "\r\n", " ; "]))
        rows.append((rng.choice(["a", "a", "b", None]), "".join(text)))
    return rows + [("a", "hot pair and " * 400), ("a", "hot pair or " * 300)]


@pytest.mark.parametrize("options", [{}, {"budget": 200}, {"least": 4, "share": 80, "top": 7, "budget": 900}])
def test_collocations(spark, monkeypatch, options):
    if options:  # a text in many parts
        monkeypatch.setattr(collocations, "FLUSH", 150)
        monkeypatch.setattr(collocations, "BLOCK", 64)
    rows = talk(random.Random(4), 150)
    docs = spark.createDataFrame([(lang, t, "x") for lang, t in rows], "lang string, text string, n string").repartition(3)
    got = collocations.collocations(docs, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_collocations(rows, options.get("least", 10), options.get("share", 50), options.get("top", 2000))
    assert len(want) > 10 and sorted(map(tuple, got.collect())) == want


def test_a_crowded_word_is_spread_over_groups(spark, monkeypatch):
    rows = talk(random.Random(4), 150)
    texts = spark.createDataFrame([(lang or "und", t) for lang, t in rows], "lang string, text string")
    seen = []
    plain = collocations._blocks
    monkeypatch.setattr(collocations, "_blocks", lambda *a: seen.append(plain(*a)) or seen[-1])
    collocations._phrases(texts, collocations._word_counts(texts), 10, 400, lambda df, name: df).count()
    sizes = Counter()
    for r in seen[0].collect():
        sizes[r.group] += int(np.frombuffer(r.leaves, "<u4").reshape(-1, 4)[:, 3].sum())
    assert len(sizes) > 20 and max(sizes.values()) < sum(sizes.values()) / 5


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, "a b")], "lang string, text string")).count() == 0


# --- conversation repair ----------------------------------------------------------------------


def brute_repair(turns):
    """Least (cost, audit, text) over all edits with at most two turns put in at a place."""
    seen, faults = set(), []
    for role, text in turns:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else None if ink[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = None
    extras = ["", "u", "a", "ua", "au"]
    ways = []
    for (role, text), fault in zip(turns, faults):
        ways.append([("D", 2, None)])
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            ways[-1] += [("K", more, (role, text)), ("R", 1 + more, ("user", text)), ("R", 1 + more, ("assistant", text))]
    for put in itertools.product(extras, repeat=len(turns) + 1):
        if sum(map(len, put)) > 3:
            continue
        for picked in itertools.product(*ways):
            cost = sum(p[1] for p in picked) + 5 * sum(map(len, put))
            if best and cost > best[0]:
                continue
            audit, kept = "", []
            for i in range(len(turns) + 1):
                audit += "I" * len(put[i])
                kept += [({"u": "user", "a": "assistant"}[c], "") for c in put[i]]
                if i < len(turns):
                    audit += picked[i][0]
                    kept += [picked[i][2]] if picked[i][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in kept)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in kept))
    return faults, best


def test_repair(spark):
    rng = random.Random(6)
    rows, want = [], {}
    texts = ["Yes.", "No!", "cut", "Why? ", " \n", "", "Yes."]
    for conv in range(90):
        turns = [(t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool"]), rng.choice(texts)) for t in range(rng.randrange(0, 4))]
        turns = [(None if rng.random() < 0.1 else t + rng.randrange(2) * 3, r, x) for t, r, x in turns]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        rows += [(conv, *t) for t in turns]
        if turns:
            faults, (cost, audit, text) = brute_repair([t[1:] for t in turns])
            at = [t[0] for t in turns if t[0] is not None]
            pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
            want[conv] = (
                max(at) - min(at) + 1 - len(set(at)) if at else 0,
                *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha(text),
            )
    df = spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string").repartition(4)
    got = {r.conv: tuple(r)[1:] for r in repair.repair(df).collect()}
    assert got == want


def test_repair_of_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASH)
    rows = [(None, 0, "user", "a."), (None, None, None, None), (7, 1, "user", None), (8, 2, None, "x?"), (8, 2, None, "x?")]
    df = spark.createDataFrame([(*r, *("x" for _ in CLASH)) for r in rows], schema)
    got = {r.conv_id: r for r in repair.repair(df, "conv_id").collect()}
    assert got[None].audit == "DD" and got[None].blank == 1 and got[None].gaps == 0
    assert (got[7].audit, got[7].cost, got[7].repaired_sha256) == ("D", 2, sha(""))
    assert got[8].audit == "DD" and got[8].duplicate == 1 and got[8].gaps == 0
    assert repair.repair(df.limit(0), "conv_id").count() == 0


def test_damage(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, copy string"
    rows = [(c, t, "system", "a.b!") for c in range(40) for t in range(5)] + [(None, None, None, None), (1, None, None, "x.")]
    got = repair.damage(spark.createDataFrame([(*r, "x") for r in rows], schema)).collect()
    found = Counter((r.conv, r.turn, r.role, r.text, r.copy, r.gone) for r in got)
    want = Counter()
    for c, t, role, text in rows:
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        for copy in range(2 if draw == 3 else 1):
            want[c, t, "user" if draw == 4 else role, text, copy, draw == 0] += 1
    assert found == want


def test_a_long_conversation_keeps_one_audit(spark):
    many = 9000  # more than one part of an audit
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}." if t % 500 else f"{t}") for t in range(many)]
    got = repair.repair(spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string")).first()
    # a cut question costs more than to delete it with an answer beside it, the one before if there is one
    want = "DD" + "".join("D" if (t + 1) % 500 < 2 else "K" for t in range(2, many - 1)) + "K"
    assert (got.truncated, got.cost, got.audit) == (18, 4 * 18, want)
