import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recipeframe.llm import neardup, spans
from recipeframe.llm.fmindex import FMIndex
from recipeframe.runtime import member_pairs


def similar(rows, t):
    s = {k: frozenset(w) for k, w in rows.items()}
    return {(a, b) for a, b in combinations(sorted(s), 2) if s[a] and len(s[a] & s[b]) >= t * len(s[a] | s[b]) - 1e-9}


@pytest.mark.parametrize("seed,rare,vocab,frequent", [(1, 8, 60, 10**6), (1, 8, 60, 0), (2, 0, 40, 10**6), (3, 3, 200, 10**6), (4, 1, 25, 10**6), (4, 1, 25, 0)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, seed, rare, vocab, frequent):
    monkeypatch.setattr(neardup, "RARE", 5)
    monkeypatch.setattr(neardup, "FREQUENT", frequent)
    rnd = random.Random(seed)
    rows = {}
    for i in range(260):
        if rows and rnd.random() < 0.4:
            w = set(rows[rnd.choice(list(rows))])
            for _ in range(rnd.randrange(9)):
                w.symmetric_difference_update({f"v{rnd.randrange(vocab)}"})
        else:
            w = {f"v{rnd.randrange(vocab)}" for _ in range(rnd.randrange(1, 40))} | {f"n{i}x{j}" for j in range(rnd.randrange(rare + 1))}
        rows[i] = w
    df = spark.createDataFrame([(k, " ".join(sorted(w)), None) for k, w in rows.items()], "id bigint, title string, steps array<string>")
    links, members = neardup.similar(df, "id", ["title", "steps"], 0.7)
    got = [tuple(r) for r in neardup.pairs(links, members).collect()]
    assert len(got) == len(set(got)) and set(got) == similar(rows, 0.7)


def test_copies_and_edge_cases(spark):
    rows = [(i, "same words here", ["a"]) for i in range(30)] + [(100, None, None), (101, "", []), (102, "...", [None]), (None, "same words here", ["a"]), (103, "SAME, words: here", ["a", "b"]), (0, "same words here", ["a"])]
    df = spark.createDataFrame(rows, "id bigint, title string, steps array<string>").withColumn("cls", F.lit(1)).withColumn("words", F.lit("x")).withColumn("n", F.lit(2))
    links, members = neardup.similar(df, "id", ["title", "steps"], 0.7)
    assert neardup.pairs(links, members).count() == 30 * 29 // 2 + 30
    few = neardup.pairs(links, members, expand=10)
    assert few.count() == 29 + 1  # a star and one link of the class
    g = {r["key"]: r for r in neardup.groups(links, members).collect()}
    assert g[5]["group"] == g[103]["group"] == 0 and g[5]["n_copies"] == 30 and g[100]["n_links"] == 0
    empty = neardup.similar(df.where("false"), "id", ["title", "steps"], 0.7)
    assert neardup.pairs(*empty).count() == 0 and neardup.groups(*empty).count() == 0
    with pytest.raises(ValueError):
        neardup.similar(df, "id", ["title"], 0.4)


def test_large_classes_of_different_texts(spark):
    rows = {i: ("salt pepper soup bread", "Bread: soup, PEPPER salt")[i % 2] for i in range(230)}  # one word set, two texts
    rows |= {300 + i: "salt pepper soup bread tea" for i in range(3)} | {400: "nothing like it"}
    df = spark.createDataFrame(list(rows.items()), "id bigint, title string")
    got = [tuple(r) for r in neardup.pairs(*neardup.similar(df, "id", ["title"], 0.7)).collect()]
    want = similar({k: t.lower().replace(":", "").replace(",", "").split() for k, t in rows.items()}, 0.7)
    assert len(got) == len(set(got)) == 233 * 232 // 2 and set(got) == want


def statistics(texts, owner, least):
    out = {}
    for i, t in enumerate(texts):
        for s in range(len(t)):
            n = 0
            for j, u in enumerate(texts):
                if owner[i] != owner[j]:
                    while s + n < len(t) and t[s : s + n + 1] in u:
                        n += 1
            if n >= least:
                out[i, s] = n
    return out


def test_matching_statistics():
    rnd = random.Random(1)
    for _ in range(40):
        k, least = rnd.choice([2, 3, 900]), rnd.choice([2, 3, 5])
        texts = ["".join(chr(97 + rnd.randrange(k)) for _ in range(rnd.randint(least, 30))) for _ in range(rnd.randint(2, 7))]
        texts.append(texts[0][:15] + texts[1][-5:])
        owner = np.array([rnd.randrange(4) for _ in texts])
        index = FMIndex([spans._points(t).astype(np.int64) for t in texts], owner)
        w, p, n, rows = index.matching(least)
        assert {(int(a), int(b)): int(c) for a, b, c in zip(w, p, n)} == statistics(texts, owner, least)
        sets = {tuple(x.tolist()) for x in index.owners_of(rows, least)} if len(rows) else set()
        want = {tuple(sorted({int(o) for o, u in zip(owner, texts) if t[s : s + least] in u})) for t in texts for s in range(len(t) - least + 1)}
        assert sets == {x for x in want if len(x) > 1}


def corpus(seed, n=120):
    rnd = random.Random(seed)
    abc = "abcdefgh 煮饭茶" if seed % 2 else "ab "
    text = lambda k: "".join(rnd.choice(abc) for _ in range(k))
    docs = {}
    for i in range(n):
        t = text(rnd.randrange(0, 900))
        if docs and rnd.random() < 0.5:
            src = docs[rnd.choice(list(docs))]
            if len(src) > 300:
                a = rnd.randrange(len(src) - 250)
                t = t[: rnd.randrange(len(t) + 1)] + src[a : a + rnd.choice([250, 298, 299, 300, 301, 340, 600])] + t
        docs[i] = t
    docs[n], docs[n + 1] = docs[1], docs[1]
    return docs


def shared_pairs(docs, least):
    at = {}
    for d, t in docs.items():
        for g in {t[i : i + least] for i in range(len(t) - least + 1)}:
            at.setdefault(g, set()).add(d)
    return {p for s in at.values() for p in combinations(sorted(s), 2)}


def covered(docs, d, least):
    t, mark = docs[d], bytearray(len(docs[d]))
    for i in range(len(t) - least + 1):
        if any(t[i : i + least] in u for e, u in docs.items() if e != d):
            mark[i : i + least] = b"\1" * least
    return sum(mark)


@pytest.mark.parametrize("seed,hot,run", [(1, 10**6, 32), (2, 10**6, 2), (3, 800, 32)])
def test_shared_spans(spark, monkeypatch, seed, hot, run):
    monkeypatch.setattr(spans, "HOT_CHARS", hot)
    monkeypatch.setattr(spans, "RUN", run)
    docs = corpus(seed)
    rows = [*docs.items(), (900, None), (901, ""), (None, docs[1]), (3, docs[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("pos", F.lit(1))
    matches, members = spans.shared(df, 300)
    got = [tuple(r) for r in spans.pairs(matches, members, df.select("doc_id", F.length("text").alias("n")), 300).collect()]
    want = shared_pairs(docs, 300)
    assert len(got) == len(set(got)) and set(got) == want
    for r in spans.portions(df, matches, members, 300).collect():
        if r["doc_id"] < 900:
            assert r["shared_chars"] == covered(docs, r["doc_id"], 300), r


@pytest.mark.parametrize("seed,whole,hot", [(3, True, 800), (4, False, 800), (4, False, 10**6)])
def test_pairs_of_hot_stretches_are_complete(spark, monkeypatch, seed, whole, hot):
    monkeypatch.setattr(spans, "HOT_CHARS", hot)
    monkeypatch.setattr(spans, "LISTED", 8)
    docs, rnd = corpus(seed), random.Random(seed)
    text = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    header, passage = text(260), text(330)
    docs |= {200 + i: text(rnd.randrange(99)) + header + text(rnd.randrange(99)) for i in range(20)}  # hot, too short to share
    tail = text(60)
    docs |= {300 + i: text(50) + header + tail + text(50) for i in range(3)}  # a rare stretch that starts at the hot header
    docs |= {400 + i: text(rnd.randrange(99)) + passage + text(rnd.randrange(99)) for i in range(40)}
    docs |= {500 + i: docs[1] for i in range(210)}  # exact copies
    docs |= {800: "ab" * 400, 801: "ba" * 300, 802: "b" + "ab" * 160, 803: "a" * 400, 804: "a" * 301}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    matches, members = spans.shared(df, 300, whole=whole)
    got = [tuple(r) for r in spans.pairs(matches, members, df.select("doc_id", F.length("text").alias("n")), 300).collect()]
    assert len(got) == len(set(got)) and set(got) == shared_pairs(docs, 300)


def test_long_copies_give_short_windows(spark):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefghij ") for _ in range(200_000))
    docs = spark.createDataFrame([(1, text), (2, text[:100_000] + "#" + text[100_000:]), (3, "x" * 400)], "doc_id bigint, text string")
    keys = spans.key_table(docs, 300)
    win = spans.windows(docs, keys, spans.shared_keys(keys), 300)
    longest, total = win.agg(F.max(F.length("text")), F.sum(F.length("text"))).first()
    assert longest < 20_000 and total < 2 * 400_000
    matches, members = spans.shared(docs, 300)
    n = docs.select("doc_id", F.length("text").alias("n"))
    assert [tuple(r) for r in spans.pairs(matches, members, n, 300).collect()] == [(1, 2)]
    assert {r["doc_id"]: r["shared_chars"] for r in spans.portions(docs, matches, members, 300).collect()} == {1: 200_000, 2: 200_000, 3: 0}


def test_member_pairs(spark):
    groups = {1: range(0, 70), 2: range(60, 65), 3: [900], 4: range(100, 135)}
    members = spark.createDataFrame([(g, i) for g, x in groups.items() for i in x], "group bigint, item bigint")
    for links in ([(1, 1)], [(1, 4), (4, 4)], [(1, 3), (2, 3), (2, 2)], [(1, 2)]):
        got = [tuple(r) for r in member_pairs(spark.createDataFrame(links, "a bigint, b bigint"), members, block=8).collect()]
        want = [(min(x, y), max(x, y)) for a, b in links for x in groups[a] for y in groups[b] if a != b or x < y]
        assert sorted(got) == sorted(want)


def test_spans_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    matches, members = spans.shared(df, 300)
    assert matches.count() == 0 and spans.portions(df, matches, members, 300).count() == 0
    with pytest.raises(ValueError):
        spans.distance(100)


def test_periodic_text(spark):
    df = spark.createDataFrame([(1, "ab" * 400), (2, "ba" * 300), (3, "a" * 299), (4, "a" * 400), (5, "a" * 301)], "doc_id bigint, text string")
    matches, members = spans.shared(df, 300)
    got = {tuple(r) for r in spans.pairs(matches, members, df.select("doc_id", F.length("text").alias("n")), 300).collect()}
    assert got == {(1, 2), (4, 5)}
