import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from recipeframe.llm import leakage, lookalike
from recipeframe.llm.lookalike import Trie, skeleton


@pytest.mark.parametrize(
    "a,b",
    [("ｔａｒtе", "tarte"), ("piña", "piña"), ("ﬂat​bread", "flatbread"), ("a b", "a b"), ("⼩勺", "小勺"), ("Ⅳ", "IV"), ("so\xadup‎", "soup"), ("１２g", "12g"), ("豆︀腐", "豆腐"), ("οil", "oil"), ("  a  b ", "a b"), ("ᎪꓢⲤ", "ASC"), ("ᴏꜱ", "os"), ("𝗌𝟣𝚊", "s1a")],
)
def test_same_look(a, b):
    assert skeleton(a) == skeleton(b)


@pytest.mark.parametrize("a,b", [("Tarte", "tarte"), ("pina", "piña"), ("a:b", "a：b"), ("x²", "x2"), ("①", "1"), ("œuf", "oeuf"), ("straße", "strasse"), ("ſalt", "salt"), ("饭", "飯"), ("a b", "ab"), ("ı", "i"), ("𝐬", "s")])
def test_visible_difference(a, b):
    assert skeleton(a) != skeleton(b)


def test_trie_agrees_with_table():
    words = ["tarte", "tartе", "pudding", "Борщ", "flat", "ﬂat", "piña"]
    t = Trie([(w, i) for i, w in enumerate(words)])
    for w in [*words, "ｔａｒｔｅ", "piña", "f​lat", "nothing", "tart", "​"]:
        m = t.match(w)
        assert (m is not None) == (skeleton(w) in {skeleton(x) for x in words})
        assert m is None or skeleton(m) == skeleton(w)
    assert t.match("tarte") == t.match("tartе") == "tarte"


def test_trie_budget():
    t = Trie([("pudding", 1), ("soup", 1)])
    assert t.match("puddng") is None and t.match("puddng", 1) == "pudding" and t.match("sooup", 1) == "soup" and t.match("sоap", 1) == "soup"


def brute(values):
    v = {(f, k, s) for f, k, s in values if k is not None and s is not None and skeleton(s)}
    out = set()
    for (f, k, s), (g, m, t) in combinations(v, 2):
        if f == g and k != m and s != t and skeleton(s) == skeleton(t):
            out.add((f, min(k, m), max(k, m)))
    return out


def test_same_looking_matches_brute_force(spark):
    base = ["tarte rhubarb", "tartе rhubarb", "ｔarte rhubarb", "Tarte rhubarb", "a：b", "a:b", "soup", "soup⁠", "", " ", "​", None, "x" * 5000, "ｘ" + "x" * 4999]
    rows = [("t" if i % 5 else "u", i % 23 or None, base[i % len(base)]) for i in range(120)]
    df = spark.createDataFrame([*rows, *rows[:30]], "field string, key bigint, value string").withColumn("form", F.lit("clash"))
    for limit in (1, 3, 1000):  # results don't depend on the vocabulary's bound
        got = [tuple(r) for r in lookalike.same_looking(df, limit).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert lookalike.same_looking(df.where("false")).count() == 0


def test_groups_are_the_pairs(spark):
    base = ["tarte", "tartе", "soup", "ｓoup", "soup ", "stew"]
    rows = [("t", i, base[i % 6]) for i in range(30)]
    df = spark.createDataFrame(rows, "field string, key bigint, value string")
    by = {}
    for r in lookalike.look_groups(df).collect():
        by.setdefault((r["field"], r["form"]), set()).add((r["key"], r["value"]))
    assert {(f, *sorted((k, m))) for (f, _), x in by.items() for (k, s), (m, t) in combinations(x, 2) if s != t and k != m} == brute(rows)


def test_spelling_in_one_script(spark):
    t = Trie([("рис", 3), ("pиc", 9), ("ｃafе", 5)])
    assert t.match("pис") == "рис" and t.match("cafe") == t.match("ｃafе") == "cafe"


def test_suggestions(spark):
    rows = [("soup",)] * 20 + [("sоup",)] * 2 + [("soop",), ("soap bowl",), ("stew",), (None,), ("",), ("x" * 5000,)]
    df = spark.createDataFrame(rows, "title string")
    assert {(r["token"], r["n"], r["suggestion"]) for r in lookalike.suggestions(df, "title").collect()} == {("sоup", 2, "soup"), ("soop", 1, "soup"), ("soap", 1, "soup")}


def test_plain_text_is_its_own_form():
    import re

    plain = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", lookalike.PLAIN).replace(r"\z", r"\Z"))
    for c in map(chr, range(0x20, 0x11000)):
        if plain.match(c):
            assert skeleton(c) == c and single_script_of(c)
    assert plain.match("crème brûlée 2") and plain.match("盐：2克") and not plain.match("a  b") and not plain.match("tartе") and not plain.match("e\u0301") and not plain.match("a\n")


def single_script_of(c):
    return lookalike._script(c) in ("", "LATIN")


def test_canonical_is_idempotent_and_keeps_nulls(spark):
    df = spark.createDataFrame([("piña ﬂan",), ("piña flan",), (None,), ("​",), ("Борщ",)], "t string")
    vocab = lookalike.vocabulary(df, "t")
    one = lookalike.canonical(df, "t", "c", vocab)
    two = lookalike.canonical(one, "c", "d", vocab).collect()
    assert all(r["c"] == r["d"] for r in two)
    assert [r["c"] for r in two] == ["piña flan", "piña flan", None, "", "Борщ"]


ITEM = "Explain to a beginner why the carrots weep when the stew rests longer than fifty minutes."


def test_leaks(spark):
    long = "filler words " * 20000 + ITEM + " more"
    docs = [(1, "intro: EXPLAIN, to a beginner -- why the carrots weep when the stew rests! end"), (2, "explain to a beginner why the carrots and weep when the stew rests longer"), (3, long), (4, None), (5, ""), (6, "...")]
    d = spark.createDataFrame([*docs, docs[0]], "doc_id bigint, text string").withColumn("item_id", F.lit(9))
    i = spark.createDataFrame([(7, ITEM), (8, "too short an item"), (9, None), (10, "")], "item_id bigint, text string").withColumn("doc_id", F.lit(9))
    assert {tuple(r) for r in leakage.leaked_pairs(d, i).collect()} == {(1, 7), (3, 7)}
    got = {r["doc_id"]: r for r in leakage.leaks(d, i).collect()}
    assert docs[0][1][got[1]["start"] : got[1]["end"]] == "EXPLAIN, to a beginner -- why the carrots weep when the stew rests"
    assert got[1]["n_words"] == 12 and got[3]["share"] == 1.0 and long[got[3]["start"] : got[3]["end"]] == ITEM[:-1]
    assert leakage.leaks(d.where("false"), i).count() == 0 and leakage.leaks(d, i.where("false")).count() == 0
    assert {tuple(r) for r in leakage.leaks(d, i, short=True).select("doc_id", "item_id").distinct().collect()} == {(1, 7), (3, 7)}


def test_offsets_when_lower_case_is_longer(spark):
    text = "İİ x " + "a b c d e f g h i j k l" + " y"
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id bigint, text string")
    r = leakage.leaks(d, i).first()
    assert text[r["start"] : r["end"]] == "a b c d e f g h i j k l"


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK", 100)
    items = [(k, f"w{k} " + " ".join(f"t{k}x{j}" for j in range(14))) for k in range(20)]
    d = spark.createDataFrame([(k, "see " + t) for k, t in items], "doc_id bigint, text string")
    got = {tuple(r) for r in leakage.leaked_pairs(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(k, k) for k in range(20)}


@pytest.mark.parametrize("words,short", [(1, False), (3, False), (5, True), (12, False), (12, True)])
def test_passages_match_brute_force(words, short):
    rnd = random.Random(words)
    text = lambda n, v: ", ".join(rnd.choice("abcdefgh"[:v]) for _ in range(n))
    items = [(k, text(rnd.randrange(0, 30), rnd.choice([2, 8]))) for k in range(12)]
    p = leakage.Patterns(items, words, short)
    for _ in range(60):
        src = rnd.choice(items)[1]
        a = rnd.randrange(len(src) + 1)
        doc = text(rnd.randrange(9), 8) + " " + src[a:] + " " + text(rnd.randrange(20), 2)
        w, want = leakage.words_of(doc), set()
        for k, t in items:
            v = leakage.words_of(t)
            n = min(words, len(v)) if short else words
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            want |= {(k, i) for at in range(len(w) - n + 1) if tuple(w[at : at + n]) in grams for i in range(at, at + n)}
        starts = {m.start(): i for i, m in enumerate(leakage.WORD.finditer(doc))}
        assert {(k, starts[s] + i) for k, s, _, n, _ in p.passages(doc) for i in range(n)} == want
