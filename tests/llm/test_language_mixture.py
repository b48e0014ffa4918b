import random

import pytest
from pyspark.sql import functions as F

from recipeframe.llm import language, mixture

SENTENCES = {
    "en": ["Add the carrots and stir until they are soft.", "Taste it before you add more salt.", "Cook it for ten minutes and let it rest.", "Nobody leaves any of this on the plate."],
    "es": ["Añade las zanahorias y remueve hasta que estén blandas.", "Prueba el caldo antes de echar más sal.", "Cocina diez minutos y deja que repose.", "Nadie deja nada de esto en el plato."],
    "de": ["Die Karotten dazugeben und rühren, bis sie weich sind.", "Vor dem Nachwürzen mit Salz bitte probieren.", "Zehn Minuten kochen und ruhen lassen.", "Niemand lässt davon etwas auf dem Teller."],
    "ja": ["にんじんを加えてやわらかくなるまで混ぜます。", "塩を足す前に味見をしてください。", "十分ほど煮て休ませます。", "誰もお皿に残しません。"],
}


@pytest.fixture(scope="module")
def model():
    docs = [(x, [s.replace("ten", f"ten {w}") for s in ss]) for w in "abcdefghijklmnopqrst" for x, ss in SENTENCES.items()]
    return language.train([*docs, ("en", SENTENCES["ja"])])


def test_sentences():
    t = 'One 3.5 cups. "Two!" she said? 三个。四\nfive'
    assert [t[a:z] for a, z in language.sentences(t)] == ["One 3.5 cups.", '"Two!"', "she said?", "三个。", "四", "five"]
    assert language.sentences("") == [] and language.sentences(" \n ") == []


def read(model, texts):
    return [[g[2] for g in x] for x in language.stretches(model, texts)]


def test_sentences_are_read(model):
    assert model["accuracy"] > 0.95 and all(r[3] < 0.05 for r in model["report"])
    texts = [s for ss in SENTENCES.values() for s in ss]
    assert read(model, texts) == [[x] for x, ss in SENTENCES.items() for _ in ss]
    assert read(model, []) == [] and read(model, ["", "(Musik) 12"]) == [[], []]
    assert read(model, ["Щи да каша пища наша"]) == [[None]]


def test_held_out_labels_count_as_delivered():
    docs = [(x, ss) for x, ss in SENTENCES.items() for _ in range(20)]
    wrong = [*docs[:59], ("de", SENTENCES["ja"]), *docs[60:]]  # the German document that is measured on
    assert language.train(docs)["accuracy"] == 1.0 and language.train(wrong)["accuracy"] == 0.75


def test_the_shortcut_is_the_path(model, monkeypatch):
    rnd = random.Random(3)
    every = [s for ss in SENTENCES.values() for s in ss]
    texts = [" ".join(rnd.sample(every, rnd.randint(1, 3))).replace(".", "") for _ in range(40)] + every
    got = language.stretches(model, texts)
    monkeypatch.setattr(language, "LONG", 0)  # every sentence takes the path
    for a, b in zip(got, language.stretches(model, texts)):
        assert [x[:3] for x in a] == [x[:3] for x in b]


def test_probabilities_sum_to_one():
    texts = [language.plain(s) for s in SENTENCES["en"]]
    tables, _ = language._fit(texts, 3)
    for t in tables[1:]:
        assert (t["p"] > 0).all() and (t["p"] < 1 + 1e-9).all()
    assert abs(tables[0]["p"].sum() + tables[0]["back0"] - 1) < 0.01  # the rest is for unseen characters


def test_unpunctuated_mixture(model):
    en = " ".join(SENTENCES["en"] * 2).replace(".", "").lower()
    es = " ".join(SENTENCES["es"]).replace(".", "").lower()
    got = language.stretches(model, [en + " (にんじん) " + es])[0]
    assert [g[2] for g in got] == ["en", "es"]
    assert abs(got[0][1] - len(en)) < 15


@pytest.mark.parametrize("text,want", [("en-US", "en"), ("EN", "en"), ("en_AU", "en"), ("zh-Hans", "zh"), ("jpn", "ja"), ("ko-orig", "ko"), ("und", None), ("unknown", None), ("", None), (None, None), ("ru", None), ("deu", "de")])
def test_label(text, want):
    assert language.label(text) == want


def test_wrong_labels_and_segments(spark, model):
    en, es, ja = (" ".join(SENTENCES[x]) for x in ("en", "es", "ja"))
    rows = [("a", en + " " + SENTENCES["es"][0], "en", None), ("b", es, "en", "es-MX"), ("c", None, "en", "en"), ("d", "♪ ♪", "en", "x"), ("e", "", None, None), ("f", ja, "jpn", "zh"), ("g", (en + " ") * 300, "", "en-orig"), (None, en, "en", "en")]
    d = spark.createDataFrame(rows, "key string, t string, lang string, other string").withColumn("_key", F.lit(1)).withColumn("field", F.lit("x"))
    got = {(r["key"], r["field"], r["true_lang"]) for r in language.wrong_labels(d, "key", "t", ["lang", "other"], model).collect()}
    assert got == {("a", "other", "en"), ("a", "mixed", "es"), ("b", "lang", "es"), ("f", "other", "ja"), ("g", "lang", "en")}
    seg = [(r["segment"], r["segment_lang"], r["n_sentences"]) for r in language.segments(d, "key", "t", model).where("key = 'a'").orderBy("segment").collect()]
    assert seg == [(1, "en", 4), (2, "es", 1)]
    assert language.wrong_labels(d.where("false"), "key", "t", ["lang"], model).count() == 0


def test_sample_is_bounded(spark):
    d = spark.createDataFrame([(i, "One sentence here. Two.", ["en", "EN-us", "es", None, "xx"][i % 5]) for i in range(100)], "k bigint, t string, l string")
    got = language.sample(d, "k", "t", F.col("l"), per_language=3)
    assert {x for x, _ in got} == {"en", "es"} and len(got) == 6 and all(len(ss) == 2 for _, ss in got)


def mix_docs(spark):
    rows = [(i, f"soup number {i} with salt and {'pepper ' * (i % 7)}", "big", 1) for i in range(400)]
    rows += [(1000 + i, f"cake number {i} with sugar", "small", 1) for i in range(30)] + [(2000, "lost", None, 1), (2001, None, "big", 1), (2002, "", "small", 1), (0, "again", "big", 1), (None, "x", "big", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, tokens int")


TARGETS = [("big", 0.5, 1), ("small", 0.3, 4), ("none", 0.2, 2), (None, 0.1, 1)]


def test_mixture_meets_targets(spark):
    docs, targets = mix_docs(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mix = mixture.solve(docs, targets)
    drawn = mixture.draw(mix)
    rows = {r["source"]: r for r in mixture.report(mix, drawn, targets).collect() if r["source"]}
    assert abs(rows["big"]["share"] - 0.5 / 0.8) < 0.02 and abs(rows["small"]["share"] - 0.3 / 0.8) < 0.02
    assert rows["none"]["share"] == 0 and rows["small"]["most_copies"] <= 4 and rows["big"]["most_copies"] <= 1
    got = drawn.collect()
    assert len({r["doc_id"] for r in got}) == len(got) and all(r["source"] for r in got)


def test_mixture_with_budget_and_soft_labels(spark):
    docs, targets = mix_docs(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mix = mixture.solve(docs, targets, budget=500.0)
    assert abs(mix.expected.sum() - 500) < 5
    soft = mixture.solve(docs, targets, budget=500.0, label_trust=0.8, unlabelled=True)
    assert soft.accuracy > 0.9 and abs(soft.expected[0] / soft.expected.sum() - 0.625) < 0.02
    r = soft.rates.agg(F.min("rate").alias("lo"), F.max(F.col("rate") - F.col("cap")).alias("over")).first()
    assert r["lo"] >= 0 and r["over"] <= 1e-9


def test_expected_totals_count_small_posteriors(spark):
    docs, targets = mix_docs(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mix = mixture.solve(docs, targets, label_trust=0.9, unlabelled=True)
    vocabulary = mixture.default_vocabulary()
    rates = {r["doc_id"]: r["rate"] for r in mix.rates.collect()}
    want = [0.0] * len(mix.sources)
    for r in mixture.measured(docs, mixture.classifier(docs, vocabulary), vocabulary).collect():
        for i, (s, p) in enumerate(zip(mix.sources, r["posterior"])):
            want[i] += rates[r["doc_id"]] * r["tokens"] * (p if r["source"] is None else 0.9 * (r["source"] == s) + 0.1 * p)
    assert list(mix.expected) == pytest.approx(want, rel=1e-6)
    assert all(abs(e / sum(want) - t) < 0.005 for e, t in zip(mix.expected, (0.625, 0.375)))


def test_mixture_of_nothing(spark):
    docs, targets = mix_docs(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    assert mixture.draw(mixture.solve(docs.where("false"), targets)).count() == 0
    assert mixture.draw(mixture.solve(docs, targets.where("false"))).count() == 0
