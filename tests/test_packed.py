import random

import pytest
from pyspark.sql import functions as F

from recipeframe.operators.packed import explode_packed, known, parse

LEADS = known({w: True for w in "spring fermented autumn add beat use season don't stir mix breads fish eggs vegan mild brown".split()} | {"brown rice": False})


@pytest.mark.parametrize(
    "text,values",
    [
        ("['a', \"cook's choice\", '\"secret\" family']", ["a", "cook's choice", '"secret" family']),
        ("('mild',)", ["mild"]),
        ('c("spicy", "use a 9\\" tin")', ["spicy", 'use a 9" tin']),
        ('{"mild","b, c"}', ["mild", "b, c"]),
        ('"baking","fish, smoked"', ["baking", "fish, smoked"]),
        ('grains,"fish, smoked",farmers\' market', ["grains", "fish, smoked", "farmers' market"]),
        ('"""secret"" family";beans', ['"secret" family', "beans"]),
        ("spring, fermented|vegan,autumn;mild", ["spring", "fermented", "vegan", "autumn", "mild"]),
        ("breads, quick;vegan", ["breads, quick", "vegan"]),
        ("layer mint, brown rice and eggs; beat, brown the rice", ["layer mint, brown rice and eggs", "beat", "brown the rice"]),
        ("[['a, b'], 'c']", ["'a, b'", "c"]),
        ("[[a b], 'c']", ["a b", "c"]),
        ("a ~ b~c", ["a", "b", "c"]),
        ("1) a b 2) c, d 3) e; f", ["a b", "c, d", "e; f"]),
        ("(1) x (2) y", ["x", "y"]),
        ("1. a\n2. b", ["a", "b"]),
        ("1 - a\n2 - b; c", ["a", "b; c"]),
        ("* a\n* b", ["a", "b"]),
        ("a\r\n\r\nb", ["a", "b"]),
        ("a\tb", ["a", "b"]),
        (" 145.9; 38.0;", ["145.9", "38.0"]),
        ("542,0;20,0", ["542,0", "20,0"]),
        ("352.6  34.0", ["352.6", "34.0"]),
        ("35.6; 54.0,86.0", ["35.6", "54.0", "86.0"]),
        ("[82.0, 73.0]", ["82.0", "73.0"]),
        ("353.3 / 14.0", ["353.3", "14.0"]),
        ("dairy-free/lunch-box", ["dairy-free", "lunch-box"]),
        ("add salt, pepper, and 1/2 of it", ["add salt, pepper, and 1/2 of it"]),
        ("['mix a [optional]', 'b']", ["mix a [optional]", "b"]),
        ("['a', '', ' ', 'b']", ["a", "b"]),
        ("[]", []),
        ("", []),
        (None, []),
        ("one value", ["one value"]),
        (r'["café", "a\\b"]', ["café", "a\\b"]),
    ],
)
def test_values(text, values):
    assert parse(text, LEADS) == [(v, "") for v in values]


def test_many_malformed_quotes_take_linear_time():
    values = parse("[" + ", ".join(f"'v{i}" for i in range(200_000)) + "]")
    assert len(values) == 200_000 and values[7] == ("v7", "bad_quote")


def test_malformed_quotes_are_flagged():
    assert parse("['don't rush', 'b']") == [("don't rush", "bad_quote"), ("b", "bad_quote")]
    assert [v for v, _ in parse('["a", "b')] == ["a", "b"] and parse('["a", "b')[0][1]


def test_round_trip_of_every_writing():
    rnd = random.Random(1)
    words = ["stir; wait, then stir", "use a 9\" tin", "don't skip it", "plain", "mix [a] & b", "half (or so)"]
    for _ in range(200):
        v = [rnd.choice(words) for _ in range(rnd.randint(1, 6))]
        for s in (repr(v), "(" + ", ".join(map(repr, v)) + ",)", "c(" + ", ".join('"' + x.replace('"', '\\"') + '"' for x in v) + ")", ",".join('"' + x.replace('"', '""') + '"' for x in v), "\n".join(f"{i}. {x}" for i, x in enumerate(v, 1)), "\n".join("- " + x for x in v), "\t".join(v) if len(v) > 1 else "- " + v[0], " ".join(f"{i}) {x}" for i, x in enumerate(v, 1))):
            assert [x for x, _ in parse(s)] == v, s


def test_explode(spark):
    long = "[" + ", ".join(f"'v{i}'" for i in range(5000)) + "]"
    rows = [(1, "['a', 'b']", None), (1, "['a', 'b']", None), (2, None, ""), (None, "x|y", "1;2"), (3, long, "[]")]
    df = spark.createDataFrame(rows, "id bigint, tags string, nutrition string").withColumn("pos", F.lit(7)).withColumn("value", F.lit("clash")).withColumn("_key", F.lit(0))
    got = explode_packed(df, "id", ["tags", "nutrition"])
    assert got.columns == ["id", "field", "pos", "value", "error"]
    rows = sorted((r["id"] or 0, r["field"], r["pos"], r["value"]) for r in got.where("id is null or id < 3").collect())
    assert rows == [(0, "nutrition", 1, "1"), (0, "nutrition", 2, "2"), (0, "tags", 1, "x"), (0, "tags", 2, "y"), (1, "tags", 1, "a"), (1, "tags", 2, "b")]
    assert got.where("id = 3").count() == 5000
    assert explode_packed(df.where("false"), "id", ["tags"]).count() == 0


def test_words_that_start_and_continue_values(spark):
    rows = [(1, "['brown the rice', 'layer mint, brown rice and eggs', 'layer eggs, brown rice and mint', 'layer, brown rice']"), (2, "layer x, brown rice and y; chop, brown the eggs")]
    got = explode_packed(spark.createDataFrame(rows, "id bigint, steps string"), "id", ["steps"]).where("id = 2").orderBy("pos")
    assert [r["value"] for r in got.collect()] == ["layer x, brown rice and y", "chop", "brown the eggs"]


def test_rare_lead_words_separate(spark):
    rows = [(i, "[" + ", ".join(f"'w{j} x'" for j in range(i % 2, 4500, 2)) + "]") for i in range(4)]
    rows += [(4, "['rare thing', 'w1 y']"), (5, "mild, rare thing|w1 z, other"), (None, "w7, rare"), (6, "a, rare b; c"), (7, None), (8, "['open, rare; w2")]
    got = explode_packed(spark.createDataFrame(rows, "id bigint, tags string"), "id", ["tags"]).where("id is null or id > 4")
    values = {}
    for r in got.orderBy("id", "pos").collect():
        values.setdefault(r["id"], []).append(r["value"])
    assert values[5] == ["mild", "rare thing", "w1 z, other"] and values[None] == ["w7", "rare"] and values[6] == ["a", "rare b", "c"]
