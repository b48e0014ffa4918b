import pytest
from pyspark.sql import functions as F

from recipeframe.operators import confidence, dedup, lint, quality

SCHEMA = "id bigint, title string, minutes bigint, steps array<string>, ingredients array<string>, calories double, rating_mean double, rating_n bigint"
STEPS = ["Boil the pasta in water.", "Add the tomatoes and season to taste."]


def row(id=1, title="Tomato pasta", minutes=20, steps=STEPS, ingredients=("pasta", "fresh tomato", "salt"), calories=300.0, mean=4.5, n=30):
    return (id, title, minutes, None if steps is None else list(steps), None if ingredients is None else list(ingredients), calories, mean, n)


def flags(spark, **kw):
    return lint.lint(spark.createDataFrame([row(**kw)], SCHEMA)).first()["lint_flags"]


@pytest.mark.parametrize(
    "kw,want",
    [
        ({}, []),
        ({"steps": []}, ["no_steps"]),
        ({"steps": None}, ["no_steps"]),
        ({"steps": ["  ", "Boil pasta, tomatoes and salt"]}, ["too_few_steps"]),
        ({"ingredients": []}, ["no_ingredients"]),
        ({"ingredients": ["Pasta", "pasta"]}, ["dup_ingredient"]),
        ({"ingredients": ["pasta", "saffron"]}, ["unused_ingredient"]),
        ({"ingredients": ["pasta", "saffron"], "steps": ["mix everything", "serve"]}, []),
        ({"ingredients": ["pasta", "pepper"]}, []),
        ({"ingredients": ["fresh chopped"]}, []),
        ({"ingredients": ["corn flakes"], "steps": ["crush the cornflakes", "bake"]}, []),
        ({"ingredients": ["oil"], "steps": ["boil", "bake"]}, ["unused_ingredient"]),
        ({"minutes": 0}, ["time_missing"]),
        ({"minutes": None}, ["time_missing"]),
        ({"minutes": 1051200}, ["time_insane"]),
        ({"calories": 0.0}, ["calorie_outlier"]),
        ({"calories": 30001.0}, ["calorie_outlier"]),
        ({"calories": None}, []),
        ({"calories": float("nan")}, []),
        ({"steps": [], "ingredients": [], "minutes": -1, "calories": -1.0}, ["no_steps", "no_ingredients", "time_missing", "calorie_outlier"]),
    ],
)
def test_flags(spark, kw, want):
    assert flags(spark, **kw) == want


def test_audit_counts_overlaps(spark):
    rows = [row(1, n=12), row(2, n=0, mean=None), row(3, steps=[], minutes=0, n=12, mean=5.0), row(4, steps=[], n=0, mean=None)]
    a = {r["flag"]: r for r in lint.audit(lint.lint(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert a["no_steps"]["n"] == 2 and a["time_missing"]["n"] == 1 and a[lint.BASELINE]["n"] == 2
    assert a["time_missing"]["ratio_10_vs_pass"] == 2.0 and a["no_steps"]["mean_stars"] == 5.0


def test_shrinkage(spark):
    df = spark.createDataFrame([row(1, mean=5.0, n=10000), row(2, mean=3.0, n=10000), row(3, mean=None, n=0), row(4, mean=5.0, n=2, steps=[])], SCHEMA)
    q = {r["id"]: r for r in quality.score(lint.lint(df).withColumn("prior", F.lit("clash"))).collect()}
    prior = (5.0 + 3.0 + 5.0) / 3
    assert abs(q[1]["q_rating"] - 5.0) < 0.01 and q[3]["q_rating"] == pytest.approx(prior)
    assert q[4]["q_rating"] == pytest.approx((2 * 5 + 20 * prior) / 22) and q[4]["q_score"] == 0.0


def test_ratings_skip_zero(spark):
    r = spark.createDataFrame([(1,), (2,)], "id bigint")
    i = spark.createDataFrame([(1, 5), (1, 4), (1, 0), (2, 0), (2, None), (None, 5)], "recipe_id bigint, rating int")
    got = {x["id"]: (x["rating_mean"], x["rating_n"]) for x in quality.with_ratings(r, i).collect()}
    assert got == {1: (4.5, 2), 2: (None, 0)}


def greedy(rows, edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    leader, leaders = {}, []
    for i in sorted(rows, key=lambda r: (-rows[r], r)):
        mine = [x for x in leaders if x in near.get(i, ())]
        leader[i] = mine[0] if mine else i
        if not mine:
            leaders.append(i)
    return leader


def test_families_match_sequential_visit(spark):
    import random

    rnd = random.Random(4)
    words = [f"food{c}" for c in "abcdefghij"]
    rows = [(i, rnd.choice(["red soup", "red stew", "soup", "the best"]), 1, ["x"], rnd.sample(words, rnd.randint(0, 6)), None, None, rnd.choice([0, 1, 5, None])) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    stop = {"the", "best"}
    edges = set()
    for a in rows:
        for b in rows:
            x, y = set(a[4]), set(b[4])
            if a[0] < b[0] and x and len(x & y) >= 0.6 * len(x | y) and (set(a[1].split()) & set(b[1].split())) - stop:
                edges.add((a[0], b[0]))
    assert {(r["a"], r["b"]) for r in dedup.family_edges(df).collect()} == edges
    assert {r["id"]: r["leader_id"] for r in dedup.family(df).collect()} == greedy({r[0]: r[7] or 0 for r in rows}, edges)


def test_families_of_many_copies(spark, monkeypatch):
    """Copies are one class, large groups meet in blocks, and the leader is the first in visiting order."""
    from recipeframe import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    n = 20_000
    df = spark.range(n).selectExpr("id", "if(id % 2 = 0, 'red soup', 'Soup, RED') as title", "array('salt', 'beet', 'dill') as ingredients", "if(id = 77, 9L, null) as rating_n")
    more = spark.createDataFrame([(n, "soup", ["salt", "beet", "dill", "egg"], 5), (n + 1, "stew", ["salt", "beet", "dill"], 99), (n + 2, "soup", ["egg"], 1), (n + 3, "soup", None, 1)], "id bigint, title string, ingredients array<string>, rating_n bigint")
    got = dedup.family(df.unionByName(more)).groupBy("leader_id").count().collect()
    assert {r["leader_id"]: r["count"] for r in got} == {77: n + 1, n + 1: 1, n + 2: 1, n + 3: 1}
    assert dedup.family(more.where("false")).count() == 0
    few = df.where("id < 30").unionByName(more)
    assert {(r["a"], r["b"]) for r in dedup.family_edges(few).collect()} == {(a, b) for b in range(30) for a in range(b)} | {(a, n) for a in range(30)}


def test_exact_quantiles(spark, monkeypatch):
    import random

    from recipeframe import runtime

    rnd = random.Random(2)
    values = [rnd.choice([0.0, 1.5, None, rnd.random()]) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    at = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    bucket = runtime.range_bucket
    for rows in (10**6, 100):  # one range, many ranges
        monkeypatch.setattr(quality, "range_bucket", lambda d, c, r=rows: bucket(d, c, r))
        want = df.agg(F.percentile("v", F.array(*map(F.lit, at))).alias("p")).first()["p"]
        assert quality.exact_quantiles(df, "v", at) == pytest.approx(want)
    assert quality.exact_quantiles(df.where("false"), "v", at) == [None] * len(at) and quality.describe(df.where("false"), "v").first()["p50"] is None


def test_dup_group_of_sparse_ids(spark, monkeypatch):
    from recipeframe import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    bucket = runtime.range_bucket
    monkeypatch.setattr(dedup, "range_bucket", lambda d, c: bucket(d, c, 10))
    ids = [(-1) ** i * i**7 * 1000 for i in range(120)]
    name = lambda k: chr(97 + k % 20) + chr(97 + k % 40 // 20) if k > 60 else "zz"
    df = spark.createDataFrame([row(i, title=name(k)) for k, i in enumerate(ids)], SCHEMA)
    by = {}
    for k, i in enumerate(ids):
        by.setdefault(name(k), []).append(i)
    order = sorted(by, key=lambda t: min(by[t]))
    want = {i: order.index(t) if len(x) > 1 else -1 for t, x in by.items() for i in x}
    assert {r["id"]: r["dup_group"] for r in dedup.dup_group(df).collect()} == want


def test_confidence_of_a_shared_empty_set(spark, monkeypatch):
    from recipeframe import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    df = lint.lint(spark.createDataFrame([row(i, ingredients=["盐"] if i % 3 else [f"x{chr(97 + i % 20)}"], n=1) for i in range(60)], SCHEMA)).withColumn("safety_flags", F.when(F.col("id") == 1, F.array(F.lit("raw"))))
    meta, inter = spark.createDataFrame([], "id bigint, contributor_id bigint, submitted string"), spark.createDataFrame([(1, "2011-01-01", "a keeper")], "recipe_id bigint, date string, review string")
    got = {r["id"]: r for r in confidence.confidence(df, meta, inter).collect()}
    assert len(got) == 60 and got[2]["n_copies"] == 40 and got[2]["pooled_rating_n"] == 40 and got[2]["pos_tier"] == 3 and got[1]["pos_tier"] == 0 and got[1]["safety_fail"]


def test_dup_group(spark):
    rows = [row(5, title="b A"), row(3, title="a b"), row(4, title="c"), row(9, title="c", ingredients=None), row(7, title="c", ingredients=[""]), row(8, title="c", ingredients=[])]
    got = {r["id"]: r["dup_group"] for r in dedup.dup_group(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {3: 0, 5: 0, 4: -1, 7: -1, 8: 3, 9: 3}


def test_confidence(spark):
    rows = [row(1, ingredients=["Egg", "milk"], n=2), row(2, ingredients=["milk", "egg"], n=0, title="RSC omelette"), row(3, steps=[], n=50), row(4, ingredients=["rice"], n=1), row(5, ingredients=["oats"], n=12), row(6, ingredients=["tea"], n=12)]
    meta = spark.createDataFrame([(1, 10, "2010-01-01"), (2, 11, "bad"), (5, 1, "2010-01-01"), (6, 1, "2014-06-01")], "id bigint, contributor_id bigint, submitted string")
    inter = spark.createDataFrame([(1, "2011-01-01", "I have made this twice!"), (2, "2012-01-01", "haven't made it yet"), (5, "2014-01-01", None), (6, "2013-01-01", "x"), (6, "soon", "x")], "recipe_id bigint, date string, review string")
    once = confidence.confidence(lint.lint(spark.createDataFrame(rows, SCHEMA)), meta, inter)
    got = {r["id"]: r for r in once.collect()}
    assert [got[i]["pos_tier"] for i in range(1, 7)] == [2, 2, 0, 1, 3, 2]
    assert got[2]["n_copies"] == 2 and got[2]["n_authors"] == 2 and got[2]["pooled_remake_n"] == 1 and got[2]["is_contest"]
    assert got[6]["years_active"] == 0.0 and got[5]["years_active"] == pytest.approx(1461 / 365.25)
    again = confidence.confidence(once, meta, inter)
    assert sorted(again.select("id", "pos_tier", "remake_n").collect()) == sorted(once.select("id", "pos_tier", "remake_n").collect())
    assert {r["pos_tier"]: r["n"] for r in confidence.tier_report(once).collect()} == {0: 1, 1: 1, 2: 3, 3: 1}
