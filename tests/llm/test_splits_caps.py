import random

from pyspark.sql import functions as F

from recipeframe.llm import caps, splits
from recipeframe.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_components_match_union_find(spark):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + chain
    df = spark.createDataFrame([*edges, (5, 5), (None, 3), (7, None)], "a bigint, b bigint")
    want = {k: v for k, v in brute([e for e in edges if e[0] != e[1]]).items()}
    assert {r["node"]: r["root"] for r in components(df).collect()} == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


TARGETS = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]


def world(spark, n, seed, lo=0):
    rnd = random.Random(seed)
    ids = list(range(lo, lo + n))
    ties = [(i, f"c{rnd.randrange(n // 3)}") for i in ids if rnd.random() < 0.7] + [(i, f"f{rnd.randrange(n)}") for i in ids if rnd.random() < 0.5]
    return ids, ties


def groups_of(ids, ties):
    m = {}
    for i, k in ties:
        m.setdefault(k, []).append(i)
    got = brute([(v[0], x) for v in m.values() for x in v])
    return {i: got.get(i, i) for i in ids}


def test_groups_and_shares(spark):
    ids, ties = world(spark, 3000, 1)
    records = spark.createDataFrame([(i,) for i in [*ids, *ids[:50], None]], "id bigint")
    t = spark.createDataFrame([*ties, *ties[:20], (None, "c1"), (3, None), (10**9, "c1")], "id bigint, key string")
    targets = spark.createDataFrame(TARGETS, "split_name string, target_share double")
    s = splits.update(None, records, t, targets)
    assert {r["id"]: r["group_id"] for r in s.members.collect()} == groups_of(ids, ties)
    by = {r["group_id"]: r["split"] for r in s.groups.collect()}
    assert set(by.values()) <= {"train", "validation", "test"}
    rel = {r["id"] for r in splits.related(s.members).collect()}
    g = groups_of(ids, ties)
    assert rel == {i for i in ids if sum(x == g[i] for x in g.values()) > 1}


def test_incremental_equals_whole_and_keeps_splits(spark):
    ids, ties = world(spark, 900, 2)
    targets = spark.createDataFrame(TARGETS, "split_name string, target_share double")
    rec = lambda x: spark.createDataFrame([(i,) for i in x], "id bigint")
    tie = lambda x: spark.createDataFrame([t for t in ties if t[0] in x], "id bigint, key string")
    a, b = set(ids[300:]), set(ids[:300])
    one = splits.update(None, rec(a), tie(a), targets)
    before = {r["group_id"]: r["split"] for r in one.groups.collect()}
    where = {r["id"]: before[r["group_id"]] for r in one.members.collect()}
    two = splits.update(one, rec(b), tie(b), targets)
    assert {r["id"]: r["group_id"] for r in two.members.collect()} == groups_of(ids, ties)
    after = {r["group_id"]: (r["split"], r["status"]) for r in two.groups.collect()}
    for r in two.members.collect():
        split, status = after[r["group_id"]]
        if r["id"] in where:
            assert split == where[r["id"]] or status == "quarantined"
        if status == "quarantined":
            olds = {where[i] for i, g in groups_of(ids, ties).items() if g == r["group_id"] and i in where}
            assert len(olds) > 1 and split == splits.QUARANTINE


def test_redelivered_records_follow_their_group(spark):
    """Batches that repeat records with, without and with other ties; after each the groups are those of union-find."""
    targets = spark.createDataFrame(TARGETS, "split_name string, target_share double")
    rec = lambda x: spark.createDataFrame([(i,) for i in x], "id bigint")
    tie = lambda x: spark.createDataFrame(list(x), "id bigint, key string")
    fixed = [([1, 2, 5, 10], [(1, "a"), (2, "a"), (5, "b"), (10, "b")]), ([10, 20, 1], [(20, "a"), (20, "b")])]
    for seed in (None, 5, 6):
        rnd = random.Random(seed)
        batches = fixed if seed is None else [(b := rnd.sample(range(60), 25), [(i, f"k{rnd.randrange(30)}") for i in b if rnd.random() < 0.5]) for _ in range(4)]
        state, seen, all_ties, where = None, set(), [], {}
        for ids, ties in batches:
            state = splits.update(state, rec(ids), tie(ties), targets)
            seen |= set(ids)
            all_ties += ties
            got = {r["id"]: r["group_id"] for r in state.members.collect()}
            assert got == groups_of(sorted(seen), all_ties)
            of = {r["group_id"]: (r["split"], r["n_records"]) for r in state.groups.collect()}
            assert {g: n for g, (_, n) in of.items()} == {g: list(got.values()).count(g) for g in set(got.values())}
            now = {r["id"]: r["split"] for r in splits.assigned(state).collect()}
            assert all(now[i] in (s, splits.QUARANTINE) for i, s in where.items())
            where = now


def test_hubs_are_treated_apart(spark, monkeypatch):
    from recipeframe import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 3)
    ids, ties = world(spark, 600, 8)
    ties += [(i, "hot") for i in ids if i % 3 == 0]
    s = splits.update(None, spark.createDataFrame([(i,) for i in ids], "id bigint"), spark.createDataFrame(ties, "id bigint, key string"), spark.createDataFrame(TARGETS, "split_name string, target_share double"))
    assert {r["id"]: r["group_id"] for r in splits.assigned(s).collect()} == groups_of(ids, ties)


def test_save_and_load(spark, tmp_path):
    targets = spark.createDataFrame(TARGETS, "split_name string, target_share double")
    s = splits.update(None, spark.createDataFrame([(1,), (2,)], "id bigint"), spark.createDataFrame([(1, "k"), (2, "k")], "id bigint, key string"), targets)
    s.save(str(tmp_path / "v1"))
    t = splits.SplitState.load(spark, str(tmp_path / "v1"))
    assert sorted(t.members.collect()) == sorted(s.members.collect())


def test_split_edge_cases(spark):
    none = spark.createDataFrame([], "id bigint")
    no_ties = spark.createDataFrame([], "id bigint, key string")
    targets = spark.createDataFrame([("train", 1.0), ("x", None), (None, 0.5), ("neg", -1.0)], "split_name string, target_share double")
    assert splits.update(None, none, no_ties, targets).members.count() == 0
    s = splits.update(None, spark.createDataFrame([(4,)], "id bigint"), no_ties, targets)
    assert s.groups.first()["split"] == "train"
    s = splits.update(None, spark.createDataFrame([(4,)], "id bigint"), no_ties, targets.where("false"))
    assert s.groups.first()["split"] is None


def test_hot_contributor(spark):
    ids = list(range(2000))
    t = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"c{i}") for i in ids], "id bigint, key string")
    s = splits.update(None, spark.createDataFrame([(i,) for i in ids], "id bigint"), t, spark.createDataFrame(TARGETS, "split_name string, target_share double"))
    assert s.members.where("group_id = 0").count() == 667
    got = {r["split"]: r["share"] for r in splits.shares(s.groups, spark.createDataFrame(TARGETS, "split_name string, target_share double")).collect()}
    assert abs(got["train"] - 0.8) < 0.01 and abs(got["test"] - 0.1) < 0.01


def keep(records, cap):
    by = {}
    for t, k, c, q in records:
        if c is not None:
            by.setdefault((t, c), []).append((q is None, -(q or 0), k))
    return {(t, x[2]) for (t, c), v in by.items() for x in sorted(v)[cap:]}


SCHEMA = "record_table string, record_key string, contributor string, q_score double"


def test_cap_matches_sort(spark):
    rnd = random.Random(5)
    rows = [("a" if i % 4 else "b", str(i), rnd.choice([None, "x", "y", "z", "z", "z", "z"]), rnd.choice([None, 0.5, 0.5, rnd.random()])) for i in range(3000)]
    got = {tuple(r) for r in caps.dropped(spark.createDataFrame(rows, SCHEMA), 8, salts=7).collect()}
    assert got == keep(rows, 8)


def test_cap_sampled(spark):
    rows = [("a", str(i), "x", i / 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = lambda seed, temperature: {r["record_key"] for r in caps.dropped(df, 100, temperature=temperature, seed=seed).collect()}
    assert len(out(1, 0.1)) == 900 and out(1, 0.1) == out(1, 0.1) != out(2, 0.1)
    mean = lambda s: sum(int(k) for k in map(str, range(1000)) if k not in s) / 100
    assert mean(out(1, 0.0)) > mean(out(1, 0.05)) > mean(out(1, 100.0))
    assert len({r["record_key"] for r in caps.dropped(df.unionByName(df.withColumn("contributor", F.lit(None).cast("string")).withColumn("record_key", F.concat(F.lit("n"), "record_key"))), 10**6, max_share=0.05).collect()}) == 900


def test_cap_empty(spark):
    assert caps.dropped(spark.createDataFrame([], SCHEMA), 8).count() == 0


def test_contributor_key(spark):
    names = ["Ａｎｎ Ｂ", "ann b", "AnnB", "ANN　B", " ann\xa0b ", "anné b", "", " \t", None, "ﾊﾞﾅﾅ", "バナナ"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r["k"] for r in df.select("i", caps.contributor_key(F.col("n")).alias("k")).orderBy("i").collect()]
    assert got[:5] == ["annb"] * 5 and got[5] == "annéb" and got[6:9] == [None] * 3 and got[9] == got[10]


def test_latest_score_holds_even_if_null(spark):
    rows = [("t", "1", 0.9, "2024-01-01"), ("t", "1", None, "2024-02-01"), ("t", "2", 0.1, "2024-01-01"), ("t", "2", 0.3, "2024-01-01"), ("t", None, 1.0, "2024-01-01")]
    df = spark.createDataFrame(rows, "record_table string, record_key string, q_score double, scored_at string").withColumn("extra", F.lit(1))
    assert {r["record_key"]: r["q_score"] for r in caps.latest_scores(df).collect()} == {"1": None, "2": 0.3}
