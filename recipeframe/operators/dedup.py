"""Exact duplicates and dish families.

A family is a leader with the recipes like it: at least 0.6 of the ingredients of either in common, and a title word.
Recipes are visited by falling number of ratings; one joins the earliest leader it is like, else leads itself. That is the
first maximal independent set of the similarity graph in visiting order, which needs no sequential loop: in each round a
recipe with an earlier leader neighbour is a member, and one whose earlier neighbours are all members is a leader.

Recipes with equal ingredients and title words are one class: all of them are like the same others and like each other,
so they have one leader, which is in the class only if it is the class's first. Rounds run over classes, however many
copies there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.functions.text import ing_set, norm_title, title_tokens
from recipeframe.runtime import join_hot, materialize, member_pairs, prefix_sum, range_bucket, scratch

LIKE = 0.6


def dup_group(df: DataFrame) -> DataFrame:
    """Adds dup_group: the group's number in order of first appearance by id, -1 for a recipe without a copy.

    Numbers are a running sum over key groups in ranges of their first ids, not a global sort in one task; a group may
    hold any part of all recipes."""
    keyed = df.withColumn("_key", F.struct(norm_title(F.coalesce("title", F.lit(""))).alias("t"), ing_set(F.col("ingredients")).alias("k")))
    first = materialize(keyed.groupBy("_key").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")), "first")
    order = first.select("_key", "_n", "_first", range_bucket(first, "_first").alias("_b"), F.lit(0).alias("_g"), F.lit(1).alias("_one"))
    numbered = prefix_sum(order, ["_g"], ["_first"], "_b", "_one", "_number")
    number = F.when(F.col("_n") > 1, F.col("_number")).otherwise(-1).cast("bigint").alias("dup_group")
    return join_hot(keyed, materialize(numbered.select("_key", "_n", number), "numbers"), "_key", "_n").drop("_key", "_n")


def _classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls, n, s, t, o) of distinct sets of ingredients and title words, o the first of its recipes in visiting order;
    and (id, cls). Recipes without either are in no class, as they are like none."""
    first = F.struct((-F.coalesce("rating_n", F.lit(0))).alias("n"), F.col("id").alias("i"))
    sets = F.struct(ing_set(F.col("ingredients")).alias("s"), F.sort_array(title_tokens(F.coalesce("title", F.lit("")))).alias("t"))
    keyed = materialize(df.select("id", first.alias("o"), sets.alias("key")).where("size(key.s) > 0 and size(key.t) > 0"), "keyed")
    group = materialize(keyed.groupBy("key").agg(F.min("id").alias("cls"), F.count(F.lit(1)).alias("n"), F.min("o").alias("o")), "classes")
    members = join_hot(keyed.select("id", "key"), group.select("key", "cls", "n"), "key", "n").select("id", "cls")
    return group.select("cls", "n", "key.s", "key.t", "o"), materialize(members, "members")


def _class_edges(classes: DataFrame) -> DataFrame:
    """(a, b, jaccard), a < b: classes that are alike. Exact: two sets with Jaccard >= 0.6 share one of their rarest
    n - ceil(0.6 n) + 1 ingredients, so they meet at (title word, such an ingredient), large groups block by block."""
    each = classes.select("cls", F.explode("s").alias("w"))
    freq = materialize(each.groupBy("w").agg(F.count(F.lit(1)).alias("df")), "df")
    ranked = join_hot(each, freq, "w", "df").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "w"))).alias("r"))
    # parities of the set in 64 bits: bits that differ are at most ingredients that differ, which are at most n1 + n2 - 2 o
    parity = F.expr("aggregate(s, 0L, (a, w) -> a ^ shiftleft(1L, cast(xxhash64(w) & 63 as int)))").alias("h")
    d = classes.join(ranked, "cls").select("cls", "s", "t", parity, F.expr("transform(slice(r, 1, size(r) - cast(ceil(0.6 * size(r) - 1e-9) as int) + 1), x -> x.w)").alias("p"))
    met = d.select(F.struct("cls", "s", "h").alias("item"), F.explode("t").alias("tw"), "p").select("item", "tw", F.explode("p").alias("pw"))
    met = materialize(met.select(F.struct("tw", "pw").alias("group"), "item"), "met")
    several = met.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = materialize(several.select(F.col("group").alias("a"), F.col("group").alias("b")), "several")
    like = "least(size(x.s), size(y.s)) >= 0.6 * greatest(size(x.s), size(y.s)) - 1e-9"
    like += " and bit_count(x.h ^ y.h) <= floor(0.25 * (size(x.s) + size(y.s)) + 1e-9)"
    near = member_pairs(links, met).where(like)
    pairs = near.select(F.expr("x.cls").alias("a"), F.expr("y.cls").alias("b"), F.expr("size(array_intersect(x.s, y.s))").alias("o"), F.expr("size(x.s) + size(y.s)").alias("both"))
    return pairs.where(f"o >= {LIKE} * (both - o) - 1e-9").select("a", "b", (F.col("o") / (F.col("both") - F.col("o"))).alias("jaccard")).distinct()


def family_edges(df: DataFrame) -> DataFrame:
    """(a, b, jaccard), a < b: all pairs of recipes that are alike, those of one class included."""
    classes, members = _classes(df)
    links = _class_edges(classes).unionByName(classes.where("n > 1").select(F.col("cls").alias("a"), F.col("cls").alias("b"), F.lit(1.0).alias("jaccard")))
    met = member_pairs(materialize(links, "links"), members.select(F.col("cls").alias("group"), F.col("id").alias("item")))
    return met.select(F.col("x").alias("a"), F.col("y").alias("b"), "jaccard")


def family(df: DataFrame) -> DataFrame:
    """(id, leader_id): every recipe's family leader, itself if it leads."""
    with scratch() as keep:
        classes, members = _classes(df)
        order = materialize(classes.select("cls", "n", "o"), "order")
        edges = _class_edges(classes)
        e = edges.join(order.select(F.col("cls").alias("a"), F.col("o").alias("oa")), "a").join(order.select(F.col("cls").alias("b"), F.col("o").alias("ob")), "b")
        late = F.col("oa") > F.col("ob")
        e = materialize(e.select(F.when(late, F.col("b")).otherwise(F.col("a")).alias("early"), F.least("oa", "ob").alias("o"), F.when(late, F.col("a")).otherwise(F.col("b")).alias("late")), "oriented")
        nodes = e.select(F.col("early").alias("cls")).unionByName(e.select(F.col("late").alias("cls"))).distinct()
        state = materialize(nodes.withColumn("leads", F.lit(None).cast("boolean")), "state")
        while not state.where("leads is null").isEmpty():
            seen = e.join(state.select(F.col("cls").alias("early"), "leads"), "early").groupBy(F.col("late").alias("cls"))
            seen = seen.agg(F.max(F.coalesce("leads", F.lit(False))).alias("some"), F.max(F.col("leads").isNull()).alias("open"))
            known = F.when(F.col("some"), False).when(~F.coalesce("open", F.lit(False)), True)
            state = materialize(state.join(seen, "cls", "left").select("cls", F.coalesce("leads", known).alias("leads")), "state")
        lead = e.join(state.where("leads").select(F.col("cls").alias("early")), "early").groupBy(F.col("late").alias("cls")).agg(F.min("o").alias("_o"))
        joins = state.where("not leads").join(lead, "cls").select("cls", "_o")
        leader = order.join(joins, "cls", "left").select("cls", "n", F.coalesce("_o", "o")["i"].alias("_l"))
        of = join_hot(members, materialize(leader, "leaders"), "cls", "n").select("id", "_l")
        return keep(materialize(df.select("id").join(of, "id", "left").select("id", F.coalesce("_l", "id").alias("leader_id")), "families"))


def family_top(df: DataFrame, families: DataFrame, k: int = 10) -> DataFrame:
    """The largest families with the leader's title."""
    n = families.groupBy("leader_id").agg(F.count(F.lit(1)).alias("n"))
    return n.join(df.select(F.col("id").alias("leader_id"), "title"), "leader_id").orderBy(F.desc("n"), "leader_id").limit(k)
