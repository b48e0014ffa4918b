"""Splits that keep related records together: an incremental, persisted component table.

State is three tables. ``members`` (id, group_id), ``keys`` (key, group_id), ``groups`` (group_id, split, n_records,
status). ``update`` takes a batch of records with their ties (id, key) and gives the next state:

* ids and keys that the state knows stand for their group, the others for themselves; every key hooks its holders to the
  smallest of them, and pointer jumping over the contracted graph merges what is tied (components.py);
* a group keeps its split when later records join it or when it merges with unassigned ones;
* groups with no split yet fill the deficits of the splits against their targets: groups of more than 1/LARGE of all
  records (at most LARGE of them) one by one, largest first, the rest in hash order along a running sum of sizes;
* a merge of groups that hold different splits is quarantined: its split is ``quarantine`` until someone decides, as
  training on it would put related records on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recipeframe.llm.components import components, rooted
from recipeframe.runtime import bounded_collect, join_hot, materialize, prefix_sum, scratch

QUARANTINE = "quarantine"
LARGE = 1000
BUCKETS = 1024


@dataclass
class SplitState:
    members: DataFrame
    keys: DataFrame
    groups: DataFrame

    def save(self, path: str) -> None:
        """Write as a new version; ``path`` must not exist yet (an existing state is never overwritten in place)."""
        for name in ("members", "keys", "groups"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SplitState:
        return SplitState(*(spark.read.parquet(f"{path}/{n}") for n in ("members", "keys", "groups")))


def empty_state(spark: SparkSession) -> SplitState:
    return SplitState(
        spark.createDataFrame([], "id bigint, group_id bigint"),
        spark.createDataFrame([], "key string, group_id bigint"),
        spark.createDataFrame([], "group_id bigint, split string, n_records bigint, status string"),
    )


def regroup(state: SplitState | None, records: DataFrame, ties: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members, keys and moved (old group -> new group) after a batch of records (id) with ties (id, key).

    Null ids and null keys are ignored; repeats change nothing; ties of ids that are in no batch so far are ignored."""
    known = state or empty_state(records.sparkSession)
    with scratch() as keep:
        ids = records.select("id").where("id is not null").distinct()
        old = known.members
        node = ids.join(old, "id", "left").select("id", F.coalesce("group_id", "id").alias("node"), F.col("group_id").isNotNull().alias("known"))
        held = materialize(ties.where("id is not null and key is not null").select("id", "key").distinct().join(node, "id"), "held")
        hubs = held.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
        hubs = hubs.join(known.keys.withColumnRenamed("group_id", "_g"), "key", "left").select("key", F.least("hub", F.coalesce("_g", "hub")).alias("hub"), "n", "_g")
        hubs = materialize(hubs, "hubs")
        at = materialize(join_hot(held.select("id", "key", "node", "known"), hubs.select("key", "hub", "n"), "key", "n"), "at")
        low = at.groupBy("id").agg(F.min("hub").alias("low"), F.max(F.when(F.col("known"), F.col("node"))).alias("own")).select("id", F.least("low", F.coalesce("own", "low")).alias("low"), "own")
        low = materialize(low, "low")
        # ids of one or more keys tie their hubs to one another; the ids themselves are leaves and need no node
        edges = at.join(low, "id").select(F.col("hub").alias("a"), F.col("low").alias("b")).unionByName(low.where("own is not null").select(F.col("own").alias("a"), F.col("low").alias("b")))
        edges = edges.unionByName(hubs.where("_g is not null").select(F.col("_g").alias("a"), F.col("hub").alias("b")))
        comp = components(edges.where("a <> b").distinct())
        members = rooted(low, "low", comp, "group_id").select("id", "group_id")
        members = members.unionByName(node.where("not known").join(low, "id", "left_anti").select("id", F.col("node").alias("group_id")))
        keys = rooted(hubs.select("key", "hub"), "hub", comp, "group_id").select("key", "group_id")
        moved = known.groups.select(F.col("group_id").alias("old")).join(comp.select(F.col("node").alias("old"), "root"), "old", "left").select("old", F.coalesce("root", "old").alias("group_id"))
        if state:  # what has no ties in this batch, delivered again or not, goes where its group goes
            rest = rooted(old.join(low, "id", "left_anti").withColumnRenamed("group_id", "old"), "old", comp, "group_id")
            members = members.unionByName(rest.select("id", "group_id"))
            rest = rooted(known.keys.join(hubs, "key", "left_anti").withColumnRenamed("group_id", "old"), "old", comp, "group_id")
            keys = keys.unionByName(rest.select("key", "group_id"))
        return keep(materialize(members, "members")), keep(materialize(keys, "keys")), keep(materialize(moved, "moved"))


def hash_order(group_id: Column, seed: int) -> Column:
    """A number by md5, which SQL elsewhere can repeat."""
    return F.conv(F.substring(F.md5(F.concat(group_id.cast("string"), F.lit(f"-{seed}"))), 1, 15), 16, 10).cast("bigint")


def fill_deficits(groups: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """groups (group_id, n_records, split or null) with every null split filled; shares end near ``targets``.

    Targets with null or negative shares count as 0; shares are rescaled to sum to 1. Empty targets leave splits null."""
    share = {r["split_name"]: max(0.0, r["target_share"] or 0.0) for r in bounded_collect(targets.where("split_name is not null"), LARGE, "split targets")}
    whole = sum(share.values())
    if not whole:
        return groups
    have = {r["split"]: r["n"] for r in groups.groupBy("split").agg(F.sum("n_records").alias("n")).collect()}
    total = sum(have.values())
    deficit = {s: share[s] / whole * total - have.get(s, 0) for s in sorted(share)}
    open_ = groups.where("split is null")
    big = bounded_collect(open_.where(F.col("n_records") * LARGE > total).orderBy(F.desc("n_records"), "group_id"), LARGE, "large groups")
    chosen = []
    for r in big:
        s = max(deficit, key=lambda x: (deficit[x], x))
        deficit[s] -= r["n_records"]
        chosen.append((r["group_id"], s))
    spark = groups.sparkSession
    picked = spark.createDataFrame(chosen, "group_id bigint, _s string")
    small = open_.where(F.col("n_records") * LARGE <= total).withColumn("_h", hash_order(F.col("group_id"), seed))
    small = small.withColumn("_b", F.pmod("_h", F.lit(BUCKETS))).withColumn("_g", F.lit(0))
    small = prefix_sum(small, ["_g"], ["_h", "group_id"], "_b", "n_records", "_before")
    left = sum(max(0.0, d) for d in deficit.values()) or 1.0
    rest = total - sum(v for k, v in have.items() if k is not None) - sum(r["n_records"] for r in big)
    at, bounds = 0.0, []
    for s in sorted(share):
        at += max(0.0, deficit[s]) / left * rest
        bounds.append((s, at))
    which = F.lit(bounds[-1][0])
    for s, upto in reversed(bounds[:-1]):
        which = F.when(F.col("_before") + F.col("n_records") / 2 < F.lit(float(upto)), F.lit(s)).otherwise(which)
    small = small.select("group_id", which.alias("_s"))
    new = picked.unionByName(small)
    return groups.join(new, "group_id", "left").withColumn("split", F.coalesce("split", "_s")).drop("_s")


def update(state: SplitState | None, records: DataFrame, ties: DataFrame, targets: DataFrame, seed: int = 0) -> SplitState:
    """The next state after a batch. Empty batches return the state's content unchanged."""
    members, keys, moved = regroup(state, records, ties)
    sizes = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_records"))
    known = (state or empty_state(records.sparkSession)).groups
    was = known.join(moved.withColumnRenamed("group_id", "_to").withColumnRenamed("old", "group_id"), "group_id").groupBy(F.col("_to").alias("group_id")).agg(F.min("split").alias("lo"), F.max("split").alias("hi"), F.count(F.lit(1)).alias("parts"))
    groups = sizes.join(was, "group_id", "left").select(
        "group_id",
        "n_records",
        F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("lo").isNotNull(), F.lit(QUARANTINE)).alias("split"),
        F.when(F.col("lo").isNull(), "new").when(F.col("lo") != F.col("hi"), "quarantined").when(F.col("parts") > 1, "merged").otherwise("kept").alias("status"),
    )
    with scratch() as keep:
        filled = fill_deficits(materialize(groups, "sizes"), targets, seed).select("group_id", "split", "n_records", "status")
        return SplitState(members, keys, keep(materialize(filled, "groups")))


def assigned(state: SplitState) -> DataFrame:
    """(id, group_id, split) of every record."""
    return join_hot(state.members, state.groups.select("group_id", "split", "n_records"), "group_id", "n_records").select("id", "group_id", "split")


def related(members: DataFrame) -> DataFrame:
    """(id, group_id) of ids that share a group with at least one other id."""
    sizes = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    return join_hot(members, materialize(sizes, "sizes").where("n > 1"), "group_id", "n").select("id", "group_id")


def shares(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """split, n_records, n_groups, share reached and target share."""
    got = groups.groupBy("split").agg(F.sum("n_records").alias("n_records"), F.count(F.lit(1)).alias("n_groups"))
    total = F.sum("n_records").over(Window.partitionBy(F.lit(0)))  # one row per split
    return got.select("split", "n_records", "n_groups", (F.col("n_records") / total).alias("share")).join(targets.select(F.col("split_name").alias("split"), "target_share"), "split", "full")
