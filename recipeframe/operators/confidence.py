"""How sure a recipe is a real one that people cook: evidence pooled over copies, tiers and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recipeframe.functions.text import contest, copy_key, remake
from recipeframe.runtime import join_hot, materialize

OWN = ["remake_n", "last_review", "years_active", "copy_group", "n_copies", "n_authors", "pooled_rating_n", "pooled_remake_n", "is_contest", "structural_fail", "safety_fail", "pos_tier", "pos_weight", "submitted", "contributor_id"]
# Weight of each tier.
WEIGHT = {0: 0.0, 1: 0.25, 2: 0.6, 3: 1.0}


def day(c: str):
    return F.to_date(F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")))


def evidence(interactions: DataFrame) -> DataFrame:
    """(recipe_id, remake_n, last_review); reviews without a rating count, dates that don't parse don't."""
    return interactions.groupBy("recipe_id").agg(F.sum(remake(F.col("review")).cast("bigint")).alias("remake_n"), F.max(day("date")).alias("last_review"))


def with_evidence(df: DataFrame, meta: DataFrame, interactions: DataFrame) -> DataFrame:
    base = df.drop(*OWN)
    m = meta.select("id", "contributor_id", day("submitted").alias("submitted"))
    per = materialize(evidence(interactions), "evidence")
    d = base.join(m, "id", "left").join(per.withColumnRenamed("recipe_id", "id"), "id", "left")
    days = F.datediff("last_review", "submitted")
    return d.withColumn("remake_n", F.coalesce("remake_n", F.lit(0))).withColumn("years_active", F.greatest(F.coalesce(days / F.lit(365.25).cast("double"), F.lit(0.0)), F.lit(0.0)))


def copy_pool(df: DataFrame) -> DataFrame:
    """(copy_group, n_copies, n_authors, pooled_rating_n, pooled_remake_n): grouped with partial sums, so that a group with
    many copies is never in one task."""
    return df.groupBy("copy_group").agg(F.count(F.lit(1)).alias("n_copies"), F.count_distinct("contributor_id").alias("n_authors"), F.sum("rating_n").alias("pooled_rating_n"), F.sum("remake_n").alias("pooled_remake_n"))


def confidence(df: DataFrame, meta: DataFrame, interactions: DataFrame) -> DataFrame:
    """Adds the confidence columns; needs lint_flags. Running it on its own output gives the same.

    Reviews are read once: their evidence is written before it is used for pools and rows. Pools are a row per ingredient
    set, of which one may hold a large part of all recipes (those without Latin ingredients share the empty one)."""
    d = with_evidence(df, meta, interactions).withColumn("copy_group", copy_key(F.col("ingredients")))
    d = join_hot(d, materialize(copy_pool(d), "pool"), "copy_group", "n_copies")
    safety = F.coalesce(F.size("safety_flags") > 0, F.lit(False)) if "safety_flags" in df.columns else F.lit(False)
    d = d.withColumn("is_contest", contest(F.col("title"))).withColumn("structural_fail", F.arrays_overlap("lint_flags", F.array(F.lit("no_steps"), F.lit("no_ingredients")))).withColumn("safety_fail", safety)
    r, m, y, a = F.col("pooled_rating_n"), F.col("pooled_remake_n"), F.col("years_active"), F.col("n_authors")
    tier = F.when(F.col("structural_fail") | F.col("safety_fail"), 0).when((r >= 20) | (m >= 3) | ((r >= 10) & (y >= 3)), 3).when((r >= 3) | (m >= 1) | (a >= 2), 2).otherwise(1)
    d = d.withColumn("pos_tier", tier.cast("tinyint"))
    weight = F.create_map(*[x for k, v in WEIGHT.items() for x in (F.lit(k).cast("tinyint"), F.lit(v))])
    return d.withColumn("pos_weight", weight[F.col("pos_tier")]).drop("last_review", "submitted", "contributor_id")


def tier_report(df: DataFrame) -> DataFrame:
    t = df.groupBy("pos_tier").agg(F.count(F.lit(1)).alias("n"), F.median(F.col("rating_n").cast("double")).alias("median_rating_n"), F.avg("remake_n").alias("mean_remake"), F.avg(F.col("is_contest").cast("double")).alias("contest_share"))
    return t.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))  # one row per tier


def copy_reps(df: DataFrame) -> DataFrame:
    """The first record of each copy group."""
    return df.groupBy("copy_group").agg(F.min_by(F.struct("id", "title", "n_copies", "n_authors"), "id").alias("r")).select("copy_group", "r.*")


def copy_groups_top(df: DataFrame, k: int = 8) -> DataFrame:
    return copy_reps(df).select("copy_group", F.col("n_copies").alias("n"), F.col("n_authors").alias("authors"), "title").orderBy(F.desc("n"), "copy_group").limit(k)
