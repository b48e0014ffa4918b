"""Structural lint: eight flags in a fixed order, all Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recipeframe.functions.text import DESCRIPTORS, stem, tokens

WEEK = 10080
_NONE = "array<string>"


def body_words(steps: Column) -> Column:
    """Stemmed words of all steps; seasoning stands for what it is done with."""
    body = tokens(F.array_join(steps, " "))
    seasons = F.arrays_overlap(body, F.array(F.lit("season"), F.lit("taste")))
    return F.when(seasons, F.array_union(body, F.array(*map(F.lit, ("salt", "pepper", "seasoning"))))).otherwise(body)


def n_unused(ingredients: Column, body: Column) -> Column:
    """How many ingredients no step mentions. Each ingredient's words are taken once, then compared."""
    plain = F.array_distinct(F.array(*[stem(F.lit(w)) for w in DESCRIPTORS]))  # constant: folded when planned
    contents = F.transform(ingredients, lambda i: F.array_except(tokens(i), plain))

    def missing(content: Column) -> Column:
        long = lambda t: (F.length(t) > 3) & F.exists(body, lambda b: (F.length(b) > 3) & (b.contains(t) | t.contains(b)))
        return (F.size(content) > 0) & ~F.arrays_overlap(content, body) & ~F.exists(content, long)

    return F.size(F.filter(contents, missing))


def lint(df: DataFrame) -> DataFrame:
    """Adds lint_flags and lint_pass. Null lists count as empty, null minutes as missing, null calories as unknown; null
    items are ignored."""
    empty = F.array().cast(_NONE)
    s = F.filter(F.coalesce("steps", empty), lambda x: x.isNotNull() & x.rlike(r"(?U)\S"))
    i = F.filter(F.coalesce("ingredients", empty), lambda x: x.isNotNull())
    d = df.withColumn("_s", s).withColumn("_i", i).withColumn("_body", body_words(F.col("_s")))
    vague = F.arrays_overlap("_body", F.array(F.lit("ingredient"), F.lit("everything")))
    told = (F.size("_s") > 0) & (F.size("_i") > 0) & ~vague
    d = d.withColumn("_unused", F.when(told, n_unused(F.col("_i"), F.col("_body"))).otherwise(0))
    flag = lambda c, name: F.when(c, F.lit(name))
    minutes, cal = F.col("minutes"), F.col("calories")
    flags = F.array_compact(
        F.array(
            F.when(F.size("_s") == 0, "no_steps").when(F.size("_s") < 2, "too_few_steps"),
            flag(F.size("_i") == 0, "no_ingredients"),
            flag(F.size(F.array_distinct(F.transform("_i", F.lower))) < F.size("_i"), "dup_ingredient"),
            flag(F.col("_unused") > 0, "unused_ingredient"),
            F.when(minutes.isNull() | (minutes <= 0), "time_missing").when(minutes > WEEK, "time_insane"),
            flag(cal.isNotNull() & ~F.isnan(cal.cast("double")) & ((cal <= 0) | (cal > 30000)), "calorie_outlier"),
        )
    )
    return d.withColumn("lint_flags", flags).withColumn("lint_pass", F.size("lint_flags") == 0).drop("_s", "_i", "_body", "_unused")


def histogram(linted: DataFrame) -> DataFrame:
    return linted.select(F.explode("lint_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


BASELINE = "PASS (baseline)"


def audit(linted: DataFrame) -> DataFrame:
    """Each flag, and the rows without one, against how often recipes are rated. Rows with two flags count in both."""
    groups = F.concat("lint_flags", F.when(F.col("lint_pass"), F.array(F.lit(BASELINE))).otherwise(F.array().cast(_NONE)))
    rows = linted.select(F.explode(groups).alias("flag"), "rating_n", "rating_mean")
    share = lambda k: F.avg((F.col("rating_n") >= k).cast("double"))
    t = rows.groupBy("flag").agg(
        F.count(F.lit(1)).alias("n"),
        share(1).alias("share_rated"),
        share(10).alias("share_rated_10"),
        F.median(F.col("rating_n").cast("double")).alias("median_rating_n"),
        F.avg("rating_n").alias("mean_rating_n"),
        F.avg(F.when(F.col("rating_n") > 0, F.col("rating_mean"))).alias("mean_stars"),
    )
    base = F.max(F.when(F.col("flag") == BASELINE, F.col("share_rated_10"))).over(Window.partitionBy(F.lit(0)))  # a row per flag
    return t.withColumn("ratio_10_vs_pass", F.try_divide("share_rated_10", base))
