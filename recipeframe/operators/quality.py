"""Ratings, shrunk toward the corpus, and the score gated by lint."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.runtime import materialize, prefix_sum, range_bucket

PRIOR_N = 20


def rating_agg(interactions: DataFrame) -> DataFrame:
    """(recipe_id, rating_mean, rating_n) over ratings above 0; 0 and null are reviews without a rating."""
    return interactions.where("rating > 0").groupBy("recipe_id").agg(F.avg("rating").alias("rating_mean"), F.count(F.lit(1)).alias("rating_n"))


def with_ratings(recipes: DataFrame, interactions: DataFrame) -> DataFrame:
    agg = rating_agg(interactions)
    return recipes.join(agg, recipes["id"] == agg["recipe_id"], "left").drop("recipe_id").withColumn("rating_n", F.coalesce("rating_n", F.lit(0)))


def prior(df: DataFrame) -> DataFrame:
    return df.where("rating_n > 0").agg(F.avg("rating_mean").alias("prior"))


def score(df: DataFrame) -> DataFrame:
    """Adds q_rating and q_score; needs lint_pass. The prior is a scalar subquery, computed once."""
    p = prior(df).scalar()
    n, m = F.col("rating_n"), F.col("rating_mean")
    q = F.when(n.isNull() | (n == 0) | m.isNull() | F.isnan(m), p).otherwise((n * m + F.lit(float(PRIOR_N)) * p) / (n + PRIOR_N))
    return df.withColumn("q_rating", q).withColumn("q_score", F.col("q_rating") / F.lit(5.0) * F.col("lint_pass").cast("double"))


def exact_quantiles(df: DataFrame, col: str, at: tuple[float, ...]) -> list[float | None]:
    """Interpolated quantiles of a column, null where it has no values. Equal values are counted first; ranks are running
    sums in ranges of the values, and only the few values at the wanted ranks are collected."""
    counts = df.groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    values = materialize(counts, "values").where("v is not null")  # a filter before would compute a derived column twice
    total = values.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return [None] * len(at)
    ranked = prefix_sum(values.withColumn("_b", range_bucket(values, "v")).withColumn("_g", F.lit(0)), ["_g"], ["v"], "_b", "n", "before")
    places = [(total - 1) * q for q in at]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    hit = " or ".join(f"(before <= {r} and before + n > {r})" for r in ranks)
    rows = ranked.where(hit).select("v", "n", "before").collect()
    value = {r: next(x["v"] for x in rows if x["before"] <= r < x["before"] + x["n"]) for r in ranks}
    return [value[math.floor(p)] + (p - math.floor(p)) * (value[math.ceil(p)] - value[math.floor(p)]) for p in places]


def quantiles(df: DataFrame, col: str = "q_score", at: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    return df.sparkSession.createDataFrame(list(zip(at, exact_quantiles(df, col, at))), "q double, value double")


def describe(df: DataFrame, col: str = "q_score") -> DataFrame:
    c = F.col(col)
    quarters = [F.lit(v).cast("double").alias(n) for n, v in zip(("p25", "p50", "p75"), exact_quantiles(df, col, (0.25, 0.5, 0.75)))]
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), *quarters, F.max(c).alias("max"))
