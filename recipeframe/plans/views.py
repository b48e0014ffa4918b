"""The engine's inputs over the test tables: one row per record, each view with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recipeframe.runtime import table


def recipes(spark: SparkSession, d: str) -> DataFrame:
    """The corpus: recipes in the contract, repeats dropped, nulls as the ingest leaves them."""
    r = table(spark, d, "recipes_fixture").distinct()
    return r.withColumn("title", F.coalesce("title", F.lit(""))).withColumn("minutes", F.coalesce("minutes", F.lit(0))).withColumn("rating_n", F.coalesce("rating_n", F.lit(0)))


RECIPES = "r as (select distinct * replace (coalesce(title, '') as title, coalesce(minutes, 0) as minutes, coalesce(rating_n, 0) as rating_n) from recipes_fixture)"


def interactions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_interactions_mini").distinct()


INTERACTIONS = "i as (select distinct * from raw_interactions_mini)"


def meta(spark: SparkSession, d: str) -> DataFrame:
    """(id, contributor_id, submitted), one row per recipe."""
    return table(spark, d, "raw_recipes_mini").groupBy("id").agg(F.max("contributor_id").alias("contributor_id"), F.max("submitted").alias("submitted"))


META = "m as (select id, max(contributor_id) as contributor_id, max(submitted) as submitted from raw_recipes_mini group by id)"


def raw_recipes(spark: SparkSession, d: str) -> DataFrame:
    """Raw recipes, one row per id: the greatest value of each column over the repeats."""
    t = table(spark, d, "raw_recipes_mini")
    return t.groupBy("id").agg(*[F.max(c).alias(c) for c in t.columns if c != "id"])


RAW = "w as (select id, max(name) as name, max(minutes) as minutes, max(tags) as tags, max(nutrition) as nutrition, max(steps) as steps, max(ingredients) as ingredients, max(n_ingredients) as n_ingredients from raw_recipes_mini group by id)"


def dishes(spark: SparkSession, d: str) -> DataFrame:
    """Dish records, one row per line number: the greatest value of each column over the repeats."""
    t = table(spark, d, "xiachufang_mini")
    return t.groupBy("line_no").agg(*[F.max(c).alias(c) for c in t.columns if c != "line_no"])


DISHES = "x as (select line_no, max(name) as name, max(dish) as dish, max(description) as description, max(recipeIngredient) as recipeIngredient, max(recipeInstructions) as recipeInstructions, max(author) as author, max(keywords) as keywords from xiachufang_mini group by line_no)"


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events as a resume log: (key, status, seq)."""
    return table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("status"), F.struct("ts", "event_id").alias("seq"))


EVENTS = "e as (select user_id as key, event_type as status, row(ts, event_id) as seq from events)"
