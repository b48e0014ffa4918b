"""Readers into the typed contract: CSV, JSON lines, schema.org pages, video metadata, sitemaps, shards."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from urllib import robotparser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from recipeframe.functions.text import calories, clean_list, listify, minutes_of, strip

_WORDS = T.ArrayType(T.StringType())
RECIPE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("minutes", T.LongType()),
        T.StructField("tags", _WORDS),
        T.StructField("steps", _WORDS),
        T.StructField("ingredients", _WORDS),
        T.StructField("n_ingredients", T.LongType()),
        T.StructField("calories", T.DoubleType()),
        T.StructField("rating_mean", T.DoubleType()),
        T.StructField("rating_n", T.LongType()),
    ]
)
RAW_RECIPES = "name string, id bigint, minutes bigint, contributor_id bigint, submitted string, tags string, nutrition string, n_steps bigint, steps string, description string, ingredients string, n_ingredients bigint"
RAW_INTERACTIONS = "user_id bigint, recipe_id bigint, date string, rating int, review string"
DISH_LINE = "name string, dish string, description string, recipeIngredient array<string>, recipeInstructions array<string>, author string, keywords array<string>"
# Writings of a missing value in CSV.
NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_STRINGS = "array<string>"


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """CSV with header and quoted multi-line text; the usual writings of a missing value are null.

    Quoted text may hold line ends, so a file can't be cut into parts: one task reads each file of ``path``, and large
    tables should come as many files. What is selected from the result is all that is parsed."""
    df = spark.read.schema(ddl).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*[F.when(~F.col(f.name).isin(NA), F.col(f.name)).alias(f.name) if f.dataType == T.StringType() else F.col(f.name) for f in df.schema])


def contract(raw: DataFrame, source: str = "foodcom") -> DataFrame:
    """Raw recipes in the contract's columns, without ratings. Nulls: title "", minutes and n_ingredients 0, lists empty."""
    return raw.select(
        "id",
        F.lit(source).alias("source"),
        F.coalesce("name", F.lit("")).alias("title"),
        F.coalesce("minutes", F.lit(0)).cast("bigint").alias("minutes"),
        listify(F.col("tags")).alias("tags"),
        listify(F.col("steps")).alias("steps"),
        listify(F.col("ingredients")).alias("ingredients"),
        F.coalesce("n_ingredients", F.lit(0)).cast("bigint").alias("n_ingredients"),
        calories(F.col("nutrition")).alias("calories"),
    )


def usable(title: Column, ingredients: Column, steps: Column) -> Column:
    return (F.coalesce(title, F.lit("")) != "") & ((F.size(ingredients) > 0) | (F.size(steps) > 0))


def dish_rows(lines: DataFrame) -> DataFrame:
    """Rows (line_no, name, dish, ...) in the contract; rows without a title, or without ingredients and steps, are left out."""
    title = strip(F.coalesce("name", F.lit("")))
    dish = strip(F.coalesce("dish", F.lit("")))
    d = lines.select(
        F.col("line_no").alias("id"),
        F.lit("xiachufang").alias("source"),
        F.lit("dataset").alias("source_kind"),
        F.lit("zh").alias("lang"),
        title.alias("title"),
        F.when(dish == "Unknown", "").otherwise(dish).alias("dish"),
        strip(F.coalesce("description", F.lit(""))).alias("description"),
        clean_list(F.col("recipeIngredient")).alias("ingredients"),
        clean_list(F.col("recipeInstructions")).alias("steps"),
        F.coalesce("author", F.lit("")).alias("author"),
        F.coalesce("keywords", F.array().cast(_STRINGS)).alias("keywords"),
    )
    return d.withColumn("n_ingredients", F.size("ingredients").cast("bigint")).where(usable(F.col("title"), F.col("ingredients"), F.col("steps")))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, ok, fields of DISH_LINE): one row per physical line, numbered from 0 (files in order of their names),
    malformed and blank ones with ok false.

    A line's number is its place in its block of a file plus the lines of the blocks before, which is one row a block."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"))
    blocks = lines.groupBy("f", "b").agg(F.min("m").alias("m0"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.join(blocks.select("f", "b", (before - F.col("m0")).alias("shift")), ["f", "b"]).select((F.col("m") + F.col("shift")).alias("line_no"), F.col("value").alias("line"))
    j = numbered.withColumn("ok", F.try_parse_json("line").isNotNull() & F.ltrim("line").startswith("{"))
    j = j.withColumn("j", F.from_json(F.when(F.col("ok"), F.col("line")), DISH_LINE))
    return j.select("line_no", "ok", "j.*")


def line_stats(lines: DataFrame) -> DataFrame:
    """lines, rows, skipped, with_dish of numbered lines."""
    rows = dish_rows(lines)
    n, named = rows.agg(F.count(F.lit(1))).scalar(), rows.agg(F.count_if(F.col("dish") != "")).scalar()
    return lines.agg(F.count(F.lit(1)).alias("lines")).select("lines", n.alias("rows"), (F.col("lines") - n).alias("skipped"), named.alias("with_dish"))


def recipe_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds the schema.org recipe of each page's ld+json as columns; title is null where there is none.

    Takes objects, lists and @graph; @type may be a list; instructions may be strings, objects or a single text; a review
    may be a list or one object, its text under any of four names."""
    scripts = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    node = "struct<`@type`:string,name:string,recipeIngredient:array<string>,recipeInstructions:string,totalTime:string,recipeYield:string,recipeCategory:string,inLanguage:string,author:string,aggregateRating:string,review:string>"
    flat = F.flatten(
        F.transform(
            scripts,
            lambda s: F.when(s.rlike(r"^\s*\["), F.from_json(s, f"array<{node}>")).otherwise(
                F.concat(F.array(F.from_json(s, node)), F.coalesce(F.from_json(s, f"struct<`@graph`:array<{node}>>")["@graph"], F.array().cast(f"array<{node}>")))
            ),
        )
    )
    kind = lambda x: (x["@type"] == "Recipe") | F.coalesce(F.array_contains(F.from_json(x["@type"], _STRINGS), "Recipe"), F.lit(False))
    r = F.get(F.filter(flat, lambda x: x.isNotNull() & kind(x)), F.lit(0))
    d = pages.withColumn("_r", r)
    raw = F.col("_r.recipeInstructions")
    steps = F.coalesce(F.filter(F.transform(F.from_json(F.when(raw.startswith("["), raw), "array<struct<text:string>>"), lambda x: x["text"]), lambda t: t.isNotNull()), F.array().cast(_STRINGS))
    plain = F.coalesce(F.from_json(F.when(raw.startswith("["), raw), _STRINGS), F.when(raw.isNotNull() & ~raw.startswith("[") & ~raw.startswith("{"), F.split(raw, r"\n+")), F.array().cast(_STRINGS))
    steps = F.when(F.size(steps) > 0, steps).otherwise(F.filter(plain, lambda t: t.isNotNull() & ~t.startswith("{")))
    review = "struct<reviewBody:string,review_text:string,text:string,description:string>"
    rv = F.col("_r.review")
    texts = F.transform(
        F.when(rv.startswith("["), F.from_json(rv, f"array<{review}>")).when(rv.startswith("{"), F.array(F.from_json(rv, review))).otherwise(F.array().cast(f"array<{review}>")),
        lambda x: strip(F.coalesce(F.nullif(x["reviewBody"], F.lit("")), F.nullif(x["review_text"], F.lit("")), F.nullif(x["text"], F.lit("")), F.nullif(x["description"], F.lit("")), F.lit(""))),
    )
    rating = F.from_json("_r.aggregateRating", "struct<ratingValue:string,ratingCount:string>")
    author = F.coalesce(F.from_json("_r.author", "struct<name:string>")["name"], F.when(~F.col("_r.author").rlike(r"^[\[{]"), F.col("_r.author")))
    title, ing = strip(F.col("_r.name")), clean_list(F.col("_r.recipeIngredient"))
    d = d.withColumns({"_t": title, "_i": ing, "_s": clean_list(steps)}).withColumn("_ok", usable(F.col("_t"), F.col("_i"), F.col("_s")))
    only = lambda c: F.when(F.col("_ok"), c)
    out = {
        "title": F.col("_t"), "ingredients": F.col("_i"), "steps": F.col("_s"), "minutes": minutes_of(F.col("_r.totalTime")), "yields": F.col("_r.recipeYield"), "category": F.col("_r.recipeCategory"),
        "page_lang": F.col("_r.inLanguage"), "author": author, "rating_mean": rating["ratingValue"].try_cast("double"), "rating_n": rating["ratingCount"].try_cast("bigint"), "review_texts": F.filter(texts, lambda t: t != ""),
    }
    return d.withColumns({k: only(v) for k, v in out.items()}).drop("_r", "_t", "_i", "_s", "_ok")


def _gunzip(content: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in content:
        yield s.map(lambda b: (gzip.decompress(b) if bytes(b[:2]) == b"\x1f\x8b" else bytes(b)).decode("utf-8", "replace"), na_action="ignore")


def sitemap_text(content: Column) -> Column:
    return F.pandas_udf(_gunzip, "string")(content)


def sitemap_locs(text: Column) -> tuple[Column, Column]:
    """(child sitemaps, pages) of a sitemap's text."""
    locs = F.regexp_extract_all(text, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    index = F.substring(text, 1, 2000).contains("<sitemapindex")
    none = F.array().cast(_STRINGS)
    return F.when(index, locs).otherwise(none), F.when(index, none).otherwise(locs)


def robots_sitemaps(text: Column, host: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.concat(F.lit("https://"), host, F.lit("/sitemap.xml"))))


def robots_allow(text: Column, url: Column, agent: str = "recipeframe") -> Column:
    """Whether robots.txt lets the agent, or any, fetch the url; a missing file allows all."""

    def run(texts: pd.Series, urls: pd.Series) -> pd.Series:
        memo, out = {}, []
        for t, u in zip(texts, urls):
            t = t or ""
            if t not in memo:
                memo[t] = robotparser.RobotFileParser()
                memo[t].parse(t.splitlines())
            out.append(memo[t].can_fetch(agent, u or "") or memo[t].can_fetch("*", u or ""))
        return pd.Series(out)

    run.__annotations__ = {"texts": pd.Series, "urls": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "boolean")(text, url)


def numbered_url(template: str, seed: str, place: Column, lo: int, hi: int) -> Column:
    """The address of the sample's member number ``place``: a number from lo to hi by hash, with replacement."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), place)), 1, 15), 16, 10).cast("bigint")
    return F.format_string(template, h % (hi - lo + 1) + lo)


def caption_track(info: Column, lang: Column) -> Column:
    """struct<url,kind,lang> of the caption track to take: manual before automatic, then the language itself, its original
    track, its variants by name; the first json3 format with an address."""
    tracks = "map<string,array<struct<ext:string,url:string>>>"
    j = F.from_json(info, f"struct<subtitles:{tracks},automatic_captions:{tracks}>")

    def of(m: Column, kind: str) -> Column:
        keys = F.array_sort(F.map_keys(m))
        order = F.concat(F.array(lang, F.concat(lang, F.lit("-orig"))), F.filter(keys, lambda k: k.startswith(F.concat(lang, F.lit("-"))) | k.startswith(F.concat(lang, F.lit("_")))))
        first = lambda k: F.get(F.filter(F.coalesce(m[k], F.array().cast("array<struct<ext:string,url:string>>")), lambda f: (f["ext"] == "json3") & (F.coalesce(f["url"], F.lit("")) != "")), F.lit(0))["url"]
        return F.transform(order, lambda k: F.struct(first(k).alias("url"), F.lit(kind).alias("kind"), k.alias("lang")))

    none = F.array().cast("array<struct<url:string,kind:string,lang:string>>")
    every = F.concat(F.coalesce(of(j["subtitles"], "manual"), none), F.coalesce(of(j["automatic_captions"], "auto"), none))
    return F.get(F.filter(every, lambda x: x["url"].isNotNull()), F.lit(0))


def write_shards(df: DataFrame, directory: str, rows: int = 100_000) -> None:
    """Append shards of at most ``rows`` rows; earlier shards stay."""
    df.write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(directory)


def read_shards(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    """All shards under one explicit schema; a missing or empty directory is an empty table."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(directory)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.listStatus(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(directory)
