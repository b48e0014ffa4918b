"""Every query of the engine proper with its SQL. Arrays are compared as joined text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recipeframe.functions import text
from recipeframe.operators import confidence, dedup, lint, quality
from recipeframe.operators.packed import explode_packed
from recipeframe.plans import views as v
from recipeframe.runtime import shared_dir, table
from recipeframe.sources import crawl, readers
from recipeframe.streaming import resume

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _joined(c: str, sep: str = "|"):
    return F.array_join(c, sep).alias(c)


# ---- SQL pieces


def _letters(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z]+')"


def _stem(w: str) -> str:
    return f"case when length({w}) > 3 and {w} like '%ies' then substr({w}, 1, length({w}) - 3) || 'y' when length({w}) > 3 and {w} like '%es' then substr({w}, 1, length({w}) - 2) when length({w}) > 2 and {w} like '%s' and {w} not like '%ss' then substr({w}, 1, length({w}) - 1) else {w} end"


def _tokens(x: str) -> str:
    return f"list_distinct(list_transform({_letters(x)}, lambda w: {_stem('w')}))"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_PLAIN = f"list_transform({_list(text.DESCRIPTORS)}, lambda d: {_stem('d')})"
_BARE = "list_transform(coalesce(ingredients, []), lambda z: trim(regexp_replace(lower(z), '[^a-z ]', '', 'g')))"
_ING = f"list_sort(list_distinct({_BARE}))"
_KEY = f"array_to_string({_ING}, '|')"
_NORM = f"array_to_string(list_sort({_letters('title')}), ' ')"
_TITLE = f"list_filter(list_distinct({_letters('title')}), lambda w: not list_contains({_list(text.TITLE_STOP)}, w))"
_LINT = f"""
b as (select *, list_filter(coalesce(steps, []), lambda s: regexp_matches(s, '\\S')) as s_, coalesce(ingredients, []) as i_ from r),
b2 as (select *, {_tokens("array_to_string(s_, ' ')")} as body_ from b),
b3 as (select * replace (case when list_has_any(body_, ['season', 'taste']) then list_distinct(list_concat(body_, ['salt', 'pepper', 'seasoning'])) else body_ end as body_) from b2),
b4 as (select *, case when len(s_) > 0 and len(i_) > 0 and not list_has_any(body_, ['ingredient', 'everything']) then len(list_filter(list_transform(i_, lambda z: list_filter({_tokens('z')}, lambda t: not list_contains({_PLAIN}, t))),
  lambda c: len(c) > 0 and not list_has_any(c, body_) and len(list_filter(c, lambda t: length(t) > 3 and len(list_filter(body_, lambda q: length(q) > 3 and (contains(q, t) or contains(t, q)))) > 0)) = 0)) else 0 end as unused_ from b3),
l as (select * exclude (s_, i_, body_), list_filter([case when len(s_) = 0 then 'no_steps' when len(s_) < 2 then 'too_few_steps' end, case when len(i_) = 0 then 'no_ingredients' end,
  case when len(list_distinct(list_transform(i_, lambda z: lower(z)))) < len(i_) then 'dup_ingredient' end, case when unused_ > 0 then 'unused_ingredient' end,
  case when minutes is null or minutes <= 0 then 'time_missing' when minutes > 10080 then 'time_insane' end, case when calories <= 0 or calories > 30000 then 'calorie_outlier' end], lambda f: f is not null) as lint_flags from b4),
lp as (select *, len(lint_flags) = 0 as lint_pass from l)"""
_LINTED = f"with {v.RECIPES}, {_LINT}"
_QUALITY = _LINTED + """,
p as (select avg(rating_mean) as prior from lp where rating_n > 0),
q as (select lp.*, case when rating_n = 0 or rating_mean is null then prior else (rating_n * rating_mean + 20 * prior) / (rating_n + 20) end as q_rating from lp, p),
qs as (select *, q_rating / 5 * cast(lint_pass as int) as q_score from q)"""
_REMAKE = "regexp_matches(coalesce(review, ''), '" + text.REMAKE_PATTERN.replace("'", "''") + "')"
_DAY = lambda c: f"cast(try_strptime({c}, '%Y-%m-%d') as date)"
_EVIDENCE = f"ev as (select recipe_id, cast(sum(cast({_REMAKE} as int)) as bigint) as remake_n, max({_DAY('date')}) as last_review from i group by recipe_id)"
_CONF = _LINTED + f""", {v.META}, {v.INTERACTIONS}, {_EVIDENCE},
c1 as (select lp.*, m.contributor_id, coalesce(ev.remake_n, 0) as remake_n, greatest(coalesce(date_diff('day', {_DAY('m.submitted')}, ev.last_review) / 365.25, 0), 0) as years_active, {_KEY} as copy_group
  from lp left join m on m.id = lp.id left join ev on ev.recipe_id = lp.id),
g as (select copy_group, count(*) as n_copies, count(distinct contributor_id) as n_authors, cast(sum(rating_n) as bigint) as pooled_rating_n, cast(sum(remake_n) as bigint) as pooled_remake_n from c1 group by copy_group),
c2 as (select c1.*, n_copies, n_authors, pooled_rating_n, pooled_remake_n, regexp_matches(title, '(?i)\\brsc\\b') as is_contest, list_has_any(lint_flags, ['no_steps', 'no_ingredients']) as structural_fail from c1 join g using (copy_group)),
c as (select *, case when structural_fail then 0 when pooled_rating_n >= 20 or pooled_remake_n >= 3 or (pooled_rating_n >= 10 and years_active >= 3) then 3 when pooled_rating_n >= 3 or pooled_remake_n >= 1 or n_authors >= 2 then 2 else 1 end as pos_tier from c2)"""


# ---- text functions


@query(f"with {v.RECIPES} select id, {_NORM} as norm_title from r")
def norm_title(spark: SparkSession, d: str) -> DataFrame:
    return v.recipes(spark, d).select("id", text.norm_title(F.col("title")).alias("norm_title"))


@query(f"with {v.RECIPES} select id, array_to_string(list_sort({_TITLE}), ' ') as title_tokens from r")
def title_tokens(spark: SparkSession, d: str) -> DataFrame:
    return v.recipes(spark, d).select("id", F.array_join(F.array_sort(text.title_tokens(F.col("title"))), " ").alias("title_tokens"))


@query(f"with {v.RECIPES} select id, {_KEY} as ing_set, len({_ING}) as n from r")
def ing_set(spark: SparkSession, d: str) -> DataFrame:
    s = text.ing_set(F.col("ingredients"))
    return v.recipes(spark, d).select("id", F.array_join(s, "|").alias("ing_set"), F.size(s).cast("bigint").alias("n"))


@query(f"with {v.RECIPES} select id, {_KEY} as copy_key from r")
def copy_key(spark: SparkSession, d: str) -> DataFrame:
    return v.recipes(spark, d).select("id", text.copy_key(F.col("ingredients")).alias("copy_key"))


@query(f"with {v.RECIPES}, t as (select distinct unnest({_letters('title')}) as w from r) select w, {_stem('w')} as stem from t")
def stem(spark: SparkSession, d: str) -> DataFrame:
    w = v.recipes(spark, d).select(F.explode(text.letters(F.col("title"))).alias("w")).distinct()
    return w.select("w", text.stem(F.col("w")).alias("stem"))


@query(f"with {v.RECIPES} select id, array_to_string(list_sort({_tokens('title')}), ' ') as tokens from r")
def lint_tokens(spark: SparkSession, d: str) -> DataFrame:
    return v.recipes(spark, d).select("id", F.array_join(F.array_sort(text.tokens(F.col("title"))), " ").alias("tokens"))


@query(f"with {v.INTERACTIONS} select review, {_REMAKE} as remake, count(*) as n from i group by all")
def remake_flag(spark: SparkSession, d: str) -> DataFrame:
    return v.interactions(spark, d).groupBy("review", text.remake(F.col("review")).alias("remake")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {v.RECIPES} select id, regexp_matches(title, '(?i)\\brsc\\b') as is_contest from r")
def contest_flag(spark: SparkSession, d: str) -> DataFrame:
    return v.recipes(spark, d).select("id", text.contest(F.col("title")).alias("is_contest"))


_CLEAN = lambda c: f"list_filter(list_transform(coalesce({c}, []), lambda z: regexp_replace(z, '^[\\s\\x{{A0}}\\x{{3000}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}]+|[\\s\\x{{A0}}\\x{{3000}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}]+$', '', 'g')), lambda z: z <> '')"


@query(f"with {v.DISHES} select line_no, array_to_string({_CLEAN('recipeIngredient')}, '|') as items from x")
def list_clean(spark: SparkSession, d: str) -> DataFrame:
    return v.dishes(spark, d).select("line_no", F.array_join(text.clean_list(F.col("recipeIngredient")), "|").alias("items"))


@query(f"with {v.RAW} select id, array_to_string(list_transform(regexp_extract_all(ingredients, '''[^'']*''|\"[^\"]*\"'), lambda z: z[2:-2]), '|') as items from w".replace("z[2:-2]", "substr(z, 2, length(z) - 2)"))
def listify(spark: SparkSession, d: str) -> DataFrame:
    return v.raw_recipes(spark, d).select("id", F.array_join(text.listify(F.col("ingredients")), "|").alias("items"))


@query(f"with {v.RAW} select id, case when trim(nutrition) like '[%' then try_cast(regexp_extract(nutrition, '^\\s*\\[\\s*[\"'']?([^,\"''\\]]*)', 1) as double) end as calories from w")
def calories(spark: SparkSession, d: str) -> DataFrame:
    return v.raw_recipes(spark, d).select("id", text.calories(F.col("nutrition")).alias("calories"))


@query("select distinct video_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host from ingest_youtube")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ingest_youtube").select("video_id", text.url_host(F.col("url")).alias("host")).distinct()


@query("select distinct video_id, coalesce(nullif(lower(substr(video_lang, 1, 2)), ''), lang) as lang from ingest_youtube")
def lang_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ingest_youtube").select("video_id", text.lang_of_page(F.col("video_lang"), F.col("lang")).alias("lang")).distinct()


@query("select video_id, max(array_to_string(list_filter(list_transform(string_split(transcript, '. '), lambda s: trim(replace(s, chr(10), ' '))), lambda s: s <> ''), ' ')) as captions from ingest_youtube where transcript is not null group by video_id")
def caption_text(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts written as timed captions, one event per sentence in two segments, and read back."""
    t = table(spark, d, "ingest_youtube").where("transcript is not null")
    half = lambda s: F.floor(F.length(s) / 2).cast("int")
    seg = lambda s: F.struct(s.alias("utf8"))
    events = F.transform(F.split("transcript", r"\. "), lambda s: F.struct(F.array(seg(F.substring(s, F.lit(1), half(s))), seg(F.substring(s, half(s) + 1, F.length(s)))).alias("segs")))
    return t.select("video_id", text.caption_text(F.to_json(F.struct(events.alias("events")))).alias("captions")).groupBy("video_id").agg(F.max("captions").alias("captions"))


# ---- ingest


@query(f"with {v.INTERACTIONS} select recipe_id, avg(rating) as rating_mean, count(*) as rating_n from i where rating > 0 group by recipe_id")
def rating_agg(spark: SparkSession, d: str) -> DataFrame:
    return quality.rating_agg(v.interactions(spark, d))


@query(f"with {v.RAW}, {v.INTERACTIONS}, a as (select recipe_id, avg(rating) as rating_mean, count(*) as rating_n from i where rating > 0 group by recipe_id) select w.id, coalesce(name, '') as title, rating_mean, coalesce(rating_n, 0) as rating_n from w left join a on a.recipe_id = w.id")
def ingest_ratings(spark: SparkSession, d: str) -> DataFrame:
    r = v.raw_recipes(spark, d).select("id", F.coalesce("name", F.lit("")).alias("title"))
    return quality.with_ratings(r, v.interactions(spark, d)).select("id", "title", "rating_mean", "rating_n")


@query(f"with {v.RAW} select id, 'foodcom' as source, coalesce(name, '') as title, coalesce(minutes, 0) as minutes, coalesce(n_ingredients, 0) as n_ingredients, len(regexp_extract_all(ingredients, '''[^'']*''|\"[^\"]*\"')) as n_items from w")
def recipe_project(spark: SparkSession, d: str) -> DataFrame:
    return readers.contract(v.raw_recipes(spark, d)).select("id", "source", "title", "minutes", "n_ingredients", F.size("ingredients").cast("bigint").alias("n_items"))


_DISH = f"{v.DISHES}, y as (select line_no as id, trim(coalesce(name, '')) as title, case when trim(coalesce(dish, '')) = 'Unknown' then '' else trim(coalesce(dish, '')) end as dish, {_CLEAN('recipeIngredient')} as ing, {_CLEAN('recipeInstructions')} as st from x), z as (select * from y where title <> '' and (len(ing) > 0 or len(st) > 0))"


@query(f"with {_DISH} select id, title, len(ing) as n_ingredients, array_to_string(st, '|') as steps from z")
def reject_empty(spark: SparkSession, d: str) -> DataFrame:
    return readers.dish_rows(v.dishes(spark, d)).select("id", "title", "n_ingredients", _joined("steps"))


@query(f"with {_DISH} select id, dish from z")
def dish_norm(spark: SparkSession, d: str) -> DataFrame:
    return readers.dish_rows(v.dishes(spark, d)).select("id", "dish")


_STATS = f"with {_DISH} select (select count(*) from x) as lines, count(*) as rows, (select count(*) from x) - count(*) as skipped, count(*) filter (dish <> '') as with_dish from z"


@query(_STATS)
def ingest_stats(spark: SparkSession, d: str) -> DataFrame:
    return readers.line_stats(v.dishes(spark, d))


@query(_STATS.replace("skipped", "skipped").replace("(select count(*) from x) as lines", "(select count(*) from x) * 2 as lines").replace("(select count(*) from x) - count(*)", "(select count(*) from x) * 2 - count(*)"))
def src_jsonl_stats(spark: SparkSession, d: str) -> DataFrame:
    """The dish table written as JSON lines, a malformed line after each, and read back by line number."""
    at = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/lines"
    x = v.dishes(spark, d)
    fields = ["name", "dish", "description", "recipeIngredient", "recipeInstructions", "author", "keywords"]
    x.select(F.explode(F.array(F.to_json(F.struct(*fields)), F.lit('{"name": '))).alias("value")).write.mode("overwrite").text(at)
    return readers.line_stats(readers.read_json_lines(spark, at))


@query(f"with {v.RAW} select id, coalesce(name, '') as title, coalesce(minutes, 0) as minutes, array_to_string(list_transform(regexp_extract_all(ingredients, '''[^'']*''|\"[^\"]*\"'), lambda z: substr(z, 2, length(z) - 2)), '|') as ingredients from w")
def src_csv(spark: SparkSession, d: str) -> DataFrame:
    """The raw recipes written as CSV and ingested from there."""
    at = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/csv"
    cols = [c.split()[0] for c in readers.RAW_RECIPES.split(", ")]
    raw = v.raw_recipes(spark, d)
    raw.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).option("nullValue", "NA").csv(at)
    return readers.contract(readers.read_csv(spark, at, readers.RAW_RECIPES)).select("id", "title", "minutes", _joined("ingredients"))


@query("select id, coalesce(title, '') as title, rating_n from (select distinct * from recipes_fixture)")
def shards_union(spark: SparkSession, d: str) -> DataFrame:
    """The corpus appended in two deliveries of shards and read as one table."""
    at = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/shards-{abs(hash(d))}"
    r = table(spark, d, "recipes_fixture").distinct().select(*readers.RECIPE.names)
    r.where("false").write.mode("overwrite").parquet(at)
    for k in (0, 1):
        readers.write_shards(r.where(F.pmod("id", F.lit(2)) == k), at, 1000)
    return readers.read_shards(spark, at, readers.RECIPE).select("id", F.coalesce("title", F.lit("")).alias("title"), "rating_n")


@query(f"with {v.RECIPES} select id, title, array_to_string({_CLEAN('ingredients')}, '|') as ingredients, array_to_string({_CLEAN('steps')}, '|') as steps, minutes, rating_n from r where trim(title) <> '' and title not like '%\x00%'")
def web_parse(spark: SparkSession, d: str) -> DataFrame:
    """The corpus written as pages with schema.org markup (in a @graph for odd ids) and parsed back."""
    r = v.recipes(spark, d).where("trim(title) <> ''")
    node = F.to_json(
        F.struct(
            F.lit("Recipe").alias("@type"), F.col("title").alias("name"), F.col("ingredients").alias("recipeIngredient"), F.transform("steps", lambda s: F.struct(F.lit("HowToStep").alias("@type"), s.alias("text"))).alias("recipeInstructions"),
            F.concat(F.lit("PT"), F.col("minutes"), F.lit("M")).alias("totalTime"), F.struct(F.col("rating_n").cast("string").alias("ratingCount")).alias("aggregateRating"),
        )
    )
    body = F.when(F.col("id") % 2 == 1, F.concat(F.lit('{"@context": "https://schema.org", "@graph": [{"@type": "WebPage"}, '), node, F.lit("]}"))).otherwise(node)
    pages = r.select("id", F.concat(F.lit('<html><script type="application/ld+json">'), body, F.lit("</script></html>")).alias("html"))
    got = readers.recipe_pages(pages)
    return got.select("id", "title", _joined("ingredients"), _joined("steps"), "minutes", "rating_n").where("title is not null")


@query("select id, coalesce(title, '') as title from (select distinct id, title from recipes_fixture)")
def schema_load(spark: SparkSession, d: str) -> DataFrame:
    """Records as JSON text with an unknown field, loaded under the contract's schema."""
    r = table(spark, d, "recipes_fixture").distinct()
    j = r.select(F.to_json(F.struct(*readers.RECIPE.names, F.lit("x").alias("unknown"))).alias("j")).select(F.from_json("j", readers.RECIPE).alias("r"))
    return j.select("r.id", F.coalesce("r.title", F.lit("")).alias("title")).distinct()


# ---- lint


@query(_LINTED + " select id, array_to_string(lint_flags, ',') as lint_flags, lint_pass from lp")
def lint_flags(spark: SparkSession, d: str) -> DataFrame:
    return lint.lint(v.recipes(spark, d)).select("id", _joined("lint_flags", ","), "lint_pass")


@query(_LINTED + " select id, unused_ as n_unused from lp")
def lint_unused(spark: SparkSession, d: str) -> DataFrame:
    r = v.recipes(spark, d).withColumn("_body", lint.body_words(F.coalesce("steps", F.array().cast("array<string>"))))
    vague = F.arrays_overlap("_body", F.array(F.lit("ingredient"), F.lit("everything")))
    told = F.exists("steps", lambda s: s.rlike(r"\S")) & (F.size("ingredients") > 0) & ~vague
    return r.select("id", F.when(told, lint.n_unused(F.col("ingredients"), F.col("_body"))).otherwise(0).cast("bigint").alias("n_unused"))


@query(_LINTED + " select flag, count(*) as n from (select unnest(lint_flags) as flag from lp) group by flag")
def lint_histogram(spark: SparkSession, d: str) -> DataFrame:
    return lint.histogram(lint.lint(v.recipes(spark, d)))


@query(_LINTED + """, f as (select unnest(lint_flags) as flag, rating_n, rating_mean from lp union all select 'PASS (baseline)', rating_n, rating_mean from lp where lint_pass),
t as (select flag, count(*) as n, avg(cast(rating_n >= 1 as int)) as share_rated, avg(cast(rating_n >= 10 as int)) as share_rated_10, median(cast(rating_n as double)) as median_rating_n, avg(rating_n) as mean_rating_n, avg(rating_mean) filter (rating_n > 0) as mean_stars from f group by flag)
select flag, n, median_rating_n, round(share_rated, 9) as share_rated, round(share_rated_10, 9) as share_rated_10, round(mean_rating_n, 9) as mean_rating_n, round(mean_stars, 9) as mean_stars, round(share_rated_10 / nullif((select share_rated_10 from t where flag = 'PASS (baseline)'), 0), 9) as ratio_10_vs_pass from t""")
def lint_audit(spark: SparkSession, d: str) -> DataFrame:
    t = lint.audit(lint.lint(v.recipes(spark, d)))
    return t.select("flag", "n", "median_rating_n", *[F.round(c, 9).alias(c) for c in t.columns if c not in ("flag", "n", "median_rating_n")])


# ---- duplicates and families


@query(f"with {v.RECIPES}, k as (select id, {_NORM} as t, {_KEY} || case when len({_ING}) = 0 then '~' else '' end as s from r), g as (select t, s, min(id) as first, count(*) as n from k group by t, s), o as (select *, row_number() over (order by first) - 1 as no from g) select k.id, case when n > 1 then no else -1 end as dup_group from k join o using (t, s)")
def dup_group(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dup_group(v.recipes(spark, d)).select("id", "dup_group")


_LIKE = f"""{v.RECIPES}, k as (select id, {_ING} as s, {_TITLE} as t from r), w as (select id, len(s) as n, unnest(s) as w from k where len(s) > 0),
o as (select a.id as a, b.id as b, any_value(a.n) + any_value(b.n) as n, count(*) as o from w a join w b on a.w = b.w and a.id < b.id group by 1, 2 having count(*) >= 0.6 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
e as (select o.a, o.b, o.o / (o.n - o.o) as jaccard from o join k x on x.id = o.a join k y on y.id = o.b where list_has_any(x.t, y.t))"""


@query(f"with {_LIKE} select a, b, jaccard from e")
def family_edges(spark: SparkSession, d: str) -> DataFrame:
    return dedup.family_edges(v.recipes(spark, d))


_FAMILY = f"""with recursive {_LIKE},
v as (select id, title, row_number() over (order by -rating_n, id) as i from r),
n as (select greatest(x.i, y.i) as i, list_sort(list(least(x.i, y.i))) as early from e join v x on x.id = e.a join v y on y.id = e.b group by 1),
visit as (select 0 as i, cast([] as bigint[]) as leaders union all select visit.i + 1, case when list_has_any(coalesce(n.early, []), leaders) then leaders else list_append(leaders, visit.i + 1) end
  from visit left join n on n.i = visit.i + 1 where visit.i < (select max(i) from v)),
led as (select leaders from visit order by i desc limit 1),
f as (select v.id, v.title, l.id as leader_id, l.title as leader_title from v left join n on n.i = v.i, led join v l on l.i = case when list_contains(led.leaders, v.i) then v.i else list_min(list_intersect(n.early, led.leaders)) end)
"""


@query(_FAMILY + "select id, leader_id from f")
def family(spark: SparkSession, d: str) -> DataFrame:
    """The SQL visits recipes one after another."""
    return dedup.family(v.recipes(spark, d))


@query(_FAMILY + "select leader_id, leader_title as title, count(*) as n from f group by all order by n desc, leader_id limit 10")
def family_top(spark: SparkSession, d: str) -> DataFrame:
    r = v.recipes(spark, d)
    return dedup.family_top(r, dedup.family(r))


# ---- quality


@query(f"with {v.RECIPES} select round(avg(rating_mean), 9) as prior from r where rating_n > 0")
def quality_prior(spark: SparkSession, d: str) -> DataFrame:
    return quality.prior(v.recipes(spark, d)).select(F.round("prior", 9).alias("prior"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return quality.score(lint.lint(v.recipes(spark, d)))


@query(_QUALITY + " select id, title, lint_pass, round(q_rating, 9) as q_rating, round(q_score, 9) as q_score from qs")
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("id", "title", "lint_pass", F.round("q_rating", 9).alias("q_rating"), F.round("q_score", 9).alias("q_score"))


@query(_QUALITY + ", s as (select list(q) as ql from (values (0.1), (0.25), (0.5), (0.75), (0.9), (0.99)) t(q)) select q, round(case q when 0.1 then quantile_cont(q_score, 0.1) when 0.25 then quantile_cont(q_score, 0.25) when 0.5 then quantile_cont(q_score, 0.5) when 0.75 then quantile_cont(q_score, 0.75) when 0.9 then quantile_cont(q_score, 0.9) else quantile_cont(q_score, 0.99) end, 9) as value from qs, (select cast(unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.99]) as double) as q) group by q")
def quality_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return quality.quantiles(_scored(spark, d)).select("q", F.round("value", 9).alias("value"))


@query(_QUALITY + " select count(q_score) as count, round(avg(q_score), 9) as mean, round(stddev_samp(q_score), 9) as std, round(min(q_score), 9) as min, round(quantile_cont(q_score, 0.25), 9) as p25, round(quantile_cont(q_score, 0.5), 9) as p50, round(quantile_cont(q_score, 0.75), 9) as p75, round(max(q_score), 9) as max from qs")
def quality_describe(spark: SparkSession, d: str) -> DataFrame:
    q = quality.describe(_scored(spark, d))
    return q.select("count", *[F.round(c, 9).alias(c) for c in q.columns if c != "count"])


@query(_QUALITY + " select id, title, round(q_score, 9) as q_score from qs order by qs.q_score desc, id limit 3")
def quality_top(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).orderBy(F.desc("q_score"), "id").limit(3).select("id", "title", F.round("q_score", 9).alias("q_score"))


@query(_QUALITY + " select id, title, round(q_score, 9) as q_score from qs order by qs.q_score, id limit 3")
def quality_bottom(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).orderBy("q_score", "id").limit(3).select("id", "title", F.round("q_score", 9).alias("q_score"))


# ---- confidence


@query(f"with {v.INTERACTIONS}, {_EVIDENCE} select * from ev")
def review_evidence(spark: SparkSession, d: str) -> DataFrame:
    return confidence.evidence(v.interactions(spark, d))


def _confident(spark: SparkSession, d: str) -> DataFrame:
    return confidence.confidence(lint.lint(v.recipes(spark, d)), v.meta(spark, d), v.interactions(spark, d))


@query(_CONF + " select id, remake_n, round(years_active, 9) as years_active, copy_group, n_copies, n_authors, pooled_rating_n, pooled_remake_n, is_contest, structural_fail, pos_tier, case pos_tier when 0 then 0.0 when 1 then 0.25 when 2 then 0.6 else 1.0 end as pos_weight from c")
def confidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _confident(spark, d).select("id", "remake_n", F.round("years_active", 9).alias("years_active"), "copy_group", "n_copies", "n_authors", "pooled_rating_n", "pooled_remake_n", "is_contest", "structural_fail", F.col("pos_tier").cast("int").alias("pos_tier"), "pos_weight")


@query(_CONF + " select distinct copy_group, n_copies, n_authors, pooled_rating_n, pooled_remake_n from c")
def copy_pool(spark: SparkSession, d: str) -> DataFrame:
    return _confident(spark, d).select("copy_group", "n_copies", "n_authors", "pooled_rating_n", "pooled_remake_n").distinct()


@query(_CONF + " select copy_group, id, title, n_copies, n_authors from c qualify row_number() over (partition by copy_group order by id) = 1")
def copy_reps(spark: SparkSession, d: str) -> DataFrame:
    return confidence.copy_reps(_confident(spark, d))


@query(_CONF + " select copy_group, n_copies as n, n_authors as authors, title from c qualify row_number() over (partition by copy_group order by id) = 1 order by n desc, copy_group limit 8")
def copy_groups_top(spark: SparkSession, d: str) -> DataFrame:
    return confidence.copy_groups_top(_confident(spark, d))


@query(_CONF + " select pos_tier, count(*) as n, median(cast(rating_n as double)) as median_rating_n, round(avg(remake_n), 9) as mean_remake, round(avg(cast(is_contest as int)), 9) as contest_share, round(count(*) / (select count(*) from c), 9) as share from c group by pos_tier")
def tier_report(spark: SparkSession, d: str) -> DataFrame:
    t = confidence.tier_report(_confident(spark, d)).withColumn("pos_tier", F.col("pos_tier").cast("int"))
    return t.withColumns({c: F.round(c, 9) for c in ("mean_remake", "contest_share", "share")})


@query(_CONF + " select id, title, pooled_remake_n from c where pos_tier = 3 order by pooled_remake_n desc, id limit 8")
def tier3_top(spark: SparkSession, d: str) -> DataFrame:
    return _confident(spark, d).where("pos_tier = 3").orderBy(F.desc("pooled_remake_n"), "id").limit(8).select("id", "title", "pooled_remake_n")


@query(_CONF + " select id, title, rating_n from c where pos_tier = 1 order by rating_n desc, id limit 5")
def tier1_top(spark: SparkSession, d: str) -> DataFrame:
    return _confident(spark, d).where("pos_tier = 1").orderBy(F.desc("rating_n"), "id").limit(5).select("id", "title", "rating_n")


@query(_CONF + f" select count(*) as recipes, cast(sum(rating_n) as bigint) as ratings, count(*) filter (rating_n > 0) as rated, round(avg(cast(lint_pass as int)), 9) as pass_rate, count(distinct copy_group) as ingredient_sets, cast(sum(remake_n) as bigint) as remakes, count(*) filter (is_contest) as contest from c")
def corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    return _confident(spark, d).agg(F.count(F.lit(1)).alias("recipes"), F.sum("rating_n").alias("ratings"), F.count_if(F.col("rating_n") > 0).alias("rated"), F.round(F.avg(F.col("lint_pass").cast("int")), 9).alias("pass_rate"), F.count_distinct("copy_group").alias("ingredient_sets"), F.sum("remake_n").alias("remakes"), F.count_if("is_contest").alias("contest"))


# ---- crawl bookkeeping


@query(f"with {v.EVENTS} select key, arg_max(status, seq) as status from e group by key")
def last_status(spark: SparkSession, d: str) -> DataFrame:
    return resume.last_status(v.events(spark, d))


@query(f"with {v.EVENTS}, l as (select key, arg_max(status, seq) as status from e group by key) select c_custkey as key from customer where c_custkey not in (select key from l where status <> 'error')")
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    return resume.todo(table(spark, d, "customer").select(F.col("c_custkey").alias("key")), v.events(spark, d), retry="error")


@query("select distinct video_id, case when coalesce(transcript, '') <> '' then 'ok' when transcript_kind = 'rate_limited' then 'rate_limited' else 'no_transcript' end as status from ingest_youtube")
def crawl_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ingest_youtube").select("video_id", resume.video_status(F.col("transcript"), F.col("transcript_kind")).alias("status")).distinct()


@query("select channel, count(*) as n, min(video_id) as first_seen from ingest_youtube where channel is not null group by channel order by n desc, first_seen limit 15")
def top_channels(spark: SparkSession, d: str) -> DataFrame:
    return resume.top_channels(table(spark, d, "ingest_youtube").select("channel", F.col("video_id").alias("seq")))


@query("select user_id as value, min(event_id) as pos from events group by user_id")
def ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    return resume.ordered_distinct(table(spark, d, "events").select(F.col("user_id").alias("value"), F.col("event_id").alias("seq")))


@query("select distinct video_id, url from ingest_youtube where regexp_matches(url, 'watch\\?v=[a-z0-9]*[02468]$')")
def url_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ingest_youtube").where(F.col("url").rlike(r"watch\?v=[a-z0-9]*[02468]$")).select("video_id", "url").distinct()


@query("select c_custkey, case when c_custkey % 7 = 0 then 'robots' when c_custkey % 5 = 0 then 'fetch_fail' when c_custkey % 3 = 0 then 'parse_fail' else 'ok' end as status from customer")
def page_status(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", resume.crawl_status(k % 5 != 0, k % 7 != 0, k % 3 != 0).alias("status"))


@query("""select 'https://h' || c_nationkey || '.test/' || c_custkey as key, case when c_custkey % 7 = 0 then 'robots' when c_custkey % 5 = 0 then 'fetch_fail' when c_custkey % 3 = 0 then 'parse_fail' else 'ok' end as status,
  case when c_custkey % 7 <> 0 and c_custkey % 5 <> 0 and c_custkey % 3 <> 0 then 'Dish ' || c_custkey end as title from customer where c_custkey % 11 <> 0""")
def crawl_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page per customer, crawled with the log of an earlier crawl; hosts are nations, every seventh page is private,
    every fifth gone, every third without a recipe."""

    def fetch(url: str) -> tuple[int, str | None, str | None]:
        k = int(url.rsplit("/", 1)[1])
        page = '<script type="application/ld+json">{"@type": "Recipe", "name": "Dish %d", "recipeIngredient": ["salt"]}</script>' % k
        return (404, None, None) if k % 5 == 0 else (200, url, page if k % 3 else "<p>")

    c = table(spark, d, "customer").select(F.format_string("https://h%d.test/%d", "c_nationkey", "c_custkey").alias("url"), "c_custkey")
    log = c.where("c_custkey % 11 = 0").select(F.col("url").alias("key"), F.lit("ok").alias("status"), F.lit(1).cast("bigint").alias("seq"))
    private = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint") % 7 == 0
    rows, done = crawl.crawl(c.select("url"), log, fetch, "en", allowed=~private, spacing=0.0)
    return done.select("key", "status").join(rows.select(F.col("url").alias("key"), "title"), "key", "left")


@query("select c_custkey, not (c_nationkey % 2 = 0 and c_custkey % 3 = 0) as allowed from customer")
def robots_allow(spark: SparkSession, d: str) -> DataFrame:
    """Rules of even hosts keep everyone out of /private, those of odd hosts some other robot only."""
    c = table(spark, d, "customer")
    robots = F.when(F.col("c_nationkey") % 2 == 0, "User-agent: *\nDisallow: /private\n").otherwise("User-agent: other\nDisallow: /private\n")
    url = F.concat(F.lit("https://h.test/"), F.when(F.col("c_custkey") % 3 == 0, "private/").otherwise("open/"), F.col("c_custkey"))
    return c.select("c_custkey", readers.robots_allow(robots, url).alias("allowed"))


@query("""select distinct video_id, case when transcript_kind = 'manual' and transcript_lang = lang then 'm' else 'a' end as url, case when transcript_kind = 'manual' and transcript_lang = lang then 'manual' else 'auto' end as kind,
  case when transcript_kind = 'manual' and transcript_lang = lang then lang else lang || '-orig' end as track from ingest_youtube where length(lang) = 2""")
def caption_track(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of a video: its manual one, if it is in the video's language, before the automatic original one."""
    t = table(spark, d, "ingest_youtube").where("length(lang) = 2")
    track = lambda url: F.array(F.struct(F.lit("vtt").alias("ext"), F.lit("x").alias("url")), F.struct(F.lit("json3").alias("ext"), F.lit(url).alias("url")))
    mine = (F.col("transcript_kind") == "manual") & (F.col("transcript_lang") == F.col("lang"))
    manual = F.create_map(F.when(mine, F.col("lang")).otherwise("xx"), track("m"))
    auto = F.create_map(F.lit("yy"), track("y"), F.concat("lang", F.lit("-orig")), track("a"))
    info = F.to_json(F.struct(manual.alias("subtitles"), auto.alias("automatic_captions")))
    return t.select("video_id", readers.caption_track(info, F.col("lang")).alias("c")).select("video_id", "c.url", "c.kind", F.col("c.lang").alias("track")).distinct()


@query("""select distinct video_id, title, description, coalesce(nullif(channel, ''), 'nobody') as channel, published, duration, view_count, coalesce(video_lang, '') as video_lang, len(tags) as n_tags,
  case when coalesce(transcript, '') <> '' then 'ok' when transcript_kind = 'rate_limited' then 'rate_limited' else 'no_transcript' end as status from ingest_youtube""")
def video_rows(spark: SparkSession, d: str) -> DataFrame:
    """The videos written as a service's metadata and read back."""
    t = table(spark, d, "ingest_youtube")
    info = F.to_json(F.struct(F.col("video_id").alias("id"), "title", "description", "channel", F.lit("nobody").alias("uploader"), "channel_id", F.col("published").alias("upload_date"), "duration", "view_count", F.col("video_lang").alias("language"), "tags"))
    got = crawl.video_rows(t.select(info.alias("info"), "transcript", "transcript_kind", "transcript_lang"), "en")
    return got.select("video_id", "title", "description", "channel", "published", "duration", "view_count", F.coalesce("video_lang", F.lit("")).alias("video_lang"), F.size("tags").cast("bigint").alias("n_tags"), "status").distinct()


@query(f"with {v.RECIPES} select id, case id % 5 when 4 then '' else trim(steps[1]) end as review from r where trim(title) <> '' and len(steps) > 0 and trim(steps[1]) <> ''")
def page_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a review under each of its four names, in a list or alone, or with none."""
    r = v.recipes(spark, d).where("trim(title) <> '' and size(steps) > 0 and trim(steps[0]) <> ''")
    text, names = F.to_json(F.struct(F.col("steps")[0].alias("t"))), ["reviewBody", "review_text", "text", "description"]
    body = F.element_at(F.array(*[F.replace(text, F.lit('{"t":'), F.lit(f'{{"reviewBody": "", "{n}":' if n != "reviewBody" else f'{{"{n}":')) for n in names], F.lit("{}")), (F.pmod("id", F.lit(5)) + 1).cast("int"))
    review = F.when(F.col("id") % 2 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    page = F.concat(F.lit('<script type="application/ld+json">{"@type": "Recipe", "name": "x", "recipeIngredient": ["y"], "review": '), review, F.lit("}</script>"))
    return readers.recipe_pages(r.select("id", page.alias("html"))).select("id", F.array_join("review_texts", "|").alias("review"))


@query("select n_nationkey, case when n_nationkey % 3 = 0 then 'map' else 'page' end as kind, 'https://' || n_name || '/' || c_custkey as url from nation join customer on c_nationkey = n_nationkey")
def sitemap_locs(spark: SparkSession, d: str) -> DataFrame:
    """A sitemap per nation with an address per customer; every third is an index of further maps."""
    urls = table(spark, d, "nation").join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", F.concat(F.lit("<loc>\n https://"), "n_name", F.lit("/"), "c_custkey", F.lit(" </loc>")).alias("loc"))
    n = urls.groupBy("n_nationkey").agg(F.array_join(F.collect_list("loc"), "\n").alias("locs"))  # a sitemap has at most 50,000 addresses
    xml = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("<sitemapindex>"), "locs", F.lit("</sitemapindex>"))).otherwise(F.concat(F.lit("<urlset>"), "locs", F.lit("</urlset>")))
    maps, pages = readers.sitemap_locs(xml)
    kinds = F.concat(F.transform(maps, lambda u: F.struct(F.lit("map").alias("kind"), u.alias("url"))), F.transform(pages, lambda u: F.struct(F.lit("page").alias("kind"), u.alias("url"))))
    return n.select("n_nationkey", F.explode(kinds).alias("x")).select("n_nationkey", "x.*")


@query("select c_custkey, case when c_custkey % 2 = 0 then 'https://' || c_name || '/map.xml' else 'https://' || c_name || '/sitemap.xml' end as sitemap from customer")
def robots_sitemaps(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    robots = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("User-agent: *\nSitemap: https://"), F.col("c_name"), F.lit("/map.xml\n")))
    return c.select("c_custkey", F.explode(readers.robots_sitemaps(robots, F.col("c_name"))).alias("sitemap"))


@query("""with recursive e as (select cast(c_custkey as varchar) as parent, cast(c_custkey * 2 as varchar) as url from customer union select cast(c_custkey as varchar), cast(c_custkey * 3 as varchar) from customer),
f as (select '1' as url union select e.url from e join f on e.parent = f.url where e.url not like '%7%') select url from f""")
def sitemap_bfs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    edges = c.select(F.col("c_custkey").cast("string").alias("parent"), F.explode(F.array((F.col("c_custkey") * 2).cast("string"), (F.col("c_custkey") * 3).cast("string"))).alias("url"))
    return resume.reachable(edges, spark.createDataFrame([("1",)], "url string"), child="^[^7]*$")


@query("select 'https://example.test/recipes/' || (15000000 + cast('0x' || substr(md5('example.test-' || c_custkey), 1, 15) as bigint) % 9000001) as url, c_custkey from customer")
def id_enum(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable sample of addresses by number, with replacement, as many as there are customers."""
    at = readers.numbered_url("https://example.test/recipes/%d", "example.test", F.col("c_custkey"), 15_000_000, 24_000_000)
    return table(spark, d, "customer").select(at.alias("url"), "c_custkey")


@query("select time_bucket(interval '60 minutes', ts) as start, event_type, count(*) as n, round(sum(value), 4) as value from events group by 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    w = resume.windowed_counts(table(spark, d, "events"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", F.round("value", 4).alias("value"))


# ---- packed fields


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return explode_packed(table(spark, d, "raw_recipes_mini"), "id", ["tags", "nutrition", "steps"]).select("id", "field", "pos", "value")


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
