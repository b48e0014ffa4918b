import gzip
import json

import pytest
from pyspark.sql import functions as F

from recipeframe.functions import text
from recipeframe.sources import readers
from recipeframe.streaming import resume


def test_csv(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('name,id,minutes,contributor_id,submitted,tags,nutrition,n_steps,steps,description,ingredients,n_ingredients\n"pie, ""best""",1,10,5,2011-01-02,"[\'a\', ""b\'s""]","[51.5, 0.0]",2,"[\'x, y\', \'z\']","two\nlines","[\'egg\']",1\nnull,2,,,,oops,"[]",,"(\'t\',)",NA,"[\'m\', \'n\']",\n')
    got = {r["id"]: r for r in readers.contract(readers.read_csv(spark, str(p), readers.RAW_RECIPES)).collect()}
    assert got[1]["title"] == 'pie, "best"' and got[1]["tags"] == ["a", "b's"] and got[1]["steps"] == ["x, y", "z"] and got[1]["calories"] == 51.5
    assert got[2]["title"] == "" and got[2]["minutes"] == 0 and got[2]["tags"] == [] and got[2]["calories"] is None and got[2]["ingredients"] == ["m", "n"]


def test_json_lines(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    ok = {"name": " 汤 ", "dish": "Unknown", "recipeIngredient": [" 盐 ", ""], "recipeInstructions": None, "extra": 1}
    p.write_text("\n".join([json.dumps(ok, ensure_ascii=False), "{bad", "", json.dumps({"name": ""}), json.dumps(ok | {"dish": "面"}), "[1]"]) + "\n")
    lines = readers.read_json_lines(spark, str(p))
    assert {r["id"]: (r["title"], r["dish"], r["ingredients"], r["n_ingredients"]) for r in readers.dish_rows(lines).collect()} == {0: ("汤", "", ["盐"], 1), 4: ("汤", "面", ["盐"], 1)}
    assert tuple(readers.line_stats(lines).first()) == (6, 2, 4, 1)


def test_json_lines_are_numbered_over_blocks_and_files(spark, tmp_path):
    for k, n in enumerate((400, 3, 250)):
        (tmp_path / f"part-{k}.jsonl").write_text("".join(json.dumps({"name": f"{k}-{i}", "dish": "x" * (i % 90)}) + ("\r\n" if i % 2 else "\n") for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        rows = readers.read_json_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f"{k}-{i}" for k, n in enumerate((400, 3, 250)) for i in range(n)]
    assert [r["name"] for r in sorted(rows, key=lambda r: r["line_no"])] == want and {r["line_no"] for r in rows} == set(range(653))


RECIPE = {"@type": ["CreativeWork", "Recipe"], "name": "Kürbisgulasch", "recipeIngredient": ["Kürbis", "Zwiebel", "Paprika"], "recipeInstructions": [{"@type": "HowToStep", "text": "Anschwitzen"}, {"text": "Schmoren"}], "totalTime": "PT2H5M", "aggregateRating": {"ratingValue": "3.2", "ratingCount": "58"}, "author": {"name": "Ilse"}, "inLanguage": "de-AT", "review": [{"reviewBody": ""}, {"text": " zu mild "}]}


def page(x):
    return f'<html><script type="application/ld+json">\n{json.dumps(x, ensure_ascii=False)}</script></html>'


@pytest.mark.parametrize("wrap", [lambda r: page(r), lambda r: page([{"@type": "WebSite"}, r]), lambda r: page({"@graph": [{"@type": "WebSite"}, r]}), lambda r: page({"@type": "WebSite"}) + page(r)])
def test_pages(spark, wrap):
    r = readers.recipe_pages(spark.createDataFrame([(wrap(RECIPE),)], "html string")).first()
    assert (r["title"], r["ingredients"], r["steps"], r["minutes"], r["rating_mean"], r["rating_n"], r["author"], r["review_texts"]) == ("Kürbisgulasch", ["Kürbis", "Zwiebel", "Paprika"], ["Anschwitzen", "Schmoren"], 125, 3.2, 58, "Ilse", ["zu mild"])


def test_page_variants(spark):
    one = readers.recipe_pages(spark.createDataFrame([(page(RECIPE | {"@type": "Recipe", "recipeInstructions": ["a", "b"], "review": {"reviewBody": "x"}, "author": "Lee"}),)], "html string")).first()
    assert one["steps"] == ["a", "b"] and one["review_texts"] == ["x"] and one["author"] == "Lee"
    rows = [("<p>none</p>",), (None,), ("",), (page({"@type": "Recipe", "name": "x"}),), ('<script type="application/ld+json">{bad</script>',)]
    assert all(r["title"] is None for r in readers.recipe_pages(spark.createDataFrame(rows, "html string")).collect())


def test_sitemaps_and_robots(spark):
    urls = b"<urlset><url><loc>\n https://a/1 </loc></url><url><loc>https://a/2</loc></url></urlset>"
    index = b"<sitemapindex><sitemap><loc>https://a/s.xml</loc></sitemap></sitemapindex>"
    df = spark.createDataFrame([(1, urls), (2, gzip.compress(index)), (3, None)], "k int, content binary").withColumn("t", readers.sitemap_text(F.col("content")))
    maps, pages = readers.sitemap_locs(F.col("t"))
    got = {r["k"]: r for r in df.select("k", maps.alias("maps"), pages.alias("pages")).collect()}
    assert got[1]["pages"] == ["https://a/1", "https://a/2"] and got[1]["maps"] == [] and got[2]["maps"] == ["https://a/s.xml"]
    r = spark.createDataFrame([("a", "User-agent: *\nDisallow: /x\n sitemap: https://a/m.xml"), ("b", None)], "host string, t string")
    assert [x["s"] for x in r.select("host", readers.robots_sitemaps(F.col("t"), F.col("host")).alias("s")).orderBy("host").collect()] == [["https://a/m.xml"], ["https://b/sitemap.xml"]]
    allow = r.select("host", readers.robots_allow(F.col("t"), F.lit("https://a/x/1")).alias("x"), readers.robots_allow(F.col("t"), F.lit("https://a/y")).alias("y")).orderBy("host").collect()
    assert [(x["x"], x["y"]) for x in allow] == [(False, True), (True, True)]


@pytest.mark.parametrize(
    "s,want",
    [("['a', \"b's\"]", ["a", "b's"]), ("['a', None]", ["a", "None"]), ("['a', True, 3]", ["a", "True", "3"]), ("[1.05, 273.9, 10, 0, -2.5, 1.0]", ["1.05", "273.9", "10", "0", "-2.5", "1.0"]), ("[1.50, 1e3, 007]", []), ("[1.50, 1e3]", ["1.5", "1000.0"]), (r"['it\'s', '\xe9\u00e9']", ["it's", "éé"]), ("[['a'], ('b',)]", ["['a']", "('b',)"]), ("('a', 'b')", []), ("['a' 'b']", ["ab"]), ("['a',]", ["a"]), (" [ ]", []), ("[", []), ("['a'] x", []), ("['a\nb']", []), ("5", []), ("", []), (None, []), ("['a']\n", ["a"])],
)
def test_listify(spark, s, want):
    assert spark.createDataFrame([(s,)], "s string").select(text.listify(F.col("s")).alias("x")).first()["x"] == want


def test_captions(spark):
    info = {"subtitles": {"ko": [{"ext": "vtt", "url": "v"}, {"ext": "json3", "url": "m"}]}, "automatic_captions": {"ko-orig": [{"ext": "json3", "url": "o"}], "en": [{"ext": "json3", "url": "e"}], "en-US": [{"ext": "json3", "url": "u"}]}}
    df = spark.createDataFrame([(json.dumps(info),)], "j string")
    pick = lambda lang: df.select(readers.caption_track(F.col("j"), F.lit(lang)).alias("c")).first()["c"]
    assert tuple(pick("ko")) == ("m", "manual", "ko") and tuple(pick("en")) == ("e", "auto", "en") and pick("fr") is None
    events = {"events": [{"segs": [{"utf8": "가\n"}, {"utf8": "나"}]}, {"tStart": 1}, {"segs": [{"utf8": "\n"}]}, {"segs": [{"utf8": " 다 "}]}]}
    assert spark.createDataFrame([(json.dumps(events),)], "j string").select(text.caption_text(F.col("j")).alias("t")).first()["t"] == "가 나 다"


@pytest.mark.parametrize("d,m", [("PT30M", 30), ("PT1H30M", 90), ("P1DT2H", 1560), ("PT45S", 0), ("P", None), ("1 hour", None), (None, None)])
def test_duration(spark, d, m):
    assert spark.createDataFrame([(d,)], "d string").select(text.minutes_of(F.col("d")).alias("m")).first()["m"] == m


def test_resume_log(spark):
    log = spark.createDataFrame([("a", "ok", 1), ("b", "rate_limited", 2), ("c", "rate_limited", 3), ("c", "ok", 4), ("d", "fetch_fail", 5)], "key string, status string, seq int")
    c = spark.createDataFrame([(x,) for x in "abcde"], "key string")
    assert {r["key"] for r in resume.todo(c, log).collect()} == {"e"}
    assert {r["key"] for r in resume.todo(c, log, retry="rate_limited").collect()} == {"b", "e"}


def test_stream_takes_only_what_is_new(spark, tmp_path):
    src, sink, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "key string, n int"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], schema).coalesce(1).write.parquet(src)
    assert resume.stream_new(spark, src, schema, "key", sink, ck) == 2
    spark.createDataFrame([("b", 5), ("c", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    assert resume.stream_new(spark, src, schema, "key", sink, ck) == 1
    assert resume.stream_new(spark, src, schema, "key", sink, ck) == 0
    assert sorted(r["key"] for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_shards(spark, tmp_path):
    at = str(tmp_path / "s")
    assert readers.read_shards(spark, at, readers.RECIPE).count() == 0
    df = spark.createDataFrame([(i, "s", "t", 1, [], [], [], 0, None, None, 0) for i in range(5)], readers.RECIPE)
    readers.write_shards(df.coalesce(1), at, rows=2)
    readers.write_shards(df.coalesce(1), at, rows=2)
    assert readers.read_shards(spark, at, readers.RECIPE).count() == 10 and len(list((tmp_path / "s").glob("*.parquet"))) == 6


def test_reachable(spark):
    e = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "a"), ("a", "x-no"), ("z", "q")], "parent string, url string")
    assert {r["url"] for r in resume.reachable(e, spark.createDataFrame([("r",)], "url string"), child="^[a-z]$").collect()} == {"r", "a", "b"}


def test_status(spark):
    df = spark.createDataFrame([(True, True, True), (False, True, True), (True, False, True), (True, True, False)], "f boolean, a boolean, p boolean")
    assert [r["s"] for r in df.select(resume.crawl_status(F.col("f"), F.col("a"), F.col("p")).alias("s")).collect()] == ["ok", "fetch_fail", "robots", "parse_fail"]
