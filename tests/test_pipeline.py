import json

import pytest
from pyspark.sql import functions as F

from recipeframe.plans import pipeline
from recipeframe.sources import crawl
from recipeframe.streaming import resume

RECIPES = """name,id,minutes,contributor_id,submitted,tags,nutrition,n_steps,steps,description,ingredients,n_ingredients
tomato pasta,1,20,7,2010-01-01,['a'],"[300.0, 1.0]",2,"['boil the pasta', 'add tomato and salt']",x,"['pasta', 'tomato', 'salt']",3
pasta tomato,2,20,8,2011-01-01,['a'],"[300.0, 1.0]",2,"['boil the pasta', 'add tomato and salt']",x,"['Salt', 'pasta', 'tomato']",3
cake,3,90,7,2012-01-01,[],"[0.0]",0,[],x,"['flour', 'egg']",2
"""
INTERACTIONS = """user_id,recipe_id,date,rating,review
1,1,2012-01-01,5,"Great, a keeper"
2,1,2013-01-01,4,fine
3,1,2013-01-01,0,
4,3,2013-01-01,2,no
"""


def test_stages_end_to_end(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "r.csv").write_text(RECIPES)
    (tmp_path / "i.csv").write_text(INTERACTIONS)
    pipeline.run(spark, "ingest", at("r.csv"), at("0"), at("i.csv"))
    for k, stage in enumerate(["lint", "dedup", "quality"]):
        pipeline.run(spark, stage, at(str(k)), at(str(k + 1)))
    pipeline.run(spark, "confidence", at("3"), at("4"), at("r.csv"), at("i.csv"))
    got = {r["id"]: r for r in spark.read.parquet(at("4")).collect()}
    assert got[1]["rating_mean"] == 4.5 and got[1]["rating_n"] == 2 and got[2]["rating_n"] == 0
    assert got[1]["dup_group"] == got[2]["dup_group"] == 0 and got[3]["dup_group"] == -1 and got[2]["family_id"] == 1
    assert got[3]["lint_flags"] == ["no_steps", "calorie_outlier"] and got[3]["q_score"] == 0
    assert got[2]["pos_tier"] == 2 and got[2]["n_authors"] == 2 and got[3]["pos_tier"] == 0
    for stage in ("report", "lint_audit", "confidence_report"):
        pipeline.run(spark, stage, at("4"), at(stage + ".md"))
    text = (tmp_path / "report.md").read_text()
    assert "3 recipes, 3 ratings, 2 rated recipes" in text and "| no_steps | 1 |" in text and "2 families" in text
    assert "PASS (baseline)" in (tmp_path / "lint_audit.md").read_text() and "| 0 | 1 |" in (tmp_path / "confidence_report.md").read_text()


def scripted(*answers):
    left = iter(answers)

    def fetch(url):
        a = next(left)
        if isinstance(a, Exception):
            raise a
        return a

    return fetch


def test_asking():
    waits = []
    go = lambda policy, *answers: tuple(crawl.ask(scripted(*answers), "u", policy, waits.append))
    assert go(crawl.PAGES, OSError(), (503, None, None), (200, "u2", "body")) == ("ok", "u2", "body") and waits == [1, 10]
    waits.clear()
    assert go(crawl.PAGES, (404, None, None)) == ("refused", None, None) and waits == []
    assert go(crawl.PAGES, *[(429, None, None)] * 3) == ("busy", None, None) and waits == [5, 10, 20]
    waits.clear()
    assert go(crawl.CAPTIONS, *[(429, None, None)] * 4) == ("busy", None, None) and waits == [30, 90, 180]
    waits.clear()
    assert go(crawl.CAPTIONS, (429, None, None), (200, None, "x")) == ("ok", "u", "x") and waits == [30]
    assert go(crawl.CAPTIONS, OSError()) == ("error", None, None) and go(crawl.CAPTIONS, (500, None, None)) == ("refused", None, None) and waits == [30]


def test_pacing_goes_by_host():
    waits = []
    get = crawl.paced(lambda u: (200, None, u), 5.0, waits.append)
    for u in ("https://a/1", "https://b/1", "https://a/2"):
        get(u)
    assert len(waits) == 1 and 4 < waits[0] <= 5


def test_http_fetch():
    import http.server
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.path == "/page"
            self.send_response(200 if ok else 503)
            self.send_header("Content-Type", "text/html; charset=latin-1")
            self.end_headers()
            self.wfile.write("grüß".encode("latin-1") if ok else b"")

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    assert crawl.http_fetch(at + "/page") == (200, at + "/page", "grüß") and crawl.http_fetch(at + "/gone")[0] == 503
    server.shutdown()


GOOD = '<script type="application/ld+json">' + json.dumps({"@type": "Recipe", "name": "Soup", "recipeIngredient": ["water"], "inLanguage": "DE-at"}) + "</script>"


def test_crawl(spark):
    def fetch(url):
        return (404, None, None) if url.endswith("gone") else (200, None, GOOD if "r/" in url else "<p>")

    urls = spark.createDataFrame([(f"https://h{k}.test/{p}",) for k in (1, 2) for p in ("r/1", "gone", "other", "done", "private")] + [(None,)], "url string")
    log = spark.createDataFrame([("https://h1.test/done", "ok", 1), ("https://h2.test/done", "ok", 1)], "key string, status string, seq int")
    rows, done = crawl.crawl(urls, log, fetch, "en", allowed=~F.col("url").endswith("private"), spacing=0.01)
    assert sorted((r["source"], r["title"], r["lang"]) for r in rows.collect()) == [("h1.test", "Soup", "de"), ("h2.test", "Soup", "de")]
    assert {r["key"].split("/")[-1]: r["status"] for r in done.collect()} == {"1": "ok", "gone": "fetch_fail", "other": "parse_fail", "private": "robots"}
    assert resume.todo(urls.select(F.col("url").alias("key")).where("key is not null"), log.unionByName(done)).count() == 0
    rows, done = crawl.crawl(urls.where("false"), log, fetch, "en")
    assert rows.count() == done.count() == 0


def test_crawl_stops_early_and_goes_on(spark, tmp_path):
    asked = str(tmp_path / "asked")

    def fetch(url):
        with open(asked, "a") as f:
            f.write(url + "\n")
        return 200, None, GOOD if "r" in url else "<p>"

    names = ["a", "br", "c", "dr", "er", "fr"]
    urls = spark.createDataFrame([(f"https://h.test/{n}",) for n in names], "url string")
    log, total = crawl.read_log(spark, str(tmp_path / "log")), []
    for want in (["a", "br", "c", "dr"], ["er", "fr"], []):
        open(asked, "w").close()
        rows, done = crawl.crawl(urls, log, fetch, "en", limit=2, spacing=0.0)
        crawl.append(rows, str(tmp_path / "rows"), done, str(tmp_path / "log"))
        assert [u.strip().split("/")[-1] for u in open(asked)] == want
        log = crawl.read_log(spark, str(tmp_path / "log"))
        total.append(spark.read.parquet(str(tmp_path / "rows")).count())
    assert total == [2, 4, 4]


FAKES = """
import json

def page(url):
    return 200, None, %r

def metadata(video):
    if video == "down":
        raise OSError
    track = [{"ext": "json3", "url": f"https://c.test/{video}"}]
    return None if video == "gone" else "{bad" if video == "bad" else json.dumps({"id": video, "title": video} | ({} if video == "mute" else {"subtitles": {"en": track}}))

def captions(url):
    v = url.split("/")[-1]
    return (429, None, None) if v == "busy" else (200, None, "no json" if v == "odd" else json.dumps({"events": [{"segs": [{"utf8": "hi "}, {"utf8": v}]}]}))
"""


@pytest.fixture(scope="module")
def fakes(spark, tmp_path_factory):
    """A module of services that the workers can import, too."""
    at = tmp_path_factory.mktemp("fakes") / "crawl_fakes.py"
    at.write_text(FAKES % GOOD)
    spark.sparkContext.addPyFile(str(at))
    import crawl_fakes

    return crawl_fakes


def test_stages_of_the_crawls(spark, tmp_path, fakes):
    at = lambda n: str(tmp_path / n)
    spark.createDataFrame([("https://h.test/r/1",)], "url string").write.parquet(at("urls"))
    pipeline.run(spark, "crawl", at("urls"), at("rows"), at("log"), "en", "crawl_fakes:page")
    assert spark.read.parquet(at("rows")).first()["title"] == "Soup" and spark.read.parquet(at("log")).first()["status"] == "ok"
    spark.createDataFrame([("v1", 0), ("v2", 1)], "video_id string, pos int").write.parquet(at("ids"))
    crawl_spacing, crawl.VIDEO_SPACING = crawl.VIDEO_SPACING, 0.0
    pipeline.run(spark, "videos", at("ids"), at("videos"), at("vlog"), "en", "crawl_fakes:metadata", "crawl_fakes:captions", "1")
    crawl.VIDEO_SPACING = crawl_spacing
    assert [(r["video_id"], r["transcript"]) for r in spark.read.parquet(at("videos")).collect()] == [("v1", "hi v1")]


def test_video_crawl(spark, fakes):
    ids = ["v1", "gone", "down", "bad", "mute", "busy", "odd", "v2", "old", "again", "v1"]
    candidates = spark.createDataFrame(list(zip(ids, range(99))), "video_id string, pos int")
    log = spark.createDataFrame([("old", "ok", 1), ("again", "ok", 1), ("again", "rate_limited", 2)], "key string, status string, seq bigint")
    nap = lambda s: None
    rows, done = crawl.crawl_videos(candidates, log, fakes.metadata, fakes.captions, "en", spacing=0.0, sleep=nap)
    status = {r["key"]: r["status"] for r in done.collect()}
    assert status == {"v1": "ok", "gone": "fetch_fail", "down": "fetch_fail", "bad": "fetch_fail", "mute": "no_transcript", "busy": "rate_limited", "odd": "no_transcript", "v2": "ok", "again": "ok"}
    assert {r["video_id"]: (r["transcript"], r["transcript_kind"]) for r in rows.collect()} == {"v1": ("hi v1", "manual"), "mute": (None, None), "busy": (None, "rate_limited"), "odd": (None, "manual"), "v2": ("hi v2", "manual"), "again": ("hi again", "manual")}
    left = resume.todo(candidates.select(F.col("video_id").alias("key")).distinct(), log.unionByName(done), retry="rate_limited")
    assert [r["key"] for r in left.collect()] == ["busy"]
    rows, done = crawl.crawl_videos(candidates, log, fakes.metadata, fakes.captions, "en", limit=2, spacing=0.0, sleep=nap)
    assert {r["video_id"] for r in rows.collect()} == {"v1", "mute"} and {r["key"] for r in done.collect()} == {"v1", "gone", "down", "bad", "mute"}


def test_video_candidates(spark, tmp_path):
    hits = {"q1": [("a", "x"), ("b", "y"), ("c", "y")], "q2": [("b", "y"), ("d", None), ("e", "z")]}

    def listing(channel):
        if channel == "z":
            raise OSError
        return {"x": ["x1", "a"], "y": ["y1"]}[channel]

    queries = spark.createDataFrame([("q1", 0), ("q2", 1)], "query string, pos int")
    make = lambda: crawl.video_candidates(queries, hits.__getitem__, listing, spacing=0.0)
    got = crawl.kept(str(tmp_path / "seeds"), make, spark)
    assert [r["video_id"] for r in got.orderBy("pos").collect()] == ["a", "b", "c", "d", "e", "y1", "x1"]
    assert crawl.kept(str(tmp_path / "seeds"), lambda: 1 / 0, spark).count() == 7  # the kept list is read, not made again


def test_swap(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    for n in ("t", "t2"):
        spark.createDataFrame([(n,)], "n string").write.parquet(at(n))
    pipeline.swap(spark, at("t"), at("t2"))
    assert spark.read.parquet(at("t")).first()["n"] == "t2" and spark.read.parquet(at("t.before")).first()["n"] == "t"
    try:
        pipeline.swap(spark, at("t"), at("t2"))
    except FileNotFoundError:
        pass
    else:
        raise AssertionError


def test_video_rows(spark):
    info = {"id": "v", "title": "t", "channel": "", "uploader": "u", "upload_date": "20240102", "view_count": 5, "chapters": [{"title": "재료", "start_time": 0, "end_time": 60}]}
    df = spark.createDataFrame([(json.dumps(info), None, "rate_limited", "ko"), (json.dumps(info), "text", "auto", "ko"), ("{bad", None, None, None)], "info string, transcript string, transcript_kind string, transcript_lang string")
    got = crawl.video_rows(df, "ko").collect()
    assert [r["status"] for r in got] == ["rate_limited", "ok"] and got[0]["channel"] == "u" and "재료" in got[0]["chapters"] and got[0]["tags"] == []


def test_ship(spark):
    """The workers find the package in a zip, wherever they run."""
    import subprocess
    import sys

    from recipeframe import runtime

    runtime.ship(spark)
    found = [p for p in spark.sparkContext._python_includes if p == "recipeframe.zip"]
    assert found
    from pyspark import SparkFiles

    code = "import recipeframe.runtime, recipeframe.operators.packed as p; print(p.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env={"PYTHONPATH": SparkFiles.get("recipeframe.zip") + ":" + ":".join(x for x in sys.path if x.endswith("site-packages"))}, capture_output=True, text=True)
    assert "recipeframe.zip" in out.stdout, out.stderr[-500:]
