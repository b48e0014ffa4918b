"""Fetching pages and videos: host by host, spaced, retried by a policy, resumable. Fetchers are passed in, so nothing
here needs a network; ``http_fetch`` is one for HTTP.

Pages of a host go to one task in order (``repartition`` by host), which keeps the spacing without coordination."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from recipeframe.functions.text import caption_text, lang_of_page, url_host
from recipeframe.runtime import materialize
from recipeframe.sources.readers import caption_track, read_shards, recipe_pages
from recipeframe.streaming.resume import crawl_status, ordered_distinct, todo, top_channels, video_status

Fetch = Callable[[str], tuple[int, str | None, str | None]]  # url -> (status, final url, body); raises OSError
Sleep = Callable[[float], None]


class Policy(NamedTuple):
    """How often to ask, and how long to wait after the k-th answer of a kind; a kind without a wait ends it."""

    attempts: int
    busy: tuple[int, ...]  # statuses of a server that may answer later
    waits: dict[str, tuple[float, ...]]  # by outcome: error, busy


# Retries and waits in seconds.
PAGES = Policy(3, (429, 500, 502, 503, 504), {"error": (1, 2, 4), "busy": (5, 10, 20)})
CAPTIONS = Policy(4, (429,), {"busy": (30, 90, 180)})
VIDEO_SPACING, TOP_CHANNELS, CHANNEL_CAP = 3.0, 15, 1500


class Answer(NamedTuple):
    outcome: str  # ok, refused, error, busy
    final: str | None = None
    body: str | None = None


def ask(fetch: Fetch, url: str, policy: Policy = PAGES, sleep: Sleep = time.sleep) -> Answer:
    """The first answer that the policy doesn't wait after, else the last one."""
    answer = Answer("error")
    for k in range(policy.attempts):
        try:
            status, final, body = fetch(url)
            answer = Answer("ok", final or url, body) if status == 200 else Answer("busy" if status in policy.busy else "refused")
        except OSError:
            answer = Answer("error")
        pauses = policy.waits.get(answer.outcome, ())
        if k >= len(pauses):
            break
        sleep(pauses[k])
    return answer


def paced(fetch: Fetch, spacing: float, sleep: Sleep = time.sleep) -> Fetch:
    """``fetch``, which asks no host more often than once per ``spacing`` seconds; for one task at a time."""
    last: dict[str, float] = {}

    def get(url: str) -> tuple[int, str | None, str | None]:
        host = urlsplit(url).netloc
        ahead = last.get(host, float("-inf")) + spacing - time.monotonic()
        if ahead > 0:
            sleep(ahead)
        last[host] = time.monotonic()
        return fetch(url)

    return get


def http_fetch(url: str, timeout: float = 25.0, agent: str = "recipeframe") -> tuple[int, str | None, str | None]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
            return r.status, r.url, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, url, None


def fetch_pages(urls: DataFrame, fetch: Fetch, spacing: float = 1.0, partitions: int = 32) -> DataFrame:
    """(url, host, final_url, html) for urls (url); nulls are left out, repeats asked once. No html where it failed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = paced(fetch, spacing)
        for b in batches:
            answers = [ask(get, url) for url in b["url"]]
            yield b.assign(final_url=[a.final for a in answers], html=[a.body for a in answers])

    hosts = urls.where("url is not null").select("url", url_host(F.col("url")).alias("host")).distinct()
    return hosts.repartition(partitions, "host").sortWithinPartitions("host", "url").mapInPandas(run, "url string, host string, final_url string, html string")


def _seq() -> int:
    return time.time_ns() // 1000


def _batches(left: DataFrame, key: str, limit: int | None, took: Callable[[DataFrame], int]) -> None:
    """Hand out candidates in order of ``key``, as many at a time as are still wanted, until ``took`` (which tells how
    many of them counted) has had ``limit`` of them or none are left."""
    if limit is None:
        took(left)
        return
    wanted = limit
    while wanted > 0:
        part = left.orderBy(key).limit(wanted)
        end = part.agg(F.max(key).alias("m")).first()["m"]
        if end is None:
            return
        end = F.struct(*[F.lit(v) for v in end]) if isinstance(end, Row) else F.lit(end)
        wanted -= took(left.where(F.col(key) <= end))
        left = left.where(F.col(key) > end)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl(candidates: DataFrame, log: DataFrame, fetch: Fetch, site_lang: str, allowed=None, limit: int | None = None, spacing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(rows in the contract, new log entries (key, status, seq)) of the candidates (url) that the log doesn't have.

    With ``limit``, candidates are taken in order of their address, as many at a time as rows are still wanted; what comes
    after the last row is neither fetched nor logged, so the next run goes on there. Rows are to be written before their
    log entries (``append``), so a crash repeats work but loses none. ``allowed`` is a Column over ``url``; disallowed
    pages are logged as robots and not fetched. Null addresses are left out; no candidates, no rows."""
    keys = candidates.select(F.col("url").alias("key")).where("key is not null").distinct()
    new = materialize(todo(keys, log).select(F.col("key").alias("url")).withColumn("_ok", F.lit(True) if allowed is None else F.coalesce(allowed, F.lit(False))), "candidates")
    rows, done, seq = [], [], _seq()

    def take(part: DataFrame) -> int:
        parsed = materialize(recipe_pages(fetch_pages(part.where("_ok").select("url"), fetch, spacing)), "crawl")
        rows.append(parsed.where("title is not null"))
        status = crawl_status(F.col("html").isNotNull(), F.lit(True), F.col("title").isNotNull())
        done.append(parsed.select(F.col("url").alias("key"), status.alias("status")))
        done.append(part.where("not _ok").select(F.col("url").alias("key"), F.lit("robots").alias("status")))
        return rows[-1].count()

    _batches(new, "url", limit, take)
    if not rows:  # a limit of 0, or nothing new
        take(new.where("false"))
    out = _union(rows).select(
        lang_of_page(F.col("page_lang"), F.lit(site_lang)).alias("lang"), F.col("host").alias("source"), F.lit("web").alias("source_kind"), F.coalesce("final_url", "url").alias("url"),
        "title", "ingredients", "steps", "minutes", "yields", "category", "author", "rating_mean", "rating_n", "review_texts", F.date_format(F.timestamp_micros(F.lit(seq)), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
    )
    return out, _union(done).withColumn("seq", F.lit(seq))


LOG = "key string, status string, seq bigint"


def read_log(spark, path: str) -> DataFrame:
    """The resume log of a folder; empty where there is none yet."""
    return read_shards(spark, path, spark.createDataFrame([], LOG).schema)


def append(rows: DataFrame, rows_path: str, done: DataFrame, log_path: str) -> None:
    """Rows first, then their log entries."""
    rows.write.mode("append").option("compression", "zstd").parquet(rows_path)
    done.write.mode("append").parquet(log_path)


# ---- videos

VIDEO = "struct<id:string,title:string,description:string,channel:string,uploader:string,channel_id:string,upload_date:string,duration:bigint,view_count:bigint,like_count:bigint,comment_count:bigint,language:string,tags:array<string>,chapters:array<struct<title:string,start_time:double,end_time:double>>>"


def video_rows(info: DataFrame, lang: str) -> DataFrame:
    """Video metadata (info, transcript, transcript_kind, transcript_lang) as rows of the video table, with their status."""
    j = info.withColumn("_j", F.from_json("info", VIDEO)).where("_j.id is not null")
    g = lambda c: F.col(f"_j.{c}")
    none = F.array().cast("array<string>")
    return j.select(
        g("id").alias("video_id"), F.lit(lang).alias("lang"), F.lit("youtube").alias("source"), F.lit("youtube").alias("source_kind"), F.concat(F.lit("https://www.youtube.com/watch?v="), g("id")).alias("url"), g("title").alias("title"), g("description").alias("description"),
        F.coalesce(F.nullif(g("channel"), F.lit("")), g("uploader")).alias("channel"), g("channel_id").alias("channel_id"), g("upload_date").alias("published"), g("duration").alias("duration"),
        g("view_count").alias("view_count"), g("like_count").alias("like_count"), g("comment_count").alias("comment_count"), g("language").alias("video_lang"), F.coalesce(g("tags"), none).alias("tags"),
        F.coalesce(F.to_json(g("chapters")), F.lit("[]")).alias("chapters"), "transcript", "transcript_kind", "transcript_lang", none.alias("ingredients"), none.alias("steps"),
        video_status(F.col("transcript"), F.col("transcript_kind")).alias("status"),
    )


def fetch_captions(info: DataFrame, lang: str, fetch: Fetch, policy: Policy = CAPTIONS, sleep: Sleep = time.sleep) -> DataFrame:
    """Adds transcript, transcript_kind and transcript_lang to videos (info, ...): the caption track is picked from the
    metadata and fetched with waits; one that stays busy has the kind rate_limited, one that fails no transcript."""
    tracked = info.withColumn("_track", caption_track(F.col("info"), F.lit(lang)))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            answers = [ask(fetch, u, policy, sleep) if isinstance(u, str) else Answer("none") for u in s]
            yield pd.DataFrame({"outcome": [a.outcome for a in answers], "body": [a.body for a in answers]})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    got = tracked.withColumn("_a", F.pandas_udf(run, "outcome string, body string")(F.col("_track.url")))
    text = F.nullif(caption_text(F.col("_a.body")), F.lit(""))
    kind = F.when(F.col("_a.outcome") == "busy", "rate_limited").otherwise(F.col("_track.kind"))
    return got.withColumns({"transcript": text, "transcript_kind": kind, "transcript_lang": F.col("_track.lang")}).drop("_track", "_a")


def video_candidates(queries: DataFrame, search: Callable[[str], list[tuple[str, str | None]]], listing: Callable[[str], list[str]], spacing: float = VIDEO_SPACING) -> DataFrame:
    """(video_id, pos): what searches (query, pos) find, in order, then the uploads of the channels in most hits.

    ``search`` gives (video, channel) of a query, ``listing`` the videos of a channel; one that raises OSError gives none."""

    def each(call: Callable[[str], list], width: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for name, pos in zip(b["name"], b["pos"]):
                    try:
                        got = call(name)
                    except OSError:
                        got = []
                    time.sleep(spacing)
                    rows = [x if width == 2 else (x, None) for x in got]
                    if rows:
                        yield pd.DataFrame({"video_id": [v for v, _ in rows], "channel": pd.Series([c for _, c in rows], dtype=object), "pos": int(pos), "k": range(len(rows))})

        return run

    shape = "video_id string, channel string, pos bigint, k bigint"
    asked = queries.select(F.col("query").alias("name"), F.col("pos").cast("bigint").alias("pos")).coalesce(1)
    hits = materialize(asked.mapInPandas(each(search, 2), shape).where("video_id is not null"), "hits")
    top = top_channels(hits.select("channel", F.struct("pos", "k").alias("seq")), TOP_CHANNELS)
    ranked = top.select(F.col("channel").alias("name"), (F.struct((-F.col("n")).alias("n"), "first_seen")).alias("o")).orderBy("o").coalesce(1).select("name", F.monotonically_increasing_id().alias("pos"))
    uploads = materialize(ranked.mapInPandas(each(lambda c: listing(c)[:CHANNEL_CAP], 1), shape).where("video_id is not null"), "uploads")
    every = hits.select(F.col("video_id").alias("value"), F.struct(F.lit(0).alias("part"), "pos", "k").alias("seq")).unionByName(uploads.select(F.col("video_id").alias("value"), F.struct(F.lit(1).alias("part"), "pos", "k").alias("seq")))
    return ordered_distinct(every).select(F.col("value").alias("video_id"), "pos")


def kept(path: str, make: Callable[[], DataFrame], spark) -> DataFrame:
    """The table at ``path``; made and written there first if it isn't complete yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def crawl_videos(candidates: DataFrame, log: DataFrame, metadata: Callable[[str], str | None], fetch: Fetch, lang: str, limit: int | None = None, spacing: float = VIDEO_SPACING, sleep: Sleep = time.sleep) -> tuple[DataFrame, DataFrame]:
    """(video rows, new log entries (key, status, seq)) of candidates (video_id, pos) that the log doesn't have, or has as
    rate_limited. ``metadata`` gives a video's JSON; null, or an OSError, is logged as fetch_fail. ``limit`` counts videos
    with metadata, taken in order; what comes after them is neither fetched nor logged."""
    keys = candidates.where("video_id is not null").groupBy(F.col("video_id").alias("key")).agg(F.min("pos").alias("pos"))
    new = materialize(todo(keys, log, retry="rate_limited").select(F.col("key").alias("video_id"), F.struct("pos", "key").alias("order")), "candidates")
    shape = "video_id string, info string"
    rows, done, seq = [], [], _seq()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for v in b["video_id"]:
                try:
                    got.append(metadata(v))
                except OSError:
                    got.append(None)
                sleep(spacing)
            yield pd.DataFrame({"video_id": b["video_id"], "info": got})

    def take(part: DataFrame) -> int:
        # one service: one task asks it, in order
        info = materialize(part.orderBy("order").select("video_id").coalesce(1).mapInPandas(run, shape), "info")
        there = F.from_json("info", "struct<id:string>")["id"].isNotNull()
        found = materialize(video_rows(fetch_captions(info.where(there).coalesce(1), lang, fetch, sleep=sleep), lang), "videos")
        rows.append(found)
        done.append(info.where(~F.coalesce(there, F.lit(False))).select(F.col("video_id").alias("key"), F.lit("fetch_fail").alias("status")))
        done.append(found.select(F.col("video_id").alias("key"), "status"))
        return found.count()

    _batches(new, "order", limit, take)
    if not rows:
        take(new.where("false"))
    out = _union(rows).drop("status").withColumn("fetched_at", F.date_format(F.timestamp_micros(F.lit(seq)), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return out, _union(done).withColumn("seq", F.lit(seq))
