"""Resumable ingest: the log of what was done, and an incremental stream that takes only what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from recipeframe.runtime import materialize


def last_status(log: DataFrame) -> DataFrame:
    """(key, status) of the latest entry per key; log: (key, status, seq)."""
    return log.groupBy("key").agg(F.max_by("status", "seq").alias("status"))


def todo(candidates: DataFrame, log: DataFrame, retry: str | None = None) -> DataFrame:
    """Candidates (key) not in the log, and those whose last status is ``retry``."""
    done = last_status(log)
    if retry is not None:
        done = done.where(F.col("status") != retry)
    return candidates.join(done.select("key"), "key", "left_anti")


def crawl_status(fetched, allowed, parsed) -> F.Column:
    """Status of a page from what became of it."""
    return F.when(~allowed, "robots").when(~fetched, "fetch_fail").when(~parsed, "parse_fail").otherwise("ok")


def video_status(transcript, kind) -> F.Column:
    return F.when(F.coalesce(transcript, F.lit("")) != "", "ok").when(kind == "rate_limited", "rate_limited").otherwise("no_transcript")


def top_channels(hits: DataFrame, k: int = 15) -> DataFrame:
    """The k channels in most hits, ties by first appearance; hits: (channel, seq)."""
    return hits.where("channel is not null").groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(k)


def ordered_distinct(values: DataFrame) -> DataFrame:
    """(value, pos): distinct values with the place of their first appearance; values: (value, seq)."""
    return values.groupBy("value").agg(F.min("seq").alias("pos"))


def reachable(edges: DataFrame, roots: DataFrame, child: str = ".*") -> DataFrame:
    """(url): maps reached from ``roots`` over edges (parent, url) whose url matches ``child``; breadth first, each once."""
    seen = materialize(roots.select("url").distinct(), "seen")
    front = seen
    good = edges.where(F.col("url").rlike(child))
    while True:
        nxt = good.join(front.select(F.col("url").alias("parent")), "parent", "left_semi").select("url").distinct().join(seen, "url", "left_anti")
        nxt = materialize(nxt, "front")
        if nxt.isEmpty():
            return seen
        seen, front = materialize(seen.unionByName(nxt), "seen"), nxt


def stream_new(spark: SparkSession, source: str, schema, key: str, sink: str, checkpoint: str) -> int:
    """Append rows of files that came since the last run, one per key that the sink doesn't have; returns how many.

    Each micro-batch is written to a folder of its own number, which a repeat after a crash overwrites: no row is repeated
    and none lost. The keys seen so far are those in the sink, so no state grows besides it."""
    added = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal added
        new = batch.dropDuplicates([key])
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(sink)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            seen = spark.read.schema(batch.schema.add("batch", LongType())).parquet(sink).where(F.col("batch") != number)
            new = new.join(seen.select(key), key, "left_anti")
        out = f"{sink}/batch={number}"
        new.write.mode("overwrite").parquet(out)
        added += spark.read.schema(batch.schema).parquet(out).count()

    rows = spark.readStream.schema(schema).parquet(source)
    q = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return added


def windowed_counts(events: DataFrame, minutes: int = 60, late: str = "10 minutes") -> DataFrame:
    """Events per window and type, with a watermark; works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
