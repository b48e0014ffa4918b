"""The stages over a corpus on disk: ``python -m recipeframe.plans.pipeline STAGE IN OUT [more inputs]``.

Each stage reads one Parquet directory and writes a new one; nothing is overwritten in place. With ``--swap``, OUT takes
the place of IN once it is complete, and IN is kept beside it as ``IN.before``. The crawls append:

    crawl  URLS OUT LOG LANG [package:fetch] [limit]               -- URLS (url); rows to OUT, the resume log to LOG
    videos IDS OUT LOG LANG package:metadata [package:fetch] [limit] -- IDS (video_id, pos)
"""

from __future__ import annotations

import importlib
import sys

from pyspark.sql import DataFrame, SparkSession

from recipeframe.operators import confidence, dedup, lint, quality
from recipeframe.plans import reports
from recipeframe.runtime import clear, ship
from recipeframe.sources import crawl, readers


def ingest(spark: SparkSession, recipes_csv: str, interactions_csv: str) -> DataFrame:
    raw = readers.contract(readers.read_csv(spark, recipes_csv, readers.RAW_RECIPES))
    return quality.with_ratings(raw, readers.read_csv(spark, interactions_csv, readers.RAW_INTERACTIONS))


def groups(df: DataFrame) -> DataFrame:
    """Adds dup_group and family_id (the leader's id)."""
    return dedup.dup_group(df).join(dedup.family(df).withColumnRenamed("leader_id", "family_id"), "id")


STAGES = {"lint": lint.lint, "dedup": groups, "quality": quality.score}


def run(spark: SparkSession, stage: str, src: str, out: str, *more: str) -> None:
    if stage == "ingest":
        ingest(spark, src, more[0]).write.parquet(out)
    elif stage == "xiachufang":
        readers.dish_rows(readers.read_json_lines(spark, src)).write.option("compression", "zstd").parquet(out)
    elif stage in STAGES:
        STAGES[stage](spark.read.parquet(src)).write.parquet(out)
    elif stage == "confidence":
        meta, inter = (readers.read_csv(spark, p, ddl) for p, ddl in zip(more, (readers.RAW_RECIPES, readers.RAW_INTERACTIONS)))
        confidence.confidence(spark.read.parquet(src), meta, inter).write.parquet(out)
    elif stage == "crawl":
        log, lang, *rest = more
        rows, done = crawl.crawl(spark.read.parquet(src), crawl.read_log(spark, log), named(rest[0]) if rest else crawl.http_fetch, lang, limit=int(rest[1]) if len(rest) > 1 else None)
        crawl.append(rows, out, done, log)
    elif stage == "videos":
        log, lang, metadata, *rest = more
        rows, done = crawl.crawl_videos(spark.read.parquet(src), crawl.read_log(spark, log), named(metadata), named(rest[0]) if rest else crawl.http_fetch, lang, limit=int(rest[1]) if len(rest) > 1 else None)
        crawl.append(rows, out, done, log)
    elif stage == "report":
        df = spark.read.parquet(src)
        write(out, reports.corpus_report(df, df.selectExpr("id", "family_id as leader_id")))
    elif stage == "lint_audit":
        write(out, reports.audit_report(spark.read.parquet(src)))
    elif stage == "confidence_report":
        write(out, reports.confidence_report(spark.read.parquet(src)))
    else:
        raise SystemExit(f"no stage {stage}")


def named(name: str):
    """A function given as package.module:name."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def swap(spark: SparkSession, src: str, out: str) -> None:
    """Put the complete table at ``out`` in the place of ``src``, which is kept as ``src.before``."""
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at(f"{out}/_SUCCESS")):
        raise FileNotFoundError(f"{out} isn't complete")
    if fs.exists(at(f"{src}.before")):
        raise FileExistsError(f"{src}.before is there already")
    fs.rename(at(src), at(f"{src}.before"))
    fs.rename(at(out), at(src))


def write(path: str, text: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


if __name__ == "__main__":
    session = SparkSession.builder.appName("recipeframe").getOrCreate()
    ship(session)
    arguments = [a for a in sys.argv[1:] if a != "--swap"]
    run(session, *arguments)
    clear(session)
    if "--swap" in sys.argv:
        swap(session, *arguments[1:3])
