"""Markdown reports; each collects a few aggregated rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.operators import confidence, dedup, lint, quality


def markdown(df: DataFrame, digits: int = 3) -> str:
    """A small table as markdown; floats rounded, nulls empty."""
    show = lambda v: "" if v is None else f"{v:.{digits}f}" if isinstance(v, float) else str(v)
    rows = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(rows + ["| " + " | ".join(map(show, r)) + " |" for r in df.collect()])


def corpus_report(df: DataFrame, families: DataFrame, on: date | None = None) -> str:
    """Lint, duplicates, families and quality of a scored corpus (lint_flags, lint_pass, dup_group, q_score)."""
    s = df.agg(F.count(F.lit(1)).alias("n"), F.sum("rating_n").alias("ratings"), F.count_if(F.col("rating_n") > 0).alias("rated"), F.avg(F.col("lint_pass").cast("int")).alias("ok"), F.avg((F.col("dup_group") >= 0).cast("int")).alias("dup")).first()
    names = lambda order: "; ".join(r["title"] for r in df.where("q_score is not null").orderBy(order, "id").limit(3).collect())
    parts = [
        f"# Corpus report, {on or date.today()}",
        f"{s['n']} recipes, {s['ratings'] or 0} ratings, {s['rated']} rated recipes",
        "## Lint",
        f"pass rate {100 * (s['ok'] or 0):.1f} %",
        markdown(lint.histogram(df).orderBy(F.desc("n"), "flag")),
        "## Duplicates",
        f"exact duplicates {100 * (s['dup'] or 0):.1f} %, {families.select('leader_id').distinct().count()} families",
        markdown(dedup.family_top(df, families)),
        "## Quality",
        markdown(quality.quantiles(df), 6),
        "top: " + names(F.desc("q_score")),
        "bottom: " + names(F.asc("q_score")),
    ]
    return "\n\n".join(parts) + "\n"


def audit_report(linted: DataFrame) -> str:
    return "# Lint flags against ratings\n\nA ratio below 1 means that recipes with the flag are rated less than those without any.\n\n" + markdown(lint.audit(linted).orderBy(F.col("flag") != lint.BASELINE, "flag")) + "\n"


def confidence_report(df: DataFrame) -> str:
    s = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("copy_group").alias("sets"), F.sum("remake_n").alias("remakes"), F.count_if("is_contest").alias("contest")).first()
    many = confidence.copy_reps(df).where("n_copies > 1").count()
    best = lambda tier, by, k: "; ".join(r["title"] for r in df.where(F.col("pos_tier") == tier).orderBy(F.desc(by), "id").limit(k).collect())
    parts = [
        "# Confidence tiers",
        f"{s['n']} recipes, {s['sets']} ingredient sets, {many} of them more than once, {s['remakes'] or 0} reviews of a remake, {s['contest']} contest entries",
        markdown(confidence.tier_report(df).orderBy("pos_tier")),
        "## Largest groups of copies",
        markdown(confidence.copy_groups_top(df)),
        "## Tier 3",
        best(3, "pooled_remake_n", 8),
        "## Tier 1 with most ratings",
        best(1, "rating_n", 5),
    ]
    return "\n\n".join(parts) + "\n"
