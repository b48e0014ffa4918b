"""Capping records per dominant contributor: quality-weighted reservoir sampling without replacement.

Every record gets an exponential random key scaled by its score: the rate of the exponential is weight = exp(score /
temperature), and the cap-size smallest arrivals stay. Taking logs, that is the cap-size largest of
score / temperature + g with Gumbel g = -ln(-ln u), u hashed from the record's key and the seed; multiplied by the
temperature it is score + temperature * g, which also has a meaning at temperature 0: the strictly best scores stay.
Null scores are last at every temperature, ties go to the smaller key as text.

The reservoir is kept per (contributor, salt) first and merged per contributor, so a contributor with a third of all
rows is never in one task; at most salts * cap rows of a contributor meet.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


_SIMPLE = r"^[\x00-\x7f\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}]*$"  # nothing to fold but case and space


def _fold(ch: str) -> str:
    kind, _, rest = unicodedata.decomposition(ch).partition(" ")
    return "".join(chr(int(x, 16)) for x in rest.split()) if kind in ("<wide>", "<narrow>") else ch


def _keys(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
    memo: dict[str, str | None] = {}

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        if s not in memo:
            if len(memo) > 200_000:
                memo.clear()
            t = unicodedata.normalize("NFC", "".join(_fold(c) for c in s))
            memo[s] = "".join(c for c in t.lower() if not c.isspace() and unicodedata.category(c) != "Cf") or None
        return memo[s]

    for s in names:
        yield s.map(one, na_action="ignore")


def contributor_key(name: Column) -> Column:
    """One form of a name whatever its case, spacing and character width; null where nothing is left."""
    simple = name.rlike(_SIMPLE)
    short = F.nullif(F.regexp_replace(F.lower(name), r"[\s\x1c-\x1f]+", ""), F.lit(""))
    return F.when(simple, short).otherwise(F.pandas_udf(_keys, "string")(F.when(~simple, name)))


def latest_scores(scores: DataFrame) -> DataFrame:
    """(record_table, record_key, q_score): the score of the latest scored_at, null scores included; among equal times
    the higher score."""
    last = scores.where("record_key is not null").groupBy("record_table", "record_key").agg(F.max(F.struct("scored_at", "q_score")).alias("_l"))
    return last.select("record_table", "record_key", F.col("_l.q_score").alias("q_score"))


def arrival(score: Column, key: Column, temperature: float, seed: int) -> Column:
    if temperature == 0:
        return score
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"-{seed}"))), 1, 15), 16, 10).cast("bigint")  # as SQL elsewhere can draw it
    u = (F.pmod(h, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return score - F.lit(float(temperature)) * F.log(-F.log(u))


def dropped(records: DataFrame, cap: int, max_share: float | None = None, temperature: float = 0.0, seed: int = 0, salts: int = 256) -> DataFrame:
    """(record_table, record_key) beyond the cap of their contributor.

    records: (record_table, record_key, contributor, q_score), one row per record (``one_per_record`` joins repeats);
    other columns are ignored. A null contributor is never capped; an empty table gives an empty result.
    ``max_share`` also caps a contributor to that share of its table's records (at least 1)."""
    records = records.select("record_table", "record_key", "contributor", "q_score")
    r = records.where("contributor is not null").withColumn("_a", arrival(F.col("q_score"), F.col("record_key"), temperature, seed))
    limit = F.lit(cap)
    if max_share is not None:
        n = records.groupBy("record_table").agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(max_share))).alias("_most"))
        r = r.join(F.broadcast(n), "record_table")  # one row per table
        limit = F.least(F.lit(cap), F.col("_most"))
    else:
        r = r.withColumn("_most", limit)
    order = [F.col("_a").desc_nulls_last(), F.col("record_key").asc()]
    r = r.withColumn("_salt", F.pmod(F.xxhash64("record_key"), F.lit(salts)))
    r = r.withColumn("_r1", F.row_number().over(Window.partitionBy("record_table", "contributor", "_salt").orderBy(*order)))
    r = r.withColumn("_out", F.col("_r1") > limit)
    # those already out stay in their salt; the others meet
    r = r.withColumn("_part", F.when(F.col("_out"), F.col("_salt")).otherwise(F.lit(-1)))
    r = r.withColumn("_r2", F.row_number().over(Window.partitionBy("record_table", "contributor", "_part").orderBy(*order)))
    return r.where(F.col("_out") | (F.col("_r2") > limit)).select("record_table", "record_key")


def one_per_record(df: DataFrame, table: str, key: str, contributor: str, numeric: bool = False) -> DataFrame:
    """(record_table, record_key, contributor) of a table: repeats of a key are one record, whose contributor is the
    smallest normalised one of its rows, nulls aside. Null keys are no records; a numeric 0 is no contributor."""
    c = F.when(F.col(contributor) != 0, F.col(contributor).cast("string")) if numeric else contributor_key(F.col(contributor))
    rows = df.where(F.col(key).isNotNull()).select(F.lit(table).alias("record_table"), F.col(key).cast("string").alias("record_key"), c.alias("contributor"))
    return rows.groupBy("record_table", "record_key").agg(F.min("contributor").alias("contributor"))
