"""What every operator needs from the session: tables, written intermediate results, hot keys, bounded collection."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def local_session(name: str = "recipeframe", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only a local session may go without it."""
    sc = spark.sparkContext
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            set_to = jdir.get()
    if not set_to:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        set_to = tempfile.mkdtemp(prefix="recipeframe-")
        atexit.register(shutil.rmtree, set_to, ignore_errors=True)
        sc.setCheckpointDir(set_to)
    return set_to.rstrip("/")


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives the loss of executors, and gives the
    planner true sizes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._recipeframe_path = path
    for tables in _open[-1:]:
        tables.append(out)
    return out


_open: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end what ``materialize`` wrote inside, but for the tables given to ``keep``, the function it yields:
    those must be results of ``materialize`` and are handed to the scratch outside, if there is one."""
    tables: list[DataFrame] = []
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _open.append(tables)
    try:
        yield keep
    finally:
        _open.pop()
        for t in tables:
            if not any(t is k for k in kept):
                release(t)
        for outer in _open[-1:]:
            outer.extend(kept)


def release(df: DataFrame) -> None:
    """Delete a table written by ``materialize`` that nothing reads any more."""
    path = getattr(df, "_recipeframe_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bounded_collect(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size is bounded by its meaning; fails, rather than truncates, beyond the bound."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


HOT_SHARE, HOT_ROWS = 1e-3, 10_000


def join_hot(facts: DataFrame, dims: DataFrame, key: str, n: str) -> DataFrame:
    """``facts`` inner join ``dims`` (one row per key, ``n`` = rows of that key in facts), whatever the skew.

    Keys that hold more than HOT_SHARE of all rows (and more than HOT_ROWS) are at most 1 / HOT_SHARE in number, so their
    rows of ``dims`` are broadcast with that proven bound and their facts never move; the rest takes an ordinary join."""
    seen = dims.agg(F.sum(n).alias("t"), F.max(n).alias("m")).first()
    limit = max(HOT_ROWS, (seen["t"] or 0) * HOT_SHARE)
    if (seen["m"] or 0) <= limit:
        return facts.join(dims, key)
    hot, cold = dims.where(F.col(n) > limit), dims.where(F.col(n) <= limit)
    left = facts.join(F.broadcast(hot), key)
    right = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return left.unionByName(right)


def member_pairs(links: DataFrame, members: DataFrame, block: int = 500) -> DataFrame:
    """(x, y), x <> y unless an item is in both groups: all pairs of an item of group ``a`` and an item of group ``b``, for
    each row (a, b) of ``links``; for a = b the pairs x < y within the group. ``members``: (group, item), each row once.
    Other columns of ``links`` go with its pairs.

    Groups are cut into blocks of about ``block`` items by hash and met block by block, so no key of a join has more than
    that many members, whatever the size of a group."""
    size = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(size.where(F.col("n") > block).select("group", "n", F.ceil(F.col("n") / block).cast("int").alias("parts")), "large")
    cut = join_hot(members, large, "group", "n").select("group", "item", F.expr("cast(pmod(xxhash64(item), parts) as int)").alias("part"))
    whole = members.join(large.select("group"), "group", "left_anti").select("group", "item", F.lit(0).alias("part"))
    placed = materialize(cut.unionByName(whole), "placed")
    parts = large.select("group", "parts")
    more = [c for c in links.columns if c not in ("a", "b")]
    met = links.join(parts.select(F.col("group").alias("a"), F.col("parts").alias("na")), "a", "left")
    met = met.join(parts.select(F.col("group").alias("b"), F.col("parts").alias("nb")), "b", "left")
    met = met.withColumn("pa", F.explode(F.expr("sequence(0, coalesce(na, 1) - 1)"))).withColumn("pb", F.explode(F.expr("sequence(0, coalesce(nb, 1) - 1)")))
    met = met.where("a <> b or pa <= pb").select("a", "b", "pa", "pb", *more)
    x = met.join(placed.select(F.col("group").alias("a"), F.col("part").alias("pa"), F.col("item").alias("x")), ["a", "pa"])
    y = x.join(placed.select(F.col("group").alias("b"), F.col("part").alias("pb"), F.col("item").alias("y")), ["b", "pb"])
    return y.where("a <> b or pa <> pb or x < y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), *more)


def range_bucket(df: DataFrame, col: str, rows: int = 1_000_000, most: int = 512) -> Column:
    """A column that numbers ranges of ``col`` in order, of about ``rows`` rows each (at most ``most`` ranges); nulls are in
    range 0. The bounds are quantiles of the values, so sparse or uneven values fill the ranges alike."""
    parts = min(most, 1 + df.count() // rows)
    if parts == 1:
        return F.lit(0)
    at = [i / parts for i in range(1, parts)]
    bounds = sorted(set(df.agg(F.percentile_approx(col, at, 20_000).alias("b")).first()["b"] or []))

    def place(lo: int, hi: int) -> Column:  # a balanced tree of comparisons
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(col) > F.lit(bounds[mid]), place(mid + 1, hi)).otherwise(place(lo, mid))

    return place(0, len(bounds))


def prefix_sum(df: DataFrame, group: list[str], order: list, bucket: str, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` before each row within ``group``, in the order (bucket, *order).

    ``bucket`` is a column of small bounded range, monotone in the wanted order. Bucket totals are a table of bounded
    size and are summed in one window; the rows themselves are only ordered within (group, bucket)."""
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_t"))
    before = totals.withColumn("_pre", F.coalesce(F.sum("_t").over(Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    w = Window.partitionBy(*group, bucket).orderBy(*order)
    inner = df.withColumn("_in", F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(before, [*group, bucket]).withColumn(out, F.col("_in") + F.col("_pre")).drop("_in", "_pre")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as functions that run there import it: a zip in the shared folder. Not needed where
    the package is installed on every machine."""
    root, data = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-code/recipeframe.zip")
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(str(at.toString()))


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once no result is read any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
