"""Near-duplicate records: an exact set-similarity join by vertical partitioning of the global word order.

Records are sets of distinct words; copies (equal sets) are joined as one class first. Words are put in one global order,
rarest first, and the order is cut into fragments. Fragment 0 holds the rare words (in at most ``RARE`` classes), the
others share the frequent ones; a record is its vertical pieces, one per fragment.

Candidates. Let r be a record's number of rare words and c of frequent ones (n = r + c), and t the threshold: a pair with
Jaccard >= t shares o >= t / (1 + t) * (n1 + n2) words. Either the pair shares a rare word, and meets in fragment 0, whose
posting lists are short. Or all shared words are frequent; then the frequent words in which the two differ are at most
delta = (1 - t) / (1 + t) * (n1 + n2) - r1 - r2, and of any more than delta pieces into which the frequent words are cut,
one piece is the same on both sides. The number of pieces is a level (LEVELS) above the delta of two records as large as
the larger one; the larger record meets the smaller ones there at equal pieces, and a smaller one shows its pieces at
every level that a larger partner can have (o <= c bounds its size). As delta depends on r, records with few rare words
(below the ``LOW`` quantile) are met separately, so that they don't make the pieces of all others short.

Filter. Each record carries its words' parities in 128 bits; the bits in which two records differ are at most the words
in which they differ, and those are at most n1 + n2 - 2o. This runs inside the join, so only close pairs leave it.

Count. The partial overlap of each surviving pair is counted in each fragment separately and summed per pair.
Nothing is sampled or capped: every pair at or above the threshold is found and written out, whatever the data. Classes
of equal sets are expanded block by block; their pairs grow with the square of their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.llm.components import components
from recipeframe.runtime import join_hot, materialize, member_pairs, scratch

RARE, FRAGMENTS, LOW, FREQUENT = 64, 5, 0.1, 1_000_000
LEVELS = [*range(1, 7), *(round(1.25**k) + 3 for k in range(6, 60))]  # numbers of pieces


def word_sets(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, words): distinct lower-case words over all fields and rows of a key; null is empty. Null keys are dropped."""
    kinds = dict(records.dtypes)
    parts = [F.coalesce(F.array_join(F.col(f), " "), F.lit("")) if kinds[f].startswith("array") else F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    text = F.lower(F.concat_ws(" ", *parts))
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), 0))
    one = records.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), words.alias("words"))
    # repeats of a key are one record: the row with the greatest words, so that the choice doesn't depend on order
    return one.groupBy("key").agg(F.max(F.sort_array("words")).alias("words"))


def classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls, n, words) of distinct word sets, and members (key, cls, size). The class is its least key; from here on a word
    is its 64-bit hash (two different words of a pair of records are taken for one with a chance of about 1e-16)."""
    hashed = sets.select("key", F.expr("transform(words, w -> xxhash64(w))").alias("words"), F.sha2(F.array_join("words", " "), 256).alias("_h"))
    keyed = materialize(hashed, "sets")
    group = materialize(keyed.groupBy("_h").agg(F.min("key").alias("cls"), F.count(F.lit(1)).alias("size")), "classes")
    members = join_hot(keyed.select("key", "_h", "words"), group, "_h", "size")
    bare = F.size("words") == 0  # records without words are nobody's copies
    members = members.withColumn("cls", F.when(bare, F.col("key")).otherwise(F.col("cls"))).withColumn("size", F.when(bare, F.lit(1)).otherwise(F.col("size")))
    members = materialize(members.select("key", "cls", "size", F.when(F.col("key") == F.col("cls"), F.col("words")).alias("words")), "members")
    reps = members.where("key = cls and size(words) > 0").select("cls", F.size("words").alias("n"), "words")
    return reps, members.select("key", "cls", "size")


def _bits(words: str, half: int) -> str:
    """SQL: 64 parity bits of an array of hashed words."""
    return f"aggregate({words}, 0L, (a, w) -> a ^ if((w & 64) = {64 * half}, shiftleft(1L, cast(w & 63 as int)), 0L))"


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an array column in one array, and the length of each row."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _listed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _pieces(batches: Iterator[pa.RecordBatch], t: float, least: int, usual: int, larger: bool) -> Iterator[pa.RecordBatch]:
    """Keys of the pieces of each record's frequent words: as the larger of a pair at one level, or as the smaller at every
    level that a larger partner can have; for each combination of partners with few (fewer than ``usual``) rare words."""
    coef, span, levels = (1 - t) / (1 + t), (1 + t) / t, np.array(LEVELS)

    def level(size: np.ndarray, rare: int) -> np.ndarray:
        return np.searchsorted(levels, coef * 2 * size - rare + 1e-9, side="right")  # the first level above

    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            b = whole.slice(at, 2000)
            n, r = (b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("n", "r"))
            words, c = _lists(b.column("h"))
            words, c = words.astype(np.int64).view(np.uint64), c.astype(np.int64)
            owner = np.repeat(np.arange(len(c)), c)
            most = np.floor(span * c + 1e-9) - n
            wanted = []  # (tag, first level, last level) per record; an empty range where it has no partner
            for tag, (low_x, low_y) in enumerate(((False, False), (False, True), (True, False), (True, True))):
                rx, ry = (least if low_x else usual), (least if low_y else usual)
                first = level(n, rx + ry)
                if larger:
                    x = ((r < usual) == low_x) & (np.floor(coef * 2 * n + 1e-9) - r - ry >= 0)
                    wanted.append((tag, first, np.where(x, first, first - 1)))
                else:
                    y = ((r < usual) == low_y) & (most >= n)
                    wanted.append((tag, first, np.where(y, level(most, rx + ry), first - 1)))
            who, keys = [], []
            for k, pieces in enumerate(levels):
                roles = [(tag, np.flatnonzero((lo <= k) & (k <= hi))) for tag, lo, hi in wanted]
                if not any(len(x) for _, x in roles):
                    continue
                need = np.unique(np.concatenate([x for _, x in roles]))
                place = np.full(len(c), -1)
                place[need] = np.arange(len(need))
                mine = place[owner] >= 0
                sums = np.zeros(len(need) * pieces, np.uint64)
                np.add.at(sums, place[owner[mine]] * pieces + (words[mine] % np.uint64(pieces)).astype(np.int64), words[mine])
                sums = sums.reshape(len(need), pieces)
                for tag, x in roles:
                    if len(x):
                        salt = (np.arange(pieces, dtype=np.uint64) * np.uint64(8) + np.uint64(tag)) * np.uint64(1 << 20) + np.uint64(pieces)
                        key = (sums[place[x]] ^ (salt * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
                        who.append(np.repeat(x, pieces))
                        keys.append((key ^ (key >> np.uint64(32))).ravel().view(np.int64))
            if who:
                rows = b.select(["cls", "n", "p0", "p1"]).take(pa.array(np.concatenate(who)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(keys))], ["cls", "n", "p0", "p1", "k"])


def _cut(reps: DataFrame, each: DataFrame, freq: DataFrame) -> DataFrame:
    """(cls, n, frequent, cut, rare, p0, p1): each record's words in the global order, with the fragment of each frequent
    one (they pass from one to the next where the document frequency passes RARE times a power of 8), and parities.

    Frequent words stand in more than RARE classes each. Up to FREQUENT of them are looked up in a broadcast sorted array
    (16 bytes a word); if there are more, words are joined with their frequencies instead, hot words apart."""
    common = freq.where(F.col("df") > RARE)
    kind = dict(reps.dtypes)["cls"]
    if common.count() > FREQUENT:
        pieces = join_hot(each, freq, "w", "df").groupBy("cls").agg(
            F.sort_array(F.collect_list(F.when(F.col("df") > RARE, F.struct("df", "w")))).alias("frequent"),
            F.collect_list(F.when(F.col("df") <= RARE, F.col("w"))).alias("rare"),
        )
        cut = f"transform(frequent, x -> least({FRAGMENTS - 1}, 1 + cast(floor(log(8, x.df / {RARE}) + 1e-9) as int)))"
        d = pieces.select("cls", (F.size("rare") + F.size("frequent")).alias("n"), F.expr("frequent.w").alias("frequent"), F.expr(cut).alias("cut"), "rare")
        return d.withColumns({"p0": F.expr(_bits("concat(rare, frequent)", 0)), "p1": F.expr(_bits("concat(rare, frequent)", 1))})
    rows = common.orderBy("w").toPandas()
    b = reps.sparkSession.sparkContext.broadcast((rows["w"].to_numpy(np.int64), rows["df"].to_numpy(np.int64)))
    last, rare_to = FRAGMENTS - 1, RARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, dfs = b.value
        for batch in batches:
            if not batch.num_rows:
                continue
            w, sizes = _lists(batch.column("words"))
            w, rows_ = w.astype(np.int64), len(sizes)
            owner = np.repeat(np.arange(rows_), sizes)
            at = np.minimum(np.searchsorted(known, w), max(0, len(known) - 1))
            often = known[at] == w if len(known) else np.zeros(len(w), bool)
            bit = np.left_shift(np.int64(1), w & 63)
            starts = np.cumsum(sizes) - sizes
            halves = [np.bitwise_xor.reduceat(np.where((w & 64) == 64 * k, bit, 0), starts) for k in (0, 1)]
            f, fo = w[often], owner[often]
            df = dfs[at[often]] if len(known) else f
            order = np.lexsort((f, df, fo))
            f, fo, df = f[order], fo[order], df[order]
            cut = np.minimum(last, 1 + np.floor(np.log(df / rare_to) / np.log(8) + 1e-9)).astype(np.int32)
            many = np.bincount(fo, minlength=rows_)
            columns = [batch.column("cls"), pa.array(sizes.astype(np.int32)), _listed(f, many), _listed(cut, many), _listed(w[~often], sizes - many), pa.array(halves[0]), pa.array(halves[1])]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "n", "frequent", "cut", "rare", "p0", "p1"])

    return reps.select("cls", "words").mapInArrow(run, f"cls {kind}, n int, frequent array<bigint>, cut array<int>, rare array<bigint>, p0 bigint, p1 bigint")


def pairs_of_classes(reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b, overlap, union) of class pairs a < b with Jaccard >= threshold > 0.5."""
    if not 0.5 < threshold < 1:
        raise ValueError("threshold must lie between 0.5 and 1")
    t = threshold
    each = reps.select("cls", F.explode("words").alias("w"))
    freq = each.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    freq = materialize(freq, "df")
    d = materialize(_cut(reps, each, freq), "pieces")
    least = d.agg(F.min(F.size("rare")).alias("m")).first()["m"] or 0
    close = lambda x, y: (
        f"least({x}.n, {y}.n) >= ceil({t} * greatest({x}.n, {y}.n) - 1e-9)"
        f" and bit_count({x}.p0 ^ {y}.p0) + bit_count({x}.p1 ^ {y}.p1) <= {x}.n + {y}.n - 2 * ceil({t / (1 + t)!r} * ({x}.n + {y}.n) - 1e-9)"
    )
    # fragment 0: pairs that share a rare word
    shared = freq.where(f"df between 2 and {RARE}").select("w")
    r = d.select("cls", "n", "p0", "p1", F.explode("rare").alias("w")).join(shared, "w", "left_semi")
    met = r.alias("x").join(r.alias("y"), F.expr(f"x.w = y.w and x.cls < y.cls and {close('x', 'y')}")).select(F.expr("x.cls").alias("a"), F.expr("y.cls").alias("b"))
    # the other fragments: pairs that share frequent words only, met at equal pieces
    usual = d.agg(F.percentile_approx(F.size("rare"), LOW)).first()[0] or 0
    h = d.select("cls", "n", "p0", "p1", F.size("rare").alias("r"), F.col("frequent").alias("h"))
    shape = f"cls {dict(d.dtypes)['cls']}, n int, p0 bigint, p1 bigint, k bigint"
    probe, index = (h.mapInArrow(partial(_pieces, t=t, least=int(least), usual=int(usual), larger=x), shape) for x in (True, False))
    met2 = probe.alias("x").join(index.alias("y"), F.expr(f"x.k = y.k and (x.n > y.n or (x.n = y.n and x.cls > y.cls)) and {close('x', 'y')}"))
    met2 = met2.select(F.expr("least(x.cls, y.cls)").alias("a"), F.expr("greatest(x.cls, y.cls)").alias("b"))
    candidates = materialize(met.unionByName(met2).distinct(), "candidates")
    # count the overlap of each fragment by itself, then sum
    frag = f"transform(sequence(0, {FRAGMENTS - 1}), i -> struct(i as fragment, if(i = 0, rare, filter(frequent, (w, j) -> cut[j] = i)) as words))"
    needed = candidates.select(F.col("a").alias("cls")).unionByName(candidates.select(F.col("b").alias("cls"))).distinct()
    vertical = materialize(d.join(needed, "cls", "left_semi").select("cls", "n", F.explode(F.expr(frag)).alias("v")).select("cls", "n", "v.*").where("size(words) > 0"), "vertical")
    x = candidates.join(vertical.select(F.col("cls").alias("a"), F.col("n").alias("na"), "fragment", F.col("words").alias("wa")), "a")
    y = x.join(vertical.select(F.col("cls").alias("b"), F.col("n").alias("nb"), "fragment", F.col("words").alias("wb")), ["b", "fragment"])
    counted = y.select("a", "b", "na", "nb", F.size(F.array_intersect("wa", "wb")).alias("o"))
    total = counted.groupBy("a", "b").agg(F.sum("o").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    total = total.withColumn("union", F.col("na") + F.col("nb") - F.col("overlap"))
    return materialize(total.where(F.col("overlap") >= F.lit(t) * F.col("union") - 1e-9).select("a", "b", "overlap", "union"), "links")


def similar(records: DataFrame, key: str, fields: list[str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """links (a, b, overlap, union) between classes, and members (key, cls, size).

    Null fields are empty, null keys are dropped, repeats of a key are one record, columns other than key and fields are
    ignored. Records without words (also null or blank ones) link to none; an empty table gives empty results."""
    with scratch() as keep:
        reps, members = classes(word_sets(records, key, fields))
        return keep(pairs_of_classes(reps, threshold)), keep(materialize(members, "members"))


def pairs(links: DataFrame, members: DataFrame, expand: int | None = None) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs between the members of linked classes and within classes.

    With ``expand`` a short form that is not all pairs: of classes with more than ``expand`` records (equal word sets, not
    always equal texts) only the least one stands for the others outside, and pairs with each of them."""
    placed = members.select(F.col("cls").alias("group"), F.col("key").alias("item"), "size")
    within = members.where("key = cls and size > 1").select(F.col("cls").alias("a"), F.col("cls").alias("b"), "size")
    star = None
    if expand is not None:
        placed, within = placed.where((F.col("size") <= expand) | (F.col("group") == F.col("item"))), within.where(F.col("size") <= expand)
        star = members.where((F.col("size") > expand) & (F.col("key") != F.col("cls"))).select(F.col("cls").alias("x"), F.col("key").alias("y"))
    both = member_pairs(links.select("a", "b").unionByName(within.select("a", "b")), placed.select("group", "item"))
    if star is not None:
        both = both.unionByName(star)
    return both.select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))


def groups(links: DataFrame, members: DataFrame) -> DataFrame:
    """(key, cls, n_copies, n_links, group): one row per record; group is the least class reachable over links."""
    comp = components(links.select("a", "b"))
    degree = links.select(F.col("a").alias("cls")).unionByName(links.select(F.col("b").alias("cls"))).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    info = comp.withColumnRenamed("node", "cls").join(degree, "cls")
    out = members.join(info, "cls", "left")
    return out.select("key", "cls", F.col("size").alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "cls").alias("group"))
