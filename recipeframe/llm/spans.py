"""Long exact spans shared between records: sharded FM-indexes, fed only with text that can be shared.

1. Copies (equal texts) are joined as one class; its least document stands for it.
2. Anchors. Of each window of ``W`` k-grams (k = ``K``) of a text the one with the least hash is an anchor (winnowing), so
   equal stretches have equal anchors. A key is the exact text from an anchor to the first anchor at least ``D`` further:
   two texts with a common stretch of ``least`` characters have a common key in it, as least >= D + 3 W + K.
3. Keys that only one document has are dropped by an aggregation over hashes; so are keys whose every occurrence follows
   one and the same key that has as many occurrences (they say nothing new), but for one in ``RUN`` of them by hash. What is
   left marks windows of text: from a kept key over the run of dropped ones after it. A run has ``RUN`` keys on average
   and is cut at the same keys in all documents, so a window is short however long the stretch.
4. Windows go to shards by key, the keys along a running sum of characters. A shard's task builds an FM-index over its
   windows (fmindex.py) and streams the windows through it: matching statistics by backward search over the wavelet
   matrix give each window's intervals of at least ``least`` characters that another document has, and the sets of
   documents that share a stretch. Keys whose windows have more than ``HOT_CHARS`` characters never go to one task: there
   each window's ``least``-grams are spread by hash over all tasks and joined there, which gives the same stretches and
   the same sets of documents.
5. All pairs are written out within such a set, and between all copies of both sides, large sets block by block.

Characters are compared as stored. Null texts and texts shorter than ``least`` share nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.llm.fmindex import FMIndex
from recipeframe.runtime import join_hot, materialize, member_pairs, prefix_sum, scratch

K, W, RUN = 12, 48, 32
SHARD_CHARS, HOT_CHARS, LISTED = 500_000, 1_000_000, 64
CHUNK, BUCKETS = 400_000, 1024
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


class Rolling:
    """Hashes of any stretch of an array of code points, equal for equal stretches, by prefix sums modulo 2^64."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        power = np.full(n + 1, _ODD, np.uint64)
        power[0] = 1
        self.down = np.full(n + 1, _INVERSE, np.uint64)
        self.down[0] = 1
        power, self.down = np.cumprod(power), np.cumprod(self.down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(points.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])

    def __call__(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        return _mix((self.sums[z] - self.sums[a]) * self.down[a] + (z - a).astype(np.uint64))


def anchors(points: np.ndarray, starts: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the anchors of texts that lie one after another in ``points``."""
    n = len(points) - k + 1
    if n < w:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    v = (Rolling(points)(at, at + k) >> np.uint64(28) << np.uint64(28)) | (np.uint64(0xFFFFFFF) - at.astype(np.uint64))
    low, size = v, 1
    while size * 2 <= w:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    if size < w:
        low = np.minimum(low[: n - w + 1], low[w - size : n - size + 1])
    ends = np.repeat(starts[1:], np.diff(starts))[: len(low)]
    inside = at[: len(low)] + w + k - 1 <= ends
    return np.unique((np.uint64(0xFFFFFFF) - (low[inside] & np.uint64(0xFFFFFFF))).astype(np.int64))


def keys_of(texts: list[str], k: int, w: int, d: int) -> tuple[np.ndarray, ...]:
    """(text, position, length, key, key before or 0) of every key of every text."""
    points = np.concatenate([_points(t) for t in texts])
    starts = np.cumsum([0] + [len(t) for t in texts])
    a = anchors(points, starts, k, w)
    which = np.searchsorted(starts, a, side="right") - 1
    j = np.searchsorted(a, a + d)
    ok = j < len(a)
    ok[ok] = which[j[ok]] == which[ok]
    a0, t0, z = a[ok], which[ok], a[j[ok]] + k
    h = Rolling(points)(a0, z).view(np.int64)
    before = np.zeros(len(h), np.int64)
    if len(h):
        before[1:] = np.where(t0[1:] == t0[:-1], h[:-1], 0)
    return t0, a0 - starts[t0], z - a0, h, before


def distance(least: int, k: int = K, w: int = W) -> int:
    d = least - k - 3 * w
    if d < w:
        raise ValueError(f"least must be at least {k + 4 * w}")
    return d


def key_table(docs: DataFrame, least: int) -> DataFrame:
    d = distance(least)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, texts, part, n = b["doc_id"].tolist(), b["text"].tolist(), [], 0
            for i, t in enumerate(texts):
                part.append(i)
                n += len(t)
                if n > CHUNK or i + 1 == len(texts):
                    t0, pos, size, h, before = keys_of([texts[x] for x in part], K, W, d)
                    yield pd.DataFrame({"doc_id": np.array([ids[x] for x in part], np.int64)[t0], "pos": pos.astype(np.int32), "len": size.astype(np.int32), "key": h, "before": before})
                    part, n = [], 0

    return docs.where(F.length("text") >= least).select("doc_id", "text").mapInPandas(run, "doc_id bigint, pos int, len int, key bigint, before bigint")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, n, keep) of keys that two or more documents have."""
    g = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("before").alias("b0"), F.max("before").alias("b1"))
    g = materialize(g.where("lo < hi").select("key", "n", "b0", "b1"), "shared")
    follows = g.where("b0 = b1 and b0 <> 0").select("key", F.col("b0").alias("before"), "n")
    idle = follows.join(g.select(F.col("key").alias("before"), "n"), ["before", "n"], "left_semi").select("key")
    keep = F.col("idle").isNull() | (F.pmod(F.xxhash64("key"), F.lit(RUN)) == 0)
    return materialize(g.select("key", "n").join(idle.withColumn("idle", F.lit(True)), "key", "left").select("key", "n", keep.alias("keep")), "kept")


def windows(docs: DataFrame, keys: DataFrame, shared: DataFrame, least: int, margin: int = W) -> DataFrame:
    """(key, doc_id, start, text): the text around each kept key, to the end of the run of keys that follow idly.

    Every ``least`` characters of a common stretch lie in the window of the first key in them: that begins less than W
    after them, and the window reaches ``least`` beyond the start of its last key; so margin W finds all pairs. With
    margin ``least`` a window also holds what precedes it. A key that repeats within its own window extends it."""
    occ = join_hot(keys.select("key", "doc_id", "pos", "len"), shared, "key", "n")
    per_doc = occ.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "len", "keep", "key"))).alias("occ"))
    both = docs.select("doc_id", "text").join(per_doc, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text, occ in zip(b["doc_id"], b["text"], b["occ"]):
                current = None
                for o in occ:
                    again = current and (not o["keep"] or (o["key"] == current[0] and o["pos"] <= current[2] and o["pos"] < current[1] + 16 * least))
                    if again:
                        current[2], current[3] = max(current[2], o["pos"] + o["len"]), o["pos"]
                    elif o["keep"]:
                        current = [o["key"], o["pos"], o["pos"] + o["len"], o["pos"]]
                        rows.append((doc, text, current))
            out = []
            for doc, text, (key, pos, end, last) in rows:
                s, e = max(0, pos - margin), min(len(text), max(end + 2 * W, last + least))
                out.append((key, doc, s, text[s:e]))
            yield pd.DataFrame(out, columns=["key", "doc_id", "start", "text"])

    return both.mapInPandas(run, "key bigint, doc_id bigint, start int, text string")


def shard_matches(pdf: pd.DataFrame, least: int) -> pd.DataFrame:
    """Rows of kind 0: pairs (a, b); of kind 1: stretches (a = document, start, end); of kind 2: sets of more than LISTED
    documents that share a stretch (a, start, end = the set, b = document)."""
    texts = [_points(t).astype(np.int64) for t in pdf["text"]]
    docs, offset = pdf["doc_id"].to_numpy(np.int64), pdf["start"].to_numpy(np.int64)
    if len(np.unique(docs)) < 2:
        return _rows([], np.zeros((0, 3), np.int64))
    index = FMIndex(texts, docs)
    w, p, n, row = index.matching(least)
    found, large = set(), []
    if len(w):
        for group in index.owners_of(row, least):
            if len(group) <= LISTED:
                found.update(combinations(group.tolist(), 2))
            else:
                name = np.frombuffer(hashlib.blake2b(group.tobytes(), digest_size=16).digest(), np.int64)
                low, high = name[1:].view(np.int32)
                large.append(pd.DataFrame({"kind": np.int32(2), "a": name[0], "b": group, "start": low, "end": high}))
    return pd.concat([_rows(sorted(found), _intervals(docs[w], p + offset[w], p + n + offset[w])), *large])


def _intervals(doc: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Unions of overlapping or touching intervals per document."""
    if not len(doc):
        return np.zeros((0, 3), np.int64)
    o = np.lexsort((a, doc))
    doc, a, z = doc[o], a[o], z[o]
    base = np.searchsorted(np.unique(doc), doc) * (int(z.max()) + 2)
    reach = np.maximum.accumulate(z + base)
    new = np.concatenate([[True], a[1:] + base[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([doc[first], a[first], np.maximum.reduceat(z, first)], 1)


SHARED = "kind int, a bigint, b bigint, start int, end int"


def _rows(pairs: list[tuple[int, int]], spans: np.ndarray) -> pd.DataFrame:
    n, m = len(pairs), len(spans)
    return pd.DataFrame(
        {
            "kind": np.repeat(np.array([0, 1], np.int32), [n, m]),
            "a": np.concatenate([np.array([x for x, _ in pairs], np.int64), spans[:, 0]]),
            "b": np.concatenate([np.array([y for _, y in pairs], np.int64), np.zeros(m, np.int64)]),
            "start": np.concatenate([np.zeros(n, np.int32), spans[:, 1].astype(np.int32)]),
            "end": np.concatenate([np.zeros(n, np.int32), spans[:, 2].astype(np.int32)]),
        }
    )


def hot_matches(hot: DataFrame, least: int) -> DataFrame:
    """The same rows for windows of hot keys: grams of ``least`` characters joined by two 64-bit hashes, spread over all
    tasks.

    Two documents with the same character before a gram share the gram before it, too, so a gram gives only the pairs with
    different characters before it (at the start of a window there is none, which differs from all). A group is the set of
    documents with one gram and one character before it; equal sets, by their size and 128 bits of hash, are one group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc, start, text in zip(b["doc_id"], b["start"], b["text"]):
                x = _points(text)
                if len(x) >= least:
                    at = np.arange(len(x) - least + 1)
                    h, g = Rolling(x)(at, at + least), Rolling(x[::-1].copy())(len(x) - at - least, len(x) - at)
                    before = np.concatenate([[-1], x[: len(at) - 1].astype(np.int32)]).astype(np.int32)
                    yield pd.DataFrame({"g1": h.view(np.int64), "g2": g.view(np.int64), "doc_id": doc, "pos": (at + start).astype(np.int32), "before": before})

    grams = materialize(hot.select("doc_id", "start", "text").mapInPandas(run, "g1 bigint, g2 bigint, doc_id bigint, pos int, before int"), "grams")
    common = grams.groupBy("g1", "g2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("before").alias("b0"), F.max("before").alias("b1"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    common = materialize(common.select(F.struct("g1", "g2").alias("g"), "n", F.expr("b0 <> b1 or b0 = -1").alias("opens")), "common")
    met = join_hot(grams.select(F.struct("g1", "g2").alias("g"), "doc_id", "pos", "before"), common, "g", "n")
    docs = materialize(met.where("opens").select("g", "before", "doc_id").distinct(), "opening")
    sets = docs.groupBy("g", "before").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("s1"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("s2"))
    sets = materialize(sets.withColumn("group", F.struct("n", "s1", "s2")), "sets")
    one = sets.groupBy("group").agg(F.min(F.struct("g", "before")).alias("at"), F.max("n").alias("n"))
    members = join_hot(docs.select(F.struct("g", "before").alias("at"), F.col("doc_id").alias("item")), materialize(one, "groups"), "at", "n").select("group", "item")
    a, b = (sets.select("g", F.col("before").alias(f"before_{x}"), F.col("group").alias(x)) for x in "ab")
    links = a.join(b, "g").where("before_a < before_b or (before_a = -1 and before_b = -1)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pair = member_pairs(links, materialize(members, "groupmembers")).where("x < y").distinct()
    links = pair.select(F.lit(0).alias("kind"), F.col("x").alias("a"), F.col("y").alias("b"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    spans = met.select(F.lit(1).alias("kind"), F.col("doc_id").alias("a"), F.lit(0).cast("bigint").alias("b"), F.col("pos").alias("start"), (F.col("pos") + least).alias("end"))
    return links.unionByName(spans)


def copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """representatives (doc_id, text) and members (doc_id, rep, size) of texts that occur more than once."""
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    group = keyed.groupBy("h").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).where("rep < hi")
    members = materialize(join_hot(keyed, materialize(group.select("h", "rep", "n"), "copies"), "h", "n").select("doc_id", "rep").distinct(), "members")
    size = members.groupBy("rep").agg(F.count(F.lit(1)).alias("size"))
    members = materialize(join_hot(members, materialize(size, "sizes"), "rep", "size"), "members")
    reps = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return reps.join(members.where("doc_id <> rep").select("doc_id"), "doc_id", "left_anti"), members


def shared(docs: DataFrame, least: int, whole: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw results between representatives (kind, a, b, start, end), and the members of classes of copies. Without
    ``whole`` the pairs are complete, but not the extents of their stretches.

    docs: (doc_id, text), other columns are ignored. Null ids and texts are dropped, a repeated row counts once, an empty
    table gives empty results."""
    with scratch() as keep:
        reps, members = copies(docs)
        keys = materialize(key_table(reps, least), "keys")
        common = shared_keys(keys)
        win = materialize(windows(reps, keys, common, least, least if whole else W), "windows")
        per_key = materialize(win.groupBy("key").agg(F.sum(F.length("text")).alias("chars")), "perkey")
        hot, calm = per_key.where(F.col("chars") > HOT_CHARS), per_key.where(F.col("chars") <= HOT_CHARS)
        chars = calm.agg(F.sum("chars").alias("c")).first()["c"] or 0
        size = min(SHARD_CHARS, max(SHARD_CHARS // 10, chars // docs.sparkSession.sparkContext.defaultParallelism))
        shards = int(1 + chars // size)
        order = calm.withColumn("_b", F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).withColumn("_g", F.lit(0))
        place = prefix_sum(order, ["_g"], ["key"], "_b", "chars", "before").select("key", F.floor(F.col("before") / size).cast("int").alias("shard"))

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = [b for b in batches if len(b)]  # one shard: at most size + HOT_CHARS characters
            if parts:
                yield shard_matches(pd.concat(parts, ignore_index=True), least)

        spread = win.join(place, "key").select("shard", "doc_id", "start", "text").repartitionById(shards, "shard")
        out = spread.mapInPandas(task, SHARED)
        if not hot.isEmpty():
            out = out.unionByName(hot_matches(win.join(hot, "key", "left_semi"), least))
        return keep(materialize(out, "matches")), keep(members)


def pairs(matches: DataFrame, members: DataFrame, lengths: DataFrame, least: int) -> DataFrame:
    """(doc_id_a, doc_id_b) with all copies written out; lengths: (doc_id, n) of the texts."""
    large = materialize(matches.where("kind = 2").select(F.struct("a", "start", "end").alias("group"), F.col("b").alias("item")).distinct(), "large")
    links = matches.where("kind = 0").select("a", "b")
    if not large.isEmpty():
        within = large.select(F.col("group").alias("a"), F.col("group").alias("b")).distinct()
        links = links.unionByName(member_pairs(within, large).select(F.col("x").alias("a"), F.col("y").alias("b")))
    links = materialize(links.distinct(), "links")
    copied = members.select(F.col("rep").alias("group"), F.col("doc_id").alias("item"))
    mark = members.select("rep").distinct()
    alone = links.join(mark.withColumnRenamed("rep", "a"), "a", "left_anti").join(mark.withColumnRenamed("rep", "b"), "b", "left_anti")
    linked = links.join(alone, ["a", "b"], "left_anti")
    ends = linked.select(F.col("a").alias("group")).unionByName(linked.select(F.col("b").alias("group"))).distinct()
    single = ends.join(mark.withColumnRenamed("rep", "group"), "group", "left_anti").select("group", F.col("group").alias("item"))
    long = members.join(lengths.where(F.col("n") >= least).select(F.col("doc_id").alias("rep")), "rep", "left_semi")
    within = long.select(F.col("rep").alias("a"), F.col("rep").alias("b")).distinct()
    met = member_pairs(linked.unionByName(within), copied.unionByName(single)).where("x <> y")
    return alone.unionByName(met.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b")).distinct()


def portions(docs: DataFrame, matches: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share, spans) of every document: what of it stands in some other document, too."""
    rows = matches.where("kind = 1").select(F.col("a").alias("doc_id"), "start", "end").distinct()
    joined = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("x"))
    step = "if(size(a) > 0 and a[size(a) - 1].end >= x.start, concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start, 'end', greatest(a[size(a) - 1].end, x.end)))), concat(a, array(x)))"
    spans = joined.select("doc_id", F.expr(f"aggregate(x, cast(array() as array<struct<start:int,end:int>>), (a, x) -> {step})").alias("spans"))
    n = docs.where("doc_id is not null and text is not null").groupBy("doc_id").agg(F.max(F.length("text")).alias("n_chars"))
    full = n.join(members.select("doc_id", F.lit(True).alias("copy")), "doc_id", "left").join(spans, "doc_id", "left")
    whole = (F.col("copy") & (F.col("n_chars") >= least)) | F.lit(False)
    s = F.when(whole, F.array(F.struct(F.lit(0).alias("start"), F.col("n_chars").alias("end")))).otherwise(F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")))
    out = full.withColumn("s", s).withColumn("shared_chars", F.expr("aggregate(s, 0, (t, x) -> t + x.end - x.start)"))
    return out.select("doc_id", "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0).alias("share"), F.size("s").alias("spans"))
