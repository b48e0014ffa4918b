"""Mixing sources to target weights: soft membership and projected-gradient least squares over document rates.

1. Every text's tokens are counted with a public tokenizer (its vocabulary file is a parameter).
2. A softmax classifier over hashed token counts, fitted on at most ``TRAIN_DOCS`` labelled documents per source, predicts
   each document's posterior over the sources. A document's membership is label_trust * its own source + (1 -
   label_trust) * posterior; one without a source has its posterior alone.
3. Rates r in [0, max_repeats] per document minimise the squared distance of the expected token totals per source,
   sum of r * tokens * membership, from share * budget. The gradient of a document's rate depends on its membership only,
   so documents of about equal membership (the same to two decimals) and equal cap are summed into cells first, which
   carry their exact sums of tokens * membership; a step is one distributed pass that brings back one number per source.
   Steps are scaled by each source's expected tokens, which makes the step 1 stable. The steps are then taken for each
   document with its own membership, unrounded, and the expected totals are summed over the documents.
4. Copies are drawn by systematic sampling along a running sum of rates, in strata of about equal length and in hash
   order within them, so a source's copies are within one of the sum of its rates, their tokens close to the expected
   ones, and no document is used more often than its cap.

By the statement of the problem a null source belongs to none: with ``unlabelled=False`` (the default) such documents
have cap 0 and are only reported. Labels that are there are right, so label_trust is 1 by default; below 1 the fit is
over expected totals under the classifier. The default budget is the largest total at which every source that has
documents meets its share (shares of the others are spread in proportion).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recipeframe.runtime import bounded_collect, materialize, prefix_sum, scratch

TRAIN_DOCS, LONGEST, FEATURES, SOURCES, STRATA, PARTS = 200, 20_000, 2048, 1000, 64, 256
# Fixed value: the pattern by which this byte-level BPE cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encoders: dict[int, object] = {}


def encoder(data: bytes):
    """A byte-level BPE encoder from the bytes of a rank file; one per process."""
    import tiktoken

    k = hash(data)
    if k not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        _encoders[k] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[k]


def features(tokens: list[list[int]]) -> np.ndarray:
    """Log counts of hashed tokens, of unit length."""
    x = np.zeros((len(tokens), FEATURES), np.float32)
    for row, t in zip(x, tokens):
        if t:
            np.add.at(row, (np.asarray(t, np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % FEATURES, 1)
    x = np.log1p(x)
    return x / np.maximum(1e-6, np.linalg.norm(x, axis=1, keepdims=True))


@dataclass
class Classifier:
    sources: list[str]
    weights: np.ndarray
    accuracy: float

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1) @ self.weights
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, sources: list[str], prior: np.ndarray, steps: int = 120, rate: float = 20.0, decay: float = 1e-5) -> Classifier:
    """Softmax regression by gradient descent; every tenth document is held out for the accuracy. ``prior`` (shares of
    the corpus) corrects for the sample, which has equally many documents of each source."""
    held = np.arange(len(y)) % 10 == 9
    one = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    a, t = one[~held], np.eye(len(sources), dtype=np.float32)[y[~held]]
    w = np.zeros((one.shape[1], len(sources)), np.float32)
    for _ in range(steps if len(a) else 0):
        z = a @ w
        z = np.exp(z - z.max(1, keepdims=True))
        w -= rate * (a.T @ (z / z.sum(1, keepdims=True) - t) / len(a) + decay * w)
    accuracy = float(((one[held] @ w).argmax(1) == y[held]).mean()) if held.any() else 0.0
    in_sample = np.bincount(y, minlength=len(sources)) / max(1, len(y))
    w[-1] += np.log(np.maximum(prior, 1e-9) / np.maximum(in_sample, 1e-9))
    return Classifier(sources, w, accuracy)


def classifier(docs: DataFrame, vocabulary: str) -> Classifier:
    """Fitted on the documents of each source with the least hashes among those of at most LONGEST characters: at most
    SOURCES * TRAIN_DOCS * LONGEST characters are collected."""
    labelled = docs.where("source is not null and text is not null")
    n = {r["source"]: r["count"] for r in bounded_collect(labelled.groupBy("source").count(), SOURCES, "sources")}
    few = labelled.where(F.length("text") <= LONGEST).select("source", "text", F.xxhash64("doc_id").alias("h"))
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("h", "text"))).where(F.col("k") <= TRAIN_DOCS)
    rows = sorted(few.select("h", "source", "text").collect())
    sources = sorted(n)
    with open(vocabulary, "rb") as f:
        enc = encoder(f.read())
    x = features([enc.encode_ordinary(r["text"]) for r in rows])
    y = np.array([sources.index(r["source"]) for r in rows], np.int64)
    return fit(x, y, sources, np.array([n[s] for s in sources], float) / max(1, sum(n.values())))


def measured(docs: DataFrame, model: Classifier, vocabulary: str) -> DataFrame:
    """(doc_id, source, tokens, posterior) of each document; repeats of a doc_id are one (its longest text)."""
    with open(vocabulary, "rb") as f:
        b = docs.sparkSession.sparkContext.broadcast((f.read(), model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data, m = b.value
        enc = encoder(data)
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.iloc[i : i + 1000]
                tokens = [enc.encode_ordinary(t or "") for t in part["text"]]
                p = m.posterior(features(tokens)) if m.sources else np.zeros((len(part), 0))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "source": part["source"].to_numpy(), "tokens": [len(t) for t in tokens], "posterior": list(p.astype(np.float64))})

    rows = docs.where("doc_id is not null").select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, tokens bigint, posterior array<double>")
    one = rows.groupBy("doc_id").agg(F.max(F.struct("tokens", "source", "posterior")).alias("x"))
    return materialize(one.select("doc_id", "x.source", "x.tokens", "x.posterior"), "measured")


@dataclass
class Mix:
    rates: DataFrame  # doc_id, source, tokens, rate, cap
    sources: list[str]
    targets: dict[str, float]
    caps: dict[str, int]
    budget: float
    expected: np.ndarray
    accuracy: float


def solve(docs: DataFrame, targets: DataFrame, vocabulary: str | None = None, budget: float | None = None, label_trust: float = 1.0, unlabelled: bool = False, steps: int = 60) -> Mix:
    """Rates of all documents. targets: (source, target_share, max_repeats); null and negative values count as 0.

    docs: (doc_id, text, source), other columns are ignored. Null doc_ids are dropped, repeats are one document, null
    texts have no tokens. Without documents or usable targets nothing is drawn."""
    with scratch() as keep:
        mix = _solve(docs, targets, vocabulary or default_vocabulary(), budget, label_trust, unlabelled, steps)
        keep(mix.rates)
        return mix


def _solve(docs: DataFrame, targets: DataFrame, vocabulary: str, budget: float | None, label_trust: float, unlabelled: bool, steps: int) -> Mix:
    rows = bounded_collect(targets.where("source is not null"), SOURCES, "targets")
    share = {r["source"]: max(0.0, r["target_share"] or 0.0) for r in rows}
    cap = {r["source"]: max(0, r["max_repeats"] or 0) for r in rows}
    model = classifier(docs, vocabulary)
    m = measured(docs, model, vocabulary)
    sources = model.sources
    k = len(sources)
    onehot = F.array(*[F.when(F.col("source") == s, 1.0).otherwise(0.0) for s in sources]) if k else F.expr("cast(array() as array<double>)")
    soft = F.zip_with(onehot, "posterior", lambda a, p: label_trust * a + (1 - label_trust) * p)
    member = F.when(F.col("source").isNotNull(), soft).otherwise(F.col("posterior"))
    caps = F.create_map(*[F.lit(x) for s in sources for x in (s, cap.get(s, 0))]) if k else F.create_map().cast("map<string,int>")
    most = F.coalesce(caps[F.col("source")], F.lit(0))
    if unlabelled and k:  # one that may belong to several is used as often as the likeliest of them allows
        likeliest = F.element_at(F.array(*[F.lit(s) for s in sources]), F.array_position("posterior", F.array_max("posterior")).cast("int"))
        most = F.when(F.col("source").isNotNull(), most).otherwise(F.coalesce(caps[likeliest], F.lit(0)))
    d = m.select("doc_id", "source", "tokens", member.alias("member"), most.alias("cap"))
    part = [F.sum(F.col("tokens") * F.col("member")[i]) for i in range(k)]
    near = F.transform("member", lambda x: F.round(x, 2))  # only the key of a cell
    cells = d.groupBy(near.alias("near"), "cap").agg(F.sum("tokens").alias("tokens"), F.array(*part).cast("array<double>").alias("sums"))
    mean = F.when(F.col("tokens") > 0, F.transform("sums", lambda x: x / F.col("tokens"))).otherwise(F.col("near"))
    cells = materialize(cells.select(mean.alias("member"), "cap", "tokens"), "cells")
    sums = cells.agg(*[x.alias(f"t{i}") for i, x in enumerate(part)], *[F.sum(F.col("tokens") * F.col("cap") * F.col("member")[i]).alias(f"c{i}") for i in range(k)]).first() if k else {}
    have = np.array([sums[f"t{i}"] or 0.0 for i in range(k)])
    room = np.array([sums[f"c{i}"] or 0.0 for i in range(k)])
    want = np.array([share.get(s, 0.0) for s in sources])
    usable = (want > 0) & (room > 0)
    want = np.where(usable, want, 0.0)
    want = want / want.sum() if want.sum() else want
    total = budget or (float((room[usable] / want[usable]).min()) if usable.any() else 0.0)
    goal, scale = want * total, np.maximum(have, 1e-9)
    history: list[list[float]] = []
    got = np.zeros(k)
    for _ in range(steps if usable.any() else 0):
        error = (got - goal) / scale
        if np.abs(got - goal).max() <= 1e-4 * max(total, 1.0) and history:
            break
        history.append(error.tolist())
        got = _totals(cells, history, k)
    if history:
        got = _totals(d, history, k)  # over documents: the steps saw cells only
    b = docs.sparkSession.sparkContext.broadcast(history)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="member").assign(rate=_rates(batch, b.value, k))

    rates = d.mapInPandas(run, "doc_id bigint, source string, tokens bigint, cap int, rate double")
    return Mix(materialize(rates, "rates"), sources, share, cap, total, got, model.accuracy)


def _rates(batch: pd.DataFrame, history: list[list[float]], k: int) -> np.ndarray:
    """The rates after the steps so far: each is a step against the gradient, then the projection onto [0, cap]."""
    r, cap = np.zeros(len(batch)), batch["cap"].to_numpy(float)
    x = np.stack(batch["member"].to_numpy()) if len(batch) and k else np.zeros((len(batch), k))
    for e in history:
        r = np.clip(r - x @ np.array(e), 0, cap)
    return r


def _totals(cells: DataFrame, history: list[list[float]], k: int) -> np.ndarray:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k)
        for batch in batches:
            if len(batch):
                total += (_rates(batch, history, k) * batch["tokens"].to_numpy(float)) @ np.stack(batch["member"].to_numpy())
        yield pd.DataFrame({"i": np.arange(k), "t": total})

    rows = cells.mapInPandas(run, "i int, t double").groupBy("i").agg(F.sum("t").alias("t")).collect()
    out = np.zeros(k)
    for r in rows:
        out[r["i"]] = r["t"]
    return out


def draw(mix: Mix, seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, copies) of the documents drawn at least once.

    The running sum goes by stratum of length, then by hash; each stratum is summed in PARTS ranges of the hash."""
    r = mix.rates.where("rate > 0").withColumn("_s", F.coalesce("source", F.lit("")))
    r = r.withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))
    part = F.shiftright("_h", 64 - (PARTS - 1).bit_length()) + PARTS // 2
    r = r.withColumn("_b", F.floor(F.log1p("tokens") * STRATA) * PARTS + part)
    r = prefix_sum(r, ["_s"], ["_h", "doc_id"], "_b", "rate", "_before")
    start = F.lit(0.5)  # the middle of a step: sums of rates are met to within half a copy
    copies = F.least(F.floor(F.col("_before") + F.col("rate") + start + 1e-9) - F.floor(F.col("_before") + start + 1e-9), F.col("cap"))
    return r.select("doc_id", "source", "tokens", copies.cast("int").alias("copies")).where("copies > 0")


def report(mix: Mix, drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target and reached share of all tokens drawn, tokens, documents, most copies of one, tokens there are."""
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("drawn_tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    there = mix.rates.groupBy("source").agg(F.sum("tokens").alias("tokens_available"))
    t = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    got = got.withColumnRenamed("source", "_s")
    out = t.join(there.join(got, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "source", "full")
    share = F.coalesce(F.col("drawn_tokens") / F.sum("drawn_tokens").over(Window.partitionBy(F.lit(0))), F.lit(0.0))  # one row per source
    return out.select("source", "target_share", share.alias("share"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"), F.coalesce("tokens_available", F.lit(0)).alias("tokens_available"))
