"""Document language: interpolated Kneser-Ney character models per language in sorted hash arrays.

Training takes a bounded sample of labelled documents (``TRAIN_DOCS`` per language, the least hashes of the key). Every
tenth document is held out as delivered; the others' sentences are cleaned first, as labels may be wrong and documents mix
languages: a naive Bayes vote over the relative frequencies of n-grams in each language drops sentences labelled otherwise
than they read. (A Kneser-Ney model can't do that itself: it learns the continuations of a few mislabelled sentences as
well as those of the right ones.)

A model of order ``ORDER`` has, for every seen n-gram, the interpolated log probability of its last character, and for
every seen context the log back-off weight. The n-grams of all languages share one sorted array of 64-bit hashes per
order with a column per language, so a text is scored for all languages by one binary search per order and position.
A stretch goes to the language of the lowest cross-entropy per character. Confidence is a softmax over the log
likelihoods with a temperature fitted on held-out sentences. A stretch is rejected (language null) if its cross-entropy
lies above that language's limit, which is set between held-out sentences of the language and those of others that read
most like it (``_limit``); the errors left are measured on other held-out documents (``train``).

A sentence may change its language, and captions often have no sentence marks at all. So each sentence is cut by the most
likely path (Viterbi) through languages over its words (characters where writing has no spaces), each change costing
``SWITCH`` nats; text in brackets doesn't count, and a stretch too short to be a sentence (``LEAST`` letters, ``LEAST_CJK``
in scripts without spaces) goes with its neighbour. A sentence of one language and up to ``LONG`` letters counts as one,
any other stretch as one per ``USUAL`` (``USUAL_CJK``) letters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LANGUAGES = ["de", "en", "es", "fr", "it", "ja", "ko", "pt", "zh"]
# Three-letter codes (ISO 639-2 and -3) of these languages.
THREE = {"deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr", "ita": "it", "jpn": "ja", "kor": "ko", "por": "pt", "zho": "zh", "chi": "zh", "cmn": "zh"}
ORDER, TRAIN_DOCS, WEIGHT = 5, 250, 5.0
LONG, SWITCH, LEAST, LEAST_CJK, USUAL, USUAL_CJK = 110, 14.0, 20, 9, 40, 16
_RUN = re.compile(r"[^\W\d_]+")
_BRACKET = re.compile(r"\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_SENTENCE = re.compile(r"[^.!?。！？…\n]*(?:[.!?…]+(?=\s|$|[\"'”’)\]])[\"'”’)\]]*|[。！？]+[」』”’）]*|[.!?…]+|\n|$)", re.S)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_JUNK = re.compile(r"[\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence: up to an end mark before space or a full-width end mark, or a line end."""
    out, start = [], 0
    for m in _SENTENCE.finditer(text):
        if m.end() == m.start():
            continue
        tail = text[m.end() - 1]
        whole = m.end() == len(text) or tail in "\n。！？」』）" or text[m.end()].isspace()
        if whole:
            s, e = start, m.end()
            while s < e and text[s].isspace():
                s += 1
            while e > s and text[e - 1].isspace():
                e -= 1
            if e > s:
                out.append((s, e))
            start = m.end()
    return out


def plain(text: str) -> str:
    """What the models see: composed lower-case letters, anything else one space, spaces at both ends."""
    return " " + _JUNK.sub(" ", unicodedata.normalize("NFC", text.lower())).strip() + " "


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and each text's start."""
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return data, np.cumsum([0] + [len(t) for t in texts])


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _hashes(codes: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n characters that end at each position; 0 where they would cross a start."""
    out = [_mix((codes + np.uint64(1)) * _MULT)]
    begin = np.zeros(len(codes), np.int64)
    begin[starts[:-1][np.diff(starts) > 0]] = 1
    since = np.arange(len(codes)) - np.maximum.accumulate(np.where(begin == 1, np.arange(len(codes)), 0))
    for n in range(2, order + 1):
        h = np.zeros(len(codes), np.uint64)
        h[1:] = _mix(out[-1][:-1] * _MULT + out[0][1:])
        h[since < n - 1] = 0
        out.append(h)
    return out


def _fit(texts: list[str], order: int) -> tuple[list[dict], float]:
    """Per order the sorted n-gram hashes with interpolated probability and, as contexts, back-off; and the floor."""
    codes, starts = _codes(texts)
    h = _hashes(codes, starts, order)
    grams, counts, ctx, low = [], [], [], []
    for n in range(order):
        if n == order - 1:
            ok = h[n] != 0
            g, first, c = np.unique(h[n][ok], return_index=True, return_counts=True)
            at = np.flatnonzero(ok)[first]
        else:  # continuation counts: in how many distinct (n+1)-grams this n-gram is the end
            ok = h[n + 1] != 0
            _, first = np.unique(h[n + 1][ok], return_index=True)
            pos = np.flatnonzero(ok)[first]
            g, i, c = np.unique(h[n][pos], return_index=True, return_counts=True)
            at = pos[i]
        grams.append(g)
        counts.append(c.astype(np.float64))
        ctx.append(h[n - 1][at - 1] if n else np.zeros(len(g), np.uint64))
        low.append(h[n - 1][at] if n else np.zeros(len(g), np.uint64))
    out = []
    floor = 1.0 / 200_000
    for n in range(order):
        c = counts[n]
        n1, n2 = (c == 1).sum(), (c == 2).sum()
        d = min(0.95, max(0.1, n1 / max(1.0, n1 + 2 * n2)))
        contexts, inv = np.unique(ctx[n], return_inverse=True)
        total = np.bincount(inv, c)
        kinds = np.bincount(inv)
        back = d * kinds / total
        if n == 0:
            lower = np.full(len(c), floor)
        else:
            j = np.searchsorted(out[n - 1]["gram"], low[n])
            j = np.minimum(j, len(out[n - 1]["gram"]) - 1)
            hit = out[n - 1]["gram"][j] == low[n]
            lower = np.where(hit, out[n - 1]["p"][j], floor * out[0]["back0"])
        p = np.maximum(c - d, 0) / total[inv] + back[inv] * lower
        out.append({"gram": grams[n], "p": p, "ctx": contexts, "back": back, "back0": back[0] if n == 0 else 0})
    return out, float(floor * out[0]["back0"])


def agreeing(data: list[tuple[str, str]], order: int = 4, rounds: int = 2) -> list[tuple[str, str]]:
    """The (language, plain text) pairs whose n-grams are relatively most frequent in the language they are labelled with."""
    langs = sorted({x for x, _ in data})
    codes, starts = _codes([t for _, t in data])
    h = _hashes(codes, starts, order)
    label_of = np.array([langs.index(x) for x, _ in data])
    keep = np.ones(len(data), bool)
    which = np.repeat(np.arange(len(data)), np.diff(starts))
    for _ in range(rounds):
        total = np.zeros((len(data), len(langs)))
        for n in range(order):
            grams, inv = np.unique(h[n], return_inverse=True)
            c = np.zeros((len(grams), len(langs)))
            ok = keep[which] & (h[n] != 0)
            np.add.at(c, (inv[ok], label_of[which][ok]), 1)
            lp = np.log(c + 0.1) - np.log(c.sum(0) + 0.1 * len(grams))
            lp[grams == 0] = 0
            total += np.add.reduceat(lp[inv], starts[:-1], axis=0)
        keep = total.argmax(1) == label_of
    return [r for r, k in zip(data, keep) if k]


def train(labelled: list[tuple[str, list[str]]], order: int = ORDER) -> dict:
    """Models from documents (language, sentences). Of the held-out documents every second calibrates rejection and
    confidence; on the others, with their labels as delivered, ``report`` has per language the numbers of sentences, and
    the shares that are read as labelled (accuracy), that are so but rejected (false_reject), and that are accepted as some
    other language by the models without their own (false_accept)."""
    langs = sorted({x for x, _ in labelled})
    docs = [(x, [t for t in map(plain, ss) if len(t) > 8]) for x, ss in labelled]
    by = [[ss for y, ss in docs if y == x] for x in langs]
    held = [[(x, t) for x, mine in zip(langs, by) for ss in mine[k::20] for t in ss] for k in (9, 19)]
    fit = agreeing([(x, t) for x, mine in zip(langs, by) for i, ss in enumerate(mine) if i % 10 != 9 for t in ss])
    model = _joint({x: [t for y, t in fit if y == x] or [" "] for x in langs}, order)
    ce, n = score(model, [t for _, t in held[0]])
    y = np.array([langs.index(x) for x, _ in held[0]], np.int64)
    right = ce.argmin(1) == y if len(y) else np.zeros(0, bool)
    foreign = ce.copy()
    foreign[np.arange(len(y)), y] = np.inf  # as the models of the other languages alone would read
    taken = foreign.argmin(1) if len(y) else y
    model["limit"] = np.array([_limit(ce[right & (y == k), k], ce[right & (taken == k) & (y != k), k]) for k in range(len(langs))])

    def loss(t: float) -> float:  # capped, for labels that are wrong
        z = -ce * n[:, None] / t
        z = z - z.max(1, keepdims=True)
        return float(np.minimum(6, -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(1)))).mean())

    model["temperature"] = min((1, 2, 4, 8, 16, 32), key=loss) if len(y) else 8
    ce, _ = score(model, [t for _, t in held[1]])
    y = np.array([langs.index(x) for x, _ in held[1]], np.int64)
    ok = ce <= model["limit"]
    model["report"] = []
    for k, x in enumerate(langs):
        mine = ce[y == k]
        if len(mine):
            read = mine.argmin(1) == k
            others = np.where(np.arange(len(langs)) == k, np.inf, mine).argmin(1)
            taken = ok[y == k][np.arange(len(mine)), others] if len(langs) > 1 else np.zeros(len(mine), bool)
            model["report"].append((x, len(mine), float(read.mean()), float((read & ~ok[y == k][:, k]).sum() / max(1, read.sum())), float(taken.mean())))
    total = sum(r[1] for r in model["report"])
    model["accuracy"] = sum(r[1] * r[2] for r in model["report"]) / total if total else 0.0
    return model


def _limit(own: np.ndarray, foreign: np.ndarray) -> float:
    """The cross-entropy above which a stretch is rejected: where WEIGHT times the share of own sentences above plus the
    share of foreign ones below is least, in the middle of the widest such place."""
    if not len(own):
        return 99.0
    at = np.unique(np.concatenate([own, foreign, [2 * own.max()]]))
    above = 1 - np.searchsorted(np.sort(own), at, side="right") / len(own)
    below = np.searchsorted(np.sort(foreign), at, side="right") / max(1, len(foreign))
    cost = (WEIGHT * above + below)[:-1]
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    k = best[np.argmax((at[1:] - at[:-1])[best])]
    return float((at[k] + at[k + 1]) / 2)


def _joint(texts: dict[str, list[str]], order: int) -> dict:
    langs = sorted(texts)
    fits = [_fit(texts[x], order) for x in langs]
    floor = np.log(np.array([f for _, f in fits], np.float32))
    tables = []
    for n in range(order):
        keys = np.unique(np.concatenate([f[n]["gram"] for f, _ in fits] + ([f[n + 1]["ctx"] for f, _ in fits] if n + 1 < order else [])))
        lp = np.full((len(keys) + 1, len(langs)), np.nan, np.float32)
        bow = np.zeros((len(keys) + 1, len(langs)), np.float32)
        for k, (f, _) in enumerate(fits):
            lp[np.searchsorted(keys, f[n]["gram"]), k] = np.log(f[n]["p"])
            if n + 1 < order:
                bow[np.searchsorted(keys, f[n + 1]["ctx"]), k] = np.log(f[n + 1]["back"])
        tables.append((keys, lp, bow))
    return {"langs": langs, "order": order, "tables": tables, "floor": floor}


def score(model: dict, texts: list[str], chunk: int = 150_000) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each (plain) text under each language, and the numbers of characters."""
    out, sizes = [], np.array([len(t) for t in texts])
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (n == 0 or n + sizes[j] <= chunk):
            n += sizes[j]
            j += 1
        out.append(_score(model, texts[i:j]))
        i = j
    ce = np.concatenate(out) if out else np.zeros((0, len(model["langs"])))
    return ce, sizes


def _score(model: dict, texts: list[str]) -> np.ndarray:
    codes, starts = _codes(texts)
    lp = _positions(model, codes, starts)
    return -np.add.reduceat(lp, starts[:-1], axis=0) / np.diff(starts)[:, None]


def _positions(model: dict, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log probability of the character at each position under each language."""
    lp = np.broadcast_to(model["floor"], (len(codes), len(model["langs"])))
    prev = None
    for (keys, p, bow), h in zip(model["tables"], _hashes(codes, starts, model["order"])):
        j = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        j = np.where(keys[j] == h, j, len(keys))  # the last row: seen nowhere
        here = p[j]
        if prev is not None:
            back = np.zeros_like(here)
            back[1:] = prev[:-1]
            back[h == 0] = 0
            lp = np.where(np.isnan(here), lp + back, here)
        else:
            lp = np.where(np.isnan(here), lp, here)
        prev = bow[j]
    return lp


def _tokens(text: str) -> tuple[list[tuple[int, int]], str, list[int]]:
    """Words (characters where writing has no spaces) outside brackets, the line the models see, each word's place in it."""
    masked = _BRACKET.sub(lambda m: " " * len(m[0]), text) if "(" in text or "（" in text or "[" in text else text
    tokens: list[tuple[int, int]] = []
    for m in _RUN.finditer(masked):
        s, e = m.span()
        while s < e:
            x = _CJK.search(masked, s, e)
            if x is None:
                tokens.append((s, e))
                break
            if x.start() > s:
                tokens.append((s, x.start()))
            tokens.append((x.start(), x.start() + 1))
            s = x.start() + 1
    parts, at, place, last = [" "], [], 1, len(tokens) - 1
    for k, (s, e) in enumerate(tokens):
        at.append(place)
        w = unicodedata.normalize("NFC", masked[s:e].lower())
        if k == last or tokens[k + 1][0] != e:
            w += " "
        parts.append(w)
        place += len(w)
    return tokens, "".join(parts), at


def _verdict(model: dict, total: np.ndarray, x: int, n: int) -> tuple[str | None, float]:
    """Language (null if rejected) and confidence of ``n`` characters with these log likelihoods that read as ``x``."""
    if -total[x] / max(1, n) > model["limit"][x]:
        return None, 0.0
    w = total / model["temperature"]
    return model["langs"][x], float(1 / np.exp(w - w[x]).sum())


def _cut(model: dict, emit: np.ndarray, sizes: np.ndarray, tokens: list[tuple[int, int]], text: str) -> list[tuple[int, int, str | None, float, int]]:
    """(start, end, language, confidence, sentences it counts as) along the most likely path through languages."""
    best, back = emit[0], []
    for row in emit[1:]:
        jump = best.max() - SWITCH
        back.append(np.where(best >= jump, np.arange(len(best)), best.argmax()))
        best = np.maximum(best, jump) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    runs: list[list[int]] = []  # first token, end token, language, letters, letters of scripts without spaces
    for k, (x, (s, e)) in enumerate(zip(path, tokens)):
        if not runs or runs[-1][2] != x:
            runs.append([k, k, x, 0, 0])
        r = runs[-1]
        r[1], r[3], r[4] = k + 1, r[3] + e - s, r[4] + ((e - s) if _CJK.match(text, s) else 0)
    whole = [r for r in runs if r[3] >= (LEAST_CJK if 2 * r[4] > r[3] else LEAST)] or [max(runs, key=lambda r: r[3])]
    merged: list[list[int]] = []
    for r in whole:
        if merged and merged[-1][2] == r[2]:
            merged[-1][1], merged[-1][3], merged[-1][4] = r[1], merged[-1][3] + r[3], merged[-1][4] + r[4]
        else:
            merged.append(list(r))
    out: list[tuple[int, int, str | None, float, int]] = []
    for a, z, x, letters, cjk in merged:
        lang, conf = _verdict(model, emit[a:z].sum(0), x, int(sizes[a:z].sum()))
        n = 1 if len(merged) == 1 and letters <= LONG else max(1, round(letters / (USUAL_CJK if 2 * cjk > letters else USUAL)))
        out.append((tokens[a][0], tokens[z - 1][1], lang, conf, n))
    return out


def stretches(model: dict, texts: list[str]) -> list[list[tuple[int, int, str | None, float, int]]]:
    """Of each sentence its stretches (start, end, language, confidence, sentences it counts as).

    If taking every word in its own best language gains no more than one change costs, no path with a change is better
    than the best language throughout; so only the other sentences need the path itself."""
    out: list[list[tuple[int, int, str | None, float, int]]] = [[] for _ in texts]
    cut = [_tokens(t) for t in texts]
    ids = [i for i, (tokens, _, _) in enumerate(cut) if tokens]
    while ids:
        n, size = 0, 0
        while n < len(ids) and (n == 0 or size + len(cut[ids[n]][1]) <= 150_000):
            size += len(cut[ids[n]][1])
            n += 1
        part, ids = ids[:n], ids[n:]
        codes, starts = _codes([cut[i][1] for i in part])
        lp = _positions(model, codes, starts)
        at = np.concatenate([np.asarray(cut[i][2], np.int64) + s for i, s in zip(part, starts)])
        first = np.cumsum([0] + [len(cut[i][2]) for i in part])
        # a word's part of the line ends where the next begins, the last one's at the end of its line
        ends = np.concatenate([at[1:], [len(codes)]])
        ends[first[1:] - 1] = starts[1:]
        bounds = np.stack([at, ends], 1).ravel()
        emit = np.add.reduceat(np.concatenate([lp, np.zeros((1, lp.shape[1]), lp.dtype)]), bounds, axis=0)[::2]
        sizes = ends - at
        total, free = np.add.reduceat(emit, first[:-1], axis=0), np.add.reduceat(emit.max(1), first[:-1])
        who, length = total.argmax(1), np.add.reduceat(sizes, first[:-1])
        for k, i in enumerate(part):
            tokens, a, z = cut[i][0], first[k], first[k + 1]
            letters = sum(e - s for s, e in tokens)
            if free[k] - total[k, who[k]] <= SWITCH and letters <= LONG:
                out[i] = [(tokens[0][0], tokens[-1][1], *_verdict(model, total[k], int(who[k]), int(length[k])), 1)]
            else:
                out[i] = _cut(model, emit[a:z], sizes[a:z], tokens, texts[i])
    return out


def pieces(model: dict, texts: list[str]) -> list[tuple[int, int, int, str | None, float, int]]:
    """(text, start, end, language, confidence, sentences it counts as) of every sentence of every text, in order."""
    spans = [(i, s, e) for i, t in enumerate(texts) for s, e in sentences(t) if any(c.isalpha() for c in t[s:e])]
    known: dict[str, int] = {}
    which = [known.setdefault(texts[i][s:e], len(known)) for i, s, e in spans]
    found = stretches(model, list(known))
    out = []
    for (i, s, e), k in zip(spans, which):
        if len(found[k]) == 1:
            out.append((i, s, e, *found[k][0][2:]))
        else:
            out += [(i, s + a, s + z, *rest) for a, z, *rest in found[k]]
    return out


def label(text: str | None) -> str | None:
    """The language a label names: region, script, track and three-letter notations included; null if none of the nine."""
    first = re.split(r"[-_\s.]", (text or "").strip().lower())[0]
    first = THREE.get(first, first)
    return first if first in LANGUAGES else None


def sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int = TRAIN_DOCS, longest: int = 20_000) -> list[tuple[str, list[str]]]:
    """(language, sentences) of at most ``per_language`` documents of each labelled language; those with the least hashes
    of their keys among documents of at most ``longest`` characters. This bounds what is collected and fitted on."""
    named = F.element_at(F.split(F.lower(F.trim(lang)), r"[-_\s.]"), 1)
    code = F.coalesce(F.create_map(*[F.lit(x) for kv in THREE.items() for x in kv])[named], named)
    d = docs.where(F.length(text) <= longest).select(code.alias("_l"), F.xxhash64(key).alias("_h"), F.col(text).alias("_t")).where(F.col("_l").isin(LANGUAGES))
    few = d.withColumn("_n", F.row_number().over(Window.partitionBy("_l").orderBy("_h", "_t"))).where(F.col("_n") <= per_language)
    return [(r["_l"], [r["_t"][s:e] for s, e in sentences(r["_t"])]) for r in few.select("_l", "_t", "_h").orderBy("_l", "_h", "_t").collect()]


SEGMENTS = "segment int, start int, end int, n_sentences int, segment_lang string, confidence double"


def segments(docs: DataFrame, key: str, text: str, model: dict) -> DataFrame:
    """(key, segment, start, end, n_sentences, segment_lang, confidence): stretches of one language in order.

    Neighbouring sentences of one language form a segment; rejected sentences join the segment before them, or the one
    after at the start. A text with no letters gives no rows, one whose sentences are all rejected a null language."""
    b = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text is not null")
    kind = dict(d.dtypes)["_key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[list] = []
            for i, s, e, x, c, n in pieces(b.value, batch["_text"].tolist()):
                last = rows[-1] if rows and rows[-1][0] == i else None
                weight = (e - s) if x else 0
                if last and (x is None or last[5] is None or last[5] == x):
                    last[3], last[4], last[5], last[6], last[7] = e, last[4] + n, last[5] or x, last[6] + c * weight, last[7] + weight
                else:
                    rows.append([i, (last[1] + 1) if last else 1, s, e, n, x, c * weight, weight])
            keys = batch["_key"].tolist()
            yield pd.DataFrame([(keys[r[0]], *r[1:6], r[6] / max(1, r[7])) for r in rows], columns=["_key", "segment", "start", "end", "n_sentences", "segment_lang", "confidence"])

    return d.mapInPandas(run, f"_key {kind}, {SEGMENTS}").withColumnRenamed("_key", key)


FINDINGS = "field string, true_lang string, confidence double"


def wrong_labels(docs: DataFrame, key: str, text: str, labels: list[str], model: dict) -> DataFrame:
    """(key, field, true_lang, confidence): one row per label that is missing or wrong, and one with field ``mixed`` per
    further language that at least one whole sentence is in. docs: one row per record.

    The true language is the one most sentences are in, ties going to more characters, then to the name. Texts without
    words, or with rejected sentences only, give no rows."""
    b = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"_l{i}") for i, c in enumerate(labels)]).where("_text is not null")
    kind = dict(d.dtypes)["_key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            by: dict[int, dict[str, list]] = {}
            for i, s, e, x, c, n in pieces(b.value, batch["_text"].tolist()):
                if x:
                    v = by.setdefault(i, {}).setdefault(x, [0, 0, 0.0])
                    v[0], v[1], v[2] = v[0] + n, v[1] + e - s, v[2] + c * n
            keys, given = batch["_key"].tolist(), [batch[f"_l{k}"].tolist() for k in range(len(labels))]
            rows = []
            for i, found in by.items():
                true = max(found, key=lambda x: (found[x][0], found[x][1], x))
                rows += [(keys[i], f, true, found[true][2] / found[true][0]) for k, f in enumerate(labels) if label(given[k][i]) != true]
                rows += [(keys[i], "mixed", x, v[2] / v[0]) for x, v in found.items() if x != true]
            yield pd.DataFrame(rows, columns=["_key", "field", "true_lang", "confidence"])

    return d.mapInPandas(run, f"_key {kind}, {FINDINGS}").withColumnRenamed("_key", key)
