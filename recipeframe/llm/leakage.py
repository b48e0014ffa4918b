"""Evaluation texts leaking into training text: one Aho-Corasick automaton over the normalised items.

Texts are normalised to their words (lower case, one space between). Any ``words`` consecutive words of an item hold one
of its pieces whole, when the item is cut into pieces of half as many words; so the patterns are these pieces, and the
automaton has about one node per character of the items. A document is written the same way with the place of each word
in the original and scanned once; each hit is extended word by word to both sides, and what reaches ``words`` words is a
run. Runs that overlap or touch are merged into passages with offsets in the original text. Items with fewer words than
``words`` match whole if ``short`` is set.

An automaton takes items of up to ``BLOCK`` characters (8 million: about 0.3 GB in a Python worker, and one read of the
documents); more items are taken in further automata, each with its own read. A longer item has one for itself.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.runtime import prefix_sum

WORD = re.compile(r"[^\W_]+")
BLOCK, BUCKETS = 8_000_000, 1024
HITS = "doc_id bigint, item_id bigint, start int, end int, n_words int, share double"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Patterns:
    """items: (item_id, text); an item with several texts is looked for under each of them."""

    def __init__(self, items: list[tuple[int, str]], words: int, short: bool):
        self.items: list[tuple[int, list[str], int]] = []  # item, its words, how many must be in a row
        found: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            w = [sys.intern(x) for x in words_of(text or "")]
            need = min(words, len(w)) if short else words
            if not w or len(w) < need:
                continue
            size = (need + 1) // 2
            for at in range(0, len(w) - size + 1, size):
                found.setdefault(f" {' '.join(w[at : at + size])} ", []).append((len(self.items), at))
            self.items.append((item, w, need))
        self.automaton = ahocorasick.Automaton()
        for p, who in found.items():
            self.automaton.add_word(p, (len(p), tuple(who)))
        if found:
            self.automaton.make_automaton()

    def passages(self, text: str) -> list[tuple[int, int, int, int, float]]:
        """(item, start, end, words, share of the item's words) of each maximal passage of one document."""
        lower = text.lower()
        spans = [m.span() for m in WORD.finditer(lower)]
        if not spans or not self.items:
            return []
        mine = [lower[s:e] for s, e in spans]
        at = None
        runs: dict[int, dict[int, list[list[int]]]] = {}  # per item and diagonal, in order
        for end, (size, who) in self.automaton.iter(f" {' '.join(mine)} "):
            if at is None:
                at = np.cumsum([0] + [e - s + 1 for s, e in spans])  # where each word's leading space is in the line
            first = int(np.searchsorted(at, end - size + 1))
            for k, there in who:
                known = runs.setdefault(k, {}).setdefault(first - there, [])
                if known and first < known[-1][1]:
                    continue
                w = self.items[k][1]
                lo, i = first, there
                while lo and i and mine[lo - 1] == w[i - 1]:
                    lo, i = lo - 1, i - 1
                hi, j = first, there
                while hi < len(mine) and j < len(w) and mine[hi] == w[j]:
                    hi, j = hi + 1, j + 1
                known.append([lo, hi])
        out = []
        back = None
        for k, by in runs.items():
            item, w, need = self.items[k]
            merged: list[list[int]] = []
            for s, e in sorted(r for rs in by.values() for r in rs if r[1] - r[0] >= need):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            for s, e in merged:
                lo, hi = spans[s][0], spans[e - 1][1]
                if len(lower) != len(text):  # lower case changed the length: map places back character by character
                    back = back or np.repeat(np.arange(len(text)), [len(c.lower()) for c in text]).tolist() + [len(text)]
                    lo, hi = back[lo], back[hi - 1] + 1
                out.append((item, lo, hi, e - s, min(1.0, (e - s) / len(w))))
        return out


def leaks(docs: DataFrame, items: DataFrame, words: int = 12, short: bool = False) -> DataFrame:
    """(doc_id, item_id, start, end, n_words, share) for docs (doc_id, text) and items (item_id, text).

    Null texts and empty tables give no rows; a repeated document gives its passages once per row. At most BLOCK
    characters of items (or one longer item) are collected at a time."""
    known = items.where("text is not null").select("item_id", "text").distinct()
    sized = known.select("item_id", "text", F.length("text").alias("n"), F.lit(0).alias("_g"), F.pmod(F.xxhash64("item_id"), F.lit(BUCKETS)).alias("_b"))
    placed = prefix_sum(sized, ["_g"], ["item_id", "text"], "_b", "n", "before").withColumn("block", F.floor(F.col("before") / BLOCK))
    blocks = placed.agg(F.max("block").alias("b")).first()["b"] or 0
    sc = docs.sparkSession.sparkContext
    out = None
    for k in range(blocks + 1):
        mine = placed.where(F.col("block") == k).select("item_id", "text").orderBy("item_id", "text").collect()
        b = sc.broadcast(Patterns([tuple(r) for r in mine], words, short))

        def run(batches: Iterator[pd.DataFrame], b=b) -> Iterator[pd.DataFrame]:
            patterns = b.value
            for batch in batches:
                rows = [(d, *p) for d, t in zip(batch["doc_id"], batch["text"]) if t for p in patterns.passages(t)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "n_words", "share"])

        part = docs.select("doc_id", "text").mapInPandas(run, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def leaked_pairs(docs: DataFrame, items: DataFrame, words: int = 12) -> DataFrame:
    return leaks(docs, items, words).select("doc_id", "item_id").distinct()
