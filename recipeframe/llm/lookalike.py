"""Visually identical text with different characters: a trie of the vocabulary, walked by a weighted edit automaton.

A token is read as units (a base character with its combining marks). The automaton's state is a trie node and a cost:

* an ignorable unit (zero-width, soft hyphen, variation selector, direction mark) stays at the node at cost 0;
* a unit that looks like an edge's unit follows that edge at cost 0; so does a unit that stands for several (a ligature);
* with ``budget`` > 0, substitution, insertion and deletion cost 1 each (for suggestions; equality uses budget 0).

Of the vocabulary entries reached at the least cost, the canonical spelling is one in a single script that is drawn as it
is stored, else the most frequent in a single script ("рис" before its mixed drawing), else the most frequent. The
vocabulary is the ``VOCABULARY`` most frequent tokens of at most ``LONGEST`` characters, a bounded, broadcast list counted
over all rows, with what they are drawn as. Tokens that match no entry are normalised by table (``skeleton``).

Two tokens look alike exactly if their skeletons are equal; an entry is reached at cost 0 exactly by the tokens of its
skeleton, and all of them get the same canonical spelling. So which values are equal doesn't depend on the vocabulary's
bound; how a token is spelled can, if its skeleton mixes scripts. Text of letters that are drawn as they are stored
(``PLAIN``: most Latin, Chinese, Japanese and Korean text) is its own form and never leaves the JVM.

Visible differences stay: letter case, accents and dots (also the missing one of a dotless i), punctuation (also its
width), words, digits set high or in circles, bold or slanted letters.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.runtime import materialize, member_pairs

VOCABULARY, LONGEST = 200_000, 64

# Letters of other scripts, and of small size, that are drawn like Latin letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ѵ": "v", "ɡ": "g", "ɑ": "a",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ѵ": "V", "Ү": "Y", "ү": "y",
    "ο": "o", "ν": "v", "ρ": "p", "α": "a", "ι": "i", "γ": "y", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "ϲ": "c", "ϳ": "j", "Ϳ": "J",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ք": "p", "Օ": "O", "Տ": "S", "Լ": "L",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M", "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
    "Ⲥ": "C", "ⲥ": "c", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    "ᴄ": "c", "ᴏ": "o", "ꜱ": "s", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z",
}
SCRIPTS = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU", "COPTIC")
_WIDTH = ("<wide>", "<narrow>")
_UPRIGHT = ("MATHEMATICAL SANS-SERIF CAPITAL", "MATHEMATICAL SANS-SERIF SMALL", "MATHEMATICAL SANS-SERIF DIGIT", "MATHEMATICAL MONOSPACE")


@lru_cache(maxsize=100_000)
def look(ch: str) -> str:
    """What one character is drawn as: "" for an ignorable, " " for any space, else one or more characters."""
    if ch.isascii():
        return " " if ch.isspace() else ch
    kind = unicodedata.category(ch)
    if kind == "Cf" or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF or ch in "͏ᅟᅠㅤ":
        return ""
    if kind[0] == "Z" or ch.isspace():
        return " "
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag in _WIDTH or tag == "<compat>":
        to = "".join(chr(int(x, 16)) for x in rest.split())
        one_letter = tag == "<compat>" and len(to) == 1 and ord(ch) < 0x2160  # the long s and its like look different
        if not one_letter and all(unicodedata.category(c)[0] in ("LMN" if tag in _WIDTH else "L") or 0x3099 <= ord(c) <= 0x309A for c in to):
            return "".join(look(c) for c in to)
    if tag == "<font>" and unicodedata.name(ch, "").startswith(_UPRIGHT):
        return chr(int(rest, 16))
    return LOOKALIKES.get(ch, ch)


def skeleton(text: str) -> str:
    """The table: what is drawn, composed, with single spaces."""
    if text.isascii():
        return " ".join(text.split())
    drawn = unicodedata.normalize("NFD", "".join(map(look, unicodedata.normalize("NFC", text))))
    return " ".join(unicodedata.normalize("NFC", "".join(map(look, drawn))).split())


def units(token: str) -> list[str]:
    """Base characters with their combining marks, each composed."""
    if token.isascii() or unicodedata.is_normalized("NFC", token) and not any(map(unicodedata.combining, token)):
        return list(token)
    out: list[str] = []
    for c in unicodedata.normalize("NFD", token):
        if out and unicodedata.combining(c):
            out[-1] += c
        else:
            out.append(c)
    return [unicodedata.normalize("NFC", u) for u in out]


@lru_cache(maxsize=100_000)
def drawn(unit: str) -> list[str]:
    """The unit's class: the drawn units it stands for, none for an ignorable."""
    return units(skeleton(unit)) if unit.strip() else []


def _plain() -> str:
    """A pattern of text whose characters, in scripts of this range, are drawn as they are stored, with single spaces."""
    whole: list[list[int]] = []
    for a, z in ((0x21, 0x24F), (0x3001, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20)):
        for i in range(a, z + 1):
            c = chr(i)
            if unicodedata.category(c)[0] in "LNPS" and look(c) == c and unicodedata.is_normalized("NFC", c):
                if whole and whole[-1][1] == i - 1:
                    whole[-1][1] = i
                else:
                    whole.append([i, i])
    one = "[" + "".join(rf"\x{{{a:x}}}-\x{{{z:x}}}" for a, z in whole) + "]+"
    return rf"^{one}(?: {one})*\z"


PLAIN = _plain()


@lru_cache(maxsize=10_000)
def _script(ch: str) -> str:
    return next((x for x in SCRIPTS if unicodedata.name(ch, "").startswith(x)), "")


def single_script(word: str) -> bool:
    """Whether no two of the scripts with look-alikes meet in the word."""
    return word.isascii() or len({x for x in map(_script, word) if x}) < 2


class Trie:
    """Vocabulary entries by the units they are drawn as. The trie is laid out as the sorted array of its paths (units
    with an end mark each): a node is the range of paths that begin alike, and a step narrows it by binary search."""

    def __init__(self, entries: list[tuple[str, int]]):
        best: dict[str, tuple[int, int, str]] = {}
        for word, n in entries:
            for spelling in {word, skeleton(word)}:  # the drawing itself is an entry, too
                drawing = skeleton(spelling)
                kind = 2 if not single_script(spelling) else int(spelling != drawing)
                rank = (kind, -n, spelling)
                path = "".join(u + "\0" for u in units(drawing))
                if path and (path not in best or rank < best[path]):
                    best[path] = rank
        self.paths = sorted(best)
        self.best = [(n, word) for _, n, word in map(best.__getitem__, self.paths)]

    def _step(self, node: tuple[int, int, int], unit: str) -> tuple[int, int, int] | None:
        lo, hi, depth = node
        stem = self.paths[lo][:depth] + unit
        lo = bisect_left(self.paths, stem + "\0", lo, hi)
        hi = bisect_left(self.paths, stem + "\1", lo, hi)
        return (lo, hi, len(stem) + 1) if lo < hi else None

    def _children(self, node: tuple[int, int, int]) -> Iterator[tuple[int, int, int]]:
        lo, hi, depth = node
        while lo < hi:
            path = self.paths[lo]
            if len(path) == depth:  # the entry that ends here
                lo += 1
                continue
            child = self._step((lo, hi, depth), path[depth : path.index("\0", depth)])
            yield child
            lo = child[1]

    def match(self, token: str, budget: int = 0) -> str | None:
        """The canonical spelling of ``token``: the entry reached at least cost, among those the most frequent."""
        if not self.paths:
            return None
        states = {(0, len(self.paths), 0): 0}

        def close(states: dict) -> dict:  # insertions: an entry's unit that the token lacks
            todo = [s for s in states.items() if s[1] < budget]
            while todo:
                at, cost = todo.pop()
                for to in self._children(at):
                    if states.get(to, budget + 1) > cost + 1:
                        states[to] = cost + 1
                        if cost + 1 < budget:
                            todo.append((to, cost + 1))
            return states

        states = close(states)
        for u in units(token):
            for d in drawn(u):
                step: dict = {}
                for at, cost in states.items():
                    to = self._step(at, d)
                    if to is not None:
                        step[to] = min(cost, step.get(to, cost))
                    if cost < budget:
                        step[at] = min(cost + 1, step.get(at, cost + 1))
                        for to in self._children(at):
                            step[to] = min(cost + 1, step.get(to, cost + 1))
                states = close(step)
                if not states:
                    return None
        ends = [(cost, *self.best[lo]) for (lo, _, depth), cost in states.items() if len(self.paths[lo]) == depth]
        return min(ends)[2] if ends else None


def counted(values: DataFrame, col: str) -> DataFrame:
    """(w, count): the column's tokens of at most LONGEST characters, over all rows."""
    words = values.select(F.explode(F.split(F.col(col), r"(?U)\s+")).alias("w")).where(f"w <> '' and length(w) <= {LONGEST}")
    return words.groupBy("w").count()


def vocabulary(values: DataFrame, col: str, limit: int = VOCABULARY) -> list[tuple[str, int]]:
    """The ``limit`` most frequent tokens with their counts; at most ``limit`` * LONGEST characters are collected."""
    return [(r["w"], r["count"]) for r in counted(values, col).orderBy(F.desc("count"), "w").limit(limit).collect()]


def canonical(df: DataFrame, col: str, out: str, vocab: list[tuple[str, int]], budget: int = 0) -> DataFrame:
    """``df`` with ``out``, the one form of ``col``. Null stays null; text of ignorables only becomes ""."""
    b = df.sparkSession.sparkContext.broadcast(Trie(vocab))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie, memo = b.value, {}

        def token(w: str) -> str:
            got = memo.get(w)
            if got is None:
                if len(memo) > 300_000:
                    memo.clear()
                # a canonical spelling may itself carry look-alikes; its tokens are kept apart by single spaces
                got = memo[w] = trie.match(w, budget) or skeleton(w)
            return got

        def text(s: str) -> str:
            return " ".join(t for t in map(token, "".join(" " if look(c) == " " else c for c in s).split()) if t)

        for s in batches:
            yield s.map(text, na_action="ignore")

    form = F.pandas_udf(_typed(run), "string")
    if budget:
        return df.withColumn(out, form(F.col(col)))
    plain = F.col(col).rlike(PLAIN)
    return df.withColumn(out, F.when(plain, F.col(col)).otherwise(form(F.when(~plain, F.col(col)))))


def _typed(run):
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


def _values(values: DataFrame) -> DataFrame:
    return values.where("key is not null and value is not null").select("field", "key", "value").distinct()


def _spellings(v: DataFrame, limit: int) -> DataFrame:
    """(field, form, value) of the forms that are stored in more than one way.

    Two plain values never look alike, so only the others are brought to their form; plain values join those."""
    spelled = v.select("field", "value").distinct()
    other = spelled.where(~F.col("value").rlike(PLAIN))
    forms = materialize(canonical(other, "value", "form", vocabulary(spelled, "value", limit)).where("form <> ''"), "forms")
    wanted = forms.select("field", F.col("form").alias("value")).distinct()
    plain = spelled.where(F.col("value").rlike(PLAIN)).join(wanted, ["field", "value"], "left_semi")
    every = forms.select("field", "form", "value").unionByName(plain.select("field", F.col("value").alias("form"), "value"))
    several = every.groupBy("field", "form").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialize(every.join(several, ["field", "form"]).select("field", "form", "value"), "spellings")


def same_looking(values: DataFrame, limit: int = VOCABULARY) -> DataFrame:
    """(field, key_a, key_b) of different records holding values that look the same but differ in characters.

    values: (field, key, value). Nulls and blank values match nothing; repeats count once. Pairs are made between the
    spellings of a form; the records of either side then meet block by block, however many hold a popular one."""
    v = _values(values)
    s = _spellings(v, limit)
    a, b = s.select("field", "form", F.col("value").alias("va")), s.select("field", "form", F.col("value").alias("vb"))
    links = a.join(b, ["field", "form"]).where("va < vb").select(F.struct("field", F.col("va").alias("value")).alias("a"), F.struct("field", F.col("vb").alias("value")).alias("b"))
    held = v.join(s.select("field", "value"), ["field", "value"], "left_semi")
    members = materialize(held.select(F.struct("field", "value").alias("group"), F.struct("field", "key").alias("item")), "holders")
    met = member_pairs(materialize(links, "links"), members).where("x <> y")
    return met.select("x.field", F.col("x.key").alias("key_a"), F.col("y.key").alias("key_b")).distinct()


def look_groups(values: DataFrame, limit: int = VOCABULARY) -> DataFrame:
    """(field, form, key, value): ``same_looking`` as groups, one row per record and value whose form is stored in more
    than one way; records of one form with different values are its pairs."""
    v = _values(values)
    return v.join(_spellings(v, limit), ["field", "value"]).select("field", "form", "key", "value")


def suggestions(values: DataFrame, col: str, usual: int = 20, budget: int = 1, limit: int = VOCABULARY) -> DataFrame:
    """(token, n, suggestion): tokens that occur fewer than ``usual`` times and lie within ``budget`` edits of one of the
    (``limit`` most frequent) tokens that occur at least as often; look-alikes cost nothing."""
    words = materialize(counted(values, col), "words")
    known = [(r["w"], r["count"]) for r in words.where(F.col("count") >= usual).orderBy(F.desc("count"), "w").limit(limit).collect()]
    rare = words.where(F.col("count") < usual).select(F.col("w").alias("token"), F.col("count").alias("n"))
    b = rare.sparkSession.sparkContext.broadcast(Trie(known))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda w: b.value.match(w, budget))

    found = rare.withColumn("suggestion", F.pandas_udf(_typed(run), "string")("token"))
    return found.where("suggestion is not null and suggestion <> token")
