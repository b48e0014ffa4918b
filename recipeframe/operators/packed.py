"""Several values packed in one field: a parsing expression grammar over the string, one row per value out.

Every alternative is a rule that takes the whole string or fails and gives its input back; ``FIELD`` tries them in order:

    field    <- square / call / brace / round / decimals / numbers / numbered / lines / tabbed / csv / delimited / commas / slashed / single
    square   <- '[' items ']' end / '[' &quote items end           -- without its closer: open_bracket
    call     <- 'c(' items ')' end / 'c(' &quote items end
    brace    <- '{' items(',' or ';') '}' end / '{' &quote items end
    round    <- !numbered '(' &(quote / digit / ')') items ')' end
    items    <- (ws item ws (sep / end))*
    item     <- quoted &(ws (sep / end)) / '[' text ']' &(ws (sep / end)) / mended &(sep / end) / bare
    quoted   <- '"' (escape / '""' / [^"])* '"'  and the same with single quotes
    mended   <- quote text quote                                   -- quotes inside: bad_quote
    decimals <- decimal (junk decimal)* junk?                      -- a comma is the decimal point
    numbers  <- (number / junk)*
    numbered <- mark(1) text (mark(2) text)*                       -- '1)', '(1)', '1.', '1 -', 'Step 1:'
    lines    <- (line newline)+ line? / bullet text                -- line <- bullet? text
    tabbed   <- text (tab text)+
    csv      <- cell (sep cell)*, one of them quoted               -- one sep throughout; cell <- quoted / !quote text
    delimited<- piece (('|' / '~' / ';') piece)+                   -- piece <- text (leading comma text)*
    commas   <- text (leading comma text)*, one comma at least
    slashed  <- text (ws '/' ws text)+
    single   <- bullet? text

A quote that doesn't close before a separator makes ``quoted`` fail; the parser goes back and takes ``mended`` or bare
text, with the error flag ``bad_quote``. A comma next to another delimiter, or before a space, is ambiguous ("breads,
quick; vegan" against "vegan, mild; quick"): it leads to a value where the two words after it (else the one word) start
values in quoted lists more often than they follow commas inside values there (``lead_words``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recipeframe.runtime import join_hot, materialize

OUT = "field string, pos bigint, value string, error string"
Leads = Callable[[str], bool]
Result = tuple[list[str], str] | None  # values and error flag; None: the rule failed
Rule = Callable[[str, Leads], Result]

_NUMBER = re.compile(r"[-+]?\d+(?:\.\d+)?")
_NUMERIC = re.compile(r"[\s\d.,;|~/+-]*")
_DECIMALS = re.compile(r"\s*\d+,\d+(?:\s*[;|~/\s]\s*\d+,\d+)+\s*[;|~/]?\s*|\s*\d+,\d+\s*[;|~/]\s*")
_DECIMAL = re.compile(r"\d+,\d+")
_MARKS = [
    lambda k: re.compile(rf"(?:(?<=\s)|^){k}\)\s+"),
    lambda k: re.compile(rf"(?:(?<=\s)|^)\({k}\)\s+"),
    lambda k: re.compile(rf"(?:(?<=\s)|^){k}\.\s+(?!\d)"),
    lambda k: re.compile(rf"(?:(?<=\s)|^){k}\s+[-–]\s+"),
    lambda k: re.compile(rf"(?:(?<=\s)|^)[Ss]tep\s+{k}\s*[:.)-]\s*"),
]
_BULLET = re.compile(r"^\s*(?:[-*•·–]\s+|\(?\d+[.):]\s+|\d+\s+[-–]\s+)")
_BULLETED = re.compile(r"\s*[-*•·–]\s")
_LINE_END = re.compile(r"[\r\n]+")
_SLASH = re.compile(r"\s/\s|(?<!\d)/|/(?!\d)")
_ESC = re.compile(r"\\(u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|.)", re.S)
_PLAIN_ESC = {"n": "\n", "t": "\t", "r": "\r"}
_LEAD = re.compile(r"\s*[\"'(]*([^\s,;|~\"']+)(?:\s+([^\s,;|~\"']+))?")


def unescape(s: str, quote: str) -> str:
    s = s.replace(quote * 2, quote)
    if "\\" not in s:
        return s
    return _ESC.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "ux" and len(m[1]) > 1 else _PLAIN_ESC.get(m[1], m[1]), s)


def _patterns(seps: str) -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
    """item's alternatives in order as one terminal (quoted / bracketed / bare), mended, its end, bare text."""
    sep = f"[{seps}]"
    good = (
        rf"""\s*+(?:"(?P<dq>(?:[^"\\]|\\.|"")*)"(?=\s*(?:{sep}|\Z))|'(?P<sq>(?:[^'\\]|\\.|'')*)'(?=\s*(?:{sep}|\Z))"""
        rf"""|\[(?P<br>[^\[\]]*)\](?=\s*(?:{sep}|\Z))|(?P<bare>(?!["'])[^{seps}]*))\s*(?:{sep}|\Z)"""
    )
    return re.compile(good, re.S), re.compile(rf"\s*(?P<q>[\"'])(.*?)(?P=q)(?:{sep}|\Z)", re.S), re.compile(rf"[\"'](?={sep}|\Z)"), re.compile(rf"\s*([^{seps}]*)(?:{sep}|\Z)")


_ITEM = {seps: _patterns(seps) for seps in (",", ",;")}


def items(s: str, seps: str) -> tuple[list[str], str]:
    """items end; never fails, as every alternative of item ends in bare text."""
    good, mended, close, bare = _ITEM[seps]
    out, error, i, last = [], "", 0, None
    while i < len(s):
        m = good.match(s, i)
        if m is not None:
            kind = m.lastgroup
            v = m[kind]
            out.append(unescape(v, '"') if kind == "dq" else unescape(v, "'") if kind == "sq" else v)
        else:  # a quote that doesn't close where a value ends
            error = "bad_quote"
            if last is None:
                last = max((x.start() for x in close.finditer(s)), default=-1)
            m = mended.match(s, i) if i < last else None
            if m is None:
                m = bare.match(s, i)
                out.append(m[1].strip().strip("\"'"))
            else:
                out.append(m[2].strip(m["q"]))
        i = m.end()
    return out, error


def enclosed(opener: str, closer: str, seps: str, needs: str = "", open_end: bool = True) -> Rule:
    closed = re.compile(rf"\s*{re.escape(opener)}{needs}(.*){re.escape(closer)}\s*\Z", re.S)
    unclosed = re.compile(rf"\s*{re.escape(opener)}(?=\s*[\"'])(.*)\Z", re.S)

    def rule(s: str, leads: Leads) -> Result:
        if (m := closed.match(s)) is not None:
            return items(m[1], seps)
        if open_end and (m := unclosed.match(s)) is not None:
            values, error = items(m[1].rstrip(), seps)
            return values, error or "open_bracket"
        return None

    return rule


def unless(other: Rule, rule: Rule) -> Rule:
    """!other rule"""
    return lambda s, leads: None if other(s, leads) is not None else rule(s, leads)


def choice(*rules: Rule) -> Rule:
    """The first rule that takes the whole string; the others never see what a failed one did."""

    def rule(s: str, leads: Leads) -> Result:
        for r in rules:
            if (got := r(s, leads)) is not None:
                return got
        return None

    return rule


def decimals(s: str, leads: Leads) -> Result:
    return (_DECIMAL.findall(s), "") if _DECIMALS.fullmatch(s) else None


def numbers(s: str, leads: Leads) -> Result:
    return (_NUMBER.findall(s), "") if _NUMERIC.fullmatch(s) else None


def numbered(s: str, leads: Leads) -> Result:
    t = s.lstrip()
    for mark in _MARKS:
        m = mark(1).match(t)
        if m is None:
            continue
        out, k, at = [], 1, m.end()
        while n := mark(k + 1).search(t, at):
            out.append(t[at : n.start()])
            k, at = k + 1, n.end()
        return [*out, t[at:]], ""
    return None


def lines(s: str, leads: Leads) -> Result:
    if "\n" in s or "\r" in s or _BULLETED.match(s):
        return [_BULLET.sub("", x) for x in _LINE_END.split(s)], ""
    return None


def tabbed(s: str, leads: Leads) -> Result:
    return (s.split("\t"), "") if "\t" in s.strip() else None


def csv(sep: str) -> Rule:
    cell = re.compile(rf"""\s*(?:"(?P<quoted>(?:[^"\\]|\\.|"")*)"\s*|(?P<plain>(?!")[^{sep}]*))(?P<end>{sep}|\Z)""", re.S)

    def rule(s: str, leads: Leads) -> Result:
        if '"' not in s:
            return None
        out, some, i = [], False, 0
        while True:
            m = cell.match(s, i)
            if m is None:
                return None
            if m["quoted"] is not None:
                some = True
                out.append(unescape(m["quoted"], '"'))
            else:
                out.append(m["plain"])
            i = m.end()
            if not m["end"]:
                return (out, "") if some else None

    return rule


def piece(s: str, leads: Leads, unspaced: bool) -> list[str]:
    """text (leading comma text)*; with ``unspaced`` a comma without a space after it leads, too."""
    first, *rest = s.split(",")
    out = [first]
    for p in rest:
        if leads(p) or (unspaced and p[:1] not in (" ", "")) or not p.strip():
            out.append(p)
        else:
            out[-1] += "," + p
    return out


def delimited(s: str, leads: Leads) -> Result:
    parts = re.split(r"[|~;]", s)
    return ([y for x in parts for y in piece(x, leads, False)], "") if len(parts) > 1 else None


def commas(s: str, leads: Leads) -> Result:
    return (piece(s, leads, True), "") if "," in s else None


def slashed(s: str, leads: Leads) -> Result:
    return (re.split(r"\s*/\s*", s), "") if _SLASH.search(s) else None


def single(s: str, leads: Leads) -> Result:
    return [_BULLET.sub("", s)], ""


FIELD = choice(
    enclosed("[", "]", ","), enclosed("c(", ")", ","), enclosed("{", "}", ",;"), unless(numbered, enclosed("(", ")", ",", r"(?=\s*(?:[\"'\d.-]|\)))", open_end=False)),
    decimals, numbers, numbered, lines, tabbed, csv(","), csv(";"), delimited, commas, slashed, single,
)


def contexts(p: str) -> list[str]:
    """What is looked up of the text after a comma: its first two words, then its first word; lower case."""
    m = _LEAD.match(p)
    if m is None:
        return []
    one = m[1].lower()
    return [f"{one} {m[2].lower()}", one] if m[2] else [one]


def known(table: dict[str, bool]) -> Leads:
    """A comma leads to a value as its longest known context says; an unknown one doesn't."""
    return lambda p: next((table[c] for c in contexts(p) if c in table), False)


def parse(s: str | None, leads: Leads = lambda p: False) -> list[tuple[str, str]]:
    """Values of one packed string in order, each with its error flag ("" where clean). Null, empty: no values."""
    if s is None or not s.strip():
        return []
    values, error = FIELD(s, leads)
    return [(v, error) for v in map(str.strip, values) if v]


def questions(s: str | None) -> set[str]:
    """The contexts that ``parse`` looks up; no answer changes what else it asks."""
    if s is None or "," not in s or (s.startswith("[") and s.endswith("]")):  # a closed list asks nothing
        return set()
    asked: set[str] = set()
    parse(s, lambda p: bool(asked.update(contexts(p))))
    return asked


def lead_words(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, context, leads): the first one and two words of values in closed quoted lists and of what follows a comma inside
    such a value; ``leads`` if they start more values than they continue. Over all rows, nothing is left out."""
    two = r"""([^\s"',;]+(?:\s+[^\s"',;]+)?)"""
    kinds = ((1, r"""(?:^\s*\[|,\s?)["']""" + two), (-1, r"""[^\s"'\[],\s+""" + two))
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(sign).alias("sign"), F.regexp_extract_all(F.col(f), F.lit(pattern), F.lit(1)).alias("w")) for f in fields for sign, pattern in kinds])
    each = F.filter(each, lambda x: F.size(x["w"]) > 0)
    closed = df.select(*[F.when(F.trim(f).like("[%]"), F.col(f)).alias(f) for f in fields])
    found = closed.where(" or ".join(f"`{f}` is not null" for f in fields)).select(F.explode(each).alias("x")).select("x.field", "x.sign", F.explode("x.w").alias("w"))
    counted = found.groupBy("field", "w").agg(F.sum("sign").alias("n")).withColumn("w", F.split(F.lower("w"), r"\s+"))
    both = F.array_distinct(F.array(F.get("w", F.lit(0)), F.array_join("w", " ")))
    return counted.select("field", "n", F.explode(both).alias("context")).groupBy("field", "context").agg((F.sum("n") > 0).alias("leads"))


def explode_packed(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row per value: (key, field, pos from 1, value, error).

    Repeats of a key are one record (its least written form counts, nulls aside); a null key is kept as one record.
    Null and empty cells give no rows. Columns other than key and fields are ignored, whatever they are called.
    A record is parsed with those contexts that its ambiguous commas ask for, found by a join: nothing is bounded by the
    number of words."""
    used = df.select(F.struct(F.col(key).alias("key")).alias("_id"), *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)])
    named = used.select(*[F.col(f"_f{i}").alias(f) for i, f in enumerate(fields)])
    # a struct is never null, so that a null key joins like any other and rows stay where the aggregation has put them
    one = used.groupBy("_id").agg(*[F.min(f"_f{i}").alias(f"_f{i}") for i in range(len(fields))])
    kind = dict(df.select(key).dtypes)[key]
    asks = {f"_f{i}": F.col(f"_f{i}").contains(",") & ~(F.col(f"_f{i}").startswith("[") & F.col(f"_f{i}").endswith("]")) for i in range(len(fields))}
    doubtful = one.select(F.col("_id.key").alias("_key"), *[F.when(c, F.col(f)).alias(f) for f, c in asks.items()]).where(" or ".join(f"{f} is not null" for f in asks))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, f, w) for i, f in enumerate(fields) for k, s in zip(b["_key"], b[f"_f{i}"]) for w in sorted(questions(s))]
            if rows:
                yield pd.DataFrame(dict(zip(("_key", "field", "context"), map(list, zip(*rows)))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for i, f in enumerate(fields):
                for k, s, told in zip(b["_key"], b[f"_f{i}"], b["_leads"]):
                    leads = known({} if told is None else {x["context"]: x["leads"] for x in told if x["field"] == f})
                    for pos, (v, e) in enumerate(parse(s, leads), 1):
                        for c, x in zip(cols, (k, f, pos, v, e)):
                            c.append(x)
            yield pd.DataFrame(dict(zip(("_key", "field", "pos", "value", "error"), cols)))

    asked = materialize(doubtful.mapInPandas(ask, f"_key {kind}, field string, context string"), "asked")
    wanted = asked.groupBy("field", "context").agg(F.count(F.lit(1)).alias("n")).join(lead_words(named, fields), ["field", "context"])
    wanted = materialize(wanted.select(F.struct("field", "context").alias("at"), "leads", "n"), "leads")
    answers = join_hot(asked.select(F.struct(F.col("_key").alias("key")).alias("_id"), F.struct("field", "context").alias("at")), wanted, "at", "n")
    answers = answers.groupBy("_id").agg(F.collect_list(F.struct("at.field", "at.context", "leads")).alias("_leads"))
    told = one.join(answers, "_id", "left").select(F.col("_id.key").alias("_key"), *[f"_f{i}" for i in range(len(fields))], "_leads")
    return told.mapInPandas(run, f"_key {kind}, {OUT}").withColumnRenamed("_key", key)
