"""The pN_ queries of this package over the test tables, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recipeframe.llm import caps, language, leakage, lookalike, mixture, neardup, spans, splits
from recipeframe.runtime import table

CAP = 8


# ---- 1: splits that keep related records together


def _p1_ties(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    recipes, dedup = table(spark, d, "raw_recipes_mini"), table(spark, d, "dedup")
    by_author = recipes.where("contributor_id is not null and contributor_id <> 0").select("id", F.concat(F.lit("c"), F.col("contributor_id")).alias("key"))
    by_family = dedup.where("family_id is not null and family_id <> -1").select("id", F.concat(F.lit("f"), F.col("family_id")).alias("key"))
    return recipes.select("id"), by_author.unionByName(by_family)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    records, ties = _p1_ties(spark, d)
    members, _, _ = splits.regroup(None, records, ties)
    return splits.related(members)


def _p1_state(spark: SparkSession, d: str) -> splits.SplitState:
    """Two deliveries: those submitted before 2014 build the table, the rest are merged into it."""
    records, ties = _p1_ties(spark, d)
    late = table(spark, d, "raw_recipes_mini").groupBy("id").agg(F.min(F.regexp_extract("submitted", r"(\d{4})", 1)).alias("y"))
    early_ids = late.where("y < '2014'").select("id")
    late_ids = late.where("y >= '2014' or y is null").select("id")
    targets = table(spark, d, "split_targets")
    first = splits.update(None, early_ids, ties.join(early_ids, "id", "left_semi"), targets)
    return splits.update(first, late_ids, ties.join(late_ids, "id", "left_semi"), targets)


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    records, ties = _p1_ties(spark, d)
    return splits.assigned(splits.update(None, records, ties, table(spark, d, "split_targets")))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    records, ties = _p1_ties(spark, d)
    targets = table(spark, d, "split_targets")
    return splits.shares(splits.update(None, records, ties, targets).groups, targets)


def p1_incremental(spark: SparkSession, d: str) -> DataFrame:
    state = _p1_state(spark, d)
    return state.groups.groupBy("split", "status").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n_records").alias("n_records"))


def p1_merged(spark: SparkSession, d: str) -> DataFrame:
    """The groups of p1_found out of the state that two deliveries have built, the second repeating the records of the first
    without their ties."""
    records, ties = _p1_ties(spark, d)
    targets = table(spark, d, "split_targets")
    odd = "pmod(xxhash64(id), 2) = 1"
    first = splits.update(None, records.where(odd), ties.where(odd), targets)
    second = splits.update(first, records, ties.where(f"not {odd}"), targets)
    return splits.related(second.members)


P1_SQL = r"""
with recursive ties as (
  select distinct id, 'c' || contributor_id as k from raw_recipes_mini where contributor_id <> 0
  union select distinct d.id, 'f' || d.family_id from dedup d join raw_recipes_mini r on r.id = d.id where d.family_id <> -1),
edges as (select distinct a.id as a, b.m as b from ties a join (select k, min(id) m from ties group by k) b on a.k = b.k),
hop as (select a, b from edges union select b, a from edges),
reach(id, g) as (select a, least(a, min(b)) from hop group by a union select h.a, r.g from reach r join hop h on h.b = r.id where r.g < h.a),
best as (select id, min(g) as group_id from reach group by id)
select id, group_id from best where group_id in (select group_id from best group by group_id having count(*) > 1)
"""


_P1_SPLIT = (
    P1_SQL[: P1_SQL.rindex("select id, group_id from best")].rstrip()
    + r""",
m as (select distinct r.id, coalesce(b.group_id, r.id) as group_id from raw_recipes_mini r left join best b on b.id = r.id where r.id is not null),
g as (select group_id, count(*) as n from m group by group_id),
w as (select cast(sum(n) as double) as total from g),
t as (select split_name, greatest(coalesce(target_share, 0), 0) as s from split_targets where split_name is not null),
big as (select group_id, n, row_number() over (order by n desc, group_id) as i from g, w where n * 1000 > total),
pick as (select cast(0 as bigint) as i, (select list({'d': s / (select sum(s) from t) * total, 'name': split_name} order by split_name) from t, w) as deficits, cast(null as varchar) as split
  union all select big.i, list_transform(deficits, lambda x: {'d': case when x.name = list_max(deficits).name then x.d - n else x.d end, 'name': x.name}), list_max(deficits).name from pick join big on big.i = pick.i + 1),
d as (select unnest(deficits, recursive := true) from (select deficits from pick order by i desc limit 1)),
b as (select name, sum(greatest(d, 0)) over (order by name) / (select case when sum(greatest(d, 0)) = 0 then 1 else sum(greatest(d, 0)) end from d) * ((select total from w) - coalesce((select sum(n) from big), 0)) as upto, name = (select max(name) from d) as last from d),
small as (select group_id, n, sum(n) over (order by h % 1024, h, group_id) - n as before from (select group_id, n, cast('0x' || substr(md5(group_id || '-0'), 1, 15) as bigint) as h from g, w where n * 1000 <= total)),
put as (select big.group_id, n, split from big join pick on pick.i = big.i
  union all select group_id, n, (select min(name) from b where small.before + small.n / 2 < b.upto or last) from small)
"""
)
P1_SPLITS_SQL = _P1_SPLIT + "select m.id, m.group_id, split from m join put on put.group_id = m.group_id"
P1_SHARES_SQL = _P1_SPLIT + "select coalesce(split, split_name) as split, n_records, n_groups, n_records / total as share, target_share from (select split, cast(sum(n) as bigint) as n_records, count(*) as n_groups from put group by split) p full join split_targets s on s.split_name = p.split, w"

# ---- 2: capping records per contributor


def _p2_records(spark: SparkSession, d: str) -> DataFrame:
    records = (
        caps.one_per_record(table(spark, d, "raw_recipes_mini"), "raw_recipes_mini", "id", "contributor_id", numeric=True)
        .unionByName(caps.one_per_record(table(spark, d, "xiachufang_mini"), "xiachufang_mini", "line_no", "author"))
        .unionByName(caps.one_per_record(table(spark, d, "ingest_youtube"), "ingest_youtube", "video_id", "channel"))
    )
    return records.join(caps.latest_scores(table(spark, d, "q_scores")), ["record_table", "record_key"], "left")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return caps.dropped(_p2_records(spark, d), CAP)


def p2_sampled(spark: SparkSession, d: str) -> DataFrame:
    """Records dropped when chance has its part: temperature 0.1, and no contributor above 1 % of its table."""
    return caps.dropped(_p2_records(spark, d), CAP, max_share=0.01, temperature=0.1, seed=7)


P2_SQL = r"""
with w as (
  select 'raw_recipes_mini' t, cast(id as varchar) k, case when contributor_id <> 0 then cast(contributor_id as varchar) end c from raw_recipes_mini where id is not null
  union all select 'xiachufang_mini', cast(line_no as varchar), author from xiachufang_mini where line_no is not null
  union all select 'ingest_youtube', video_id, channel from ingest_youtube where video_id is not null),
n as (select t, k, min(nullif(regexp_replace(lower(translate(c, 'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９＿', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_')), '[\s\x{00A0}\x{3000}]+', '', 'g'), '')) as c from w group by t, k),
s as (select record_table, record_key, arg_max(coalesce(q_score, -1), scored_at) q from q_scores group by 1, 2),
r as (select n.t, n.k, row_number() over (partition by n.t, n.c order by coalesce(s.q, -1) desc, n.k) rn from n left join s on s.record_table = n.t and s.record_key = n.k where n.c is not null)
select t as record_table, k as record_key from r where rn > 8
"""

P2_SAMPLED_SQL = (
    P2_SQL[: P2_SQL.index("r as (select")]
    + r"""j as (select n.t, n.k, n.c, nullif(s.q, -1) as q, least(8, greatest(1, floor(count(*) over (partition by n.t) * 0.01))) as most,
  (cast('0x' || substr(md5(n.k || '-7'), 1, 15) as bigint) % 4503599627370496 + 0.5) / 4503599627370496.0 as u from n left join s on s.record_table = n.t and s.record_key = n.k),
r as (select t, k, most, row_number() over (partition by t, c order by q - 0.1 * ln(-ln(cast(u as double))) desc nulls last, k) as rn from j where c is not null)
select t as record_table, k as record_key from r where rn > most
"""
)

# ---- 3: visually identical text


def _p3_values(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "recipes_fixture").select(F.lit("title").alias("field"), F.col("id").alias("key"), F.col("title").alias("value"))
    items = table(spark, d, "xiachufang_mini").select(F.lit("recipeIngredient").alias("field"), F.col("line_no").alias("key"), F.explode("recipeIngredient").alias("value"))
    return titles.unionByName(items)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.same_looking(_p3_values(spark, d))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """The same as groups: every record with a value whose form is stored in more than one way."""
    return lookalike.look_groups(_p3_values(spark, d))


def p3_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """Rare words of titles one edit from a usual one."""
    return lookalike.suggestions(table(spark, d, "recipes_fixture").select("id", "title").distinct(), "title")


def p3_titles(spark: SparkSession, d: str) -> DataFrame:
    """Every title in its one form."""
    t = table(spark, d, "recipes_fixture").select("id", "title").distinct()
    return lookalike.canonical(t, "title", "form", lookalike.vocabulary(t, "title"))


def _p3_sql(select: str) -> str:
    """The table of lookalike.py as SQL: what single characters are drawn as, and the few drawn as several."""
    spaces, letters, several = [], [], "value"
    for c in map(chr, range(0x80, 0x10000)):
        to = lookalike.look(c)
        if to == " ":
            spaces.append(c)
        elif len(to) == 1 and to != c:
            letters.append((c, to))
        elif len(to) > 1 and c.isalpha() and not 0xD800 <= ord(c) < 0xE000:
            several = f"replace({several}, '{c}', '{to}')" if c in "ﬀﬁﬂﬃﬄ" else several
    one = "".join(c for c, _ in letters) + "".join(spaces), "".join(t for _, t in letters) + " " * len(spaces)
    form = f"trim(regexp_replace(nfc_normalize(translate(regexp_replace(nfc_normalize({several}), '[\\p{{Cf}}\\x{{FE00}}-\\x{{FE0F}}]', '', 'g'), '{one[0]}', '{one[1]}')), '\\s+', ' ', 'g'))"
    return f"""
with v as (select distinct 'title' as field, id as key, title as value from recipes_fixture union select distinct 'recipeIngredient', line_no, unnest(recipeIngredient) from xiachufang_mini),
f as (select field, key, value, {form} as form from v where key is not null and value is not null),
s as (select * from f where form <> '' and (field, form) in (select (field, form) from f group by field, form having count(distinct value) > 1))
{select}"""


P3_PAIRS = "select distinct a.field, least(a.key, b.key) as key_a, greatest(a.key, b.key) as key_b from s a join s b on a.field = b.field and a.form = b.form and a.value < b.value and a.key <> b.key"

# ---- 4: language labels


def _p4_videos(spark: SparkSession, d: str) -> DataFrame:
    """The latest fetch of each video."""
    v = table(spark, d, "ingest_youtube").where("video_id is not null")
    last = F.max_by(F.struct("lang", "video_lang", "transcript_lang", "transcript"), F.struct(F.col("transcript").isNotNull(), F.coalesce("fetched_at", F.lit("")), F.coalesce("transcript", F.lit(""))))
    return v.groupBy("video_id").agg(last.alias("v")).select("video_id", "v.*")


def _p4_model(spark: SparkSession, d: str) -> dict:
    return language.train(language.sample(table(spark, d, "documents"), "doc_id", "text", "lang"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = language.wrong_labels(_p4_videos(spark, d), "video_id", "transcript", ["lang", "video_lang", "transcript_lang"], _p4_model(spark, d))
    return found.select("video_id", "field", "true_lang")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """How the models do on held-out documents, labels as delivered."""
    rows = _p4_model(spark, d)["report"]
    return spark.createDataFrame(rows, "lang string, sentences int, accuracy double, false_reject double, false_accept double")


def p4_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(_p4_videos(spark, d), "video_id", "transcript", _p4_model(spark, d))


# ---- 6: near-duplicate recipes

SIMILAR = 0.7  # set by the problem's statement


def _p6(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return neardup.similar(table(spark, d, "recipes_fixture"), "id", ["title", "ingredients", "steps"], SIMILAR)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.pairs(*_p6(spark, d))


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(*_p6(spark, d)).withColumnRenamed("key", "id")


P6_SQL = r"""
with one as (select id, max(list_sort(list_distinct(regexp_extract_all(lower(concat_ws(' ', coalesce(title, ''), coalesce(array_to_string(ingredients, ' '), ''), coalesce(array_to_string(steps, ' '), ''))), '[\p{L}\p{N}]+')))) as s from recipes_fixture where id is not null group by id),
t as (select id, len(s) as n, unnest(s) as w from one),
o as (select a.id as id_a, b.id as id_b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as o from t a join t b on a.w = b.w and a.id < b.id group by 1, 2)
select id_a, id_b from o where o >= 0.7 * (na + nb - o) - 1e-9
"""


P6_GROUPS_SQL = (
    P6_SQL[: P6_SQL.index("t as (")].replace("with one", "with recursive one")
    + r"""k as (select id, s, case when len(s) = 0 then id else min(id) over (partition by s) end as cls, case when len(s) = 0 then 1 else count(*) over (partition by s) end as n from one),
t as (select cls, len(s) as n, unnest(s) as w from k where id = cls),
o as (select a.cls as a, b.cls as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as o from t a join t b on a.w = b.w and a.cls < b.cls group by 1, 2),
l as (select a, b from o where o >= 0.7 * (na + nb - o) - 1e-9),
hop as (select a, b from l union select b, a from l),
reach(id, g) as (select a, least(a, min(b)) from hop group by a union select h.a, r.g from reach r join hop h on h.b = r.id where r.g < h.a)
select k.id, k.cls, k.n as n_copies, coalesce(d.n, 0) as n_links, coalesce(r.g, k.cls) as "group" from k
left join (select a, count(*) as n from hop group by a) d on d.a = k.cls left join (select id, min(g) as g from reach group by id) r on r.id = k.cls
"""
)


# ---- 7: evaluation texts in training text


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_pairs(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).distinct()


P7_SQL = r"""
with w as (select distinct doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' as t from documents),
i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as a from eval_items),
g as (select distinct item_id, ' ' || array_to_string(a[k : k + 11], ' ') || ' ' as p from (select item_id, a, unnest(range(1, len(a) - 10)) as k from i))
select distinct doc_id, item_id from w, g where contains(w.t, g.p)
"""

# ---- 8: mixing sources


def p8_draw(spark: SparkSession, d: str) -> DataFrame:
    return mixture.draw(mixture.solve(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    mix = mixture.solve(table(spark, d, "documents"), targets)
    return mixture.report(mix, mixture.draw(mix), targets)


def _p8_soft(spark: SparkSession, d: str) -> mixture.Mix:
    """The soft form: labels count 0.9, the classifier 0.1, and documents without a source take part by the classifier."""
    return mixture.solve(table(spark, d, "documents"), table(spark, d, "mix_targets"), label_trust=0.9, unlabelled=True)


def p8_soft_draw(spark: SparkSession, d: str) -> DataFrame:
    return mixture.draw(_p8_soft(spark, d))


def p8_soft_report(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the soft draw by label; documents without one are a row of their own."""
    mix = _p8_soft(spark, d)
    return mixture.report(mix, mixture.draw(mix), table(spark, d, "mix_targets"))


def p8_expected(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the soft form as expected under memberships, with the classifier's held-out accuracy."""
    mix = _p8_soft(spark, d)
    total = float(mix.expected.sum()) or 1.0
    rows = [(s, mix.targets.get(s), float(e) / total, mix.accuracy) for s, e in zip(mix.sources, mix.expected)]
    return spark.createDataFrame(rows, "source string, target_share double, expected_share double, classifier_accuracy double")


# ---- 9: long exact spans

SPAN = 300


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    matches, members = spans.shared(docs, SPAN, whole=False)
    return spans.pairs(matches, members, docs.select("doc_id", F.length("text").alias("n")), SPAN)


def p9_portions(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return spans.portions(docs, *spans.shared(docs, SPAN), SPAN)


P9_SQL = r"""
with g as (select distinct doc_id, md5(substr(text, k, 300)) as h from (select doc_id, text, unnest(range(1, length(text) - 298)) as k from documents)),
s as (select h from g group by h having count(*) > 1)
select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from g a join g b on a.h = b.h and a.doc_id < b.doc_id where a.h in (select h from s)
"""


P9_PORTIONS_SQL = r"""
with d as (select distinct doc_id, text from documents where doc_id is not null and text is not null),
g as (select doc_id, k, md5(substr(text, k, 300)) as h from (select doc_id, text, unnest(range(1, length(text) - 298)) as k from d)),
p as (select doc_id, k, lead(k) over (partition by doc_id order by k) - k as gap from g where h in (select h from g group by h having count(distinct doc_id) > 1)),
c as (select doc_id, cast(sum(least(300, coalesce(gap, 300))) as bigint) as n, count(*) filter (gap is null or gap > 300) as spans from p group by doc_id),
n as (select doc_id, max(length(text)) as n_chars from d group by doc_id)
select n.doc_id, n_chars, coalesce(c.n, 0) as shared_chars, coalesce(c.n, 0) / greatest(n_chars, 1) as share, coalesce(spans, 0) as spans from n left join c on c.doc_id = n.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_merged": P1_SQL, "p1_splits": P1_SPLITS_SQL, "p1_shares": P1_SHARES_SQL, "p2_found": P2_SQL, "p2_sampled": P2_SAMPLED_SQL, "p3_found": _p3_sql(P3_PAIRS), "p3_groups": _p3_sql("select field, form, key, value from s"), "p6_found": P6_SQL, "p6_groups": P6_GROUPS_SQL, "p7_found": P7_SQL, "p9_found": P9_SQL, "p9_portions": P9_PORTIONS_SQL}
