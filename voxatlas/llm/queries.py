"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.llm import audit, decontamination, extraction, importance, jaccard, lines, packing, quality, rules, secrets, substrings, toxicity
from voxatlas.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_matrices(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_spans(table(spark, sf_dir, "documents"), with_text=False).drop("spans")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), size=3, percent=90).drop("row", "component_row")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("spans")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.evaluate(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("failed_rules")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    text = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = "filter(found, s -> s.kind <> 'markov')"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(found, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(F.array_join(F.expr(text.format(base)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(text.format("found")), ",").alias("spans"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"), extraction.drawn_model(spark))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_matrices": op7_token_matrices,
    "op8_secret_scan": op8_secret_scan,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
}

#: DuckDB: lines with their words, earlier lines by equality or by a variant with one word left out.
LINE_DEDUP_SQL = r"""
with lines as (
    select doc_id, text, pos - 1 as pos, [w for w in regexp_split_to_array(line, '[ \t\x0B\f\r]+') if w <> ''] as words, line
    from (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
),
worded as (select *, len(words) as n from lines where len(words) > 0),
firsts as (select words, n, min((doc_id, pos)) as first from worded group by words, n),
places as (select words, n, first, unnest(range(n)) as i from firsts where n >= 8),
variants as (select words, n, first, i, words[:i] || words[i + 2:] as v from places),
near as (
    select distinct a.words from variants a join variants b on a.v = b.v and a.i = b.i and a.n = b.n and b.first < a.first
    union select a.words from variants a join firsts b on a.v = b.words and b.n >= 8 and b.first < a.first
    union select b.words from variants a join firsts b on a.v = b.words and b.n >= 8 and a.first < b.first
),
judged as (
    select l.doc_id, l.pos, l.line, len(l.words) as n,
        len(l.words) > 0 and (f.first <> (l.doc_id, l.pos) or l.words in (select words from near)) as gone
    from lines l left join firsts f on l.words = f.words
)
select d.doc_id, case when d.text is null then null else coalesce(string_agg(j.line, chr(10) order by j.pos) filter (where not j.gone), '') end as text,
    count(*) filter (where j.n > 0) as n_lines, count(*) filter (where j.gone) as n_removed
from documents d left join judged j on d.doc_id = j.doc_id group by d.doc_id, d.text
"""

#: DuckDB: every window of 50 words as text, the least document of each.
SUBSTRING_SQL = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as k from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from docs)),
firsts as (select k, min(doc_id) as m from windows group by k),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from windows join firsts using (k) where m < doc_id),
words as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from docs),
kept as (
    select w.doc_id, count(g.p) as n_removed, string_agg(word, ' ' order by w.p) filter (where g.p is null) as text
    from words w left join gone g on w.doc_id = g.doc_id and w.p = g.p group by w.doc_id
)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join kept k using (doc_id)
"""

#: DuckDB: shared shingles counted for each pair, components by recursion.
JACCARD_SQL = r"""
with recursive docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
shingles as (
    select distinct doc_id, array_to_string(ws[i:i + 2], ' ') as s from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) as i from docs where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    where least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 90
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))
),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (select doc_id, doc_id from docs union select r.a, l.b from reach r join both_ways l on l.a = r.b)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, min(r.b) as component_id
from docs d left join sizes s using (doc_id) join reach r on r.a = d.doc_id group by all
"""

#: DuckDB: windows of the items and of the documents as text.
DECONTAMINATION_SQL = r"""
with items as (select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
windows as (select distinct item, n, array_to_string(ws[i:i + n - 1], ' ') as k from (select item, ws, n, unnest(range(1, len(ws) - n + 2)) as i from (select *, least(13, len(ws)) as n from items where len(ws) > 0))),
places as (
    select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as k
    from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from docs, (select distinct n from windows) where len(ws) >= n)
),
found as (select p.doc_id, p.i, p.n, w.item from places p join windows w on p.n = w.n and p.k = w.k),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
own as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from found) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from docs d left join hits using (doc_id) left join own using (doc_id)
"""


#: DuckDB: crc32 from its table of 256 entries, words by words; gains, noise and ranks as stated.
IMPORTANCE_SQL = r"""
with recursive steps as (
    select i::bigint as i, i::bigint as c, 0 as turn from range(256) t(i)
    union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, turn + 1 from steps where turn < 8
),
crc_table as (select list(c order by i) as crcs from steps where turn = 8),
docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
target as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
raw_words as (select w, count(*) as n from (select unnest(ws) as w from docs) group by w),
target_words as (select w, count(*) as n from (select unnest(ws) as w from target) group by w),
hexed as (select w, hex(encode(w)) as h from (select w from raw_words union select w from target_words)),
hashed as (
    select w, xor(list_reduce([('0x' || h[2 * j - 1:2 * j])::bigint for j in range(1, len(h) // 2 + 1)], lambda crc, b: xor(crc >> 8, crcs[xor(crc & 255, b) + 1]), 4294967295::bigint), 4294967295) % 10000 as bucket
    from hexed, crc_table
),
raw_counts as (select bucket, sum(n)::double as s from raw_words join hashed using (w) group by bucket),
target_counts as (select bucket, sum(n)::double as t from target_words join hashed using (w) group by bucket),
sums as (select (select coalesce(sum(s), 0) from raw_counts) as s_all, (select coalesce(sum(t), 0) from target_counts) as t_all),
gains as (
    select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as gain
    from raw_counts left join target_counts using (bucket), sums
),
word_gains as (select w, gain from hashed join gains using (bucket)),
weights as (select doc_id, sum(gain)::bigint as weight from (select doc_id, unnest(ws) as w from docs) join word_gains using (w) group by doc_id),
scored as (
    select doc_id, len(ws)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint as score
    from docs left join weights using (doc_id)
),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select s.doc_id, n_features, weight, score, case when place <= (10 * n) // 100 then place end as rank from scored s left join placed p using (doc_id)
"""


#: DuckDB: every filter judged, every order of them applied from left to right.
AUDIT_SQL = r"""
with docs as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
firsts as (select text, min(doc_id) as first_id from docs group by text),
judged as (
    select part, coalesce(quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic, {
        'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws), 'C': 100 * len(regexp_replace(docs.text, '[^A-Z]', '', 'g')) > 5 * len(docs.text),
        'D': regexp_matches(docs.text, '[#$%&*|]'), 'E': docs.doc_id > first_id} as f
    from docs join firsts using (text) left join labels l on l.doc_id = docs.doc_id
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
flagged as (select part, good, toxic, f, [k for k in ['A', 'B', 'C', 'D', 'E'] if (case k when 'A' then f.A when 'B' then f.B when 'C' then f.C when 'D' then f.D else f.E end)] as fails from judged),
grouped as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from flagged group by part, fails),
steps as (select filter_order, step, filter_order[step] as x, filter_order[:step - 1] as before from orders, range(1, 6) t(step)),
counted as (
    select part, filter_order, step::int as step, x,
        sum(case when len([k for k in fails if contains(before || x, k)]) = 0 then n else 0 end)::bigint as kept,
        sum(case when list_contains(fails, x) and len([k for k in fails if contains(before, k)]) = 0 then n else 0 end)::bigint as removed,
        sum(case when list_contains(fails, x) and len([k for k in fails if contains(before, k)]) > 0 then n else 0 end)::bigint as redundant,
        sum(case when fails = [x] then n else 0 end)::bigint as unique_fails,
        sum(case when list_contains(fails, x) and len([k for k in fails if contains(before, k)]) = 0 then good else 0 end)::bigint as good_lost,
        sum(case when list_contains(fails, x) and len([k for k in fails if contains(before, k)]) = 0 then toxic else 0 end)::bigint as toxic_lost
    from grouped, steps group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, x))::bigint as shapley from counted
"""


def _rules_sql() -> str:
    """DuckDB: the measures, then the same table of thresholds."""
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in rules.STOP_WORDS.values() for w in words}))
    bounds = " and ".join(f"{name} {op} {value}" for name, least, most in rules.RULES for op, value in ((">=", least), ("<=", most)) if value is not None)
    return rf"""
with docs as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
        [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines from documents
),
triples as (select doc_id, i, md5(array_to_string(ws[i:i + 2], ' ')) as k from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from docs)),
again as (select doc_id, k from triples group by doc_id, k having count(*) > 1),
marked as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 3)) as p from triples join again using (doc_id, k)) group by doc_id),
measured as (
    select d.doc_id, len(ws)::bigint as n_words, len(array_to_string(ws, ''))::bigint as word_chars, len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(m.n, 0)::bigint as n_repeat_words, len(lines) as n_lines, len(list_distinct(ws)) as n_distinct,
        len([w for w in ws if w in ({stops})]) as n_stops, len(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper, len(regexp_replace(text, '[^!?]', '', 'g')) as n_marks
    from docs d left join marked m using (doc_id)
),
ratios as (
    select *, greatest(n_words, 1) as w, word_chars / w as mean_word_chars, n_symbols / w as symbol_ratio, n_dup_lines / greatest(n_lines, 1) as dup_line_ratio,
        n_upper / greatest(word_chars, 1) as upper_ratio, n_marks / w as mark_ratio, n_distinct / w as distinct_word_ratio, n_stops / w as stop_word_ratio, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {bounds} as kept from ratios
"""


ORACLE_SQL = {
    "op4_substring_dedup": SUBSTRING_SQL,
    "op5_jaccard_join": JACCARD_SQL,
    "op6_quality_rules": _rules_sql(),
    "op9_decontamination": DECONTAMINATION_SQL,
    "op10_line_dedup": LINE_DEDUP_SQL,
    "op12_importance_resampling": IMPORTANCE_SQL,
    "op13_filter_audit": AUDIT_SQL,
}
