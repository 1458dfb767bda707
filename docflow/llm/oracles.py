"""SQL for the queries that SQL can express, written for the tables as views."""

from __future__ import annotations

from docflow.llm import quality_rules as q

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS = f"""
with w as (select doc_id, {WORDS.format(text="text")} as ws from documents),
win as (select doc_id, i as pos, array_to_string(ws[i : i + 12], ' ') as k from w, unnest(range(1, len(ws) - 11)) t(i)),
firsts as (select k, min(doc_id) as low from win group by k),
gone as (
  select distinct win.doc_id, p as pos
  from win join firsts on win.k = firsts.k and firsts.low < win.doc_id, unnest(range(win.pos, win.pos + 13)) t(p)
),
word as (select doc_id, i as pos, ws[i] as word from w, unnest(range(1, len(ws) + 1)) t(i)),
kept as (
  select doc_id, string_agg(word, ' ' order by pos) as text, count(*) as n
  from word anti join gone using (doc_id, pos) group by doc_id
)
select w.doc_id, len(ws) as n_words, len(ws) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
"""

def _jaccard(size: int, percent: int, more: str = "") -> str:
    return f"""
with recursive w as (select doc_id, {WORDS.format(text=LOWER)} as ws from documents),
sh as (
  select distinct doc_id, array_to_string(ws[i : i + {size - 1}], ' ') as s from w, unnest(range(1, len(ws) - {size - 2})) t(i)
  union all
  select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and {size - 1}
),
size as (select doc_id, count(*) as n from sh group by doc_id),
pair as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by all
),
link as (
  select x, y from pair join size a on a.doc_id = x join size b on b.doc_id = y where 100 * c >= {percent} * (a.n + b.n - c)
),
reach as (select x, y from link union select r.x, l.y from reach r join link l on r.y = l.x),
low as (select x, min(y) as y from reach group by x)
select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(low.y, w.doc_id)) as component_id{more}
from w left join size using (doc_id) left join low on low.x = w.doc_id
"""


def _rules() -> str:
    rules = " union all ".join(
        f"select lang, source, '{name}' as rule, {q.bucket(f'({value})')} as bucket from counted" for name, (value, _) in q.RULES.items()
    )
    low = "case rule " + " ".join(f"when '{name}' then {low:e}" for name, (_, low) in q.RULES.items()) + " end"
    within = " and ".join(f"{value} <= max_{name}" for name, (value, _) in q.RULES.items())
    picked = ", ".join(f"max(case when rule = '{name}' then edge end) as max_{name}" for name in q.RULES)
    fence = f"(select high + {q.FENCE} * (high - mid) from (select {q.bucket_value('m')} as mid, {q.bucket_value('h')} as high))"
    at = "min(case when upto >= total * {share} then bucket end)"

    def fences(keys: str, table: str) -> str:
        return f"""
  select {keys} rule, {fence} as fence, n from (
    select {keys} rule, max(total) as n, {at.format(share=0.5)} as m, {at.format(share=0.75)} as h from (
      select *, sum(n) over (partition by {keys} rule order by bucket) as upto, sum(n) over (partition by {keys} rule) as total from {table}
    ) group by all
  )"""

    return f"""
with w as (select doc_id, lang, source, coalesce(text, '') as text, {WORDS.format(text="text")} as ws from documents),
win as (select doc_id, i as pos, array_to_string(ws[i : i + 2], ' ') as k from w, unnest(range(1, len(ws) - 1)) t(i)),
twice as (select doc_id, k from win group by all having count(*) > 1),
rep as (
  select doc_id, count(distinct p) as n from (
    select win.doc_id, unnest(range(win.pos, win.pos + 3)) as p from win semi join twice using (doc_id, k)
  ) group by doc_id
),
line as (select doc_id, unnest(string_split(text, chr(10))) as line from w),
dup as (
  select doc_id, count(*) as n, count(*) - count(distinct line) as d from line
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
),
counted as (
  select w.doc_id, lang, source, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(d, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
    coalesce(dup.n, 0) as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper
  from w left join rep using (doc_id) left join dup using (doc_id)
),
fine as (select lang, source, rule, bucket, count(*) as n from ({rules}) group by all),
own as ({fences("lang, source,", "fine")}),
weighed as (
  select rule, fence, sum(least(n, total - n)) as weight
  from own join (select rule, sum(n) as total from fine group by rule) using (rule) group by rule, fence
),
top as (
  select rule, min(fence) as fence from (
    select rule, fence, sum(weight) over (partition by rule order by fence) as upto, sum(weight) over (partition by rule) as of_all from weighed
  ) where 2 * upto >= of_all group by rule
),
edges as (
  select lang, source, rule, greatest({low}, least(own.fence, {q.LEEWAY} * greatest({low}, top.fence))) as edge
  from own join top using (rule)
),
limits as (select lang, source, {picked} from edges group by lang, source),
judged as (
  select c.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {within} as fine
  from counted c join limits l on c.lang is not distinct from l.lang and c.source is not distinct from l.source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and fine as kept from judged
"""


SQL = {
    "op3_adaptive_rules": _rules(),
    "op5_pivot_regions": _jaccard(5, 75),
    "op6_relative_lempel_ziv": SUBSTRINGS,
    "op12_one_permutation_minhash": _jaccard(4, 80, ", w.doc_id = component_id as kept"),
}
