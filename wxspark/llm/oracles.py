"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
iw as (
  select distinct item_id, array_to_string(list_slice(w, s, s + 9), ' ') as win, least(len(w), 10) as n
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as s from b where len(w) > 0)
),
dw as (
  select r, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') as win
  from (
    select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as s
    from d, (select distinct n from iw) where len(w) >= n
  )
),
hit as (select distinct r, s, n, item_id from dw join iw using (win, n)),
words as (
  select r, count(distinct p) as n_hit
  from (select r, unnest(generate_series(s, s + n - 1)) as p from (select distinct r, s, n from hit)) group by r
),
items as (
  select r, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct r, cast(item_id as varchar) as i from hit where item_id is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""

_LINE_WORDS = r"regexp_extract_all(l, '[^\x20\x09-\x0D]+')"

OP5 = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
),
grams as (
  select r, i, [w[i], w[i + 1], w[i + 2]] as g
  from (select r, w, unnest(generate_series(1, len(w) - 2)) as i from d where len(w) >= 3)
),
twice as (select r, g from grams group by r, g having count(*) > 1),
repeats as (
  select r, count(distinct p) as n
  from (select r, unnest([i, i + 1, i + 2]) as p from grams join twice using (r, g)) group by r
),
lines as (
  select r, l, len({_LINE_WORDS}) as n, len(list_distinct({_LINE_WORDS})) as k
  from (select r, unnest(string_split(t, chr(10))) as l from d)
  where regexp_matches(l, '[^\x20\x09-\x0D]')
),
judged as (
  select r, l, n,
    regexp_matches(l, '( [|»›·] .*){{2,}}|^\s*([|»›·•>-]\s*)+$')
    or 100 * (length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g'))) > 5 * length(l)
    or (n > 8 and regexp_matches(l, '^\P{{Ll}}*\p{{Lu}}\P{{Ll}}*\p{{Lu}}\P{{Ll}}*$'))
    or regexp_matches(l, '\p{{Lu}}!!')
    or (n >= 10 and 3 * k < n)
    or (n <= 8 and regexp_matches(l, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie policy|click here|sign in|log in|subscribe to|enable javascript|skip to (main )?content|powered by|back to top)\b'))
    or (n <= 8 and not regexp_matches(l, '[.!?:;"''”’)…。！？]\s*$')) as bad
  from lines
),
per as (
  select r, count(*) as n_lines, count(distinct l) as k, count(*) filter (where bad) as removed,
    coalesce(sum(n) filter (where not bad), 0) as left_words
  from judged group by r
),
figures as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_lines - k, 0) as bigint) as n_dup_lines,
    cast(coalesce(repeats.n, 0) as bigint) as n_repeat_words,
    cast(coalesce(removed, 0) as bigint) as n_lines_removed,
    cast(len(w) - coalesce(left_words, 0) as bigint) as n_words_lost
  from d left join repeats using (r) left join per using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * n_words_lost <= 20 * n_words as kept,
  n_lines_removed, n_words_lost
from figures
"""

OP7 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from d where len(w) > 0)
),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (
  select x, y from p join n u on u.doc_id = x join n v on v.doc_id = y where 100 * c >= 85 * (u.n + v.n - c)
),
both_ways as (select x, y from e union all select y, x from e),
r as (select doc_id as x, doc_id as y from d union select r.x, b.y from r join both_ways b on r.y = b.x),
groups as (select x, min(y) as least from r group by x)
select doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least as component_id, doc_id = least as kept
from d left join n using (doc_id) join groups on x = doc_id
"""

OP12 = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
),
t as (select r, lang, source, unnest(w) as term from d),
k as (select lang, term, count(*) as lang_n from t group by lang, term having count(distinct r) >= 30),
v as (select lang, count(*) as v, sum(lang_n) as lang_total from k group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t join k using (lang, term) group by lang, source, term),
gn as (select g.lang, g.source, coalesce(sum(c.n), 0) as total from g left join c using (lang, source) group by g.lang, g.source),
p as (
  select gn.lang, gn.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (gn.total + 5 * v.v) as p,
    1 + (1000000000::hugeint * (k.lang_n + 5)) // (v.lang_total + 5 * v.v) as q
  from gn join k using (lang) join v using (lang) left join c using (lang, source, term)
),
apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source
),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, p - q from p where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50
"""

ORACLES: dict[str, str] = {"op4_decontamination": OP4, "op5_line_rules": OP5, "op7_near_duplicates": OP7, "op12_divergence": OP12}
