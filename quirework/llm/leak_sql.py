"""SQL of the search for leaked items, in the plain way: all five-word runs of all readings of every document.

Tags, marks and entities are taken out by patterns, not parsed; what is left of them would only interrupt a run.
"""

P7_FOUND = r"""
with t0 as (select doc_id, text as t from documents where text is not null),
t1 as (select doc_id, regexp_replace(regexp_replace(t, '(?is)<!--.*?-->|</?(?:a|abbr|b|big|code|del|em|font|i|ins|kbd|mark|q|s|small|span|strike|strong|sub|sup|tt|u|var)(?:\s[^<>]*)?/?>', '', 'g'), '<[^<>\n]+>', ' ', 'g') as t from t0),
t2 as (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\{\{[^{}]*\}\}', '', 'g'), '\[\[(?:[^\[\]|\n]*\|)*([^\[\]\n]*)\]\]', '\1', 'g'),
  '!?\[([^\[\]\n]*)\]\((?:https?://|mailto:|[/#.])[^)\s]*\)', '\1', 'g'), '\[https?://[^\s\]]+[ \t]([^\[\]\n]*)\]', '\1', 'g') as t from t1),
t3 as (select doc_id, regexp_replace(regexp_replace(replace(t, '&nbsp;', ' '), '&[a-z]+;', '', 'g'), '\\[a-z]+\*?|[{}*`\x{200b}-\x{200d}\x{2060}\x{feff}]|''{2,5}|__|~~', '', 'g') as t from t2),
l as (select doc_id, generate_subscripts(x, 1) as i, unnest(x) as line from (select doc_id, string_split(t, chr(10)) as x from t3)),
k as (select *, lower(trim(regexp_replace(trim(line), '^\d+\s{2,}|\s{2,}\d+$', ''))) as key from l),
f as (select *, count(*) over (partition by doc_id, key) as n from k
  where not regexp_matches(line, '(?i)^[ \t]*(?:[-—–\[][ \t]*\d{1,4}[ \t]*[-—–\]]|\d{1,4}(?:[ \t]*/[ \t]*\d{1,4})?|(?:pag\.?|page|seite|página|p\.)[ \t]*\d{1,4}(?:[ \t]+\w{2,3}[ \t]+\d{1,4})?)[ \t]*\r?$')),
-- lines that return are read as page furniture and as text
r as (select doc_id, 0 as reading, string_agg(line, chr(10) order by i) as t from f where n < 3 or length(line) <= 3 group by doc_id
  union all select doc_id, 1, string_agg(line, chr(10) order by i) from f group by doc_id),
c as (select doc_id, reading, j, case when j = 0 then t else regexp_replace(t, '([\p{L}])[-‐¬\x{ad}][ \t]*\r?\n\s*([\p{L}])', '\1\2', 'g') end as t from r, (values (0), (1)) v(j)),
w as (select doc_id, reading, j, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') as w from c),
g as (select distinct doc_id, array_to_string(w[q:q + 4], ' ') as gram from (select doc_id, w, unnest(range(1, len(w) - 3)) as q from w)),
iw as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from eval_items where text is not null),
ig as (select item_id, len(w) as n, q, array_to_string(w[q:q + 4], ' ') as gram from (select item_id, w, unnest(range(1, len(w) - 3)) as q from iw)),
hit as (select distinct item_id, doc_id, n, unnest(range(q, q + 5)) as at from ig join g using (gram))
select item_id, doc_id from hit group by item_id, doc_id, n having count(*) >= 0.4 * n"""
