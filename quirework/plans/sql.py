"""DuckDB SQL of the core queries, written apart from the operators."""

from __future__ import annotations

from quirework.functions.tokens import TOKEN_RE2, token_sql
from quirework.plans.clean_sql import CLEAN_BLOCKS

_WS = r"[\s\p{Z}\x1c-\x1f\x{85}]"


def _hex(column: str) -> str:
    return f"ltrim(lower(replace(lower({column}), 'sha1:', '')), '0')"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _pct(part: str, total: str) -> str:
    return f"case when {total} > 0 then round_even({part}::DOUBLE / {total} * 100, 2) else 0.0 end"


def _lines(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({x}, '\\r\\n|\\r|[\\n\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda l: {_strip('l')}), lambda l: l <> '')"


_STATE = f"""
scan as (
  select doc_id, {_hex('content_hash')} as content, {_hex('processing_signature')} as signature
  from folder_scan where content_hash is not null
  qualify row_number() over (partition by doc_id order by seen_at desc, loaded_at desc, content_hash desc, processing_signature desc) = 1
), done as (
  select distinct run_id, doc_id from run_manifest where error is null and reused = false
), last as (
  select h.doc_id, {_hex('h.content_hash')} as content, {_hex('h.processing_signature')} as signature
  from doc_hashes h join done using (run_id, doc_id)
  qualify row_number() over (partition by h.doc_id order by run_id desc, generated_at_utc desc, version desc, content_hash desc, processing_signature desc) = 1
), decided as (
  select s.doc_id, l.doc_id is not null as same from scan s left join last l
    on s.doc_id = l.doc_id and s.content is not distinct from l.content and s.signature is not distinct from l.signature
)"""

_P95 = "list_sort(list({0}))[greatest(1, 95 * count({0}) // 100)]"
_SIZES = "count({0}) as count, min({0}) as min, median({0}) as median, " + _P95 + " as p95, max({0}) as max, round_even(avg({0}), 2) as avg"

_BLOCKS = """
b0 as (
  select doc_id, pos, text, block_type, page_refs, heading_level from blocks
  qualify row_number() over (partition by doc_id, pos order by row_id) = 1
)"""

_ART_LINE = rf"(?i)^{_WS}*(?:#{_WS}*)?(?:ARTICLE|ARTICOLO|ART\.?){_WS}*[-.:]?{_WS}*(\d+(?:\.\d+)*)\b(.*)$"
_ART_START = rf"(?i)^{_WS}*(?:#{_WS}*)?(?:article|articolo|art\.?){_WS}*[-.:]?{_WS}*(\d+(?:\.\d+)*)\b"
_SECTION = (
    rf"(?i)^{_WS}*(?:#{_WS}*)?((?:SECTION|SEZIONE|PART|CHAPTER|CAPO|TITOLO){_WS}+[IVXLC0-9]+.*|(?:\d+\.)+{_WS}+.*"
    rf"|GENERAL SECTION.*|(?:SCHOLARSHIP|BORSA|ACCOMODATION|ACCOMMODATION)\b.*)$"
)

_STRUCTURE = (
    "with "
    + _BLOCKS
    + f""", b1 as (
  select *, {_strip('text')} as line, heading_level is not null as heading from b0 where {_strip('text')} <> ''
), b2 as (
  select *,
    case when regexp_matches(line, '{_SECTION}') then {_strip(f"regexp_extract(line, '{_SECTION}', 1)")} end as sec,
    case when regexp_matches(line, '{_ART_LINE}') and (heading or ((length(line) <= 140 or (upper(line) = line and lower(line) <> line))
      and len(regexp_extract_all(line, '(?i)\\b(?:ART\\.?|ARTICLE|ARTICOLO)\\b')) <= 1)) then regexp_extract(line, '{_ART_LINE}', 1) end as num
  from b1
), b3 as (
  select *, split_part(num, '.', 1) as art,
    coalesce(case when heading and regexp_matches(regexp_extract(line, '{_ART_LINE}', 2), '\\((\\d+(?:\\.\\d+)?)\\)')
                  then regexp_extract(regexp_extract(line, '{_ART_LINE}', 2), '\\((\\d+(?:\\.\\d+)?)\\)', 1) end,
             case when contains(num, '.') then num end) as sub,
    case when not regexp_matches(line, '{_ART_LINE}') and regexp_matches(line, '^{_WS}*(\\d+\\.\\d+)\\b')
         then regexp_extract(line, '^{_WS}*(\\d+\\.\\d+)\\b', 1) end as dotted
  from b2
), b4 as (
  select *, last_value(sec ignore nulls) over w as section, last_value(art ignore nulls) over w as article from b3
  window w as (partition by doc_id order by pos rows between unbounded preceding and current row)
), b5 as (
  select *, case when num is not null then coalesce(sub, chr(1)) when starts_with(dotted, article || '.') then dotted end as event from b4
), b6 as (
  select *, nullif(last_value(event ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and current row), chr(1)) as subarticle from b5
), state as (
  select *, (section is distinct from lag(section) over w) or (article is distinct from lag(article) over w) or (subarticle is distinct from lag(subarticle) over w) as changed
  from b6 window w as (partition by doc_id order by pos)
)"""
)

_ART_IN = rf"(?i)\b(?:article|articolo|art\.?){_WS}*[-.:]?{_WS}*(\d+(?:\.\d+)*)\b"
_SEC_IN = rf"(?i)\b(?:section|sezione){_WS}+[IVXLC0-9]+\b"
_TOC_ENTRY = rf"(?i)^(?:#{_WS}*)?(?:art\.?|article|articolo){_WS}*\d+(?:\.\d+)?\b.*\b\d{{1,3}}{_WS}*$"
_TOC_NUMBERED = rf"(?i)^{_WS}*(?:\d+(?:\.\d+){{0,4}})(?:\.?{_WS}+|[.:])\S.*{_WS}+\d{{1,3}}{_WS}*$"
_TAIL = rf"\b\d{{1,3}}{_WS}*$"
#: RE2's word boundary knows ASCII only, so the end of the word is spelled out.
_STUB = rf"(?i)^{_WS}*(?:#{_WS}*)?(?:art|article|articolo|section|sezione)(?:[^\p{{L}}\p{{N}}_]|$)"
_TOC_WORD = r"(?i)\b(?:summary|sommario|indice|table of contents)\b"


def _hits(lines: str, pattern: str) -> str:
    return f"len(list_filter({lines}, lambda l: regexp_matches(l, '{pattern}')))"


_YEAR_SPAN = rf"(20\d{{2}}){_WS}*[/_\-]{_WS}*(\d{{2,4}})\b"
_AY = rf"(?i)\bA\.?{_WS}*Y\.?{_WS}*{_YEAR_SPAN}"


def _span(p: str) -> str:
    a, b = (f"regexp_extract(text, '{p}', {i})" for i in (1, 2))
    return f"""case when regexp_matches(text, '{p}') then {a} || '-' || (case when length({b}) = 2 then
      (case when ({a}::INT // 100) * 100 + {b}::INT < {a}::INT then ({a}::INT // 100) * 100 + {b}::INT + 100 else ({a}::INT // 100) * 100 + {b}::INT end)
      else try_cast({b} as INT) end)::VARCHAR end"""


_ROOTS = (
    f"list_distinct(list_transform(list_filter({_lines('text')}, lambda l: regexp_matches(l, '{_ART_START}')),"
    f" lambda l: split_part(regexp_extract(l, '{_ART_START}', 1), '.', 1)))"
)
_HTML, _MATH, _LATEX = r"(?i)</?(?:table|tr|td|th)\b", r"\$[^$\n]+\$", r"\\[()\[\]]|\\[A-Za-z]+"
_BOOK = r"(?i)errore\.\s*il\s+(?:segnalibro|segnalbro)\s+non\s+[^\n]*?definit[oa]"

_COUNTED = (
    "with d as (select doc_key as doc_id, max({'year': year, 'name': name}) as doc from documents group by 1), c as ("
    f" select c.*, coalesce(token_count, 0) as n, {_ROOTS.replace('text', 'c.text')} as roots, metadata as m, d.doc from chunks c left join d using (doc_id)"
    "), k as (select count(*) as chunks, count_if(n < 20)::BIGINT as small, count_if(n < 50)::BIGINT as moderate, count_if(n > 520)::BIGINT as oversized,"
    " count_if(n between 20 and 520)::BIGINT as in_range,"
    f" count_if(regexp_matches(text, '{_HTML}'))::BIGINT as html, count_if(regexp_matches(text, '{_MATH}'))::BIGINT as inline_math,"
    f" count_if(regexp_matches(text, '{_LATEX}'))::BIGINT as latex, count_if(regexp_matches(text, '{_BOOK}'))::BIGINT as bookmark,"
    " count_if(coalesce(len(page_refs), 0) = 0)::BIGINT as empty_refs, count_if(page_start is null or page_end is null)::BIGINT as missing_range,"
    " count_if(page_start > page_end)::BIGINT as invalid_range, count_if(len(roots) >= 2)::BIGINT as mixed_article,"
    " count_if(coalesce(m.article, '') <> '' and len(roots) > 0 and not list_contains(roots, m.article))::BIGINT as article_mismatch,"
    + ", ".join(f" count_if(coalesce(m.{f}, '') = '')::BIGINT as missing_{f}" for f in ("year", "name", "brief_description", "language_hint", "section", "article", "subarticle"))
    + ", "
    + ", ".join(f" count_if(coalesce(m.{f}, '') <> '' and coalesce(doc.{f}, '') <> '' and m.{f} <> doc.{f})::BIGINT as {f}_differs" for f in ("year", "name"))
    + " from c)"
)


def _p(c: str) -> str:
    return _pct(c, "chunks")


_SCORED = f""", s as (select
  greatest(0.0, 100 - {_p('oversized')} * 2 - {_p('small')} * 0.6::DOUBLE) as a,
  greatest(0.0, 100 - {_p('html')} * 3 - {_p('inline_math')} * 2 - {_p('latex')} * 2.5::DOUBLE - {_p('bookmark')} * 5) as b,
  greatest(0.0, 100 - (({_p('missing_year')} + {_p('missing_name')} + {_p('missing_brief_description')} + {_p('missing_language_hint')}) * 0.15::DOUBLE
    + ({_p('missing_section')} + {_p('missing_article')}) * 0.2::DOUBLE + {_p('article_mismatch')} * 1.2::DOUBLE + ({_p('year_differs')} + {_p('name_differs')}) * 2)) as c,
  greatest(0.0, 100 - ({_p('empty_refs')} + {_p('missing_range')}) * 3 - {_p('invalid_range')} * 8) as d from k),
t as (select *, round_even(a * 0.3::DOUBLE + b * 0.2::DOUBLE + c * 0.3::DOUBLE + d * 0.2::DOUBLE, 2) as overall from s)
select round_even(a, 2) as size_score, round_even(b, 2) as cleanliness_score, round_even(c, 2) as metadata_score, round_even(d, 2) as provenance_score,
  overall as overall_score, case when overall >= 90 then 'excellent' when overall >= 75 then 'good' when overall >= 60 then 'warning' else 'critical' end as status from t"""


def _gates(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nunion all ".join(f"select '{n}' as name, ({a})::DOUBLE as actual, {e}::DOUBLE as expected, ({a}) {op} {e} as passed from k" for n, a, op, e in rows)


_META_LINE = """'meta: ' || concat_ws(' | ', 'doc=' || trim(coalesce(metadata.name, '')), 'year=' || {y}, 'section=' || case when length({s}) <= 96 then {s} end,
  'article=' || {a}, 'subarticle=' || {u})"""


def _value(c: str) -> str:
    v = _strip(f"metadata.{c}")
    return f"case when {v} <> '' and lower({v}) not in ('n/a', 'front_matter') then {v} end"


def _words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{_WS}+'), lambda w: w <> ''))"


_KEY = "replace(lower(" + _squeeze("coalesce(text, '')") + "), 'ß', 'ss')"

_PAGE = """
with r as (select row_id, list_transform(list_distinct(list_filter(page_refs, lambda x: x.page_idx >= 0)),
  lambda x: {'p': x.page_idx + 1, 'q': coalesce(x.block_position, ''), 'i': coalesce(x.block_id, '')}) as r from segments)
select row_id, list_min(list_transform(r, lambda x: x.p))::INT as page_start, list_max(list_transform(r, lambda x: x.p))::INT as page_end,
  array_to_string(list_transform(list_sort(r), lambda x: x.p || ':' || x.q || ':' || x.i), ',') as refs from r"""

_MD = rf"""
with l as (select doc_id::VARCHAR as doc_id, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) as raw, generate_subscripts(regexp_split_to_array(text, '\r\n|\r|\n'), 1) - 1 as line from documents),
m as (select doc_id, line, regexp_replace(raw, '{_WS}+$', '') as raw from l),
n as (select *, regexp_matches(raw, '^{_WS}*(#{{1,6}}){_WS}+(.*)$') as h, {_strip('raw')} = '' as blank from m where not regexp_matches(raw, '^{_WS}*!\[[^\]]*\]\([^)]*\){_WS}*$')),
o as (select *, sum((h or blank)::INT) over (partition by doc_id order by line) as par from n)
select doc_id, line::INT as pos, {_strip(f"regexp_extract(raw, '^{_WS}*(#{{1,6}}){_WS}+(.*)$', 2)")} as text, 'title' as block_type,
  length(regexp_extract(raw, '^{_WS}*(#{{1,6}}){_WS}+(.*)$', 1))::INT as heading_level from o where h
union all
select doc_id, min(line)::INT as pos, {_strip("string_agg(raw, chr(10) order by line)")} as text, 'text' as block_type, null::INT as heading_level
from o where not h and not blank group by doc_id, par"""

_COVERAGE = """
with s as (select distinct doc_key as doc_id, unnest(list_distinct(string_split(regexp_replace(text, '[\\s\\p{Z}]', '', 'g'), ''))) as ch from documents),
c as (select distinct doc_id, unnest(list_distinct(string_split(regexp_replace(text, '[\\s\\p{Z}]', '', 'g'), ''))) as ch from chunks),
j as (select s.doc_id, count(*) as n, count(c.ch) as k from s left join c on c.doc_id = s.doc_id and c.ch = s.ch where s.ch <> '' group by 1)
select d.doc_id, coalesce(n, 0) as source_chars, coalesce(k, 0) as covered_chars, coalesce(k::DOUBLE / n, 0) as coverage
from (select distinct doc_key as doc_id from documents where text is not null) d left join j using (doc_id)"""


def _glued(a: str, b: str) -> str:
    """Two segments as one, with the fields of the first."""
    text = f"regexp_replace({a}.t, '{_WS}+$', '') || chr(10) || chr(10) || regexp_replace({b}.t, '^{_WS}+', '')"
    return f"case when {a} is not null then struct_pack(n := {a}.n, t := {text}, s := {a}.s, a := {a}.a, b := {a}.b, z := {token_sql('(' + text + ')')}) end"


def _may(a: str, b: str) -> str:
    """Whether the structures of two segments allow a merge."""
    same = f"({a}.s is not distinct from {b}.s and {a}.a is not distinct from {b}.a and {a}.b is not distinct from {b}.b)"
    article = f"coalesce({a}.a, '') || coalesce({b}.a, '') <> ''"
    return f"({same} or case when {article} then coalesce({a}.a, '') = coalesce({b}.a, '') else coalesce({a}.s, '') <> '' and {a}.s is not distinct from {b}.s end)"


_OPENS = r"^(?:Table:|#|- |\* |\p{Lu}|\p{Nd})"
# Windows of 350 matches (400 where the rest fits), the next one from at most 25 matches and 30 characters before the end.
_SPLIT = f"""
with recursive part as (select doc_id, text, regexp_extract_all(text, '{TOKEN_RE2}|{_WS}+') as p from documents where text is not null),
ends as (select doc_id, j, x, sum(length(x)) over (partition by doc_id order by j)::BIGINT as b from (select doc_id, generate_subscripts(p, 1) as j, unnest(p) as x from part)),
tok as (select doc_id, list(b - length(x) order by j) as a, list(b order by j) as b from ends where not regexp_matches(x, '^{_WS}') group by doc_id),
doc as (select doc_id, text, a, b, len(a) as n from part join tok using (doc_id)),
w as (
  select doc_id, 0 as no, 0 as lo, case when n <= 400 then n else 350 end as hi from doc
  union all
  select doc_id, no, lo, case when n - lo <= 400 then n else lo + 350 end from (
    select doc_id, no + 1 as no, n, coalesce(list_filter(near, lambda i: regexp_matches(substr(text, a[i + 1] + 1, 64), '{_OPENS}'))[1], near[1], hi) as lo from (
      select w.*, d.text, d.a, d.n, list_filter(range(greatest(w.lo + 1, w.hi - 25), w.hi), lambda i: d.b[w.hi] - d.a[i + 1] <= 30) as near
      from w join doc d on d.doc_id = w.doc_id where w.hi < d.n))
), raw as (select w.*, n, {_strip("substr(text, a[lo + 1] + 1, b[hi] - a[lo + 1])")} as t from w join doc using (doc_id)),
head as (select *, length(regexp_extract(left(t, 220), '(?s)^.*?[.!?;:]{_WS}+')) as h from raw),
cut as (select *, regexp_replace(substr(t, h + 1), '^{_WS}+', '') as rest from head),
piece as (select doc_id, no, case when no > 0 and not regexp_matches(t, '{_OPENS}') and h > 0 and length(rest) >= 24 then rest else t end as t from cut),
tail as (select *, lag(t) over v as was, no > 0 and no = max(no) over (partition by doc_id) as ends, lead(t) over v as nxt, lead(no) over v = max(no) over (partition by doc_id) as before from piece window v as (partition by doc_id order by no)),
glue as (select *, case when ends then was || chr(10) || chr(10) || t when before then t || chr(10) || chr(10) || nxt end as both_, case when ends then t when before then nxt end as final from tail),
fits as (select *, coalesce({token_sql('final')} < 58 and {token_sql('both_')} <= 400, false) as fit from glue)
select doc_id, no::INT as piece_no, case when before and fit then both_ else t end as text from fits where not (ends and fit)"""


ORACLES = {
    "p3_found": f"with {_STATE} select doc_id from decided where not same",
    "incremental_split": f"with {_STATE} select doc_id, case when same then 'reuse' else 'process' end as action from decided",
    "run_summary": """with m as (select distinct run_id, doc_id, source_mode_used, reused, error from run_manifest)
select run_id, source_mode_used, count(*) as results, count_if(reused)::BIGINT as reused, count_if(error is not null)::BIGINT as errors from m group by 1, 2""",
    "token_counts": f"select row_id, {token_sql('text')} as tokens from chunks",
    "chunk_size_report": f"""
with t as (select lang, len(regexp_extract_all(text, '{TOKEN_RE2}')) as n from documents),
w as (select lang, n, unnest(range(0, n, 325)) as s from t where n > 0),
c as (select lang, ((12 * least(350, n - s) + 5) // 10)::INT as x from w)
select lang, {_SIZES.format('x')}, {_pct('count_if(x < 50)', 'count(x)')} as small_pct from c group by lang""",
    "chunk_sizes": f"with c as (select doc_id, {token_sql('text')} as x from chunks) select doc_id, {_SIZES.format('x')} from c group by doc_id",
    "paragraph_blocks": _MD,
    "bookmark_noise": rf"""select row_id, regexp_replace(regexp_replace(text,
 '(?i){_WS}*errore\.{_WS}*il{_WS}+(?:segnalibro|segnalbro){_WS}+non{_WS}+[^\n]*?definit[oa]\.?{_WS}*', ' ', 'g'), '<[^>\n]+>', ' ', 'g') as text from blocks""",
    "folder_titles": f"""select distinct source_folder, {_squeeze("replace(regexp_replace(regexp_replace(regexp_extract(source_folder, '([^/]+)$', 1), '(?i)-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$', ''), '[.]pdf$', ''), '_', ' ')")} as title from folder_scan""",
    "year_extract": rf"select doc_id, coalesce({_span(_AY)}, {_span(chr(92) + 'b' + _YEAR_SPAN)}, nullif(regexp_extract(text, '\b(20\d{{2}})\b', 1), '')) as found_year from documents",
    "language_hint": """
with w as (select doc_id, regexp_extract_all(lower(text), '[a-z'']+') as w from documents),
n as (select doc_id, len(list_filter(w, lambda x: x in ('articolo', 'sezione', 'borsa', 'studenti', 'domanda', 'graduatoria', 'requisiti'))) as it,
  len(list_filter(w, lambda x: x in ('article', 'section', 'scholarship', 'students', 'application', 'ranking', 'requirements'))) as en from w)
select doc_id, case when it >= 3 and it > en then 'it' when en >= 3 and en >= it then 'en' end as hint from n""",
    "augmented_text": f"""
with x as (select row_id, {_META_LINE.format(y=_value('year'), s=_value('section'), a=_value('article'), u=_value('subarticle'))} as line, {_strip('text')} as body from chunks),
y as (select *, {_words('line')} as lw, {_words('body')} as bw from x)
select row_id, case when bw = 0 then line when lw::DOUBLE / (lw + bw) > 0.7 or length(line)::DOUBLE / (length(line) + length(body)) > 0.7 then body
  else line || chr(10) || chr(10) || body end as augmented from y""",
    "page_ranges": _PAGE,
    "structure_state": _STRUCTURE + " select doc_id, pos, section, article, subarticle, changed from state",
    "heading_paths": f"""
with recursive {_BLOCKS}, h as (select doc_id, pos, greatest(heading_level, 1) as lev, {_strip("regexp_replace(" + _strip('text') + ", '^#+', '')")} as t,
  row_number() over (partition by doc_id order by pos) as i from b0 where heading_level is not null),
r as (
  select doc_id, pos, i, [t] as path from h where i = 1
  union all select h.doc_id, h.pos, h.i, list_append(r.path[1:h.lev - 1], h.t) from r join h on h.doc_id = r.doc_id and h.i = r.i + 1
)
select b.doc_id, b.pos, coalesce(array_to_string(r.path, ' > '), '') as path from b0 b asof left join r on b.doc_id = r.doc_id and b.pos >= r.pos""",
    "built_segments": _STRUCTURE
    + """, g as (select *, sum((heading or changed)::INT) over (partition by doc_id order by pos) as seg from state where trim(text) <> ''),
a as (select doc_id, seg, string_agg(line, chr(10) || chr(10) order by pos) as text, arg_min({'s': section, 'a': article, 'u': subarticle}, pos) as f,
  len(list_distinct(flatten(list(page_refs)))) as refs from g group by doc_id, seg)
select doc_id, (row_number() over (partition by doc_id order by seg) - 1)::INT as seg_no, text, f.s as section, f.a as article, f.u as subarticle, refs from a""",
    "toc_flags": f"""
with s as (select row_id, heading_path, {_strip('text')} as t, {_lines('text')} as l from segments),
n as (select *, {_hits('l', _TOC_ENTRY)} as e, {_hits('l', _TOC_NUMBERED)} as m, {_hits('l', _TAIL)} as p, {_hits('l', f'(?i)art{chr(92)}.?{_WS}*{chr(92)}d+')} as a from s)
select row_id, t <> '' and (regexp_matches(coalesce(array_to_string(heading_path, ' '), ''), '{_TOC_WORD}') or regexp_matches(left(t, 240), '{_TOC_WORD}')
   or (len(l) >= 3 and (e >= 3 or m >= 3 or ((e >= 2 or m >= 2) and p >= 3) or a >= 5))) as toc,
  coalesce(len(heading_path), 0) = 0 and len(l) >= 2 and greatest(e, m, p) >= 2 as continuation from n""",
    "chunk_articles": f"""
with c as (select row_id, metadata as m, list_transform(list_filter({_lines('text')}[1:10], lambda l: regexp_matches(l, '{_ART_START}')), lambda l: regexp_extract(l, '{_ART_START}', 1)) as said,
  case when regexp_matches({_strip('metadata.section')}, '^(\\d+(?:\\.\\d+)*)\\b') then regexp_extract({_strip('metadata.section')}, '^(\\d+(?:\\.\\d+)*)\\b', 1) end as num from chunks),
r as (select *, list_distinct(list_transform(said, lambda x: split_part(x, '.', 1))) as roots, said[1] as f from c),
o as (select *, len(roots) = 1 and (m.article is null or not list_contains(roots, m.article)) as own,
  case when contains(f, '.') then f end as dot from r),
q as (select *, case when own then split_part(f, '.', 1) else m.article end as art,
  case when own and m.article is null then dot when own then coalesce(dot, m.subarticle) else m.subarticle end as sub from o)
select row_id, coalesce(art, split_part(num, '.', 1), 'front_matter') as article,
  case when art is null and num is not null then coalesce(sub, case when contains(num, '.') then num end) else sub end as subarticle from q""",
    "stub_flags": f"""
with c as (select row_id, {token_sql('text')} as n, {_lines('text')} as l from chunks),
j as (select *, array_to_string(l, ' ') as j from c),
w as (select *, regexp_extract_all(j, '[A-Za-zÀ-ÿ'']+') as w from j)
select row_id, n <= 50 and (len(l) = 0
  or (len(list_filter(l, lambda x: not (regexp_matches(x, '{_TOC_ENTRY}') or regexp_matches(x, '{_TOC_NUMBERED}')))) = 0 and {_hits('l', _TAIL)} > 0)
  or ({_hits('l', _TAIL)} = len(l) and len(list_filter(l, lambda x: regexp_matches(x, '{_TOC_NUMBERED}') or regexp_matches(x, '{_STUB}'))) > 0)
  or (not contains(j, '|') and (len(list_filter(l, lambda x: not starts_with(x, '#'))) = 0 or regexp_matches(j, '{_STUB}')
    or (n <= 12 and ((upper(j) = j and regexp_matches(j, '\\p{{L}}'))
      or (len(w) between 2 and 10 and len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{L}}') and not regexp_matches(x, '^\\p{{Lu}}'))) = 0)))))) as stub from w""",
    "global_dedupe": f"select row_id from chunks qualify row_number() over (partition by {_KEY} order by doc_id, chunk_index, row_id) = 1",
    "document_stats": f"""
with c as (select doc_id, count(*)::INT as chunks, sum({token_sql('text')})::INT as tokens from chunks group by 1),
p as (select doc_id, count(distinct page)::INT as pages from (select doc_id, unnest(list_transform(page_refs, lambda x: x.page_idx)) as page from chunks) group by 1)
select d.doc_key as doc_id, coalesce(chunks, 0) as chunks, coalesce(tokens, 0) as tokens, coalesce(pages, 0) as pages
from documents d left join c on c.doc_id = d.doc_key left join p on p.doc_id = d.doc_key""",
    "duplicate_stats": """select coalesce(sum(n), 0)::BIGINT as duplicate_instances, count(*) as duplicate_texts from (select count(*) as n from chunks group by text) where n > 1""",
    "quality_counters": _COUNTED + " select * from k",
    "quality_scores": _COUNTED + _SCORED,
    "quality_gates": _COUNTED
    + " "
    + _gates([
        ("oversized_chunks", "oversized", "<=", "0"),
        ("small_chunks_pct", _p("small"), "<=", "12"),
        ("mixed_article_pct", _p("mixed_article"), "<=", "5"),
        ("residual_noise", "html + inline_math + latex + bookmark", "<=", "0"),
        ("provenance_issues", "empty_refs + missing_range + invalid_range", "<=", "0"),
    ]),
    "source_choice": """
with f as (select source_folder as folder, max(source_mode) as m from folder_scan group by 1)
select folder, case when m in ('block_list', 'content_list', 'md') then m else 'none' end as mode,
  case when m = 'block_list' then folder || '/block_list.json' end as block_path,
  case m when 'block_list' then folder || '/z_content_list.json' when 'content_list' then folder || '/a_content_list.json' end as content_path,
  case m when 'block_list' then folder || '/b.md' when 'content_list' then folder || '/c.md' when 'md' then folder || '/a.md' end as md_path,
  case when m = 'block_list' then null when m = 'content_list' then 'block_list.json missing' when m = 'md' then 'block_list.json and *_content_list.json missing'
    else 'No block_list.json, *_content_list.json, or .md file found' end as fallback_reason from f""",
    "block_list_read": f"""
with {_BLOCKS}, n as (select *, row_number() over (partition by doc_id order by pos) - 1 as i, {_strip('text')} as t from b0),
kept as (select * from n where i % 7 <> 6),
m as (select doc_id, count(*) as k, string_agg(t, chr(10) order by i) filter (where t <> '' and not (i = 2 and t = o)) as joined
  from (select *, coalesce(lag(t) over (partition by doc_id order by i), '') as o from kept where i in (1, 2)) group by doc_id)
select n.doc_id, i::INT as pos, case when i = 1 and k = 2 and joined is not null then joined else coalesce(text, '') end as text, block_type,
  case when block_type = 'title' then heading_level end as heading_level, (case when i = 1 and k = 2 and joined is not null then 2 else 1 end)::INT as refs
from kept n left join m using (doc_id) where not (i = 2 and k = 2)""",
    "content_list_read": f"""
with {_BLOCKS}, n as (select *, row_number() over (partition by doc_id order by pos) - 1 as i, block_type = 'table_body' as tab from b0)
select doc_id, i::INT as pos, case when tab then coalesce(text, '') || chr(10) || 'cap tion' || case when i % 2 = 0 then chr(10) || 'foot' else '' end else coalesce(text, '') end as text,
  case when not tab and heading_level > 0 then 'title' when block_type = 'title' then 'text' else block_type end as block_type,
  case when not tab and heading_level > 0 then heading_level end as heading_level, (i % 5)::INT as page from n""",
    "json_lines_round_trip": "select row_id, doc_id, chunk_index, text, token_count, len(page_refs)::INT as refs from chunks",
    "char_coverage": _COVERAGE,
    "split_pieces": _SPLIT,
    "clean_blocks": CLEAN_BLOCKS,
    "small_merged": f"""
with recursive s0 as (select doc_id, seg_no, text, section, article, subarticle, heading_path from segments qualify row_number() over (partition by doc_id, seg_no order by row_id) = 1),
s1 as (select *, {_strip('text')} as t, {_lines('text')} as l from s0),
s2 as (select *, {_hits('l', _TOC_ENTRY)} as e, {_hits('l', _TOC_NUMBERED)} as m, {_hits('l', _TAIL)} as p, {_hits('l', f'(?i)art{chr(92)}.?{_WS}*{chr(92)}d+')} as a from s1),
own as (select doc_id, row_number() over (partition by doc_id order by seg_no) as k, struct_pack(n := seg_no, t := text, s := section, a := article, b := subarticle, z := {token_sql('text')}) as x from s2
  where not (t <> '' and (regexp_matches(coalesce(array_to_string(heading_path, ' '), ''), '{_TOC_WORD}') or regexp_matches(left(t, 240), '{_TOC_WORD}')
     or (len(l) >= 3 and (e >= 3 or m >= 3 or ((e >= 2 or m >= 2) and p >= 3) or a >= 5))))),
-- cur takes in what follows while it is small, then goes to what stands before it, done
fold as (
  select doc_id, k, x as cur, null::STRUCT(n INT, t VARCHAR, s VARCHAR, a VARCHAR, b VARCHAR, z INT) as done, null::STRUCT(n INT, t VARCHAR, s VARCHAR, a VARCHAR, b VARCHAR, z INT) as out from own where k = 1
  union all
  select doc_id, k, case when fwd then both_ else x end, case when fwd then done when back then prior else cur end, case when not fwd and not back then done end
  from (select *, cur.z < 50 and {_may('cur', 'x')} and both_.z <= 480 as fwd, done is not null and cur.z < 50 and {_may('done', 'cur')} and prior.z <= 480 as back
    from (select f.doc_id, o.k, f.cur, f.done, o.x, {_glued('f.cur', 'o.x')} as both_, {_glued('f.done', 'f.cur')} as prior from fold f join own o on o.doc_id = f.doc_id and o.k = f.k + 1))
), last as (select * from fold qualify row_number() over (partition by doc_id order by k desc) = 1),
ends as (select *, coalesce(done is not null and cur.z < 50 and {_may('done', 'cur')} and prior.z <= 480, false) as back from (select *, {_glued('done', 'cur')} as prior from last)),
all_ as (select doc_id, out as x from fold union all select doc_id, case when back then prior else done end from ends union all select doc_id, cur from ends where not back)
select doc_id, x.n as seg_no, x.t as text, x.s as section, x.a as article from all_ where x is not null""",
    "consecutive_overlap": """
with c as (select doc_id, chunk_index, min(text) as text from chunks group by 1, 2),
p as (select *, right(lag(text) over (partition by doc_id order by chunk_index), 240) as a, left(text, 240) as b from c)
select doc_id, chunk_index, coalesce(list_max(list_filter(range(1, least(length(a), length(b)) + 1), lambda k: right(a, k) = left(b, k))), 0)::INT as overlap from p where a is not null""",
    "source_modes": "select source_mode_used, count(*) as docs from documents group by 1",
    "sentence_dedupe": f"""
with p as (select row_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){_WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda x: {_strip('x')}), lambda x: x <> '') as p from blocks),
k as (select row_id, p, list_transform(p, lambda x: lower({_squeeze('x')})) as k from p)
select row_id, array_to_string(list_filter(p, lambda x, i: length(k[i]) < 24 or list_position(k, k[i]) = i), ' ') as text from k""",
    "line_clean": f"""
with l as (select row_id, generate_subscripts(a, 1) as i, unnest(a) as l from (
    select row_id, list_transform(regexp_split_to_array(text, '[\\n\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: {_squeeze('x')}) as a from blocks)),
c as (select row_id, i, l, length(l) >= 48 and not contains(l, '|') and not starts_with(l, '#') as long from l
  where not (regexp_matches(l, '^{_WS}*!\\[[^\\]]*\\]\\([^)]*\\){_WS}*$') or (length(l) >= 4 and not regexp_matches(l, '[\\p{{L}}\\p{{N}}]'))
    or regexp_matches(l, '(?i)^{_WS}*(?:errore\\.{_WS}*il segnalibro non|error\\.{_WS}*bookmark not defined).*$'))),
d as (select * from c qualify not long or row_number() over (partition by row_id, lower(l), long order by i) = 1),
e as (select * from d qualify l is distinct from coalesce(lag(l) over (partition by row_id order by i), ''))
select b.row_id, coalesce(string_agg(e.l, chr(10) order by e.i), '') as text from blocks b left join e using (row_id) group by b.row_id""",
    "resolved_structure": f"""
with s as (select row_id, section, article, subarticle, list_transform(coalesce(heading_path, []), lambda h: {_strip('h')}) as h from segments),
f as (select *, list_filter(h, lambda x: regexp_matches(x, '{_ART_IN}'))[1] as a, list_filter(h, lambda x: regexp_matches(x, '{_SEC_IN}'))[1] as q,
  list_filter(h, lambda x: x <> '' and not regexp_matches(x, '{_ART_IN}'))[1] as o from s),
n as (select *, case when a is not null then regexp_extract(a, '{_ART_IN}', 1) end as num from f)
select row_id, case when coalesce(section, '') <> '' then section else coalesce(q, o, nullif(h[1], '')) end as section,
  case when coalesce(article, '') <> '' then article else split_part(num, '.', 1) end as article,
  case when coalesce(article, '') <> '' or coalesce(subarticle, '') <> '' then subarticle when contains(num, '.') then num end as subarticle from n""",
    "table_normalized": f"""
with t as (select row_id, text, {_lines('text')} as l from chunks),
p as (select *, list_position(list_transform(l, lambda x: contains(x, '|')), true) as f, len(list_filter(l, lambda x: contains(x, '|'))) as n from t)
select row_id, starts_with({_strip('text')}, 'Table:') as is_table,
  case when len(l) = 0 then ''
    when starts_with(l[1], 'Table:') then array_to_string(list_concat(['Table:'], list_filter([{_strip("regexp_replace(l[1], '^Table:', '')")}], lambda x: x <> ''), l[2:]), chr(10))
    when n >= 2 or length(text) - length(replace(text, '|', '')) >= 6
      then array_to_string(list_concat(['Table:'], list_filter([array_to_string(l[1:f - 1], ' | ')], lambda x: x <> ''), l[f:]), chr(10))
    else {_strip('text')} end as normalized from p""",
    "deterministic_gates": _COUNTED
    + """, x as (select doc_id, chunk_index, min(text) as text from chunks group by 1, 2),
y as (select right(lag(text) over (partition by doc_id order by chunk_index), 240) as a, left(text, 240) as b from x),
o as (select list_sort(list(v)) as v from (select coalesce(list_max(list_filter(range(1, least(length(a), length(b)) + 1), lambda k: right(a, k) = left(b, k))), 0) as v from y where a is not null)),
r as (select k.chunks, k.mixed_article, (select v[greatest(1, 95 * len(v) // 100)] from o) as p95,
  (select coalesce(sum(n), 0) from (select count(*) as n from chunks group by text) where n > 1) as dup,
  (select count(*) from chunks where coalesce(token_count, 0) < 20) as tiny, (select median(token_count) from chunks) as med,
  (select count(*) from chunks where coalesce(metadata.year, '') = '' or coalesce(metadata.name, '') = '' or coalesce(metadata.brief_description, '') = ''
     or coalesce(metadata.section, '') = '' or coalesce(metadata.article, '') = '' or coalesce(metadata.language_hint, '') = '') as miss from k)
"""
    + _gates([
        ("tiny_chunks_pct", _p("tiny"), "<=", "0.5"),
        ("duplicate_chunks_pct", _p("dup"), "<=", "0"),
        ("overlap_p95_chars", "coalesce(p95, 0)", "<=", "30"),
        ("missing_metadata_pct", _p("miss"), "<=", "0"),
        ("mixed_article_pct", _p("mixed_article"), "<=", "2"),
        ("median_tokens", "coalesce(med, 0)", ">=", "100"),
        ("coverage_pct", f"coalesce((select round_even(avg(coverage) * 100, 2) from ({_COVERAGE}) where source_chars > 0), 0)", ">=", "95"),
    ]).replace("from k", "from r"),
    "issue_samples": f"""
with c as (select *, coalesce(token_count, 0) as n, {_ROOTS} as roots from chunks),
i as (select unnest(list_filter([case when n > 520 then 'oversized' end, case when n < 20 then 'small' end, case when len(roots) >= 2 then 'mixed_article' end,
  case when regexp_matches(text, '{_BOOK}') then 'bookmark' end], lambda x: x is not null)) as issue, doc_id, chunk_index, row_id, left(replace(text, chr(10), ' '), 220) as preview from c)
select * from i qualify row_number() over (partition by issue order by doc_id, chunk_index, row_id) <= 8""",
    "toc_merged": f"""
with s0 as (select doc_id, seg_no, text, section, heading_path from segments qualify row_number() over (partition by doc_id, seg_no order by row_id) = 1),
s1 as (select *, {_strip('text')} as t, {_lines('text')} as l from s0),
s2 as (select *, {_hits('l', _TOC_ENTRY)} as e, {_hits('l', _TOC_NUMBERED)} as m, {_hits('l', _TAIL)} as p, {_hits('l', f'(?i)art{chr(92)}.?{_WS}*{chr(92)}d+')} as a from s1),
s3 as (select *, t <> '' and (regexp_matches(coalesce(array_to_string(heading_path, ' '), ''), '{_TOC_WORD}') or regexp_matches(left(t, 240), '{_TOC_WORD}')
     or (len(l) >= 3 and (e >= 3 or m >= 3 or ((e >= 2 or m >= 2) and p >= 3) or a >= 5))) as toc,
   coalesce(len(heading_path), 0) = 0 and len(l) >= 2 and greatest(e, m, p) >= 2 as cont from s2),
s4 as (select *, toc or (cont and coalesce(max(case when toc then seg_no end) over w, -1) > coalesce(max(case when not toc and not cont then seg_no end) over w, -1)) as inside
   from s3 window w as (partition by doc_id order by seg_no rows between unbounded preceding and current row)),
s5 as (select *, sum((inside and not prev)::INT) over (partition by doc_id order by seg_no) as run
   from (select *, coalesce(lag(inside) over (partition by doc_id order by seg_no), false) as prev from s4)),
g as (select doc_id, min(seg_no) as seg_no, string_agg(t, chr(10) || chr(10) order by seg_no) as whole, list(t order by seg_no) as parts from s5 where inside group by doc_id, run)
select doc_id, seg_no, section, length(text)::INT as chars from s5 where not inside
union all select doc_id, seg_no, 'TABLE OF CONTENTS', length(case when {token_sql('whole')} > 480
   then 'TABLE OF CONTENTS' || chr(10) || chr(10) || {_strip("array_to_string(parts[1:20], chr(10))")} else whole end)::INT from g""",
    "document_meta": rf"""
with {_BLOCKS}, n as (select *, row_number() over (partition by doc_id order by pos) - 1 as n, {_strip("regexp_replace(" + _strip('text') + ", '^#+', '')")} as t from b0),
w as (select *, list_transform(regexp_extract_all(lower(t), '[A-Za-zÀ-ÿ0-9'']+'), lambda x: x) as words from n),
c as (select *, case when len(words) = 0 then -1 else least(length(t), 120) + least(len(words), 16) * 5
   - 20 * len(list_filter(words, lambda x: x in ('call', 'bando', 'notice', 'avviso', 'announcement', 'regulation', 'regolamento', 'policy', 'guidelines'))) end as score
   from w where block_type = 'title' and len(page_refs) > 0 and page_refs[1].page_idx <= 1 and length(t) >= 4 and not contains(lower(t), 'art.')),
best as (select doc_id, t as bt, score from c qualify row_number() over (partition by doc_id order by score desc, n) = 1),
eight as (select doc_id, arg_min(t, n) as first from n where length(t) >= 8 group by 1),
said as (select doc_id, trim(regexp_replace(string_agg({_strip('text')}, ' ' order by n), '{_WS}+', ' ', 'g')) as joined from (
   select * from n where block_type <> 'title' and length({_strip('text')}) >= 60 and not starts_with(lower(text), 'table:') qualify row_number() over (partition by doc_id order by n) <= 3) group by 1),
look as (select doc_id, string_agg(text, chr(10) order by n) as text from n where n < 30 group by 1),
lang as (select doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z'']+'), lambda x: x in ('articolo', 'sezione', 'borsa', 'studenti', 'domanda', 'graduatoria', 'requisiti'))) as it,
   len(list_filter(regexp_extract_all(lower(text), '[a-z'']+'), lambda x: x in ('article', 'section', 'scholarship', 'students', 'application', 'ranking', 'requirements'))) as en,
   coalesce({_span(_AY)}, {_span(chr(92) + 'b' + _YEAR_SPAN)}, nullif(regexp_extract(text, '(20\d{{2}})', 1), '')) as year from look),
size as (select doc_id, count(*)::INT as blocks from b0 group by 1),
d as (select size.doc_id, blocks, year, it, en, joined, coalesce(case when score >= 20 then trim(split_part(bt, chr(10), 1)) end, first, '') as name
   from size left join best using (doc_id) left join eight using (doc_id) left join said using (doc_id) left join lang using (doc_id))
select doc_id, name, year, coalesce(case when length(joined) > 320 then rtrim(left(joined, 317)) || '...' else joined end, name) as brief_description,
  case when it >= 3 and it > en then 'it' when en >= 3 and en >= it then 'en' end as language_hint, blocks from d""",
}
