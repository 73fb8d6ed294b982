"""DuckDB SQL of the whole cleaning of texts, written apart from the operators.

What a pattern finds (numbered entities, tables, formulas in dollars) is cut out, made anew and put back between what
stood around it. Entities are those of HTML 4, with their semicolon.
"""

from __future__ import annotations

from html.entities import name2codepoint

_WS = r"[\s\p{Z}\x1c-\x1f\x{85}]"
_BREAK = r"[\n\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# What commands of formulas stand for.
_SYMBOLS = (
    (r"\left", ""), (r"\right", ""), (r"\times", "×"), (r"\cdot", "·"), (r"\succ", ">"), (r"\prec", "<"), (r"\geq", "≥"), (r"\leq", "≤"),
    (r"\bullet", "•"), (r"\neq", "≠"), (r"\approx", "≈"),
)


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _between(x: str, pattern: str, then: str) -> str:
    """``x`` with every match ``m`` of ``pattern`` replaced by the expression ``then``."""
    hits = f"list_transform(regexp_extract_all({x}, '{pattern}'), lambda m: {then})"
    return f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{pattern}'), {hits}), lambda z: z[1] || coalesce(z[2], '')), '')"


def _named_entities(x: str) -> str:
    for name, code in sorted(name2codepoint.items()):
        if name != "amp":
            x = f"replace({x}, '&{name};', chr({code}))"
    return f"replace({x}, '&amp;', '&')"


_NUMBER = "chr(cast(case when lower(m[3]) = 'x' then '0x' || m[4:-2] else m[3:-2] end as int))"
# groups with no more than one level of groups in them; what is deeper comes with the next round
_GROUP = r"\{((?:[^{}]|\{[^{}]*\})*)\}"
_FRACTION = rf"\\[dt]?frac\s*{_GROUP}\s*{_GROUP}"


def _steps(x: str, *steps: tuple[str, str]) -> str:
    for pattern, to in steps:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


def _symbols(x: str) -> str:
    for command, symbol in _SYMBOLS:
        x = f"replace({x}, '{command}', '{symbol}')"
    return x


#: ``t`` (a column) cleaned, as CTEs that end in ``cleaned`` (row_id, text); ``source`` has (row_id, text).
CLEANED = rf"""
with e1 as (select row_id, text, case when contains(text, '&#') then {_between('text', '&#(?:[0-9]+|[xX][0-9a-fA-F]+);', _NUMBER)} else text end as t from source),
e2 as (select row_id, case when contains(text, '&') then {_named_entities('t')} else t end as t from e1),
b as (select row_id, regexp_replace(t, '(?is)\s*errore\.\s*il\s+(?:segnalibro|segnalbro)\s+non\s+[^\n]*?definit[oa]\.?\s*', ' ', 'g') as t from e2),
cells as (
  select row_id, k, r, regexp_extract_all(tr, '(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>', 1) as c from (
    select row_id, k, generate_subscripts(trs, 1) as r, unnest(trs) as tr from (
      select row_id, k, regexp_extract_all(tab, '(?is)<tr\b.*?</tr>') as trs from (
        select row_id, generate_subscripts(tabs, 1) as k, unnest(tabs) as tab from (select row_id, regexp_extract_all(t, '(?is)<table\b.*?</table>') as tabs from b)))),
),
said as (select row_id, k, r, array_to_string(list_filter(list_transform(list_transform(c, lambda x: {_named_entities('x')}), lambda x: {_squeeze(_steps('x', ('<[^>]+>', ' ')))}), lambda x: x <> ''), ' | ') as line from cells),
tables as (select row_id, k, string_agg(line, chr(10) order by r) as body from said where line <> '' group by row_id, k),
bare as (select row_id, generate_subscripts(tabs, 1) as k, unnest(tabs) as tab from (select row_id, regexp_extract_all(t, '(?is)<table\b.*?</table>') as tabs from b)),
flat as (select row_id, k, coalesce('Table:' || chr(10) || body, nullif('Table: ' || {_squeeze(_steps('tab', ('<[^>]+>', ' ')))}, 'Table: '), '') as f from bare left join tables using (row_id, k)),
listed as (select row_id, list(chr(10) || f || chr(10) order by k) as f from flat group by row_id),
tf as (select row_id, case when f is null then t else
  array_to_string(list_transform(list_zip(regexp_split_to_array(t, '(?is)<table\b.*?</table>'), f), lambda z: z[1] || coalesce(z[2], '')), '') end as t from b left join listed using (row_id)),
f1 as (select row_id, {_steps('t', *[(_FRACTION, chr(92) + '1 / ' + chr(92) + '2')] * 4)} as t from tf),
f2 as (select row_id, {_symbols('t')} as t from f1),
f3 as (select row_id, case when contains(t, '$') then {_between('t', '[$][^$' + chr(92) + 'n]+[$]', "trim(replace(m[2:-2], chr(92), ''))")} else t end as t from f2),
f4 as (select row_id, {_steps('t', (r'(?s)\\\((.*?)\\\)', chr(92) + '1'), (r'(?s)\\\[(.*?)\\\]', chr(92) + '1'), (r'\\([%()\[\]])', chr(92) + '1'), (r'\\[a-z]+\b', ''))} as t from f3),
g as (select row_id, {_steps('t', (r'<[^>\n]+>', ' '), (chr(92) + 'x{a0}', ' '), (chr(92) + 'r', ''), ('([0-9]{1,2}(?:st|nd|rd|th))(20[0-9]{2})', chr(92) + '1 ' + chr(92) + '2'))} as t from f4),
l0 as (select row_id, generate_subscripts(a, 1) as i, unnest(a) as l from (select row_id, list_transform(regexp_split_to_array(t, '{_BREAK}'), lambda x: {_squeeze('x')}) as a from g)),
l1 as (select row_id, i, l, length(l) >= 48 and not contains(l, '|') and not starts_with(l, '#') as long from l0
  where not (regexp_matches(l, '^{_WS}*!\[[^\]]*\]\([^)]*\){_WS}*$') or (length(l) >= 4 and not regexp_matches(l, '[\p{{L}}\p{{N}}]'))
    or regexp_matches(l, '(?i)^{_WS}*(?:errore\.{_WS}*il segnalibro non|error\.{_WS}*bookmark not defined).*$'))),
l2 as (select * from l1 qualify not long or row_number() over (partition by row_id, lower(l), long order by i) = 1),
l3 as (select * from l2 qualify l is distinct from coalesce(lag(l) over (partition by row_id order by i), '')),
l4 as (select row_id, string_agg(l, chr(10) order by i) as t from l3 group by row_id),
s1 as (select row_id, list_filter(list_transform(string_split(regexp_replace(t, '([.!?]){_WS}+', '\1' || chr(1), 'g'), chr(1)), lambda x: {_steps('x', (f'^{_WS}+|{_WS}+$', ''))}), lambda x: x <> '') as p from l4),
s2 as (select row_id, p, list_transform(p, lambda x: lower({_squeeze('x')})) as k from s1),
cleaned as (select row_id, {_steps("array_to_string(list_filter(p, lambda x, i: length(k[i]) < 24 or list_position(k, k[i]) = i), ' ')", (f'^{_WS}+|{_WS}+$', ''))} as text from s2)"""

CLEAN_BLOCKS = CLEANED.replace("from source)", "from blocks)") + "\nselect row_id, text from cleaned where text <> ''"
