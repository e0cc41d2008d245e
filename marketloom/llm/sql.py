"""Independent ANSI SQL (DuckDB) statements of those queries that SQL can express."""

_COVERED = r"""
with texts as (select doc_id as id, 'd' as side, text as t from documents where text is not null union all select item_id, 'i', item_text from eval_items where item_text is not null),
decoded as (select id, side, array_to_string(list_transform(string_split(t, '\u'),
  lambda p, i: case when i > 1 and regexp_matches(p, '^[0-9a-fA-F]{4}') then chr(cast('0x' || p[1:4] as int)) || p[5:] else p end), '') as t from texts),
unescaped as (select id, side, replace(replace(replace(replace(regexp_replace(regexp_replace(t, '\\[nrt]', ' ', 'g'), '\\(["''/\\])', '\1', 'g'), '&amp;', '&'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' ') as t from decoded),
untagged as (select id, side, regexp_replace(regexp_replace(regexp_replace(t, '(?i)</?(b|i|u|em|strong|span|a|font|wbr|sup|sub|mark|code|small|big|tt|s|ins|del)\b[^<>]*>', '', 'g'), '</?[a-zA-Z!][^<>]*>', ' ', 'g'), '[\x{ad}\x{34f}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{feff}]', '', 'g') as t from unescaped),
joined as (select id, side, regexp_replace(t, '(\p{L})[-\x{2010}\x{2011}][ \t]*\r?\n\s*(\p{L})', '\1\2', 'g') as t from untagged),
worded as (select distinct id, side, regexp_extract_all(lower(strip_accents(t)), '[a-z0-9]+|[^\x00-\x7f\W_]+') as w from joined),
grams as (select id, side, len(w) as n, unnest(range(1, len(w) - 6)) as i, w from worded where len(w) >= 8),
keyed as (select id, side, n, i, array_to_string(w[i:i+7], ' ') as g from grams),
met as (select distinct d.id as doc_id, k.id as item_id, k.n, k.i from keyed k join keyed d on d.side = 'd' and k.side = 'i' and d.g = k.g),
covered as (select doc_id, item_id, n, count(distinct p) as matched from (select doc_id, item_id, n, unnest(range(i, i + 8)) as p from met) group by 1, 2, 3)
"""

SQL = {
    "p6_found": _COVERED + "select distinct doc_id, item_id from covered where matched >= 0.4 * n",
    "p6_leaks": _COVERED + "select doc_id, item_id, max(matched) as matched_words, any_value(n) as item_words from covered where matched >= 0.4 * n group by 1, 2",
}
