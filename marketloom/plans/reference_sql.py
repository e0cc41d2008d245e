"""Independent ANSI SQL (DuckDB) statements of the reference queries."""

_MEMBERS = "select distinct m.cluster_id, p.* from product_cluster_memberships m join products p on p.id = m.product_id where m.cluster_id is not null"
_SQUEEZE = "nullif(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '')"

_OBJECTS = """select id, marketplace, external_id, collected_at, raw_payload as j from raw_marketplace_products
  where marketplace in ('mock', 'etsy') and raw_payload like '{%}'"""

_NUMBER = "regexp_replace(regexp_extract(t, '[0-9][0-9\\s.,]*'), '\\s', '', 'g')"
_AMOUNT = f"""case
  when {_NUMBER} like '%,%' and {_NUMBER} like '%.%' then
    case when strpos(reverse({_NUMBER}), ',') < strpos(reverse({_NUMBER}), '.') then replace(replace({_NUMBER}, '.', ''), ',', '.') else replace({_NUMBER}, ',', '') end
  when {_NUMBER} like '%,%' then case when length(string_split({_NUMBER}, ',')[-1]) = 3 then replace({_NUMBER}, ',', '')
    else array_to_string(string_split({_NUMBER}, ',')[:-2], '') || '.' || string_split({_NUMBER}, ',')[-1] end
  when {_NUMBER} like '%.%' then case when len(string_split({_NUMBER}, '.')) > 2 or length(string_split({_NUMBER}, '.')[-1]) = 3 then replace({_NUMBER}, '.', '') else {_NUMBER} end
  else {_NUMBER} end"""

def _amount(t: str) -> str:
    return f"try_cast(case when {t} is not null then {_AMOUNT.replace('(t,', f'({t},')} end as decimal(18,4))"


def _currency(t: str) -> str:
    marks = [("R$", "BRL"), ("US$", "USD"), ("CA$", "CAD"), ("A$", "AUD"), ("£", "GBP"), ("€", "EUR"), ("¥", "JPY"), ("$", "USD"), *((c, c) for c in ("USD", "EUR", "GBP", "BRL", "CAD", "AUD", "JPY"))]
    return "case " + " ".join(f"when upper({t}) like '%{m}%' then '{c}'" for m, c in marks) + " end"


def _reviews(t: str) -> str:
    c = f"replace(lower(trim({t})), ' ', '')"
    k, whole = f"regexp_extract({c}, '([0-9][0-9.,]*)([km])?', 2)", f"regexp_extract({c}, '([0-9][0-9.,]*)', 1)"
    return f"""case when {k} <> '' then cast(floor(try_cast(replace({whole}, ',', '.') as decimal(20,6)) * case when {k} = 'k' then 1000 else 1000000 end) as bigint)
      else try_cast(regexp_replace({whole}, '[.,]', '', 'g') as bigint) end"""


def _rating(t: str) -> str:
    r = f"replace(lower(trim({t})), ',', '.')"
    value, scale, lone = f"try_cast(regexp_extract({r}, '([0-9.]+)\\s*/', 1) as double)", f"try_cast(regexp_extract({r}, '/\\s*([0-9.]+)', 1) as double)", f"try_cast(regexp_extract({r}, '[0-9]+(\\.[0-9]+)?') as double)"
    return f"case when regexp_matches({r}, '[0-9.]+\\s*/\\s*[0-9.]+') then case when {scale} = 5 and {value} <= 5 then {value} end when {lone} between 0 and 5 then {lone} end"


def _url(t: str) -> str:
    u = f"trim({t})"
    kept = f"""list_filter(string_split(regexp_extract({u}, '\\?([^#]*)', 1), '&'), lambda p: p <> '' and not regexp_matches(lower(p),
      '^(utm_.*|(ref|referrer|campaign|click_key|click_sum|ga_order|ga_search_query|ga_view_type|ls|organic_search_click)(=.*)?)$'))"""
    return f"""(lower(regexp_extract({u}, '^[a-zA-Z]+://[^/?#]*')) || regexp_extract({u}, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)
      || case when len({kept}) > 0 then '?' || array_to_string({kept}, '&') else '' end)"""


def _keywords(k: str) -> str:
    clean = f"list_filter(list_transform(coalesce({k}, []), lambda k: {_SQUEEZE.format('k')}), lambda k: k is not null)"
    return f"list_filter({clean}, lambda k, i: list_position(list_transform({clean}, lambda x: lower(x)), lower(k)) = i)"


_READ = """select *, case when json_valid(raw_payload) then case when json_type(raw_payload) = 'OBJECT' then raw_payload end end as j from raw_marketplace_products"""
_BOTH = lambda etsy, mock: f"json_extract_string(j, case marketplace when 'etsy' then '$.{etsy}' else '$.{mock}' end)"
NORMALIZED = f"""
normalized as (
  select id as raw_product_id, marketplace, external_id, search_query, collected_at,
    {_SQUEEZE.format(_BOTH("title", "name"))} as product_name, nullif({_url(_BOTH("url", "listing_url"))}, '') as url,
    case when lower(trim(json_extract_string(j, '$.product_type'))) in ('spreadsheet', 'calculator', 'tracker', 'template', 'unknown') then lower(trim(json_extract_string(j, '$.product_type'))) end as product_type,
    case when marketplace = 'etsy' then case when json_type(j, '$.price') = 'OBJECT' then try_cast(try_cast(json_extract_string(j, '$.price.amount') as decimal(18,4))
        / coalesce(nullif(try_cast(json_extract_string(j, '$.price.divisor') as decimal(12,2)), 0), 100) as decimal(18,4)) end
      else {_amount("json_extract_string(j, '$.price_text')")} end as price,
    case when marketplace = 'etsy' then case when json_type(j, '$.price') = 'OBJECT' then upper({_SQUEEZE.format("json_extract_string(j, '$.price.currency_code')")}) end
      else {_currency("json_extract_string(j, '$.price_text')")} end as currency,
    {_reviews(_BOTH("review_count", "reviews_text"))} as review_count, {_rating(_BOTH("rating", "rating_text"))} as rating,
    {_SQUEEZE.format("case when marketplace = 'etsy' then coalesce(json_extract_string(j, '$.shop_name'), json_extract_string(j, '$.seller')) else json_extract_string(j, '$.seller_name') end")} as seller,
    {_keywords("try_cast(json_extract(j, case marketplace when 'etsy' then '$.tags' else '$.keywords' end) as varchar[])")} as keywords,
    {_SQUEEZE.format("json_extract_string(j, '$.description')")} as description, {_SQUEEZE.format("json_extract_string(j, '$.category')")} as category
  from ({_READ}) where marketplace in ('etsy', 'mock') and j is not null
),
keyed as (
  select *, case when coalesce(external_id, '') <> '' then marketplace || ':id:' || external_id when url is not null then marketplace || ':url:' || url end as identity_key
  from normalized where product_name is not null and url is not null
)"""

_STOP = (
    "'digital','download','instant','editable','printable','best','seller','bundle','premium','2026','2025','2024','sale','offer','new','popular','etsy',"
    "'excel','google','kindle','canva','xlsx','csv','pdf','for','and','the','with','from','your','home','shop','online'"
)
TOKENS = f"""
raw_tokens as (
  select id, unnest(list_filter(regexp_split_to_array(lower(concat_ws(' ', product_name, niche, category, product_type, array_to_string(keywords, ' '), description)), '[^a-z0-9]+'), lambda x: x <> '')) as t
  from products where id is not null
),
tokens as (
  select distinct id, token from (
    select id, case when t like '%ies' and length(t) > 4 then t[:-4] || 'y' when t like '%sses' and length(t) > 5 then t[:-3]
                    when t like '%s' and t not like '%ss' and length(t) > 3 then t[:-2] else t end as token from raw_tokens)
  where token not in ({_STOP})
)"""
IDF = TOKENS + """,
idf as (select token, count(*) as df, ln(((select count(*) from products) + 1.0) / (count(*) + 1)) + 1 as idf from tokens group by token)"""
EDGES = IDF + """,
norms as (select id, sqrt(sum(idf * idf)) as norm, count(*) as n from tokens join idf using (token) group by id),
dots as (select x.id as a, y.id as b, sum(idf * idf) as dot, count(*) as c from tokens x join tokens y on x.token = y.token and x.id < y.id join idf on idf.token = x.token group by all),
edges as (
  select * from (
    select a, b, 0.55 * least(1, dot / (x.norm * y.norm)) + 0.20 * c / (x.n + y.n - c)
      + case when (nullif(lower(p.niche), '') = nullif(lower(r.niche), '')) or p.product_type = r.product_type then 0.25 else 0 end as similarity
    from dots join norms x on x.id = a join norms y on y.id = b join products p on p.id = a join products r on r.id = b)
  where similarity >= 0.72
)"""

_CONFIDENT = """
sized as (select component, count(*) as n from member group by 1),
own as (select component, token, ln((any_value(n) + 1.0) / (count(*) + 1)) + 1 as idf from tokens join member using (id) join sized using (component) group by 1, 2),
vector as (select m.component, m.id, t.token, o.idf from member m join tokens t on t.id = m.id join own o on o.component = m.component and o.token = t.token),
len as (select id, sqrt(sum(idf * idf)) as norm, count(*) as k from vector group by 1),
pair as (select a.component, a.id as a, b.id as b, (a.nk = b.nk) is true or (a.tk = b.tk) is true as shared from member a join member b on a.component = b.component and a.id < b.id),
common as (select p.component, p.a, p.b, sum(x.idf * x.idf) as dot, count(*) as c from pair p join vector x on x.id = p.a join vector y on y.id = p.b and y.token = x.token group by 1, 2, 3),
score as (select p.component, case when x.norm is null or y.norm is null then 0 else 0.55 * coalesce(dot, 0) / (x.norm * y.norm) + 0.20 * coalesce(c, 0) / (x.k + y.k - coalesce(c, 0)) + case when shared then 0.25 else 0 end end as s
  from pair p left join common q using (component, a, b) left join len x on x.id = p.a left join len y on y.id = p.b),
confident as (select component, round(least(1, greatest(0, avg(s))), 4) as confidence from score group by 1)"""
_GROUPED = EDGES + """,
both_ways as materialized (select a, b from edges union select b, a from edges),
reach(node, other) as (select distinct a, a from both_ways union select r.node, e.b from reach r join both_ways e on e.a = r.other),
member as (select p.id, coalesce(min(other), p.id) as component, nullif(lower(any_value(p.niche)), '') as nk, nullif(any_value(p.product_type), '') as tk, any_value(p.product_type) as kind, any_value(p.product_name) as name
  from products p left join reach on reach.node = p.id group by p.id)"""


def _terms(name: str, rows: str) -> str:
    """id, component, value, pos: different terms of a product, the longest first."""
    return f"{name} as (select id, component, value, row_number() over (partition by id order by length(value) desc, value) - 1 as pos from (select distinct id, component, value from ({rows}) where value is not null))"


def _elected(source: str) -> str:
    return f"(select component, value from (select component, value, count(*) as votes, min({{'id': id, 'at': pos}}) as seen from {source} group by 1, 2) qualify row_number() over (partition by component order by votes desc, seen) = 1)"


def _titled(t: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower({t}), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '')"


_PROBLEM_WORDS = "(values ('pricing', 'pricing'), ('price', 'pricing'), ('cost', 'costing'), ('costing', 'costing'), ('budget', 'budgeting'), ('budgeting', 'budgeting'), ('roi', 'roi'), ('return', 'roi'), ('profit', 'profit'), ('fee', 'fee'), ('fees', 'fee'), ('inventory', 'inventory'), ('expense', 'expense'), ('expenses', 'expense'), ('commission', 'commission'), ('pricing calculator', 'pricing'), ('cost calculator', 'costing')) k(word, value)"
_TYPE_WORDS = "('calculator', 'spreadsheet', 'tracker', 'template', 'planner', 'workbook', 'tool', 'sheet')"
_GENERAL = "('calculator', 'spreadsheet', 'tracker', 'template', 'planner', 'tool', 'sheet', 'pricing', 'costing', 'budget', 'fee', 'roi', 'inventory')"
_MARKETS = f"""
with recursive {_GROUPED},
{_CONFIDENT},
placed as (
  select id, case when t like '%ies' and length(t) > 4 then t[:-4] || 'y' when t like '%sses' and length(t) > 5 then t[:-3] when t like '%s' and t not like '%ss' and length(t) > 3 then t[:-2] else t end as token, i
  from (select id, unnest(ts) as t, unnest(range(len(ts))) as i from (select id, list_filter(regexp_split_to_array(lower(concat_ws(' ', product_name, niche, category, product_type, array_to_string(keywords, ' '), description)), '[^a-z0-9]+'), lambda x: x <> '') as ts from products))),
ordered as (select id, component, token, row_number() over (partition by id order by i) as i from (select id, token, min(i) as i from placed where token not in ({_STOP}) group by 1, 2) join member using (id)),
line as (select id, component, string_agg(token, ' ' order by i) as joined from ordered group by 1, 2),
{_terms("niches", "select id, component, nk as value from member union all select id, component, token from ordered where token in ('bakery', 'airbnb', 'wedding', 'etsy', 'cake') union all select id, component, 'tattoo artist' from ordered where token in ('tattoo', 'ink')")},
first_niche as (select * from niches where pos = 0),
{_terms("problems", f"select id, component, value from line, {_PROBLEM_WORDS} where contains(joined, word)")},
{_terms("kinds", f"select id, component, lower(kind) as value from member union all select id, component, token from ordered where token in {_TYPE_WORDS}")},
single as (select id, component, token as word, row_number() over (partition by id order by i) as pos from ordered where length(token) > 2 qualify pos <= 8),
double as (select l.id, l.component, l.token || ' ' || r.token as word, 8 + l.i as pos from ordered l join ordered r on r.id = l.id and r.i = l.i + 1
  where l.token in ('custom', 'home', 'cake', 'wedding', 'airbnb', 'bakery', 'etsy', 'tattoo') or r.token in ('pricing', 'costing', 'budget', 'roi', 'fee', 'tracker', 'sheet', 'calculator')),
phrases as (select id, component, word as value, row_number() over (partition by id order by pos) - 1 as nth from (select * from single union all select * from double) qualify nth < 10),
counted as (select component, value, count(*) as votes, min({{'id': id, 'at': nth}}) as seen from phrases group by 1, 2),
top as (select *, row_number() over (partition by component order by votes desc, seen) as r from counted qualify r <= 12),
listed as (select component, list(value order by r) as words, list(value order by r) filter (value not in {_GENERAL}) as special from top group by 1),
named as (select component, count(*) as product_count, arg_min(trim(name), id) as first_name from member group by 1),
voted as (select n.*, a.value as niche, b.value as problem, lower(c.value) as kind from named n left join {_elected("first_niche")} a using (component) left join {_elected("problems")} b using (component) left join {_elected("kinds")} c using (component)),
other as (select component, string_agg(value, '|' order by i) as secondary from (select component, value, row_number() over (partition by component order by length(value) desc, value) as i
  from (select distinct p.component, p.value from problems p join voted v on v.component = p.component where p.value is distinct from v.problem)) where i <= 3 group by 1),
labelled as (select *, case when kind in ('calculator', 'spreadsheet', 'tracker', 'template', 'planner', 'tool', 'sheet') then {_titled("kind")} || 's' else {_titled("kind")} end as plural,
  case when problem = 'roi' then 'ROI' else {_titled("problem")} end as trouble, {_titled("niche")} as place from voted),
final as (select *, case when niche is not null and problem is not null and kind is not null then place || ' ' || trouble || ' ' || plural when niche is not null and kind is not null then place || ' ' || plural
  when niche is not null and problem is not null then place || ' ' || trouble when kind is not null then plural else coalesce(first_name, 'Product Market') end as cluster_name from labelled)
select component, product_count, cluster_name, coalesce(nullif(regexp_replace(regexp_replace(lower(cluster_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'product-market') as slug,
  niche, kind as product_type, problem as primary_problem, coalesce(secondary, '') as secondary_problems,
  coalesce(array_to_string((case when len(special) > 0 then special else words end)[1:10], '|'), '') as keywords, coalesce(confidence, 1.0) as confidence
from final left join other using (component) left join listed using (component) left join confident using (component)"""

SQL = {
    "q_recent_products": "select id, identity_key, cast(floor(epoch(updated_at)) as bigint) as updated_at from products where marketplace = 'etsy' order by products.updated_at desc nulls last, id desc limit 50",
    "q_recent_raw": "select id, marketplace, external_id from raw_marketplace_products order by id desc limit 50",
    "q_lookup": """select id, identity_key, p.marketplace, p.external_id from products p
      join (select marketplace, external_id from products where external_id is not null order by id desc limit 1) k on k.marketplace is not distinct from p.marketplace and k.external_id = p.external_id""",
    "q_cluster": """select c.id as cluster_id, cluster_name, slug, p.id as product_id, product_name
      from (select * from product_clusters order by product_count desc nulls last, id limit 1) c
      left join (select distinct cluster_id, product_id from product_cluster_memberships) m on m.cluster_id = c.id left join products p on p.id = m.product_id""",
    "q_observed": """select count(*) as observations, cast(floor(epoch(min(p.collected_at))) as bigint) as first_collected_at, cast(floor(epoch(max(p.collected_at))) as bigint) as last_collected_at
      from product_cluster_memberships m join products p on p.id = m.product_id where m.cluster_id in (select id from product_clusters order by id desc limit 10)""",
    "q_memberships": "select distinct cluster_id, membership_score, product_id from product_cluster_memberships join products on products.id = product_id",
    "q_latest_scores": """
with c as (select slug, product_count, confidence from product_clusters qualify row_number() over (partition by slug order by created_at desc nulls last, id desc) = 1),
r as (select slug, algorithm, run_id from product_clusters c join cluster_runs r on r.id = c.run_id where started_at is not null
  qualify row_number() over (partition by slug order by started_at desc, c.id desc) = 1)
select c.slug, product_count as cluster_product_count, confidence as cluster_confidence, algorithm as run_algorithm, run_id as run_run_id from c left join r using (slug) where c.slug is not null""",
    "q_ranking": """select row_number() over (order by product_count desc nulls last, confidence desc nulls last, id desc) as rank, id, product_count, confidence
      from product_clusters qualify rank <= 25""",
    "q_histogram": "select algorithm, completed_at is not null as completed, count(*) as runs from cluster_runs group by 1, 2",
    "q_counts": """select marketplace, count(*) as rows, 'products' as source from products group by 1
      union all select marketplace, count(*), 'raw_marketplace_products' from raw_marketplace_products group by 1""",
    "q_top_clusters": """select c.id, cluster_name, product_count, count(distinct product_id) as members
      from (select * from product_clusters order by product_count desc nulls last, created_at desc nulls last, id limit 100) c
      left join product_cluster_memberships m on m.cluster_id = c.id group by 1, 2, 3""",
    "q_cluster_members": "select id, product_name from products where id in (select product_id from product_cluster_memberships)",
    "q_latest_observation": """select marketplace, external_id, cast(floor(epoch(collected_at)) as bigint) as collected_at, id from raw_marketplace_products where external_id is not null
      qualify row_number() over (partition by marketplace, external_id order by raw_marketplace_products.collected_at desc nulls last, id desc) = 1""",
    "q_latest_run": "select id, algorithm, product_count, cluster_count from cluster_runs order by id desc limit 1",
    "q_observation_metadata": """select count(*) as observations, cast(floor(epoch(min(p.collected_at))) as bigint) as first_collected_at, cast(floor(epoch(max(p.collected_at))) as bigint) as last_collected_at
      from product_cluster_memberships m join products p on p.id = m.product_id""",
    "n_texts": f"""
with f as (select id, coalesce(json_extract_string(j, '$.price_text'), json_extract_string(j, '$.list_price')) as t, coalesce(json_extract_string(j, '$.review_count'), json_extract_string(j, '$.reviews_text')) as c,
    coalesce(json_extract_string(j, '$.rating'), json_extract_string(j, '$.rating_text')) as r from ({_READ}))
select id, {_amount("t")} as amount, {_currency("t")} as currency, {_reviews("c")} as reviews, {_rating("r")} as rating from f""",
    "n_urls": f"""
with u as (select id, 'raw' as source, coalesce(json_extract_string(j, '$.url'), json_extract_string(j, '$.listing_url')) as u from ({_READ}) union all select id, 'products', url from products)
select id, source, {_url("u")} as url from u where u is not null""",
    "n_display": """select id, case when price is not null then case currency when 'USD' then '$' when 'EUR' then '€' when 'GBP' then '£' when 'BRL' then 'R$ ' else coalesce(currency || ' ', '') end
      || printf('%.2f', cast(price as double)) end as display from products""",
    "n_keywords": """
select id, array_to_string(list_filter(ks, lambda k, i: list_position(list_transform(ks, lambda x: lower(x)), lower(k)) = i), '|') as keywords
from (select id, list_filter(list_transform(coalesce(keywords, []), lambda k: nullif(trim(regexp_replace(k, '\\s+', ' ', 'g')), '')), lambda k: k is not null) as ks from products)""",
    "n_combined": f"""select id, array_to_string({_keywords("list_concat(coalesce(keywords, []), [niche, product_type, category])")}, '|') as keywords,
      coalesce(nullif(trim(niche), ''), nullif(trim(category), ''), nullif(trim(search_query), '')) as label, rating from products""",
    "n_slugs": "select id, coalesce(nullif(regexp_replace(regexp_replace(lower(cluster_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'product-market') as slug from product_clusters",
    "n_identities": """select id, case when coalesce(external_id, '') <> '' then marketplace || ':id:' || external_id when coalesce(url, '') <> '' then marketplace || ':url:' || url end as identity,
      case when lower(trim(product_type)) in ('spreadsheet', 'calculator', 'tracker', 'template', 'unknown') then lower(trim(product_type)) end as type,
      case when collected_at is not null and listing_date is not null then greatest(0, cast(collected_at as date) - cast(listing_date as date)) end as age_days from products""",
    "g_report": f"""
with n as (select id, marketplace, external_id,
    case when marketplace in ('mock', 'etsy') and json_valid(raw_payload) then case when json_type(raw_payload) = 'OBJECT' then raw_payload end end as j from raw_marketplace_products),
k as (select marketplace, case when {_SQUEEZE.format("json_extract_string(j, case marketplace when 'etsy' then '$.title' else '$.name' end)")} is not null
    and nullif(trim(json_extract_string(j, case marketplace when 'etsy' then '$.url' else '$.listing_url' end)), '') is not null
    then coalesce(nullif(external_id, ''), regexp_extract(json_extract_string(j, case marketplace when 'etsy' then '$.url' else '$.listing_url' end), '^[^?#]*')
      || list_sort(list_filter(string_split(regexp_extract(json_extract_string(j, case marketplace when 'etsy' then '$.url' else '$.listing_url' end), '\\?([^#]*)', 1), '&'),
           lambda p: p <> '' and not regexp_matches(p, '^(utm_|ref=)')))::varchar) end as key from n)
select marketplace, count(*) as raw_collected, count(key) as normalized, count(distinct key) as inserted, count(key) - count(distinct key) as updated, count(*) - count(key) as failed from k group by 1""",
    "g_errors": f"""
with {NORMALIZED},
r as (select r.marketplace, case when r.marketplace is null or r.marketplace not in ('etsy', 'mock') then 'unregistered marketplace' when r.j is null then 'unreadable payload'
    when n.product_name is null or n.url is null then 'no name or address' end as error
  from ({_READ}) r left join normalized n on n.raw_product_id = r.id)
select marketplace, error, count(*) as rows from r group by 1, 2""",
    "g_products": f"""
with {NORMALIZED}
select * exclude (keywords, collected_at), array_to_string(keywords, '|') as keywords, '' as image_urls, cast(null as bigint) as listing_date, cast(null as int) as listing_age_days,
  cast(floor(epoch(collected_at)) as bigint) as collected_at
from keyed qualify row_number() over (partition by identity_key order by raw_product_id desc) = 1""",
    "g_upsert": f"""
with {NORMALIZED},
m as (select cast(floor((min(id) + max(id)) / 2) as bigint) as middle from raw_marketplace_products),
k as (select *, raw_product_id <= middle as early from keyed, m),
l as (select identity_key, max(case when early then raw_product_id end) as old_id, min(case when not early then raw_product_id end) as first_new, max(case when not early then raw_product_id end) as new_id from k group by 1)
select k.identity_key, raw_product_id, product_name, price, coalesce(old_id, new_id) as created_at, raw_product_id as updated_at, old_id is null as inserted
from l join k on k.identity_key = l.identity_key and k.raw_product_id = coalesce(new_id, old_id)""",
    "c_tokens": f"with {TOKENS} select id, token from tokens",
    "c_idf": f"with {IDF} select token, df, idf from idf",
    "c_similar": f"with {EDGES} select a, b, round(similarity, 6) as similarity from edges",
    "c_components": f"""
with recursive {EDGES},
both_ways as materialized (select a, b from edges union select b, a from edges),
reach(node, other) as (select distinct a, a from both_ways union select r.node, e.b from reach r join both_ways e on e.a = r.other)
select p.id as node, coalesce(min(other), p.id) as component from products p left join reach on reach.node = p.id group by p.id""",
    "k_concentration": f"""
with m as (select cluster_id, id, marketplace, coalesce({_SQUEEZE.format("seller")}, 'unknown') as seller, coalesce(review_count, 0) as reviews from ({_MEMBERS})),
s as (select cluster_id, seller, count(*) as n, sum(reviews) as r from m group by 1, 2),
t as (select cluster_id, sum(r) as top3 from (select *, row_number() over (partition by cluster_id order by r desc) as k from s) where k <= 3 group by 1),
c as (select cluster_id, count(*) as competitor_count, count(distinct seller) as seller_count, count(distinct marketplace) as marketplace_count, sum(reviews) as reviews from m group by 1)
select c.cluster_id, competitor_count, seller_count, marketplace_count, max(n) / competitor_count as top_seller_listing_share,
  case when reviews > 0 then cast(max(r) as double) / cast(reviews as double) end as top_seller_review_share,
  case when reviews > 0 then cast(any_value(top3) as double) / cast(reviews as double) end as top_3_review_share
from c join s using (cluster_id) join t using (cluster_id) group by c.cluster_id, competitor_count, seller_count, marketplace_count, reviews""",
    "k_dispersion": f"""
select cluster_id, count(price) as priced, cast(min(price) as double) as price_min, median(cast(price as double)) as price_median, cast(max(price) as double) as price_max,
  cast(sum(price) as double) / count(price) as price_mean, round(stddev_pop(cast(price as double)), 3) as price_stddev,
  cast(sum(cast(rating as decimal(12,4))) as double) / count(rating) as rating_mean
from ({_MEMBERS}) group by 1 having count(price) > 0""",
    "k_keywords": f"""
with k as (select cluster_id, lower({_SQUEEZE.format("k")}) as keyword from (select cluster_id, unnest(keywords) as k from ({_MEMBERS}))),
u as (select cluster_id, keyword, count(*) as uses from k where keyword is not null group by 1, 2)
select * from (select *, row_number() over (partition by cluster_id order by uses desc, keyword) as rank from u) where rank <= 8""",
    "k_price_segments": f"""
with r as (select cluster_id, cast(price as double) as price, row_number() over (partition by cluster_id order by cast(price as double), id) - 1 as i, count(*) over (partition by cluster_id) as n
  from ({_MEMBERS}) where price is not null)
select cluster_id, count(*) as priced, max(case when i = n // 4 then price end) as entry_price, max(case when i = n // 2 then price end) as middle_price,
  max(price) as leader_price, max(case when i = n // 3 then price end) as lower_third, max(case when i = 2 * n // 3 then price end) as upper_third from r group by 1""",
    "k_signals": f"""
with w as (select cluster_id, unnest(list_concat(coalesce(keywords, []), [niche, product_type],
    list_filter(regexp_split_to_array(trim(coalesce(description, '')), '\\s+'), lambda x: length(x) > 3))) as w from ({_MEMBERS})),
u as (select cluster_id, nullif(replace(trim(lower(w)), ' ', '-'), '') as signal, count(*) as uses from w group by 1, 2)
select * from (select *, row_number() over (partition by cluster_id order by uses desc, signal) as rank from u where signal is not null) where rank <= 12""",
    "k_images": f"""
select cluster_id, id as product_id, cast(i - 1 as int) as position, image_urls[i] as url from (
  select *, unnest(case when len(coalesce(image_urls, [])) = 0 then [null] else range(1, len(image_urls) + 1) end) as i from ({_MEMBERS}))""",
    "c_memberships": f"""with recursive {_GROUPED}, {_CONFIDENT}
select component, id as product_id, coalesce(confidence, 1.0) as membership_score from member left join confident using (component)""",
    "k_quality": f"""
with m as (select cluster_id, id, price, rating, case when description <> '' then len(list_filter(regexp_split_to_array(trim(description), '\\s+'), lambda w: w <> '')) end as words,
    list_transform(list_filter(coalesce(keywords, []), lambda k: k is not null), lambda k: lower(k)) as ks from ({_MEMBERS})),
u as (select cluster_id, sum(case when c > 1 then c else 0 end) as repeated from (select cluster_id, k, count(*) as c from (select cluster_id, unnest(ks) as k from m) group by 1, 2) group by 1),
s as (select cluster_id, count(*) as n, cast(sum(price) as double) / count(price) as mean, stddev_pop(cast(price as double)) as dev, cast(sum(cast(rating as decimal(12,4))) as double) / count(rating) as rm,
    median(cast(cast(rating as decimal(12,4)) as double)) as rating_median, count(rating) as rated, avg(words) as words, sum(len(ks)) as uses from m group by 1)
select cluster_id, n as competitor_count, rating_median, round(case when mean > 0 then greatest(0, least(1, dev / mean)) end, 6) as price_compression, round(rated / n, 6) as rated_share,
  round(case when rated > 0 then greatest(0, least(1, rm / 5 * 0.8 + rated / n * 0.2)) end, 6) as quality,
  round(case when words is not null or uses > 0 then greatest(0, least(1, coalesce(words, 0) / 80 * 0.7 + uses / n / 12 * 0.3)) end, 6) as depth,
  round(case when uses > 0 then greatest(0, least(1, 1 - repeated / uses)) end, 6) as differentiation
from s left join u using (cluster_id)""",
    "k_reviews": f"""select cluster_id, count(review_count) > 0 as reviews_available, cast(sum(coalesce(review_count, 0)) as bigint) as reviews_analyzed,
      case when count(review_count) > 0 then least(1.0, sum(coalesce(review_count, 0)) / 30) else 0.0 end as review_coverage from ({_MEMBERS}) group by 1""",
    "k_cluster_keywords": f"""
with w as (select cluster_id, unnest(list_concat(coalesce(keywords, []), [niche, product_type],
    list_filter(regexp_split_to_array(trim(coalesce(description, '')), '\\s+'), lambda x: length(x) > 3))) as w from ({_MEMBERS})),
u as (select cluster_id, nullif(replace(trim(lower(w)), ' ', '-'), '') as signal, count(*) as uses from w group by 1, 2),
top as (select cluster_id, list(signal) as signals from (select *, row_number() over (partition by cluster_id order by uses desc, signal) as rank from u where signal is not null) where rank <= 12 group by 1),
f as (select cluster_id, arg_min(coalesce(keywords, []), id) as first from ({_MEMBERS}) group by 1),
c as (select id as cluster_id, list_transform(list_filter(coalesce(c.keywords, []), lambda k: k is not null), lambda k: lower(k)) as own from product_clusters c),
j as (select c.cluster_id, unnest(list_concat(case when len(own) > 0 then own else list_transform(list_filter(coalesce(first, []), lambda k: k is not null), lambda k: lower(k)) end, coalesce(signals, []))) as k
  from c left join f using (cluster_id) left join top using (cluster_id)),
r as (select cluster_id, k, row_number() over (partition by cluster_id order by length(k) desc, k) as i from (select distinct cluster_id, k from j))
select c.cluster_id, coalesce(string_agg(k, '|' order by i), '') as keywords from c left join r on r.cluster_id = c.cluster_id and i <= 10 group by 1""",
    "k_long_tail": f"""
with p as (select distinct cluster_id, array_to_string(list_filter(list_transform(keywords, lambda k: lower(trim(k)))[1:4], lambda k: k <> ''), ' ') as phrase from ({_MEMBERS}) where len(keywords) >= 2)
select * from (select *, row_number() over (partition by cluster_id order by phrase) as rank from p) where rank <= 8""",
    "c_markets": _MARKETS,
}
