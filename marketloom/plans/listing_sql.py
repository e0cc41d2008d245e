"""Independent ANSI SQL (DuckDB) statements of the listing queries, for checking the Spark plans."""

_SQUEEZE = "nullif(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"

_CURRENCY_OF_TEXT = """case
    when {x} like '%R$%' or upper({x}) like '%BRL%' then 'BRL'
    when {x} like '%CA$%' or {x} like '%C$%' or upper({x}) like '%CAD%' then 'CAD'
    when {x} like '%A$%' or {x} like '%AU$%' or upper({x}) like '%AUD%' then 'AUD'
    when {x} like '%€%' or upper({x}) like '%EUR%' then 'EUR'
    when {x} like '%£%' or upper({x}) like '%GBP%' then 'GBP'
    when {x} like '%¥%' or upper({x}) like '%JPY%' then 'JPY'
    when {x} like '%$%' or upper({x}) like '%USD%' then 'USD' end"""

_NUMBER_OF_TEXT = """case when regexp_matches(regexp_extract({x}, '[0-9][0-9.,]*'), '[.,][0-9]{{1,2}}$')
    then cast(replace(replace(regexp_replace(regexp_extract({x}, '[0-9][0-9.,]*'), '[.,]([0-9]{{1,2}})$', '#\\1'), '.', ''), ',', '').replace('#', '.') as decimal(24,6))
    else try_cast(replace(replace(regexp_extract({x}, '[0-9][0-9.,]*'), '.', ''), ',', '') as decimal(24,6)) end
    / case when {x} ilike '%cent%' then 100 else 1 end"""

OBSERVED = f"""
objects as (
  select id, marketplace, external_id, epoch_us(collected_at) as at_us,
         case when json_valid(raw_payload) then case when json_type(raw_payload) = 'OBJECT' then raw_payload end end as j
  from raw_marketplace_products
),
fields as (
  select id, marketplace, at_us, j,
    coalesce(external_id, json_extract_string(j, case marketplace when 'etsy' then '$.listing_id' when 'mock' then '$.id' when 'gumroad' then '$.permalink' else '$.item_id' end)) as listing_id,
    json_extract_string(j, case marketplace when 'etsy' then '$.state' when 'mock' then '$.available' when 'gumroad' then '$.published' else '$.status' end)
      = case marketplace when 'etsy' then 'active' when 'creative_market' then 'live' else 'true' end as on_sale,
    {_SQUEEZE.format(x="json_extract_string(j, case marketplace when 'etsy' then '$.title' when 'creative_market' then '$.headline' else '$.name' end)")} as title,
    {_SQUEEZE.format(x="json_extract_string(j, case marketplace when 'etsy' then '$.shop_name' when 'mock' then '$.seller_name' when 'gumroad' then '$.creator.name' else '$.vendor' end)")} as seller,
    case when marketplace = 'mock' then json_extract_string(j, '$.price_text')
         when marketplace = 'creative_market' then json_extract_string(j, '$.list_price')
         when marketplace = 'etsy' and json_type(j, '$.price') = 'VARCHAR' then json_extract_string(j, '$.price') end as price_text
  from objects where j is not null
),
priced as (
  select *,
    case when marketplace = 'gumroad' then try_cast(json_extract_string(j, '$.price_cents') as decimal(20,4)) / 100
         when marketplace = 'etsy' and json_type(j, '$.price') = 'OBJECT' then
           try_cast(json_extract_string(j, '$.price.amount') as decimal(20,4)) / try_cast(json_extract_string(j, '$.price.divisor') as decimal(20,4))
         else {_NUMBER_OF_TEXT.format(x="price_text")} end as amount_0,
    case when marketplace = 'gumroad' then upper(json_extract_string(j, '$.currency'))
         when marketplace = 'etsy' and json_type(j, '$.price') = 'OBJECT' then upper(json_extract_string(j, '$.price.currency_code'))
         else {_CURRENCY_OF_TEXT.format(x="price_text")} end as currency_0
  from fields
),
observed as (
  select id, marketplace, listing_id, at_us, on_sale, title, seller,
    case when amount_0 is not null and currency_0 is not null then cast(amount_0 as decimal(24,6)) end as amount,
    case when amount_0 is not null and currency_0 is not null then currency_0 end as currency
  from priced
)"""

HISTORY = f"""
with {OBSERVED},
latest as (
  select * from observed where on_sale is not null and at_us is not null and listing_id is not null
  qualify row_number() over (partition by marketplace, listing_id, at_us order by id desc) = 1
),
filled as (
  select marketplace, listing_id, at_us, on_sale,
    last_value(case when on_sale then title end ignore nulls) over w as title,
    last_value(case when on_sale then amount end ignore nulls) over w as amount,
    last_value(case when on_sale then currency end ignore nulls) over w as currency,
    last_value(case when on_sale then seller end ignore nulls) over w as seller
  from latest window w as (partition by marketplace, listing_id order by at_us rows between unbounded preceding and current row)
),
flagged as (
  select *, case when on_sale then
      not coalesce(lag(on_sale) over w, false)
      or (title is distinct from lag(title) over w) or (amount is distinct from lag(amount) over w)
      or (currency is distinct from lag(currency) over w) or (seller is distinct from lag(seller) over w)
    else coalesce(lag(on_sale) over w, false) end as is_event
  from filled window w as (partition by marketplace, listing_id order by at_us)
),
events as (
  select *, lead(at_us) over (partition by marketplace, listing_id order by at_us) as until_us from flagged where is_event
)
select marketplace, listing_id as external_id, title, amount, currency, seller,
  cast(floor(at_us / 1000000) as bigint) as valid_from, coalesce(cast(floor(until_us / 1000000) as bigint), -1) as valid_to
from events where on_sale"""

HISTORY_FOUND = f"select distinct marketplace, external_id, valid_from, valid_to from ({HISTORY})"

_SIGNS = r"US\$|CA\$|C\$|AU\$|A\$|R\$|GB£|\$|€|£|¥|USD|EUR|GBP|BRL|CAD|AUD|JPY"
_FIGURE = r"[0-9](?:[0-9]|[.,][0-9])*"
_WORDS = r"US dollars|Canadian dollars|Australian dollars|Brazilian reais|pounds sterling|British pounds|dollars|euros|pounds|reais|yen|USD|EUR|GBP|BRL|CAD|AUD|JPY"
_SAID = {
    "price": rf"((?:{_SIGNS}) ?{_FIGURE}|{_FIGURE} ?(?:{_SIGNS}))",
    "currency": rf"\b({_WORDS})\b",
    "scale": r"\b(hundredths|thousands?|minor units|cents?|by 1000|by 100)\b",
}
_BEFORE, _AFTER = r"((?:[A-Za-z][\w-]*[^\w.!?\n]{1,3}){0,2})", r"((?:[^\w.!?\n]{1,3}[\w-]+){0,2})"
_SPOKEN_CODE = """case {x} when 'US dollars' then 'USD' when 'dollars' then 'USD' when 'Canadian dollars' then 'CAD' when 'Australian dollars' then 'AUD'
    when 'Brazilian reais' then 'BRL' when 'reais' then 'BRL' when 'pounds sterling' then 'GBP' when 'British pounds' then 'GBP' when 'pounds' then 'GBP'
    when 'euros' then 'EUR' when 'yen' then 'JPY' else nullif({x}, '') end"""


def _mentions(kind: str) -> str:
    whole = _BEFORE + _SAID[kind] + _AFTER
    context = lambda n: f"trim(regexp_replace(lower(regexp_extract(m, '{whole}', {n})), '[^\\w-]+', ' ', 'g'))"
    return f"""select product_id, '{kind}' as kind, regexp_extract(m, '{whole}', 2) as said, {context(1)} as before, {context(3)} as behind
    from (select id as product_id, unnest(regexp_extract_all(description, '{whole}')) as m from products)"""


PRICES = f"""
with {OBSERVED},
r as (select id, amount, currency from observed where amount is not null qualify row_number() over (partition by id order by at_us desc, amount desc) = 1),
p as (select products.id as product_id, price, products.currency, strftime(collected_at, '%Y-%m') as rate_month, r.amount as raw_amount, r.currency as raw_currency
  from products left join r on r.id = products.raw_product_id),
said as ({" union all ".join(_mentions(k) for k in _SAID)}),
read as (
  select *, row_number() over () as n, case when kind = 'price' then {_NUMBER_OF_TEXT.format(x="said")} end as amount,
    case kind when 'price' then {_CURRENCY_OF_TEXT.format(x="said")} when 'currency' then {_SPOKEN_CODE.format(x="said")} end as code,
    case when kind = 'scale' then case when said like '%thousand%' or said = 'by 1000' then 1000 else 0.01 end end as factor
  from said),
sides as (select *, before as words, 'left' as side from read union all select *, behind, 'right' from read where kind = 'price'),
learnt as (
  select kind, side, words, (count(*) filter (agrees) + 1) / (count(*) + 2) as trust from (
    select kind, side, words, case kind when 'price' then amount = raw_amount and code = raw_currency when 'currency' then code = raw_currency
      else cast(price * factor as decimal(24,6)) = raw_amount end as agrees
    from sides join (select distinct product_id, price, raw_amount, raw_currency from p where raw_amount is not null) using (product_id) where words <> '')
  where agrees is not null group by all),
judged as (
  select product_id, kind, amount, code, factor, before, behind, max(trust) as trust from sides left join learnt using (kind, side, words)
  where product_id not in (select product_id from p where raw_amount is not null) group by all),
believed as (
  select * from (select *, count(*) filter (trust is null) over (partition by product_id, kind) as new from judged
    where (trust is null and (kind = 'price' or before <> '')) or trust >= case kind when 'currency' then 0.8 else 0.65 end)
  where trust is not null or new = 1),
best as (select * from believed qualify row_number() over (partition by product_id, kind order by coalesce(trust, 0) desc, amount desc, code desc, factor desc) = 1),
u as (
  select p.product_id, price, p.currency, rate_month,
    case when raw_amount is not null then raw_amount when price is null then a.amount else price * coalesce(s.factor, 1) end as amount,
    case when raw_amount is not null then raw_currency
         else coalesce(case when price is null then a.code end, c.code, {_CURRENCY_OF_TEXT.format(x="p.currency")}) end as true_currency
  from p left join best a on a.product_id = p.product_id and a.kind = 'price' left join best c on c.product_id = p.product_id and c.kind = 'currency'
    left join best s on s.product_id = p.product_id and s.kind = 'scale'
)
select product_id, cast(amount as decimal(24,6)) as amount, true_currency as currency,
  cast(floor(amount * usd_per_unit * 100 + 0.5) as bigint) as usd_cents,
  (price is not distinct from amount) and (u.currency is not distinct from true_currency) as as_stored
from u join fx_rates f on f.currency = u.true_currency and f.rate_month = u.rate_month where amount is not null"""

PRICES_FOUND = f"select distinct product_id, usd_cents from ({PRICES}) where not as_stored"
