"""Marketplace payloads (JSON texts) read into one observation schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.units import currency_code, money

# The field names of each marketplace's payload and the value of its on-sale field that means on sale.
FIELDS = {
    "etsy": {"title": "title", "seller": "shop_name", "own_id": "listing_id", "sale": "state", "on": "active"},
    "mock": {"title": "name", "seller": "seller_name", "own_id": "id", "sale": "available", "on": "true"},
    "gumroad": {"title": "name", "seller": "creator", "own_id": "permalink", "sale": "published", "on": "true"},
    "creative_market": {"title": "headline", "seller": "vendor", "own_id": "item_id", "sale": "status", "on": "live"},
}
_PRICE_FIELDS = ("price", "price_text", "price_cents", "currency", "list_price")
_OPTIONS = {"columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}


def squeeze(text: Column) -> Column:
    """White space of any kind collapsed and trimmed; blank becomes NULL."""
    return F.nullif(F.trim(F.regexp_replace(text, r"[\s\p{Z}\x1c-\x1f\x85]+", " ")), F.lit(""))


def _by_marketplace(marketplace: Column, key: str, pick) -> Column:
    out = F.lit(None).cast("string")
    for name, fields in FIELDS.items():
        out = F.when(marketplace == name, pick(fields[key])).otherwise(out)
    return out


def with_observation(raw: DataFrame, marketplace: str = "marketplace", external_id: str = "external_id", payload: str = "raw_payload") -> DataFrame:
    """Add obs_listing_id, obs_on_sale, obs_title, obs_amount, obs_currency and obs_seller, read from the payload.

    Columns of their own, so that what a plan doesn't use isn't computed. `obs_on_sale` is NULL where the payload is no JSON object with its marketplace's on-sale field (unreadable or cut off
    texts, arrays, error answers, NULL, unknown marketplace): such a row is no observation. `obs_listing_id` is the
    external id column, or the payload's own id where that is NULL. Text attributes have white space squeezed; an
    attribute that is absent, NULL, blank or unreadable is NULL. Amount and currency are known together or not at all.
    """
    names = sorted({f[k] for f in FIELDS.values() for k in ("title", "seller", "own_id", "sale")} | set(_PRICE_FIELDS))
    schema = ", ".join(f"`{n}` string" for n in (*names, "_broken"))
    m = F.col(marketplace)
    parsed = raw.withColumn("_json", F.from_json(F.col(payload), schema, _OPTIONS))
    j = lambda n: F.col("_json")[n]
    price_object = F.from_json(F.when((m == "etsy") & j("price").startswith("{"), j("price")), "amount string, divisor string, currency_code string")
    text = (
        F.when((m == "etsy") & ~j("price").startswith("{"), j("price"))
        .when(m == "mock", j("price_text"))
        .when(m == "creative_market", j("list_price"))
    )
    parsed = parsed.withColumn("_object", price_object).withColumn("_text", money(text))
    divisor = F.coalesce(F.nullif(F.col("_object.divisor").try_cast("decimal(14,2)"), F.lit(0).cast("decimal(14,2)")), F.lit(100).cast("decimal(14,2)"))
    amount = (
        F.when(F.col("_object").isNotNull(), (F.col("_object.amount").try_cast("decimal(20,4)") / divisor).cast("decimal(38,10)"))
        .when(m == "gumroad", (j("price_cents").try_cast("decimal(20,4)") / F.lit(100).cast("decimal(5,0)")).cast("decimal(38,10)"))
        .otherwise(F.col("_text.amount"))
    )
    currency = (
        F.when(F.col("_object").isNotNull(), currency_code(F.col("_object.currency_code")))
        .when(m == "gumroad", currency_code(j("currency")))
        .otherwise(F.col("_text.currency"))
    )
    seller = F.when((m == "gumroad") & j("creator").startswith("{"), F.get_json_object(j("creator"), "$.name")).when(
        m != "gumroad", _by_marketplace(m, "seller", j)
    )
    on = F.lit(None).cast("boolean")
    for name, fields in FIELDS.items():
        on = F.when(m == name, F.lower(F.trim(j(fields["sale"]))) == fields["on"]).otherwise(on)
    readable = F.col(payload).rlike(r"^\s*\{") & j("_broken").isNull()
    parsed = parsed.withColumn("_amount", amount).withColumn("_currency", currency)
    both = F.col("_amount").isNotNull() & F.col("_currency").isNotNull()
    return parsed.select(
        *raw.columns,
        F.coalesce(F.col(external_id), _by_marketplace(m, "own_id", j)).alias("obs_listing_id"),
        F.when(readable, on).alias("obs_on_sale"),
        squeeze(_by_marketplace(m, "title", j)).alias("obs_title"),
        F.when(both, F.col("_amount")).cast("decimal(24,6)").alias("obs_amount"),
        F.when(both, F.col("_currency")).alias("obs_currency"),
        squeeze(seller).alias("obs_seller"),
    )
