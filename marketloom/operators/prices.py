"""One price in US cents per product from columns, raw payloads and text that disagree about unit and scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.payload import with_observation
from marketloom.functions.units import CURRENCY_SYMBOLS, NUMBER, currency_code, money, unit
from marketloom.session import epoch_micros, staged, utc_month

_WRITTEN = sorted((s for v in CURRENCY_SYMBOLS.values() for s in v), key=len, reverse=True)
_SCALES = ("hundredths", "thousands", "thousand", "minor units", "cents", "cent", "by 1000", "by 100")
TRUSTED = {"price": 0.65, "scale": 0.65, "currency": 0.8}  # the frequent currency agrees by chance more often than an amount does


def _alternatives(words) -> str:
    return "|".join(r"\Q" + w + r"\E" for w in words)


_AMOUNT = rf"(?:{_alternatives(_WRITTEN)}) ?(?:{NUMBER})|(?:{NUMBER}) ?(?:{_alternatives(_WRITTEN)})(?![A-Za-z])"
_NAME = rf"(?<![A-Za-z\d$])(?:{_alternatives(w for w in _WRITTEN if len(w) > 2 and w.isascii())})(?![A-Za-z])"
_SCALE = rf"(?<![A-Za-z\d.,$])(?:{_alternatives(_SCALES)})(?![A-Za-z\d%]|[.,]\d)"
_LEFT, _RIGHT = r"((?:[A-Za-z][\w-]*[^\w.!?\n]{1,3}){0,2})", r"((?:[^\w.!?\n]{1,3}[\w-]+){0,2})"
MENTIONS = {"price": _AMOUNT, "currency": _NAME, "scale": _SCALE}


def mentions(products: DataFrame) -> DataFrame:
    """product_id, kind, said, left, right: what descriptions say in the form of an amount of money, a currency or a scale.

    `left` and `right` are up to two words on either side within the sentence, in lower case. Whether a mention is about the
    listing's own price isn't judged here.
    """
    def found(kind: str, pattern: str) -> Column:
        whole = rf"{_LEFT}({pattern}){_RIGHT}"
        words = lambda m, n: F.trim(F.regexp_replace(F.lower(F.regexp_extract(m, whole, n)), r"[^\w-]+", " "))
        read = lambda m: F.struct(F.lit(kind).alias("kind"), F.regexp_extract(m, whole, 2).alias("said"), words(m, 1).alias("left"), words(m, 3).alias("right"))
        return F.when(F.col("description").rlike(pattern), F.transform(F.regexp_extract_all("description", F.lit(whole), 0), read))

    each = [F.coalesce(found(k, p), F.array().cast("array<struct<kind:string,said:string,left:string,right:string>>")) for k, p in MENTIONS.items()]
    return products.where("description is not null").select("product_id", F.explode(F.concat(*each)).alias("m")).select("product_id", "m.*")


def trusted_statements(said: DataFrame, known: DataFrame) -> DataFrame:
    """product_id with text_amount, text_money (currency of that amount), text_currency and text_scale, where the text states them.

    Descriptions state prices, currencies and scales in any words, and mention other sums besides. Which words go with a
    statement is learnt from the listings whose raw payload is `known` (product_id, price, raw_amount, raw_currency): the
    share of mentions beside these words that agree with the payload, each context counted over all listings. A mention
    is believed if that share ((agreeing + 1) / (all + 2)) reaches TRUSTED; of several the best. Words that no listing
    with a payload uses can't be judged; such a mention is believed where it is the only one of its kind left in its text.
    """
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("said", "^by 1000$", "thousand"), "^by 100$", "cents"), "^minor units$", "cents")
    scale = unit(F.when(F.col("kind") == "scale", plain))["scale"]
    parsed = said.select("product_id", "kind", "left", "right", money(F.when(F.col("kind") == "price", F.col("said"))).alias("money"), currency_code(F.when(F.col("kind") == "currency", F.col("said"))).alias("code"), scale.cast("decimal(12,4)").alias("scale"))
    parsed = staged(parsed.where("money.amount is not null or code is not null or scale is not null"), "price-mentions")
    j = parsed.join(known.hint("merge"), "product_id")  # both grow with the products: neither is broadcast
    stated = F.col("money.amount").cast("decimal(24,6)")
    agrees = (
        F.when(F.col("kind") == "price", (stated == F.col("raw_amount")) & (F.col("money.currency") == F.col("raw_currency")))
        .when(F.col("kind") == "currency", F.col("code") == F.col("raw_currency"))
        .otherwise((F.col("price") * F.col("scale")).cast("decimal(24,6)") == F.col("raw_amount"))
    )
    sides = lambda: F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("left").alias("words")), F.struct(F.lit("right").alias("side"), F.col("right").alias("words")))).alias("c")
    learnt = (
        j.withColumn("agrees", agrees)
        .where("agrees is not null")
        .select("kind", "agrees", sides())
        .where("c.words <> '' and (c.side = 'left' or kind = 'price')")
        .groupBy("kind", "c.side", "c.words")
        .agg(((F.sum(F.col("agrees").cast("int")) + 1) / (F.count("*") + 2)).alias("trust"))
    )
    unknown = parsed.join(known.select("product_id").hint("merge"), "product_id", "left_anti")
    judged = unknown.select("*", sides()).select("product_id", "kind", "money", "code", "scale", "left", "right", "c.side", "c.words").join(learnt.hint("merge"), ["kind", "side", "words"], "left")
    needed = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in TRUSTED.items()))
    best = judged.groupBy("product_id", "kind", "money", "code", "scale", "left", "right").agg(F.max("trust").alias("trust"))
    best = best.where(F.col("trust").isNull() & ((F.col("kind") == "price") | (F.col("left") != "")) | (F.col("trust") >= needed))
    new = F.sum(F.col("trust").isNull().cast("int")).over(W.partitionBy("product_id", "kind"))
    best = best.withColumn("new", new).where(F.col("trust").isNotNull() | (F.col("new") == 1))
    pick = lambda kind, value, name: F.max_by(F.when(F.col("kind") == kind, value), F.when(F.col("kind") == kind, F.struct(F.coalesce("trust", F.lit(0.0)), value))).alias(name)
    return best.groupBy("product_id").agg(pick("price", F.col("money"), "text_price"), pick("currency", F.col("code"), "text_currency"), pick("scale", F.col("scale"), "text_scale"))


def resolved_prices(products: DataFrame, raw: DataFrame, rates: DataFrame) -> DataFrame:
    """product_id, amount, currency, usd_cents, origin, as_stored for every products row; unknown values are NULL.

    The raw row named by `raw_product_id` decides where it has a readable price. Otherwise the price column (scaled by
    what the description says it counts in), else the price stated in the description; and the currency stated in the
    description, else the currency column in any spelling; `trusted_statements` tells what counts as a statement.
    `usd_cents` uses the rate of the UTC month of the product's `collected_at`, halves rounded up; without a rate, or too
    large for it, it is NULL. `as_stored` tells whether `price` and `currency`, read literally, already say the same. NULL
    in any column, blank texts, repeated raw ids (the row collected last counts, then the higher amount), repeated product
    rows and empty tables are allowed; only the columns named are read.

    Raw payloads are parsed before the one shuffle that brings them to their product, so that only id, amount and currency
    travel and not the payloads, which are most of the input; the rates table joins by its measured size.
    """
    p = products.select(
        F.col("id").alias("product_id"),
        F.col("raw_product_id"),
        F.col("price").cast("decimal(24,6)").alias("price"),
        "currency",
        "description",
        utc_month(epoch_micros(products, "collected_at")).alias("rate_month"),
    )
    observed = (
        with_observation(raw.select("id", "marketplace", "external_id", "raw_payload", epoch_micros(raw, "collected_at").alias("at")))
        .select(F.col("id").alias("raw_product_id"), "at", F.col("obs_amount").alias("raw_amount"), F.col("obs_currency").alias("raw_currency"))
        .where("raw_product_id is not null")
        .groupBy("raw_product_id")
        .agg(F.max(F.struct("at", "raw_amount", "raw_currency")).alias("r"))
    )
    j = p.drop("description").join(observed, "raw_product_id", "left").withColumn("raw_amount", F.col("r.raw_amount")).withColumn("raw_currency", F.col("r.raw_currency")).drop("r")
    j = staged(j, "price-sources")
    statements = trusted_statements(mentions(p), j.where("raw_amount is not null and product_id is not null").select("product_id", "price", "raw_amount", "raw_currency").distinct())
    j = j.join(statements.hint("merge"), "product_id", "left")
    known = F.col("raw_amount").isNotNull()
    scale = F.coalesce("text_scale", F.lit(1).cast("decimal(12,4)"))
    column_price = (F.col("price") * scale).cast("decimal(24,6)")
    from_text = F.col("price").isNull()
    amount = F.when(known, F.col("raw_amount")).when(from_text, F.col("text_price.amount").cast("decimal(24,6)")).otherwise(column_price)
    currency = F.when(known, F.col("raw_currency")).otherwise(
        F.coalesce(F.when(from_text, F.col("text_price.currency")), F.col("text_currency"), currency_code(F.col("currency")))
    )
    j = j.withColumn("amount", amount).withColumn("true_currency", currency)
    both = F.col("amount").isNotNull() & F.col("true_currency").isNotNull()
    fx = rates.select(F.col("currency").alias("true_currency"), "rate_month", F.col("usd_per_unit").cast("decimal(18,6)").alias("usd_per_unit"))
    cents = F.round(F.col("amount").try_cast("decimal(18,6)") * F.col("usd_per_unit") * 100, 0).try_cast("bigint")
    literal = F.col("price").eqNullSafe(F.col("amount")) & F.col("currency").eqNullSafe(F.col("true_currency"))
    return j.join(fx, ["true_currency", "rate_month"], "left").select(
        "product_id",
        F.when(both, F.col("amount")).alias("amount"),
        F.when(both, F.col("true_currency")).alias("currency"),
        F.when(both, cents).alias("usd_cents"),
        F.when(~both, F.lit("unknown")).when(known, F.lit("raw")).when(from_text, F.lit("description")).otherwise(F.lit("columns")).alias("origin"),
        F.when(both, literal).alias("as_stored"),
    )


def corrected_prices(products: DataFrame, raw: DataFrame, rates: DataFrame) -> DataFrame:
    """product_id, usd_cents of the rows whose price is known but not what the columns say literally."""
    return resolved_prices(products, raw, rates).where("not as_stored and usd_cents is not null").select("product_id", "usd_cents").distinct()
