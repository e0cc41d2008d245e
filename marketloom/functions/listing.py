"""Scalar normalisation of listing fields as Catalyst expressions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.payload import squeeze
from marketloom.functions.units import let

# Currency markers in order of precedence, then codes.
MARKERS = (("R$", "BRL"), ("US$", "USD"), ("CA$", "CAD"), ("A$", "AUD"), ("£", "GBP"), ("€", "EUR"), ("¥", "JPY"), ("$", "USD"))
CODES = ("USD", "EUR", "GBP", "BRL", "CAD", "AUD", "JPY")
# Query parameters that only track visits.
TRACKING = ("ref", "referrer", "campaign", "click_key", "click_sum", "ga_order", "ga_search_query", "ga_view_type", "ls", "organic_search_click")
PRODUCT_TYPES = ("spreadsheet", "calculator", "tracker", "template", "unknown")


def normalize_text(text: Column) -> Column:
    """White space of any kind collapsed and trimmed; blank becomes NULL."""
    return squeeze(text)


def price_currency(text: Column) -> Column:
    """The first marker contained, else the first code contained, else NULL."""
    upper = F.upper(text)
    tests = [F.when(upper.contains(m), F.lit(c)) for m, c in (*MARKERS, *((c, c) for c in CODES))]
    return F.coalesce(*tests)


def price_amount(text: Column) -> Column:
    """The first number as decimal(18,4). Of two kinds of mark the right-most is the decimal mark; a lone kind groups
    thousands if three digits follow the last one (or, for dots, if there are several); unreadable is NULL."""

    def read(n: Column) -> Column:
        commas, dots = F.split(n, ","), F.split(n, r"\.")
        last_comma, last_dot = F.get(commas, F.size(commas) - 1), F.get(dots, F.size(dots) - 1)
        bare = F.regexp_replace(n, "[.,]", "")
        comma_later = F.length(last_comma) < F.length(last_dot)
        mixed = F.when(comma_later, F.replace(F.replace(n, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(n, F.lit(","), F.lit("")))
        only_comma = F.when(F.length(last_comma) == 3, bare).otherwise(F.regexp_replace(F.regexp_replace(n, ",(?=.*,)", ""), ",", "."))
        only_dot = F.when((F.size(dots) > 2) | (F.length(last_dot) == 3), bare).otherwise(n)
        has_comma, has_dot = F.size(commas) > 1, F.size(dots) > 1
        return F.when(has_comma & has_dot, mixed).when(has_comma, only_comma).when(has_dot, only_dot).otherwise(n)

    raw = F.nullif(F.regexp_replace(F.regexp_extract(text, r"\d[\d\s.,]*", 0), r"\s", ""), F.lit(""))
    return let(raw, read).try_cast("decimal(18,4)")


def review_count(text: Column) -> Column:
    """Reviews as a whole number: `532 reviews`, `1,234`, `2.1k`, `3m`; a letter k or m right behind the number scales it."""
    pattern = r"(\d[\d.,]*)([km])?"

    def read(t: Column) -> Column:
        n, suffix = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)
        scaled = F.replace(n, F.lit(","), F.lit(".")).try_cast("decimal(20,6)") * F.when(suffix == "k", 1_000).otherwise(1_000_000)
        return F.when(suffix != "", F.floor(scaled)).otherwise(F.regexp_replace(n, "[.,]", "").try_cast("bigint")).cast("bigint")

    return let(F.replace(F.lower(F.trim(text)), F.lit(" "), F.lit("")), read)


def rating(text: Column) -> Column:
    """A rating out of five: `4.9 / 5`, `4,8 stars`; another scale or a value outside 0 to 5 is NULL."""
    scale = r"([0-9]+(?:\.[0-9]+)?)\s*/\s*([0-9]+(?:\.[0-9]+)?)"

    def read(t: Column) -> Column:
        a, b = (F.regexp_extract(t, scale, i).try_cast("double") for i in (1, 2))
        lone = F.regexp_extract(t, r"[0-9]+(?:\.[0-9]+)?", 0).try_cast("double")
        value = F.when(t.rlike(scale), F.when(b == 5, a)).otherwise(lone)
        return F.when(value.between(0, 5), value)

    return let(F.replace(F.lower(F.trim(text)), F.lit(","), F.lit(".")), read)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, tracking parameters and fragment dropped, other parameters encoded anew."""

    def read(u: Column) -> Column:
        base = F.regexp_extract(u, r"^([^?#]*)", 1)
        head = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
        query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
        pairs = F.filter(F.split(query, "&"), lambda p: p != "")
        key = lambda p: F.lower(F.try_url_decode(F.regexp_extract(p, "^([^=]*)", 1)))
        kept = F.filter(pairs, lambda p: ~key(p).startswith("utm_") & ~key(p).isin(*TRACKING))
        again = F.transform(
            kept,
            lambda p: F.concat(
                F.url_encode(F.try_url_decode(F.regexp_extract(p, "^([^=]*)", 1))), F.lit("="), F.url_encode(F.try_url_decode(F.regexp_extract(p, "^[^=]*=?(.*)$", 1)))
            ),
        )
        return F.concat(F.lower(head), F.substr(base, F.length(head) + 1), F.when(F.size(again) > 0, F.concat(F.lit("?"), F.array_join(again, "&"))).otherwise(F.lit("")))

    return let(F.trim(url), read)


def normalize_keywords(values: Column) -> Column:
    """Squeezed, without blanks, the first spelling of each kept in order whatever the case."""
    clean = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), squeeze), lambda k: k.isNotNull())
    return let(clean, lambda ks: F.filter(ks, lambda k, i: F.array_position(F.transform(ks, lambda x: F.lower(x)), F.lower(k)) == i + 1))


def combined_keywords(*sources: Column) -> Column:
    """Several keyword arrays one after another, each word once, in the spelling that comes first; NULL sources are empty."""
    none = F.array().cast("array<string>")
    return normalize_keywords(F.concat(*(F.coalesce(s, none) for s in sources)))


def first_filled(*texts: Column) -> Column:
    """The first text that isn't NULL or blank, without outer white space."""
    return F.coalesce(*(F.nullif(F.trim(t), F.lit("")) for t in texts))


def safe_number(value: Column) -> Column:
    """A number as double; what can't be read as a finite one is NULL."""
    n = F.trim(value.cast("string")).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def controlled_product_type(text: Column) -> Column:
    value = F.lower(F.trim(text))
    return F.when(value.isin(*PRODUCT_TYPES), value)


def listing_age_days(listed: Column, now: Column) -> Column:
    """Whole days since a listing was made, at least 0; NULL if either date is unknown."""
    return F.when(listed.isNotNull() & now.isNotNull(), F.greatest(F.lit(0), F.datediff(now, listed)))


def slug(text: Column, fallback: str = "product-market") -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit(fallback))


def identity_key(marketplace: Column, external_id: Column, url: Column) -> Column:
    """`<marketplace>:id:<external id>`, else `<marketplace>:url:<url>`, NULL if there is neither."""
    by_id = F.when(F.coalesce(external_id, F.lit("")) != "", F.concat(marketplace, F.lit(":id:"), external_id))
    return F.coalesce(by_id, F.when(F.coalesce(url, F.lit("")) != "", F.concat(marketplace, F.lit(":url:"), url)))


def price_display(amount: Column, currency: Column) -> Column:
    sign = F.when(currency == "USD", "$").when(currency == "EUR", "€").when(currency == "GBP", "£").when(currency == "BRL", "R$ ")
    return F.when(amount.isNotNull(), F.concat(F.coalesce(sign, F.concat(currency, F.lit(" ")), F.lit("")), F.format_string("%.2f", amount.cast("double"))))


# --- tokens of clustering texts -------------------------------------------------------------------------------------

# Words that say nothing about the market of a listing.
PROMOTIONAL = (
    "digital", "download", "instant", "editable", "printable", "best", "seller", "bundle", "premium", "2026",
    "2025", "2024", "sale", "offer", "new", "popular", "etsy", "excel", "google", "kindle",
    "canva", "xlsx", "csv", "pdf",
)
NOISE = (
    "for", "and", "the", "with", "from", "your", "home", "shop", "online",
)


def singular(token: Column) -> Column:
    """A simple plural ending taken off: ...ies, ...sses, ...s."""
    n = F.length(token)
    return (
        F.when(token.endswith("ies") & (n > 4), F.concat(F.substr(token, F.lit(1), n - 3), F.lit("y")))
        .when(token.endswith("sses") & (n > 5), F.substr(token, F.lit(1), n - 2))
        .when(token.endswith("s") & ~token.endswith("ss") & (n > 3), F.substr(token, F.lit(1), n - 1))
        .otherwise(token)
    )


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, each in the singular."""
    return F.transform(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda t: t != ""), singular)


def clustering_text(name: Column, niche: Column, category: Column, product_type: Column, keywords: Column, description: Column) -> Column:
    """What the tokens of a product are read from, in lower case."""
    return F.lower(F.concat_ws(" ", name, niche, category, product_type, keywords, description))


class _Known(dict):
    """Word -> its token, None for promotional and noise words; what has been met is kept, up to a number of words."""

    def __missing__(self, word: bytes) -> str | None:
        t = word.decode()
        if t.endswith("ies") and len(t) > 4:
            t = t[:-3] + "y"
        elif t.endswith("sses") and len(t) > 5:
            t = t[:-2]
        elif t.endswith("s") and not t.endswith("ss") and len(t) > 3:
            t = t[:-1]
        t = None if t in _SILENT else t
        if len(self) < 200_000 and len(word) < 50:
            self[word] = t
        return t


_SILENT = frozenset((*PROMOTIONAL, *NOISE))


def token_lists(texts: pa.Array) -> pa.Array:
    """The distinct tokens of each lower-case text in order of first appearance: `words` without promotional and noise words. Several times faster than as an expression."""
    known, values, ends = _Known(), [], [0]
    for text in texts.cast(pa.binary()).to_pylist():
        tokens = dict.fromkeys(map(known.__getitem__, _RUNS(text or b"")))
        tokens.pop(None, None)
        values.extend(tokens)
        ends.append(len(values))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.string()))


_RUNS = re.compile(rb"[a-z0-9]+").findall
