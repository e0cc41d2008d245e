"""Quantities with units: a grammar of numbers and unit expressions, evaluated as Catalyst expressions.

    quantity   = [unit] number [unit]
    number     = digits with grouping and decimal marks of either convention
    unit       = factor { ("*" | "·" | " ") factor | ("/" | "per") factor }
    factor     = symbol [ "^" integer ]

A symbol stands for a vector of exponents over BASE_DIMENSIONS, a scale and an offset to the canonical unit
(metre, kilogram, second, kelvin, byte, one, unit of money). The vectors of the factors are added, their scales
multiplied; the offset counts only where the unit is that one symbol. A currency symbol also carries its ISO code.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_DIMENSIONS = ("length", "mass", "time", "temperature", "information", "count", "money")

# Symbols of ISO 4217 currencies and the ways they are written or spoken of.
CURRENCY_SYMBOLS = {
    "USD": ("USD", "US$", "$", "US dollar", "US dollars", "dollar", "dollars"),
    "EUR": ("EUR", "€", "euro", "euros"),
    "GBP": ("GBP", "£", "GB£", "pound", "pounds", "pound sterling", "pounds sterling", "British pounds"),
    "BRL": ("BRL", "R$", "real", "reais", "Brazilian real", "Brazilian reais"),
    "CAD": ("CAD", "CA$", "C$", "Canadian dollar", "Canadian dollars"),
    "AUD": ("AUD", "AU$", "A$", "Australian dollar", "Australian dollars"),
    "JPY": ("JPY", "¥", "JP¥", "yen", "Japanese yen"),
}

# Unit symbols as (dimension exponents by name, scale, offset).
_UNITS: dict[str, tuple[dict[str, int], float, float]] = {
    "m": ({"length": 1}, 1.0, 0.0),
    "in": ({"length": 1}, 0.0254, 0.0),
    "inch": ({"length": 1}, 0.0254, 0.0),
    "inches": ({"length": 1}, 0.0254, 0.0),
    '"': ({"length": 1}, 0.0254, 0.0),
    "ft": ({"length": 1}, 0.3048, 0.0),
    "yd": ({"length": 1}, 0.9144, 0.0),
    "mi": ({"length": 1}, 1609.344, 0.0),
    "g": ({"mass": 1}, 0.001, 0.0),
    "t": ({"mass": 1}, 1000.0, 0.0),
    "lb": ({"mass": 1}, 0.45359237, 0.0),
    "oz": ({"mass": 1}, 0.028349523125, 0.0),
    "s": ({"time": 1}, 1.0, 0.0),
    "sec": ({"time": 1}, 1.0, 0.0),
    "min": ({"time": 1}, 60.0, 0.0),
    "minute": ({"time": 1}, 60.0, 0.0),
    "minutes": ({"time": 1}, 60.0, 0.0),
    "h": ({"time": 1}, 3600.0, 0.0),
    "hour": ({"time": 1}, 3600.0, 0.0),
    "hours": ({"time": 1}, 3600.0, 0.0),
    "day": ({"time": 1}, 86400.0, 0.0),
    "days": ({"time": 1}, 86400.0, 0.0),
    "week": ({"time": 1}, 604800.0, 0.0),
    "weeks": ({"time": 1}, 604800.0, 0.0),
    "month": ({"time": 1}, 2629746.0, 0.0),
    "months": ({"time": 1}, 2629746.0, 0.0),
    "quarter": ({"time": 1}, 7889238.0, 0.0),
    "quarters": ({"time": 1}, 7889238.0, 0.0),
    "year": ({"time": 1}, 31556952.0, 0.0),
    "years": ({"time": 1}, 31556952.0, 0.0),
    "K": ({"temperature": 1}, 1.0, 0.0),
    "°C": ({"temperature": 1}, 1.0, 273.15),
    "°F": ({"temperature": 1}, 5.0 / 9.0, 459.67 * 5.0 / 9.0),
    "B": ({"information": 1}, 1.0, 0.0),
    "bit": ({"information": 1}, 0.125, 0.0),
    "J": ({"mass": 1, "length": 2, "time": -2}, 1.0, 0.0),
    "N": ({"mass": 1, "length": 1, "time": -2}, 1.0, 0.0),
    "W": ({"mass": 1, "length": 2, "time": -3}, 1.0, 0.0),
    "Pa": ({"mass": 1, "length": -1, "time": -2}, 1.0, 0.0),
    "Hz": ({"time": -1}, 1.0, 0.0),
    "l": ({"length": 3}, 0.001, 0.0),
    "L": ({"length": 3}, 0.001, 0.0),
    "tab": ({"count": 1}, 1.0, 0.0),
    "tabs": ({"count": 1}, 1.0, 0.0),
    "row": ({"count": 1}, 1.0, 0.0),
    "rows": ({"count": 1}, 1.0, 0.0),
    "line": ({"count": 1}, 1.0, 0.0),
    "lines": ({"count": 1}, 1.0, 0.0),
    "worksheets": ({"count": 1}, 1.0, 0.0),
    "%": ({}, 0.01, 0.0),
    "cent": ({}, 0.01, 0.0),
    "cents": ({}, 0.01, 0.0),
    "hundredths": ({}, 0.01, 0.0),
    "thousand": ({}, 1000.0, 0.0),
    "thousands": ({}, 1000.0, 0.0),
    "k": ({}, 1000.0, 0.0),
    "million": ({}, 1e6, 0.0),
}
_PREFIXES = {"k": 1e3, "M": 1e6, "G": 1e9, "c": 1e-2, "m": 1e-3, "µ": 1e-6}
_PREFIXED = {"m": "kcmµ", "g": "kmµ", "s": "mµ", "B": "kMG", "W": "kMm", "J": "kM", "N": "k", "Pa": "kM", "Hz": "kMG", "l": "cm", "L": "cm"}


def _vector(dims: dict[str, int]) -> list[int]:
    return [dims.get(d, 0) for d in BASE_DIMENSIONS]


def registry() -> dict[str, tuple[list[int], float, float, str | None]]:
    """symbol -> (exponent vector, scale, offset, ISO code or None), long symbols in lower case too."""
    out: dict[str, tuple[list[int], float, float, str | None]] = {}
    for symbol, (dims, scale, offset) in _UNITS.items():
        out[symbol] = (_vector(dims), scale, offset, None)
    for symbol, prefixes in _PREFIXED.items():
        dims, scale, offset = _UNITS[symbol]
        for p in prefixes:
            out.setdefault(p + symbol, (_vector(dims), scale * _PREFIXES[p], offset, None))
    for iso, symbols in CURRENCY_SYMBOLS.items():
        for symbol in symbols:
            out[symbol.replace(" ", "_")] = (_vector({"money": 1}), 1.0, 0.0, iso)
    for symbol, entry in list(out.items()):  # the key a symbol in another case is looked up by
        if len(symbol) > 1:
            out.setdefault(symbol.lower(), entry)
    return out


_REGISTRY = registry()
_SPOKEN = sorted((s for v in CURRENCY_SYMBOLS.values() for s in v if " " in s), key=len, reverse=True)


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _literal(values: dict, kind: str) -> Column:
    """A map known at planning time: one literal that the optimizer folds, rather than an expression per entry."""
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), kind)


def _registry_column() -> Column:
    entries = {s: {"dims": vector, "scale": scale, "offset": offset, "iso": iso} for s, (vector, scale, offset, iso) in _REGISTRY.items()}
    return _literal(entries, "map<string, struct<dims: array<int>, scale: double, offset: double, iso: string>>")


def _iso_column() -> Column:
    return _literal({s: e[3] for s, e in _REGISTRY.items() if e[3]}, "map<string, string>")


_GROUPING = r"['’    ]"
NUMBER = r"\d++(?:[.,]\d++|" + _GROUPING + r"\d{3}(?!\d))*+"  # possessive: of any length without recursion


def number(text: Column) -> Column:
    """The first number of a text as decimal(38,10), NULL where there is none.

    With both marks the right-most is the decimal mark. One kind of mark, standing once with other than three digits
    behind it or after a lone zero, is the decimal mark; else it groups thousands. Spaces and apostrophes group.
    """

    def parts(x: Column) -> Column:
        last = F.regexp_extract(x, r"([.,])\d+$", 1)
        dots, commas = F.length(F.regexp_replace(x, "[^.]", "")), F.length(F.regexp_replace(x, "[^,]", ""))
        tail = F.length(F.regexp_extract(x, r"[.,](\d+)$", 1))
        both = (dots > 0) & (commas > 0) & (F.when(last == ".", dots).otherwise(commas) == 1)
        single = (dots + commas == 1) & ((tail != 3) | x.rlike(r"^0[.,]"))
        return F.struct(F.regexp_replace(x, "[.,]", "").alias("d"), F.when((last != "") & (both | single), tail).otherwise(F.lit(0)).alias("n"))

    def join(p: Column) -> Column:
        d, n = p["d"], p["n"]
        return F.when(n > 0, F.concat(d.substr(F.lit(1), F.length(d) - n), F.lit("."), F.right(d, n))).otherwise(d)

    raw = F.regexp_replace(F.nullif(F.regexp_extract(text, NUMBER, 0), F.lit("")), _GROUPING, "")
    return let(raw, lambda x: let(parts(x), join)).try_cast("decimal(38,10)")


def unit_factors(expression: Column) -> Column:
    """array<struct<dims,scale,offset,iso,power>> of a unit expression; an unknown symbol gives a NULL element."""
    u = F.regexp_replace(F.regexp_replace(expression, "²", "^2"), "³", "^3")
    for phrase in _SPOKEN:
        u = F.regexp_replace(u, r"(?i)\b" + phrase.replace(" ", r"\s+") + r"\b", phrase.replace(" ", "_").lower())
    u = F.regexp_replace(F.regexp_replace(u, r"(?i)(^|\s)per\s+", " /"), r"\s*/\s*", " /")
    tokens = F.filter(F.split(u, r"[\s*·]+"), lambda t: t != "")
    known = _registry_column()

    def factor(token: Column) -> Column:
        sign = F.when(token.startswith("/"), F.lit(-1)).otherwise(F.lit(1))
        symbol = F.regexp_extract(token, r"^/?(.+?)(?:\^(-?\d+))?$", 1)
        power = F.coalesce(F.nullif(F.regexp_extract(token, r"\^(-?\d+)$", 1), F.lit("")).try_cast("int"), F.lit(1)) * sign

        def of(symbols: Column) -> Column:
            spec = F.coalesce(F.try_element_at(known, symbols), F.try_element_at(known, F.lower(symbols)))
            return let(spec, lambda x: F.when(x.isNotNull(), F.struct(x["dims"], x["scale"], x["offset"], x["iso"], power)))

        return let(symbol, of).cast("struct<dims:array<int>,scale:double,offset:double,iso:string,power:int>")

    return F.transform(tokens, factor)


def unit(expression: Column) -> Column:
    """struct<dims array<int>, scale double, offset double, iso string> of a unit expression; NULL if a symbol is unknown."""
    zero = F.expr(f"array({','.join('0' for _ in BASE_DIMENSIONS)})")

    def combine(factors: Column) -> Column:
        dims = F.aggregate(factors, zero, lambda acc, f: F.zip_with(acc, f["dims"], lambda a, b: a + b * f["power"]))
        scale = F.aggregate(factors, F.lit(1.0), lambda acc, f: acc * F.pow(f["scale"], f["power"]))
        only = F.get(factors, F.lit(0))
        offset = F.when((F.size(factors) == 1) & (only["power"] == 1), only["offset"]).otherwise(F.lit(0.0))
        iso = F.get(F.filter(F.transform(factors, lambda f: f["iso"]), lambda i: i.isNotNull()), F.lit(0))
        known = (F.size(factors) > 0) & ~F.exists(factors, lambda f: f.isNull())
        return F.when(known, F.struct(dims.alias("dims"), scale.alias("scale"), offset.alias("offset"), iso.alias("iso")))

    return let(unit_factors(expression), combine)


def quantity(text: Column) -> Column:
    """struct<number decimal, unit_text string, unit struct, canonical double> of a text such as `US$ 1,234.50` or `21 cm`.

    NULL text, text without a number or with an unknown unit: the fields concerned are NULL. A bare number has no unit.
    """
    negative = text.rlike(r"(^|[^\d])[-−]\s*\d")
    around = F.regexp_replace(text, r"(?s)^(.*?)(?:" + NUMBER + ")", "$1 ")
    words = F.trim(F.regexp_replace(F.regexp_replace(around, r"(^|\s)[-−](\s|$)", " "), r"\s+", " "))
    parts = F.struct(number(text).alias("n"), negative.alias("minus"), words.alias("w"), unit(words).alias("u"))

    def whole(p: Column) -> Column:
        signed = F.when(p["minus"], -p["n"]).otherwise(p["n"])
        return F.struct(signed.alias("number"), p["w"].alias("unit_text"), p["u"].alias("unit"), (signed.cast("double") * p["u"]["scale"] + p["u"]["offset"]).alias("canonical"))

    return let(parts, whole)


def currency_code(text: Column) -> Column:
    """ISO code of a currency written in any known way, NULL if unknown or blank."""
    known = _iso_column()
    key = F.regexp_replace(F.trim(text), r"\s+", "_")
    return let(key, lambda k: F.coalesce(F.try_element_at(known, k), F.try_element_at(known, F.lower(k)), F.try_element_at(known, F.upper(k))))


def money(text: Column) -> Column:
    """struct<amount decimal(38,10), currency string>: a text read as a quantity whose dimension is money^1.

    Anything else (no number, no currency, another dimension) gives NULL fields. `$` alone is USD.
    """
    vector = F.expr(f"array({','.join(map(str, _vector({'money': 1})))})")

    def read(q: Column) -> Column:
        amount = (q["number"].cast("decimal(24,8)") * q["unit"]["scale"].cast("decimal(12,4)")).cast("decimal(38,10)")
        is_money = q["unit"]["dims"] == vector
        return F.struct(F.when(is_money, amount).alias("amount"), F.when(is_money, q["unit"]["iso"]).alias("currency"))

    return let(quantity(text), read)
