"""Markets: products joined by TF-IDF similarity, their components, and what describes each of them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.listing import clustering_text, slug, token_lists
from marketloom.functions.units import let
from marketloom.operators.components import connected_components
from marketloom.session import staged

THRESHOLD = 0.72
# Weights of cosine, shared words and shared niche or type in the similarity.
COSINE, OVERLAP, SHARED = 0.55, 0.20, 0.25
DIMENSIONS, OWN = 256, 128  # of the vectors whose products bound similarities; those that one token has alone
FOLDED, KEPT = 128, 16  # of the shorter vectors that are multiplied first; those that stay what they are there
BLOCK = 24_000  # products whose vectors are multiplied with those of as many others at once
COMMON = 20_000  # most frequent tokens whose codes go to the tasks
SMALL = 128  # members of a component that are compared in one row
_UNIT = 1 << 21  # parts of 1 in which those vectors are kept
# Word -> problem, and word -> product type.
PROBLEMS = {
    "pricing": "pricing", "price": "pricing", "cost": "costing", "costing": "costing", "budget": "budgeting", "budgeting": "budgeting",
    "roi": "roi", "return": "roi", "profit": "profit", "fee": "fee", "fees": "fee", "inventory": "inventory", "expense": "expense",
    "expenses": "expense", "commission": "commission", "pricing calculator": "pricing", "cost calculator": "costing",
}
TYPES = {
    "calculator": "calculator", "calculators": "calculator", "spreadsheet": "spreadsheet", "spreadsheets": "spreadsheet", "tracker": "tracker",
    "trackers": "tracker", "template": "template", "templates": "template", "planner": "planner", "workbook": "workbook", "tool": "tool", "sheet": "sheet",
}
# Terms of the niche taxonomy (`sources.listings.taxonomy` reads others), words too general for keywords,
# plural names of types, and the words that open or close a two-word keyword.
NICHES = ("bakery", "airbnb", "wedding", "tattoo artist", "etsy", "home baker", "short term rental", "marketplace seller", "cake", "custom cake", "rental property", "event planning")
GENERIC = ("calculator", "spreadsheet", "tracker", "template", "planner", "tool", "sheet", "pricing", "costing", "budget", "fee", "roi", "inventory")
PLURALS = {t: t.capitalize() + "s" for t in ("calculator", "spreadsheet", "tracker", "template", "planner", "tool", "sheet")}
_LEADS = ("custom", "home", "cake", "wedding", "airbnb", "bakery", "etsy", "tattoo")
_ENDS = ("pricing", "costing", "budget", "roi", "fee", "tracker", "sheet", "calculator")


def with_tokens(products: DataFrame) -> DataFrame:
    """id, product_name, niche, niche_key, type_key, tokens."""
    c = F.col
    read = products.where("id is not null").select(
        c("id").cast("long"),
        "product_name",
        "niche",
        F.nullif(F.lower("niche"), F.lit("")).alias("niche_key"),
        c("product_type").alias("type_key"),
        clustering_text(c("product_name"), c("niche"), c("category"), c("product_type"), c("keywords"), c("description")).alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], token_lists(batch.columns[-1])], names=[*batch.schema.names[:-1], "tokens"])

    return read.mapInArrow(cut, "id long, product_name string, niche string, niche_key string, type_key string, tokens array<string>")


def document_frequencies(tokens: DataFrame) -> DataFrame:
    """token, df, idf over all products: ln((n + 1) / (df + 1)) + 1."""
    return _counted(tokens)[0]


def _counted(tokens: DataFrame) -> tuple[DataFrame, int]:
    n = tokens.count()
    return tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")).withColumn("idf", _idf(n, F.col("df"))), n


def _idf(n: int, df: Column) -> Column:
    return F.log(F.lit(float(max(n, 1)) + 1) / (df + 1)) + 1


def _numbered(idf: DataFrame) -> DataFrame:
    """Adds `code` to token rows: df and, in the low 32 bits, a number of the token's own, which for the most frequent ones is under OWN.

    Codes in ascending order are tokens in order of rarity, and equal if their tokens are.
    """
    counted = staged(idf.withColumn("place", F.monotonically_increasing_id()), "market-idf")  # part << 33 | row
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    parts = (counted.agg(F.max(part)).first()[0] or 0) + 1
    first = counted.orderBy(F.col("df").desc(), "token").limit(OWN)
    first = first.select("token", (F.row_number().over(W.orderBy(F.col("df").desc(), "token")) - 1).cast("bigint").alias("own"))
    number = F.coalesce("own", OWN + row * parts + part)
    return counted.join(F.broadcast(first), "token", "left").select("token", F.shiftleft("df", 32).bitwiseOR(number).alias("code"), (F.col("idf") * F.col("idf")).alias("w2"))


def _number(code: Column) -> Column:
    return code.bitwiseAND(F.lit(0xFFFFFFFF))


_SKETCH = ("bits0", "bits1")


def similar_products(products: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b (a < b), similarity of every pair of products that reaches the threshold (above SHARED + OVERLAP).

    similarity = 0.55 cosine of the idf vectors + 0.20 Jaccard of the tokens + 0.25 if niche or product type are shared.
    Pairs of one niche or type are tested all, by `_alike`, as matrix products that bound cosine and Jaccard together.

    Other pairs have to reach the threshold by their tokens alone and meet at one, in the order of rarity. From the rarest token two
    products share on, what is left of both vectors bounds their cosine and what is left of both token sets bounds their Jaccard at the same time (as
    does the number of bits in which sketches of the sets differ); a token is in a product's prefix if the two bounds
    together could still reach the threshold with the best possible partner (equal from there on), and a pair is a
    candidate if they can for these two. Where neither product could reach it with one whose rest is as small a
    part as its own, the pair can't: so at least one is in its `near` prefix, and common tokens, which few have there,
    aren't joined with themselves. Each candidate is verified exactly, once.
    """
    _check(threshold)
    return _similar(*_vectors(_tokens(products)), threshold)


def _tokens(products: DataFrame) -> DataFrame:
    return staged(with_tokens(products).select("id", "niche_key", "type_key", "tokens"), "market-tokens")


def _check(threshold: float) -> None:
    if threshold <= SHARED + OVERLAP:
        raise ValueError(f"the threshold must be above {SHARED + OVERLAP}")


def _vectors(tokens: DataFrame) -> tuple[DataFrame, int]:
    """id, niche_key, type_key, t (codes of the tokens), size, norm2, sketch of every product with tokens, and the number of products.

    The codes of the COMMON most frequent tokens go to the tasks, so that only the others, of which products have few, are joined.
    """
    frequencies, n = _counted(tokens)
    numbered = _numbered(frequencies)
    common = numbered.orderBy(F.col("code").desc()).where("length(token) < 50").limit(COMMON).toPandas()
    names, codes = pa.array(common["token"], pa.string()), common["code"].to_numpy(np.int64)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            at = pc.index_in(flat, value_set=names).fill_null(-1).to_numpy()
            parts = [pa.ListArray.from_arrays(_ends(row[kept], len(lists)), values) for kept, values in ((at >= 0, pa.array(codes[at[at >= 0]])), (at < 0, flat.filter(pa.array(at < 0))))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *parts], names=["id", "niche_key", "type_key", "t", "others"])

    told = tokens.where(F.size("tokens") > 0).select("id", "niche_key", "type_key", "tokens")
    coded = staged(told.mapInArrow(split, "id long, niche_key string, type_key string, t array<long>, others array<string>"), "market-codes")
    others = coded.select("id", F.explode("others").alias("token")).join(numbered, "token").groupBy("id").agg(F.collect_list("code").alias("more"))
    whole = coded.drop("others").join(others, "id", "left").select("id", "niche_key", "type_key", F.sort_array(F.when(F.col("more").isNull(), F.col("t")).otherwise(F.concat("t", "more"))).alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat, w2, row, size = _unpacked(batch, n)
                first = np.cumsum(size) - size
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int32)), pa.array(np.add.reduceat(w2, first)), *map(pa.array, _parity(flat, first))], names=[*batch.schema.names, "size", "norm2", *_SKETCH])

    return staged(whole.mapInArrow(measure, "id long, niche_key string, type_key string, t array<long>, size int, norm2 double, bits0 long, bits1 long"), "market-vectors"), n


def _ends(row: np.ndarray, rows: int) -> pa.Array:
    """Offsets of the lists of `rows` rows whose values stand in the given rows."""
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32))


def _parity(codes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits, each telling whether an odd number of the tokens from each `first` on falls on it: two sets differ in at least as many tokens as bits."""
    place = ((codes & 0xFFFFFFFF).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)
    bit = np.uint64(1) << (place & np.uint64(63))
    return [np.bitwise_xor.reduceat(np.where(place >> np.uint64(6) == k, bit, np.uint64(0)), first).view(np.int64) for k in (0, 1)]


def _similar(vectors: DataFrame, n: int, threshold: float) -> DataFrame:
    found = _alike(vectors, n, threshold - SHARED).groupBy("a", "b").agg(F.max("part").alias("part")).select("a", "b", F.least(F.lit(1.0), F.col("part") + SHARED).alias("similarity"))
    if threshold > COSINE + OVERLAP:
        return found.where(F.col("similarity") >= threshold)
    w2 = lambda code: F.pow(_idf(n, F.shiftright(code, 32)), 2)
    pairs = staged(_alike_anywhere(vectors, w2, threshold).distinct(), "market-pairs")
    once = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    verified = vectors.join(once, "id", "left_semi").select("id", "norm2", "t")
    pairs = pairs.join(verified.alias("x"), F.col("a") == F.col("x.id")).join(verified.alias("y"), F.col("b") == F.col("y.id"))
    both = let(F.array_intersect("x.t", "y.t"), lambda c: F.struct(F.aggregate(c, F.lit(0.0), lambda acc, e: acc + w2(e)).alias("dot"), F.size(c).alias("n")))
    pairs = pairs.select("a", "b", (F.col("x.norm2") * F.col("y.norm2")).alias("norms"), (F.size("x.t") + F.size("y.t")).alias("sizes"), both.alias("both"))
    cosine = F.least(F.lit(1.0), F.col("both.dot") / F.sqrt("norms"))
    score = COSINE * cosine + OVERLAP * F.col("both.n") / (F.col("sizes") - F.col("both.n"))
    return found.unionByName(pairs.select("a", "b", F.least(F.lit(1.0), score).alias("similarity"))).where(F.col("similarity") >= threshold)


def _alike(vectors: DataFrame, n: int, needed: float, block: int = BLOCK) -> DataFrame:
    """a, b, part: all pairs of one niche or type whose cosine and Jaccard parts together reach `needed`; those of both stand there twice.

    A token counts x = sqrt(0.55 w2 / norm2 + 0.20 / size). As (p + q)(r + s) >= (sqrt(pr) + sqrt(qs))^2, and a Jaccard similarity
    is at most the common tokens over the root of both sizes, the product of two such vectors is never less than the
    two parts; nor is it if tokens share a dimension as the root of their squares' sum. Dense vectors of
    DIMENSIONS, shorter ones first, are multiplied in blocks of about `block` products: each pair of blocks of a niche or type is one group of rows,
    so one of any size is spread over tasks. What passes is compared exactly where it was found, token by token.
    """
    packed = vectors.select("id", "norm2", "t", F.explode(F.array(F.concat(F.lit("n"), "niche_key"), F.concat(F.lit("t"), "type_key"))).alias("key")).where("key is not null")
    count = packed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = packed.join(count, "key").withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    left = placed.select("key", F.col("at").alias("i"), F.explode(F.sequence("at", F.col("blocks") - 1)).alias("j"), "id", "norm2", "t")
    right = placed.where("at > 0").select(F.col("key").alias("key"), F.explode(F.sequence(F.lit(0), F.col("at") - 1)).alias("i"), F.col("at").alias("j"), *(F.col(c).alias(c) for c in ("id", "norm2", "t")))
    side = lambda rows: rows.repartition(_tasks(vectors, 16), "key", "i", "j").groupBy("key", "i", "j")
    least = needed - 1e-4  # more than the error of a product of single precision

    def meet(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        if key[1].as_py() == key[2].as_py():
            return _compared(_met(*[_weighed(one, n)] * 2, True, least), one, n, needed)
        return _compared(_met(_weighed(one, n), _weighed(other, n), False, least), pa.concat_tables([one, other]), n, needed)

    return side(left).cogroup(side(right)).applyInArrow(meet, "a long, b long, part double")


def _tasks(df: DataFrame, times: int = 4) -> int:
    """Number of tasks of steps whose work isn't told by the bytes they read, which adaptive execution goes by."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), times * spark.sparkContext.defaultParallelism)


def _unpacked(rows: pa.Table | pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the tokens of all rows, one after another, their squared weights, the row of each, and the number of every row."""
    lists = rows.column("t")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    codes, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    return codes, (np.log((max(n, 1) + 1.0) / ((codes >> 32) + 1)) + 1) ** 2, np.repeat(np.arange(len(size)), size), size


def _weighed(rows: pa.Table, n: int) -> pa.Table:
    """id, x: dimension of each token and, in units of DIMENSIONS, the square it counts, rounded up."""
    codes, w2, row, size = _unpacked(rows, n)
    number = codes & 0xFFFFFFFF
    x2 = COSINE * w2 / rows.column("norm2").to_numpy()[row] + OVERLAP / size[row]
    x = np.ceil(x2 * _UNIT).astype(np.int32) * DIMENSIONS + np.where(number < OWN, number, OWN + number % (DIMENSIONS - OWN)).astype(np.int32)
    return pa.table({"id": rows.column("id"), "x": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), x)})


def _compared(pairs: pa.Table, rows: pa.Table, n: int, needed: float, most: int = 20_000) -> pa.Table:
    """a, b, part: cosine and Jaccard parts of those `pairs` of `rows` that reach `needed`; `most` are compared at a time."""
    a, b = (pairs.column(c).to_numpy() for c in "ab")
    part = np.zeros(len(a))
    if len(a):
        ids = rows.column("id").to_numpy()
        kept = np.flatnonzero(np.isin(ids, np.concatenate([a, b])))
        kept = kept[np.argsort(ids[kept])]
        ids, rows = ids[kept], rows.take(kept)
        codes, w2, _, size = _unpacked(rows, n)
        norm2, first = rows.column("norm2").to_numpy(), np.cumsum(size) - size
        number = np.unique(codes, return_inverse=True)[1]  # as codes ascend in each row, so do these
        span = int(number.max()) + 1

        def spread(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Pair and token as one number, ascending, and where the token stands."""
            length = size[row]
            pair = np.repeat(np.arange(len(row)), length)
            at = np.arange(len(pair)) + np.repeat(first[row] - (np.cumsum(length) - length), length)
            return pair * span + number[at], at

        for k in range(0, len(a), most):
            i, j = np.searchsorted(ids, a[k : k + most]), np.searchsorted(ids, b[k : k + most])
            (x, at), (y, _) = spread(i), spread(j)
            there = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
            pair, common = x[there] // span, at[there]
            dot, c = np.bincount(pair, w2[common], len(i)), np.bincount(pair, minlength=len(i))
            part[k : k + most] = COSINE * np.minimum(1.0, dot / np.sqrt(norm2[i] * norm2[j])) + OVERLAP * c / (size[i] + size[j] - c)
    enough = part >= needed - 1e-9
    return pa.table({"a": a[enough], "b": b[enough], "part": part[enough]})


def _met(one: pa.Table, other: pa.Table, same: bool, least: float, tile: int = 512) -> pa.Table:
    """a, b: pairs of rows whose vectors' product is `least` or more; vectors of FOLDED dimensions, whose product is never less, tell which are multiplied in full."""
    fold = np.where(np.arange(DIMENSIONS) < KEPT, np.arange(DIMENSIONS), KEPT + np.arange(DIMENSIONS) % (FOLDED - KEPT))

    def dense(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = rows.column("x").combine_chunks()
        values = lists.flatten().to_numpy()
        row, at = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy()), values % DIMENSIONS
        root = lambda at, d: np.sqrt(np.bincount(row * d + at, values // DIMENSIONS / _UNIT, rows.num_rows * d).reshape(-1, d), dtype=np.float32, casting="same_kind")
        return rows.column("id").to_numpy(), root(at, DIMENSIONS), root(fold[at], FOLDED)

    ids, x, short_x = dense(one)
    others, y, short_y = (ids, x, short_x) if same else dense(other)
    found = [np.zeros((2, 0), np.int64)]
    for r in range(0, len(x), tile):
        for c in range(r if same else 0, len(y), tile):
            product = short_x[r : r + tile] @ short_y[c : c + tile].T
            hit = np.flatnonzero(product >= least)
            i, j = r + hit // product.shape[1], c + hit % product.shape[1]
            if same and r == c:  # each pair stands there twice
                i, j = i[i < j], j[i < j]
            if 16 * len(i) > product.size:
                full = (x[r : r + tile] @ y[c : c + tile].T)[i - r, j - c]
            else:
                full = np.einsum("kd,kd->k", x[i], y[j])
            i, j = i[full >= least], j[full >= least]
            a, b = ids[i], others[j]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
    pairs = np.concatenate(found, axis=1)
    return pa.table({"a": pairs[0], "b": pairs[1]})


def _alike_anywhere(vectors: DataFrame, w2: Callable[[Column], Column], needed: float) -> DataFrame:
    """a, b: pairs without common niche or type that may reach `needed` by cosine and Jaccard. Tokens don't travel with the rows, as few pairs are left."""
    first = F.slice("t", 1, F.floor(F.col("size") * F.lit((COSINE + OVERLAP - needed) / OVERLAP) + 1e-9).cast("int") + 1)  # later tokens leave too few for Jaccard
    before = F.aggregate(F.slice("t", 1, F.col("at")), F.lit(0.0), lambda acc, e: acc + w2(e))
    kept = ("id", "niche_key", "type_key", "norm2", "size", *_SKETCH)
    rows = vectors.select(*kept, "t", F.posexplode(first).alias("at", "code")).select(
        *kept, "code", w2(F.col("code")).alias("w2"), (F.col("norm2") - before).alias("rest2"), (F.col("size") - F.col("at")).alias("rest")
    )
    own = COSINE * F.sqrt(F.col("rest2") / F.col("norm2")) + OVERLAP * F.col("rest") / F.col("size")
    prefix = rows.where((F.shiftright("code", 32) > 1) & (own >= needed - 1e-9))
    prefix = staged(prefix.withColumn("near", COSINE * F.col("rest2") / F.col("norm2") + OVERLAP * F.col("rest") / F.col("size") >= needed - 1e-9), "market-prefix")
    side = lambda rows: rows.repartition(_tasks(vectors), "code")
    x, y = side(prefix.where("near")).alias("x"), side(prefix).alias("y")
    differ = F.bit_count(F.col("x.bits0").bitwiseXOR(F.col("y.bits0"))) + F.bit_count(F.col("x.bits1").bitwiseXOR(F.col("y.bits1")))
    common = F.least("x.rest", "y.rest", F.floor((F.col("x.size") + F.col("y.size") - differ) / 2))
    dot = F.least("x.rest2", "y.rest2", common * F.col("x.w2"))  # no later token weighs more than this one
    cosine = dot / F.sqrt(F.col("x.norm2") * F.col("y.norm2"))
    met = x.join(y, F.col("x.code") == F.col("y.code")).where("x.id <> y.id and (x.id < y.id or not y.near)")
    met = met.where(COSINE * cosine + OVERLAP * common / (F.col("x.size") + F.col("y.size") - common) >= needed - 1e-9).where(~_shared("x", "y"))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _shared(x: str, y: str) -> Column:
    same = lambda n: F.coalesce(F.col(f"{x}.{n}") == F.col(f"{y}.{n}"), F.lit(False))
    return same("niche_key") | same("type_key")


def _longest_first(values: Column) -> Column:
    return F.transform(F.array_sort(F.transform(F.array_distinct(values), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))), lambda s: s["v"])


def _looked_up(tokens: Column, known: dict[str, str]) -> Column:
    table = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in known.items()) + ")")
    return F.array_compact(F.transform(tokens, lambda t: F.try_element_at(table, t)))


def with_terms(tokens: DataFrame, niches: tuple[str, ...] = NICHES) -> DataFrame:
    """Adds niche_terms, problem_terms, type_terms (longest first) and keywords (at most ten) to token rows."""
    t = F.col("tokens")
    joined = F.array_join(t, " ")
    has = lambda w: F.when(F.array_contains(t, w), F.lit(w))
    niche = F.array_compact(
        F.concat(
            F.array(F.nullif(F.lower("niche"), F.lit("")), *(has(w) for w in niches if " " not in w)),
            F.array(F.when(F.array_contains(t, "tattoo") | F.array_contains(t, "ink"), F.lit("tattoo artist"))),
        )
    )
    problem = F.array_compact(F.array(*(F.when(joined.contains(k), F.lit(v)) for k, v in PROBLEMS.items())))
    kind = F.concat(F.array_compact(F.array(F.lower("type_key"))), _looked_up(t, TYPES))
    singles = F.slice(F.filter(t, lambda w: F.length(w) > 2), 1, 8)
    bigrams = F.filter(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - 2, F.lit(0))), lambda i: F.struct(F.get(t, i).alias("l"), F.get(t, i + 1).alias("r"))),
        lambda p: p["r"].isNotNull() & (p["l"].isin(*_LEADS) | p["r"].isin(*_ENDS)),
    )
    keywords = F.slice(F.array_union(singles, F.transform(bigrams, lambda p: F.concat_ws(" ", p["l"], p["r"]))), 1, 10)
    return tokens.select(
        "*", _longest_first(niche).alias("niche_terms"), _longest_first(problem).alias("problem_terms"), _longest_first(kind).alias("type_terms"), keywords.alias("keywords")
    )


def _votes(rows: DataFrame, terms: str) -> DataFrame:
    """component, value, votes, seen: how often members name a term and where first, in order of id."""
    return (
        rows.select("component", "id", F.posexplode(terms).alias("at", "value"))
        .groupBy("component", "value")
        .agg(F.count("*").alias("votes"), F.min(F.struct("id", "at")).alias("seen"))
    )


def _elected(votes: DataFrame, name: str) -> DataFrame:
    """The value with most votes of each component, the one seen first at a tie."""
    ranked = F.struct(F.col("votes"), (-F.col("seen.id")).alias("i"), (-F.col("seen.at")).alias("p"))
    return votes.groupBy("component").agg(F.max_by("value", ranked).alias(name))


def _title(text: Column) -> Column:
    """Every letter behind a non-letter in upper case."""
    pieces = F.regexp_extract_all(text, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(pieces, F.initcap), "")


def describe_markets(members: DataFrame) -> DataFrame:
    """One row per component of `members` (with_terms rows plus `component`): name, slug, voted metadata and keywords."""
    first = members.withColumn("niche_first", F.slice("niche_terms", 1, 1))
    votes = {"niche": _votes(first, "niche_first"), "primary_problem": _votes(members, "problem_terms"), "product_type": _votes(members, "type_terms")}
    out = members.groupBy("component").agg(F.count("*").alias("product_count"), F.min_by(F.trim("product_name"), "id").alias("first_name"))
    for name, v in votes.items():
        out = out.join(_elected(v, name), "component", "left")
    problems = votes["primary_problem"].groupBy("component").agg(F.collect_set("value").alias("problems"))
    words = _votes(members, "keywords")
    top = words.withColumn("r", F.row_number().over(W.partitionBy("component").orderBy(F.col("votes").desc(), "seen"))).where("r <= 12")
    listed = top.groupBy("component").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "value"))), lambda x: x["value"]).alias("top"))
    out = out.join(problems, "component", "left").join(listed, "component", "left")
    specific = F.filter(F.coalesce("top", F.array().cast("array<string>")), lambda k: ~k.isin(*GENERIC))
    none = F.array().cast("array<string>")
    secondary = F.slice(_longest_first(F.filter(F.coalesce("problems", none), lambda p: ~p.eqNullSafe(F.col("primary_problem")))), 1, 3)
    kind = F.lower("product_type")
    plural = F.coalesce(F.try_element_at(F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in PLURALS.items()) + ")"), kind), _title(kind))
    problem = F.when(F.col("primary_problem") == "roi", "ROI").otherwise(_title(F.col("primary_problem")))
    niche = _title(F.col("niche"))
    name = (
        F.when(F.col("niche").isNotNull() & F.col("primary_problem").isNotNull() & kind.isNotNull(), F.concat_ws(" ", niche, problem, plural))
        .when(F.col("niche").isNotNull() & kind.isNotNull(), F.concat_ws(" ", niche, plural))
        .when(F.col("niche").isNotNull() & F.col("primary_problem").isNotNull(), F.concat_ws(" ", niche, problem))
        .when(kind.isNotNull(), plural)
        .otherwise(F.coalesce("first_name", F.lit("Product Market")))
    )
    return out.select(
        "component", "product_count", name.alias("cluster_name"), slug(name).alias("slug"), "niche", kind.alias("product_type"), "primary_problem",
        secondary.alias("secondary_problems"), F.slice(F.when(F.size(specific) > 0, specific).otherwise(F.coalesce("top", none)), 1, 10).alias("keywords"),
    )


def confidences(members: DataFrame, block: int = 512, small: int = SMALL) -> DataFrame:
    """component, confidence: the mean similarity of all pairs of members, idf taken from the component alone; 1 for a single member.

    `members` has component, id, tokens, niche_key and type_key. A component of up to `small` members is one row, whose pairs are compared by a
    matrix product. Of larger ones no pair of members is made: the cosines of all pairs add
    up to half of what the squared sum of the unit vectors exceeds their squares by, which is a sum over tokens; pairs that share niche or
    type are counted from group sizes. Only the Jaccard part needs pairs; there equal token sets count once with
    their multiplicity, and the different ones are compared in blocks of `block` sets by matrix products, each pair of
    blocks of a component being a row of a join that gives one number. A member without tokens is like no other.
    """
    n = members.groupBy("component").agg(F.count("*").alias("n"))
    told = members.where(F.size("tokens") > 0).join(n.where("n > 1"), "component")
    sure = _confidences(n.where("n > 1"), told, block, small)
    return n.join(sure, "component", "left").select("component", _or_alone("confidence").alias("confidence"))


def _confidences(n: DataFrame, told: DataFrame, block: int = 512, small: int = SMALL) -> DataFrame:
    """component, confidence of the components of several members, whose numbers are `n`; `told` has the members with tokens."""
    told = told.select("component", "id", "n", "tokens", F.lower("niche_key").alias("niche_key"), F.nullif("type_key", F.lit("")).alias("type_key"))
    told = staged(told, "market-told")
    few = told.where(F.col("n") <= small).repartition(_tasks(told), "component").groupBy("component").agg(F.first("n").alias("n"), F.collect_list(F.struct("tokens", "niche_key", "type_key")).alias("rows"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [_similarities_of(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.float64())], names=["component", "total"])

    totals = few.mapInArrow(add, "component long, total double").unionByName(_similarity_sums(told.where(F.col("n") > small), block))
    mean = F.coalesce("total", F.lit(0.0)) / (F.col("n") * (F.col("n") - 1) / 2)
    return n.join(totals, "component", "left").select("component", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean)), 4).alias("confidence"))


def _similarities_of(n: int, rows: list[dict]) -> float:
    """The sum of the similarities of all pairs of `rows`, which are those of `n` members that have tokens."""
    numbers: dict[str, int] = {}
    at = [[numbers.setdefault(t, len(numbers)) for t in x["tokens"]] for x in rows]
    m = np.zeros((len(rows), len(numbers)))
    for r, columns in enumerate(at):
        m[r, columns] = 1
    size, weighed = m.sum(1), m * (np.log((n + 1) / (m.sum(0) + 1)) + 1)
    summed = (weighed / np.sqrt((weighed * weighed).sum(1))[:, None]).sum(0)
    common = m @ m.T
    jaccard = (common / (size[:, None] + size[None, :] - common)).sum()
    niches, types = [x["niche_key"] for x in rows], [x["type_key"] for x in rows]
    pairs = lambda keys: sum(c * (c - 1) // 2 for c in Counter(keys).values())
    shared = pairs(k for k in niches if k is not None) + pairs(k for k in types if k is not None) - pairs(k for k in zip(niches, types) if None not in k)
    return float(COSINE * (summed @ summed - len(rows)) / 2 + OVERLAP * (jaccard - len(rows)) / 2 + SHARED * shared)


def _similarity_sums(told: DataFrame, block: int) -> DataFrame:
    """component, total: the sum of the similarities of all pairs of members with tokens."""
    rows = told.select("component", "id", "n", F.explode("tokens").alias("token"))
    idf = rows.groupBy("component", "token").agg((F.log((F.first("n") + 1.0) / (F.count("*") + 1)) + 1).alias("idf"))
    weighed = rows.join(idf, ["component", "token"])
    norms = weighed.groupBy("id").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    summed = weighed.join(norms, "id").groupBy("component", "token").agg(F.sum(F.col("idf") / F.col("norm")).alias("s")).groupBy("component").agg(F.sum(F.col("s") * F.col("s")).alias("squares"))
    pairs = F.col("c") * (F.col("c") - 1) / 2
    sharing = lambda *keys: told.dropna(subset=list(keys)).groupBy("component", *keys).agg(F.count("*").alias("c")).select("component", (pairs * (-1 if len(keys) > 1 else 1)).alias("p"))
    shared = sharing("niche_key").unionByName(sharing("type_key")).unionByName(sharing("niche_key", "type_key")).groupBy("component").agg(F.sum("p").alias("shared"))
    size = told.groupBy("component").agg(F.count("*").alias("m"))
    out = size.join(summed, "component", "left").join(shared, "component", "left").join(_jaccard_sums(told, block), "component", "left")
    return out.select("component", (COSINE * (F.col("squares") - F.col("m")) / 2 + OVERLAP * F.col("jaccard") + SHARED * F.coalesce("shared", F.lit(0.0))).alias("total"))


def _jaccard_sums(told: DataFrame, block: int) -> DataFrame:
    """component, jaccard: the sum of the Jaccard similarities of all pairs of members with tokens."""
    sets = told.groupBy("component", F.array_sort("tokens").alias("tokens")).agg(F.count("*").alias("times"))
    order = W.partitionBy("component").orderBy("tokens")
    placed = sets.withColumn("at", F.row_number().over(order) - 1).withColumn("block", F.floor(F.col("at") / block).cast("int"))
    packed = staged(placed.groupBy("component", "block").agg(F.collect_list(F.struct("tokens", "times")).alias("sets")), "market-blocks")  # `block` sets at most
    left, right = packed.select("component", F.col("block").alias("i"), F.col("sets").alias("left")), packed.select("component", F.col("block").alias("j"), F.col("sets").alias("right"))
    met = left.join(right, "component").where("i <= j").select("component", (F.col("i") == F.col("j")).alias("same"), "left", "right")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [_jaccard_of(*row) for row in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.float64())], names=["component", "s"])

    return met.repartition(_tasks(told)).mapInArrow(add, "component long, s double").groupBy("component").agg(F.sum("s").alias("jaccard"))


def _jaccard_of(same: bool, left: list[dict], right: list[dict]) -> float:
    numbers: dict[str, int] = {}
    for x in (*left, *right):
        for t in x["tokens"]:
            numbers.setdefault(t, len(numbers))

    def matrix(sets: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m = np.zeros((len(sets), len(numbers)), np.float32)
        for r, x in enumerate(sets):
            m[r, [numbers[t] for t in x["tokens"]]] = 1
        return m, m.sum(1), np.array([x["times"] for x in sets], float)

    (a, na, ta), (b, nb, tb) = matrix(left), matrix(right)
    common = a @ b.T
    jaccard = common / (na[:, None] + nb[None, :] - common)
    total = float(ta @ jaccard @ tb)
    return (total - float(ta.sum())) / 2 if same else total  # in one block each pair stands twice and each member once with itself


def _grouped(tokens: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all products, and the confidence of every component of several members.

    Members are compared by the numbers of their tokens; a product without tokens is like no other, and so alone.
    """
    vectors, n = _vectors(tokens)
    edges = staged(_similar(vectors, n, threshold), "market-edges")
    parts = staged(connected_components(tokens.select(F.col("id").alias("node")), edges), "market-parts")
    several = parts.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    members = vectors.select("id", F.col("t").alias("tokens"), "niche_key", "type_key").join(parts.join(several, "component"), F.col("id") == F.col("node"))
    return parts, staged(_confidences(several, members), "market-confidences")


def memberships(products: DataFrame, threshold: float = THRESHOLD, minimum_size: int = 2) -> DataFrame:
    """component, product_id, membership_score: what `markets` gives as memberships, from the tokens alone, without what describes a market."""
    _check(threshold)
    tokens = _tokens(products)
    return _members(tokens, *_grouped(tokens, threshold), minimum_size)


def _members(tokens: DataFrame, parts: DataFrame, sure: DataFrame, minimum_size: int) -> DataFrame:
    found = tokens.select("id").join(parts, F.col("id") == F.col("node")).select("component", F.col("id").alias("product_id"))
    if minimum_size > 2:  # else every component is kept
        enough = (F.col("n") >= minimum_size) | (F.col("n") == 1)
        found = found.join(found.groupBy("component").agg(F.count("*").alias("n")).where(enough), "component", "left_semi")
    return found.join(sure, "component", "left").select("component", "product_id", _or_alone("confidence").alias("membership_score"))


def _or_alone(confidence: str) -> Column:
    return F.coalesce(confidence, F.lit(1.0))


def markets(products: DataFrame, threshold: float = THRESHOLD, minimum_size: int = 2, niches: tuple[str, ...] = NICHES) -> tuple[DataFrame, DataFrame]:
    """(clusters, memberships) of the products. Groups smaller than `minimum_size` are dropped unless they are single.

    Every member's `membership_score` is the confidence of its cluster.
    """
    _check(threshold)
    tokens = staged(with_terms(with_tokens(products), niches), "market-terms")
    parts, sure = _grouped(tokens, threshold)
    members = staged(tokens.join(parts, tokens.id == parts.node).drop("node"), "market-members")
    enough = (F.col("product_count") >= minimum_size) | (F.col("product_count") == 1)
    kept = describe_markets(members).where(enough).join(sure, "component", "left").withColumn("confidence", _or_alone("confidence"))
    return kept, _members(tokens, parts, sure, minimum_size)
