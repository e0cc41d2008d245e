"""Choosing a varied subset: two rounds of lazy greedy maximisation of a facility-location objective."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import staged

SIZE = 100
PART = 4_000  # markets one task compares with each other
FIELD_WEIGHTS = (0.5, 0.2, 0.3)  # of three fields; any other number of fields weigh the same unless weights are given


def plain_value(value: Column) -> Column:
    """A label without case, marks, outer spaces and the plural ending of its last word; blank becomes NULL."""
    plain = F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " "))
    return F.nullif(F.regexp_replace(plain, r"(?<=\p{L}{3}[^s\P{L}])s$", ""), F.lit(""))


def lazy_greedy(codes: np.ndarray, weights: np.ndarray, field_weights: tuple[float, ...], size: int) -> tuple[list[int], list[float], np.ndarray]:
    """Positions chosen, their gains, and the weight of the rows each chosen one serves best.

    `codes` holds one row of field codes per market (-1: unknown, like nothing but itself), `weights` what covering it
    is worth. Two markets are as similar as the weights of the fields they share; a chosen market covers itself wholly.
    A gain computed earlier bounds the present one (the objective is submodular), so only the top of the heap is
    computed anew. Ties go to the earlier row.
    """
    n = len(codes)
    best = np.zeros(n)
    server = np.full(n, -1)

    def similarity(j: int) -> np.ndarray:
        s = np.zeros(n)
        for f, w in enumerate(field_weights):
            if codes[j, f] >= 0:
                s += w * (codes[:, f] == codes[j, f])
        s[j] = 1.0
        return s

    heap = [(-np.inf, j, -1) for j in range(n)]
    chosen: list[int] = []
    gains: list[float] = []
    heapq.heapify(heap)
    while heap and len(chosen) < size:
        bound, j, when = heapq.heappop(heap)
        if when == len(chosen):
            s = similarity(j)
            closer = s > best
            best[closer], server[closer] = s[closer], len(chosen)
            chosen.append(j)
            gains.append(-bound)
        else:
            gain = round(float(weights @ np.maximum(similarity(j) - best, 0.0)), 9)
            heapq.heappush(heap, (-gain, j, len(chosen)))
    served = np.bincount(server[server >= 0], weights[server >= 0], minlength=len(chosen)) if chosen else np.zeros(0)
    return chosen, gains, served


def varied_subset(rows: DataFrame, id_column: str, fields: list[str], size: int = SIZE, field_weights: tuple[float, ...] | None = None, part: int = PART) -> DataFrame:
    """rank, id, the fields in plain form, group_size (rows of the same combination) and gain of the chosen subset.

    Rows with equal fields (case, marks, spaces and plurals aside) are one market whatever their number, represented by
    its lowest id; what covering a market is worth is shared out so that each value of a field is worth the same in all.
    So neither common markets nor common values can fill the subset, and a group holding a large part of all rows costs
    no more than any other. Round one: the markets are spread over parts
    (two at least, of about `part` markets, or four times `size` if that is more), each of which nominates `size` candidates by lazy greedy choice together with the weight
    they cover; repeated while more than one part is left. Round two: a last lazy greedy choice among the
    candidates, which cover the weights of the markets they stand for; the weight of a market that no nominee of its part
    is like at all is spread evenly over them, so that the total stays what it was.

    `field_weights` must be as many as the fields. A NULL or blank field is like no other; a row with none of the fields known is a market that covers itself alone.
    Rows without an id are left out. Fewer markets than `size` are all chosen. Empty tables give an empty result. Only
    the columns named are read, whatever else there is.
    """
    if field_weights is None:
        field_weights = FIELD_WEIGHTS if len(fields) == len(FIELD_WEIGHTS) else (1.0 / max(len(fields), 1),) * len(fields)
    if len(field_weights) != len(fields) or not fields:
        raise ValueError(f"{len(field_weights)} weights for {len(fields)} fields")
    part = max(part, 4 * size)  # a part must leave out most of its markets, or rounds wouldn't end
    names = [f"f{i}" for i in range(len(fields))]
    markets = (
        rows.where(F.col(id_column).isNotNull())
        .groupBy(*(plain_value(F.col(f).cast("string")).alias(n) for f, n in zip(fields, names)))
        .agg(F.min(F.col(id_column).cast("long")).alias("id"), F.count("*").alias("group_size"))
    )
    markets = staged(markets, "subset-combinations")
    weight = F.lit(0.0)
    for n, w in zip(names, field_weights):  # every value of a field is worth the same, however many markets have it
        sharing = markets.where(F.col(n).isNotNull()).groupBy(n).agg(F.count("*").alias(f"{n}_markets"))
        markets = markets.join(sharing, n, "left")
        weight = weight + F.coalesce(F.lit(w) / F.col(f"{n}_markets"), F.lit(0.0))
    markets = markets.withColumn("weight", F.greatest(weight, F.lit(1e-6)))
    columns = ["id", *names, "group_size", "weight"]
    schema = "id long, " + ", ".join(f"{n} string" for n in names) + ", group_size long, weight double, place int, gain double"
    weights_of_fields = tuple(field_weights)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable").reset_index(drop=True)
        codes = np.stack([pd.factorize(group[n])[0] for n in names], axis=1)
        chosen, gains, served = lazy_greedy(codes, group["weight"].to_numpy(), weights_of_fields, size)
        out = group.iloc[chosen].reset_index(drop=True)
        served = served + (group["weight"].sum() - served.sum()) / max(len(served), 1)
        return out.assign(weight=served, place=np.arange(1, len(out) + 1, dtype=np.int32), gain=np.array(gains, float))[[*columns, "place", "gain"]]

    left = staged(markets.select(*columns), "subset-markets")
    n = left.count()
    first = True
    while first or n > part:
        first, parts = False, max(2, -(-n // part))
        nominated = left.groupBy(F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")).applyInPandas(lambda g: choose(g[columns]), schema)
        left = staged(nominated.select(*columns), "subset-candidates")
        n = left.count()
    final = left.groupBy(F.col("weight").isNull().alias("all")).applyInPandas(lambda g: choose(g[columns]), schema)
    return final.select(F.col("place").alias("rank"), F.col("id").alias(id_column if id_column != "id" else "chosen_id"), *(F.col(n).alias(f) for n, f in zip(names, fields)), "group_size", "gain")


def subset_coverage(rows: DataFrame, chosen: DataFrame, fields: list[str]) -> DataFrame:
    """field, values, values_chosen: how many different values of each field there are and how many the subset shows."""
    shape = lambda df, plain: df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), (plain_value(F.col(f).cast("string")) if plain else F.col(f)).alias("v")) for f in fields))).alias("x")).select("x.*").where("v is not null")
    everything = shape(rows, True).groupBy("field").agg(F.countDistinct("v").alias("distinct_values"))
    shown = shape(chosen, False).groupBy("field").agg(F.countDistinct("v").alias("distinct_chosen"))
    return everything.join(shown, "field", "left").select("field", "distinct_values", F.coalesce("distinct_chosen", F.lit(0)).alias("distinct_chosen"))
