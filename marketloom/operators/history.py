"""History of changing entity attributes: versions with the period each was valid, folded from observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.session import staged

DAY = 86_400_000_000
UNITS = (DAY, 3_600_000_000, 60_000_000, 1_000_000, 1_000)  # microseconds a slice may span
SLICE_ROWS = 1_000


def sliced(rows: DataFrame, keys: list[str], units: tuple[int, ...] = UNITS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds `slice`: the start of the longest unit of time around `t` in which the entity has at most `slice_rows` rows.

    Units that hold more are cut into the next smaller ones, which are counted only there; the last unit isn't cut. Units
    nest, so the slices of an entity follow one another in time.
    """
    crowd = rows.select(*keys, "t")
    start = lambda unit: (F.floor(F.col("t") / F.lit(unit)) * F.lit(unit)).cast("bigint")
    out = rows.withColumn("slice", start(units[0]))
    for unit, smaller in zip(units, units[1:]):
        counted = crowd.groupBy(*keys, start(unit).alias("unit")).agg(F.count("*").alias("n")).where(F.col("n") > slice_rows).drop("n")
        full = staged(counted, "history-crowds")
        if full.isEmpty():
            break
        at = [*keys, "unit"]
        crowd = crowd.withColumn("unit", start(unit)).join(full, at, "left_semi").drop("unit")
        out = out.withColumn("unit", start(unit)).join(full.withColumn("full", F.lit(True)), at, "left").withColumn("slice", F.when(F.col("full"), start(smaller)).otherwise(F.col("slice"))).drop("unit", "full")
    return out


def version_history(
    observations: DataFrame,
    keys: list[str],
    at: str,
    order: str,
    active: str,
    attributes: list[str],
    units: tuple[int, ...] = UNITS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per period in which an active entity kept one and the same set of attribute values.

    `observations` has the entity `keys`, the instant `at` (bigint microseconds), the tie breaker `order` (of several
    observations at one instant the one with the highest counts alone), the boolean `active` and the `attributes`.
    Result: keys, attributes, `valid_from` and `valid_to` (microseconds; `valid_to` NULL while open).

    - A NULL attribute keeps the last value known for the entity; attributes of inactive observations are ignored.
    - A period starts when the entity is first active, becomes active again or changes, and ends where the next
      starts or the entity becomes inactive. Inactive spans give no row.
    - Rows whose key, instant or `active` is NULL are no observations. Repeated rows change nothing; an empty
      table gives an empty result; other columns are ignored, whatever their names.

    The observations of an entity within one slice of time are folded as a sorted array by a higher-order function that
    appends a version only upon a change; then the state carried over from earlier slices is put in front and the few
    events left are folded again. A slice is cut by the number of its rows (`sliced`), so no array holds more than
    `slice_rows` observations (or than there are instants in the smallest unit), however dense an entity is, and
    appending costs no more than that many copies. What an entity's slices tell each other (their end states, the time of their
    first change) passes through windows over one slim row a slice; so an entity with a large part of all rows, or of all
    changes, is spread over as many tasks as it has slices. Observations are shuffled once, afterwards only changes are.
    """
    names = [f"a{i}" for i in range(len(attributes))]
    key_names = [f"k{i}" for i in range(len(keys))]
    kinds = {n: observations.schema[a].dataType.simpleString() for n, a in zip(names, attributes)}
    state = "struct<t:bigint,live:boolean," + ",".join(f"{n}:{k}" for n, k in kinds.items()) + ">"
    acc_type = f"struct<now:{state},out:array<{state}>>"

    rows = observations.select(
        *(F.col(k).alias(n) for k, n in zip(keys, key_names)),
        F.col(at).cast("bigint").alias("t"),
        F.col(order).alias("o"),
        F.col(active).alias("live"),
        *(F.col(a).alias(n) for a, n in zip(attributes, names)),
    ).where(" and ".join(f"{c} is not null" for c in (*key_names, "t", "live")))
    rows = sliced(staged(rows, "history-observations"), key_names, units, slice_rows)

    def fold(events: Column, start: Column) -> Column:
        def step(acc: Column, e: Column) -> Column:
            now = acc["now"]
            live = e["live"]
            merged = [F.when(live, F.coalesce(e[n], now[n])).otherwise(now[n]) for n in names]
            differs = ~now["live"].eqNullSafe(live)
            for n, m in zip(names, merged):
                differs = differs | (live & ~m.eqNullSafe(now[n]))
            after = F.struct(e["t"].alias("t"), live.alias("live"), *(m.alias(n) for m, n in zip(merged, names))).cast(state)
            return F.struct(after.alias("now"), F.when(differs, F.concat(acc["out"], F.array(after))).otherwise(acc["out"]).alias("out")).cast(acc_type)

        begin = F.struct(start.alias("now"), F.array().cast(f"array<{state}>").alias("out")).cast(acc_type)
        return F.aggregate(events, begin, step)

    nothing = F.lit(None).cast(state)
    folded = (
        rows.repartition(*(F.col(c) for c in (*key_names, "slice")))
        .groupBy(*key_names, "slice", "t")
        .agg(F.max(F.struct("o", "live", *names)).alias("e"))  # of several at one instant the last alone
        .groupBy(*key_names, "slice")
        .agg(F.sort_array(F.collect_list(F.struct("t", "e.*"))).alias("es"))
        .select(*key_names, "slice", fold(F.col("es"), nothing).alias("f"))
        .select(*key_names, "slice", F.col("f.now").alias("last"), F.col("f.out").alias("events"))
    )
    folded = staged(folded, "history-slices")
    slot = [*key_names, "slice"]
    order_by_slice = W.partitionBy(*key_names).orderBy("slice")
    before = order_by_slice.rowsBetween(W.unboundedPreceding, -1)
    carried = folded.select(
        *slot,
        F.struct(
            F.lag("last.t").over(order_by_slice).alias("t"),
            F.lag("last.live").over(order_by_slice).alias("live"),
            *(F.last(F.col("last")[n], ignorenulls=True).over(before).alias(n) for n in names),
        ).cast(state).alias("carry"),
    )
    versions = staged(folded.join(carried, slot).select(*slot, fold(F.col("events"), F.col("carry"))["out"].alias("vs")).where(F.size("vs") > 0), "history-versions")
    following = versions.select(*slot, F.lead(F.get("vs", F.lit(0))["t"]).over(order_by_slice).alias("next_t"))
    spans = F.transform("vs", lambda v, i: F.struct(v.alias("v"), F.coalesce(F.get("vs", i + 1)["t"], F.col("next_t")).alias("until")))
    ended = versions.join(following, slot)
    live = ended.select(*key_names, F.explode(F.filter(spans, lambda x: x["v"]["live"])).alias("x"))
    return live.select(
        *(F.col(n).alias(k) for n, k in zip(key_names, keys)),
        *(F.col("x.v")[n].alias(a) for n, a in zip(names, attributes)),
        F.col("x.v.t").alias("valid_from"),
        F.col("x.until").alias("valid_to"),
    )
