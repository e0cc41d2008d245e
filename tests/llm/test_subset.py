import random

import numpy as np
import pytest

from marketloom.llm.subset import lazy_greedy, subset_coverage, varied_subset

FIELDS = ["niche", "product_type", "primary_problem"]
SCHEMA = "id bigint, niche string, product_type string, primary_problem string, f0 string, weight double, place int"
W3 = (0.5, 0.2, 0.3)


def full_greedy(codes, weights, size):
    n = len(codes)
    sim = np.array([[1.0 if i == j else sum(w for f, w in enumerate(W3) if codes[i, f] >= 0 and codes[i, f] == codes[j, f]) for j in range(n)] for i in range(n)])
    best, out = np.zeros(n), []
    while len(out) < min(size, n):
        gains = [round(float(weights @ np.maximum(sim[:, j] - best, 0)), 9) if j not in out else -1 for j in range(n)]
        j = int(np.argmax(gains))
        out.append(j)
        best = np.maximum(best, sim[:, j])
    return out


def test_lazy_greedy_equals_full_greedy():
    rng = np.random.default_rng(1)
    for n in (1, 7, 60):
        codes = rng.integers(-1, 5, (n, 3))
        weights = rng.random(n)
        assert lazy_greedy(codes, weights, W3, 20)[0] == full_greedy(codes, weights, 20)
    assert lazy_greedy(np.empty((0, 3), int), np.empty(0), W3, 5)[0] == []


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0, 1) for r in rows], SCHEMA)


def test_rare_markets_are_shown_beside_a_hot_one(spark):
    rng = random.Random(2)
    rows = [(i, "Bakery " if i % 2 else "bakery", "Template", "pricing") for i in range(400)]
    rows += [(1000 + i, f"rare {i}", rng.choice(["tool", "tools"]), rng.choice(["fee", "roi"])) for i in range(9)]
    df = make(spark, rows)
    for part in (4, 1000):
        got = varied_subset(df, "id", FIELDS, 10, part=part).orderBy("rank").collect()
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert {r.niche for r in got} == {"bakery"} | {f"rare {i}" for i in range(9)}
        assert next(r for r in got if r.niche == "bakery").group_size == 400
        assert sum(r.gain for r in got) > 0
    chosen = varied_subset(df, "id", FIELDS, 10)
    assert {r.field: (r.distinct_values, r.distinct_chosen) for r in subset_coverage(df, chosen, FIELDS).collect()}["niche"] == (10, 10)


def test_two_rounds_come_close_to_one_greedy_choice(spark):
    rng = random.Random(4)
    rows = [(i, f"n{int(rng.paretovariate(1)) % 40}", f"t{rng.randrange(8)}", f"p{rng.randrange(9)}") for i in range(2000)]
    df = make(spark, rows)
    seen = {}
    for r in rows:
        seen.setdefault(r[1:], r[0])
    keys = sorted(seen, key=lambda k: seen[k])
    codes = np.array([[int(v[1:]) for v in k] for k in keys])
    weights = sum(w / np.array([(codes[:, f] == c).sum() for c in codes[:, f]]) for f, w in enumerate(W3))
    value = lambda chosen: sum(weights * np.max([[1.0 if i == j else sum(w for f, w in enumerate(W3) if codes[i, f] == codes[j, f]) for i in range(len(codes))] for j in chosen], axis=0))
    best = value(full_greedy(codes, weights, 30))
    ids = {seen[k]: i for i, k in enumerate(keys)}
    got = [ids[r.chosen_id] for r in varied_subset(df, "id", FIELDS, 30, part=60).collect()]
    assert len(set(got)) == 30 and value(got) >= 0.9 * best


def test_nulls_ties_and_empty(spark):
    rows = [(3, None, None, None), (1, None, None, None), (None, "a", "b", "c"), (2, "", " ", "fee"), (4, "x" * 20_000, "t", "fee")] * 2
    got = varied_subset(make(spark, rows), "id", FIELDS, 100).collect()
    assert sorted(r.chosen_id for r in got) == [1, 2, 4]
    assert varied_subset(make(spark, []), "id", FIELDS, 5).count() == 0


def test_parts_no_larger_than_the_subset_still_shrink(spark):
    rows = [(i, f"n{i % 97}", f"t{i % 13}", f"p{i % 7}") for i in range(3000)]
    assert varied_subset(make(spark, rows), "id", FIELDS, 20, part=5).count() == 20


def test_any_number_of_fields(spark):
    rows = [(i, f"n{i % 5}", f"t{i % 3}", "p") for i in range(60)]
    assert varied_subset(make(spark, rows), "id", FIELDS[:1], 5).count() == 5
    four = varied_subset(make(spark, rows), "id", [*FIELDS, "f0"], 6)
    assert four.count() == 6 and four.columns[2:6] == [*FIELDS, "f0"]
    with pytest.raises(ValueError):
        varied_subset(make(spark, rows), "id", FIELDS, 5, (0.5, 0.5))
