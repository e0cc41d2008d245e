import random

import marketloom.llm.leakage as leakage
from marketloom.llm.leakage import PROBES, RUN, SLACK, leak_matches, leaks, plain_words, positional_index

DOCS = "doc_id bigint, text string, item_id int, terms int, positions int"
ITEMS = "item_id bigint, item_text string, instruction string, doc_id int"


def brute(docs, items, share=0.4):
    out = {}
    for d, text in docs:
        w = plain_words(text)
        grams = {tuple(w[k : k + RUN]) for k in range(len(w) - RUN + 1)}
        for i, item in items:
            v = plain_words(item)
            covered = {p for k in range(len(v) - RUN + 1) if tuple(v[k : k + RUN]) in grams for p in range(k, k + RUN)}
            if v and len(covered) >= share * len(v) and covered:
                out[d, i] = len(covered)
    return out


def test_words():
    assert plain_words("Café <b>bre</b>ad &amp; co­ffee zero​width") == ["cafe", "bread", "coffee", "zerowidth"]
    assert plain_words("a bro-\n  ken line\nand well-known\\u0020x\\n y cafÃ©") == ["a", "broken", "line", "and", "well", "known", "x", "y", "cafe"]
    assert plain_words(None) == plain_words("") == plain_words(" .. ") == []


def test_against_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 12, 30, 60])))) for i in range(25)] + [(90, None), (91, ""), (1, "twice " * 3)]
    docs = []
    for d in range(200):
        text = " ".join(rng.choice([*words, "other", "else"]) for _ in range(rng.randrange(0, 60)))
        if d % 3 == 0:
            v = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(v) + 1)
            part = v[a : a + rng.randrange(1, 50)]
            part = ["<i>" + p.upper() + "</i>," if rng.random() < 0.3 else p for p in part]
            text += " ... " + " ".join(part) + " ... " + " ".join(v[:10])
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, "w1 " * 60_000), (503, items[3][1]), (503, items[3][1]), (504, items[3][1])]
    want = brute([(d, t or "") for d, t in docs], [(i, t or "") for i, t in items])
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in docs], DOCS).repartition(3)
    it = spark.createDataFrame([(i, t, "read", 4) for i, t in items], ITEMS)
    for block in (40, 10**6):
        got = {(r.doc_id, r.item_id): r.matched_words for r in leaks(df, it, block_words=block).collect()}
        assert got == want and len(want) > 20
    assert leaks(df, it.limit(0)).count() == 0 and leaks(df.limit(0), it).count() == 0


def test_index_holds_every_position_of_every_word(spark):
    texts = {1: "b a b", 2: "a c " * 700, 3: "c", 4: "", 5: None}
    rows = positional_index(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), segment_words=100).collect()
    found = {}
    for r in rows:
        for k, term in enumerate(r.terms):
            for place in r.places[r.ends[k - 1] if k else 0 : r.ends[k]]:
                d = max(i for i, first in enumerate(r.starts) if first <= place)
                found[r.docs[d], place - r.starts[d]] = term
    assert found == {(d, k): w for d, t in texts.items() for k, w in enumerate((t or "").split())} and len(rows) > 1


def test_blocks_scan_the_corpus_once(spark, monkeypatch):
    staged, names = leakage.staged, []
    monkeypatch.setattr(leakage, "staged", lambda df, name: names.append(name) or staged(df, name))
    items = [(i, " ".join(f"k{i}x{j}" for j in range(12)), "", 1) for i in range(6)]
    docs = [(i, items[i][1], 1, 2, 3) for i in range(6)]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_words=24).collect()}
    assert got == {(i, i) for i in range(6)}
    assert names.count("leak-index") == 1 and names.count("leak-matches") == 3


def test_proximity_matches(spark):
    w = [f"k{i}" for i in range(40)]
    reworded = [x for i, x in enumerate(w) for x in ([x, "extra"] if i % 7 == 3 else [x])]  # never eight words in a row
    docs = [(1, w), (2, w[:10] + ["x"] * 300 + w[20:30]), (3, w[:10]), (4, reworded), (5, w[::-1]), (6, [x for v in zip(w, ["x"] * 40, ["y"] * 40, ["z"] * 40) for x in v])]
    df = spark.createDataFrame([(d, " ".join(t), 1, 2, 3) for d, t in docs], DOCS)
    got = {r.doc_id: (r.matched_words, r.near_words, r.span_words) for r in leak_matches(df, spark.createDataFrame([(7, " ".join(w), "", 1)], ITEMS)).collect()}
    assert got[1] == (40, 40, 40) and got[2][0] == 20 and got[2][2] == 320
    assert got[4][0] < 16 and got[4][1] >= 36 and set(got) == {1, 2, 4}
    assert {r.doc_id for r in leaks(df, spark.createDataFrame([(7, " ".join(w), "", 1)], ITEMS)).collect()} == {1, 2}
    assert SLACK < RUN and PROBES < RUN
