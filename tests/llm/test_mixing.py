import base64
import os

import pytest
from pyspark.sql import functions as F

from marketloom.llm import mixing

DOCS = "doc_id bigint, text string, source string, copies int, rate double, n_tokens int"
TARGETS = "source_name string, target_share double, max_repeats int"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{mixing.TOKENIZER_DIR}/{mixing.TOKENIZER_FILE}"), reason="no tokenizer files")


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], DOCS)


def test_counts_are_the_tokenizers(spark):
    import tiktoken

    with open(f"{mixing.TOKENIZER_DIR}/{mixing.TOKENIZER_FILE}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=mixing.PIECES, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello  world\n\nagain", "", None, "né à 3.14 <|endoftext|>", "word " * 20_000]
    got = {r.doc_id: r.n_tokens for r in mixing.token_counts(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert got == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert all(encoding.decode(encoding.encode_ordinary(t)) == t for t in texts if t)


def test_rates():
    rates = mixing.repetition_rates({"a": 100, "b": 10, "c": 0}, {"a": (0.5, 5), "b": (0.4, 3), "c": (0.1, 9)}, 110)
    assert rates == {"a": pytest.approx(0.8), "b": 3.0, "c": 0.0}  # b is capped at 30 tokens, the rest goes to a
    assert mixing.repetition_rates({"a": 10}, {"a": (1.0, 2)}, 100) == {"a": 2.0}
    assert mixing.repetition_rates({}, {"a": (1.0, 2)}, 0) == {"a": 0.0}


def test_mixture(spark):
    rows = [(i, "one two three four", "Big ") for i in range(3000)] + [(5000 + i, "one two three four", "small-source") for i in range(300)]
    rows += [(9000 + i, "one two three four", None) for i in range(200)] + [(9900, None, "big"), (9901, "", "big"), (None, "x", "big")]
    targets = spark.createDataFrame([("big", 0.6, 2), ("Small Source", 0.3, 4), ("none", 0.1, 2), (None, 0.0, 1)], TARGETS)
    selection, shares = mixing.mixture(documents(spark, rows), targets)
    got = selection.cache().collect()
    assert {r.source_name for r in got} == {"big", "small_source"} and max(r.copies for r in got if r.source_name == "small_source") <= 4
    again = {(r.doc_id, r.copies) for r in mixing.mixture(documents(spark, rows).repartition(7), targets)[0].collect()}
    assert again == {(r.doc_id, r.copies) for r in got}
    share = {r.source_name: r for r in shares.collect()}
    assert share["none"].reached_tokens == 0 and share["small_source"].rate <= 4
    total = 3500 * 4
    reached = sum(r.n_tokens * r.copies for r in got)
    assert abs(reached - total) < 0.05 * total and abs(share["small_source"].reached_share - 1 / 3) < 0.02
    assert abs(sum(r.reached_share for r in share.values()) - 1) < 1e-9 and share["small_source"].corpus_share == share["small_source"].reached_tokens / total
    texts = mixing.emitted(documents(spark, rows), shares).groupBy("doc_id").count().collect()
    assert {(r.doc_id, r["count"]) for r in texts} == {(r.doc_id, r.copies) for r in got}


def test_repeated_rows_with_other_texts_are_drawn_apart(spark):
    rows = [(1, f"text {i}", "a") for i in range(2000)]
    got = mixing.mixture(documents(spark, rows + [(2, "other words here", "b")] * 1000), spark.createDataFrame([("a", 0.3, 1), ("b", 0.7, 9)], TARGETS))[0]
    assert 300 < got.where("source_name = 'a'").count() < 1900


def test_empty(spark):
    targets = spark.createDataFrame([("a", 1.0, 2)], TARGETS)
    selection, shares = mixing.mixture(documents(spark, []), targets)
    assert selection.count() == 0 and shares.first().reached_share is None
    selection, shares = mixing.mixture(documents(spark, [(1, "x", "a")]), targets.where(F.lit(False)))
    assert selection.count() == 0 and shares.count() == 0
