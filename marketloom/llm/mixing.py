"""Mixing sources to target weights by token counts of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.session import staged

TOKENIZER_DIR = os.environ.get("MARKETLOOM_TOKENIZERS", "/opt/tokenizers")
TOKENIZER_FILE = "byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary cuts a text into pieces before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEED = 20261
MAX_TARGETS = 10_000  # sources the driver derives rates for

_encoders: dict[str, object] = {}


def _encoder(path: str):
    """The tokenizer of a file of ranks, read once per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens, draw of every row with a doc_id; NULL and empty texts have no tokens. `draw` is a hash of the text."""
    path = path or f"{TOKENIZER_DIR}/{TOKENIZER_FILE}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if (t := x.as_py()) else 0 for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64())], names=["doc_id", "source", "draw", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text").alias("draw"), "text").where("doc_id is not null")
    return rows.mapInArrow(count, "doc_id long, source string, draw long, n_tokens long")


def copies_of(rate: Column, doc_id: Column, draw: Column, seed: int) -> Column:
    """floor(rate), and one more if a hash of the document's id and text and the seed falls below the fraction."""
    u = F.pmod(F.xxhash64(doc_id, draw, F.lit(seed)), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def source_key(source: Column) -> Column:
    """A source's name without case, outer spaces and with `_` for other marks."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_"), F.lit(""))


def repetition_rates(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int) -> dict[str, float]:
    """Times each source is to be used so that sources reach their share of `total`, none above its cap.

    What capped sources fall short of is spread over the others in proportion to their shares, again and again, until
    nothing is short or every source is at its cap.
    """
    rates = {s: 0.0 for s in targets}
    free = {s for s in targets if available.get(s, 0) > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    left = float(total)
    while free:
        weight = sum(targets[s][0] for s in free)
        capped = {s for s in free if targets[s][0] / weight * left >= targets[s][1] * available[s]}
        if not capped:
            for s in free:
                rates[s] = targets[s][0] / weight * left / available[s]
            break
        for s in capped:
            rates[s] = float(targets[s][1])
            left -= targets[s][1] * available[s]
        free -= capped
        if left <= 0:
            break
    return rates


def _plan(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """source_name, target_share, max_repeats, available_tokens, total_tokens, rate."""
    wanted = (
        targets.select(source_key(F.col("source_name")).alias("k"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("cap"))
        .where("k is not null")
        .groupBy("k")
        .agg(F.sum(F.coalesce("share", F.lit(0.0))).alias("share"), F.max(F.coalesce("cap", F.lit(0))).alias("cap"))
        .limit(MAX_TARGETS + 1)
        .collect()
    )
    if len(wanted) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} target sources")
    per_source = staged(counts.groupBy(source_key(F.col("source")).alias("k")).agg(F.sum("n_tokens").alias("n")), "mix-sources")
    total = per_source.agg(F.sum("n")).first()[0] or 0
    names = [r["k"] for r in wanted]
    available = {r["k"]: r["n"] for r in per_source.where(F.col("k").isin(names)).collect()} if names else {}
    goal = {r["k"]: (r["share"], r["cap"]) for r in wanted}
    rates = repetition_rates(available, goal, total)
    rows = [(k, goal[k][0], goal[k][1], available.get(k, 0), total, rates[k]) for k in names]
    return counts.sparkSession.createDataFrame(rows, "source_name string, target_share double, max_repeats int, available_tokens long, total_tokens long, rate double")


def mixture(documents: DataFrame, targets: DataFrame, seed: int = SEED, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(selection, shares): which documents to use how often, and what each source reaches.

    Selection: doc_id, source_name, n_tokens, copies (1 or more). A document of a source with rate r is used floor(r)
    times and once more if a hash of its id and text and the seed falls below the fraction of r, so the choice is repeatable,
    needs no shuffle and no document is used more than `max_repeats` times. Shares: one row per target source with
    target_share, max_repeats, available_tokens, rate, documents, reached_tokens, reached_share (of the selection's
    tokens, so that the shares sum to 1) and corpus_share (of the corpus's).

    Sources are compared without case, spaces and marks; documents with a NULL or unlisted source count in the total but
    are not selected, nor are those without tokens. Repeated target rows add their shares. Empty tables give empty
    results; every repeated document row is a document of its own.
    """
    counts = staged(token_counts(documents, path), "mix-counts")
    plan = _plan(counts, targets)
    keyed = counts.where("n_tokens > 0").withColumn("source_name", source_key(F.col("source"))).join(plan.select("source_name", "rate"), "source_name")
    copies = copies_of(F.col("rate"), F.col("doc_id"), F.col("draw"), seed)
    selection = keyed.withColumn("copies", copies).where("copies > 0").select("doc_id", "source_name", "n_tokens", "copies")
    reached = selection.groupBy("source_name").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("reached_tokens"), F.count("*").alias("documents"))
    shares = plan.join(reached, "source_name", "left").withColumn("selected", F.sum("reached_tokens").over(W.partitionBy(F.lit(1)))).select(
        "source_name",
        "target_share",
        "max_repeats",
        "available_tokens",
        "rate",
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("reached_tokens", F.lit(0)).alias("reached_tokens"),
        F.when(F.col("selected") > 0, F.coalesce("reached_tokens", F.lit(0)) / F.col("selected")).alias("reached_share"),
        F.when(F.col("total_tokens") > 0, F.coalesce("reached_tokens", F.lit(0)) / F.col("total_tokens")).alias("corpus_share"),
    )
    return selection, shares


def emitted(documents: DataFrame, shares: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source_name, copy (from 1), text: the mixture itself, every document as often as the rates of `shares` say.

    The copies are derived anew where the text is read, by the draw that made the selection, so texts aren't shuffled; a text
    that isn't empty has at least one token.
    """
    rates = shares.select("source_name", "rate").where("rate > 0")
    rows = documents.select(F.col("doc_id").cast("long"), source_key(F.col("source").cast("string")).alias("source_name"), "text").where("doc_id is not null and text <> ''")
    copies = copies_of(F.col("rate"), F.col("doc_id"), F.xxhash64("text"), seed)
    used = rows.join(rates, "source_name").withColumn("copies", copies).where("copies > 0")
    return used.select("doc_id", "source_name", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "text")
