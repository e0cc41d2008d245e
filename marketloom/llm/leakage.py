"""Evaluation texts leaking into training text: a positional inverted index of the corpus, searched phrase by phrase.

The index is partitioned by document: each row is a segment with the posting lists of all terms of some documents. It is
written once, knows nothing of the items, and serves any number of them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import staged

RUN = 8  # words of an exact phrase
SHARE = 0.4  # part of an item's words that must stand in such phrases
SLACK = 3  # words by which a proximity match may be off its place
PROBES = 4  # rarest words of a phrase that must be near their places
BLOCK_WORDS = 250_000  # items are searched in blocks of at most so many words, which bounds what tasks are sent
SEGMENT_WORDS = 1 << 18  # a segment of the index is closed once it holds so many postings
_GAP = 2 * (RUN + SLACK)  # free places between documents, so that no match reaches from one into the next
_ABSENT = np.iinfo(np.int32).max

_INVISIBLE = re.compile("[\u00ad\u034f\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufeff]")
_INLINE_TAG = re.compile(r"</?(?:b|i|u|em|strong|span|a|font|wbr|sup|sub|mark|code|small|big|tt|s|ins|del)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_ESCAPE = re.compile(r'\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|([nrt"\'/\\]))')
_BROKEN_WORD = re.compile(r"(?<=[^\W\d_])[-\u2010\u2011][ \t]*\r?\n\s*(?=[^\W\d_])")
_DAMAGED = re.compile("[\u00c2\u00c3][\u0080-\u00bf]")
_WORD = re.compile(r"[a-z0-9]+|[^\x00-\x7f\W_]+")


def _unescaped(m: re.Match) -> str:
    four, two, letter = m.groups()
    if four or two:
        return chr(int(four or two, 16))
    return " " if letter in "nrt" else letter


def plain_words(text: str | None) -> list[str]:
    """The words of a text without case, accents, punctuation, invisible characters, markup, escapes and line layout.

    NULL and texts without a letter or digit give no words. UTF-8 read as Latin-1 is read right again.
    """
    if not text:
        return []
    if "\\" in text:
        text = _ESCAPE.sub(_unescaped, text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE_TAG.sub("", text))
    if not text.isascii():
        text = _DAMAGED.sub(lambda m: bytes(map(ord, m.group())).decode("utf-8", "ignore"), text)
        text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
        if not text.isascii():
            text = "".join(c for c in text if not unicodedata.combining(c))
    if "\n" in text:
        text = _BROKEN_WORD.sub("", text)
    return _WORD.findall(text.lower())


SEGMENT = "docs array<bigint>, starts array<int>, terms array<string>, ends array<int>, places array<int>"


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def positional_index(documents: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of an inverted index of all words of all texts, a row each.

    `docs` are the ids of a segment's documents and `starts` their first places; documents lie one after another with a
    gap between them. `terms` are the words met and `ends` where the posting list of each ends in `places`, which holds
    the rising places of term after term. A document is never cut; rows without an id or a text are left out. Documents
    aren't shuffled.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, docs, texts, size = _Numbers(), [], [], 0

        def segment() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int64)
            starts = _GAP + np.cumsum(lengths + _GAP) - lengths - _GAP
            terms = np.concatenate(texts)
            place = np.arange(len(terms)) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
            order = np.argsort(terms, kind="stable")
            lists = [pa.array(docs, pa.int64()), pa.array(starts.astype(np.int32)), pa.array(list(numbers), pa.string()), pa.array(np.cumsum(np.bincount(terms, minlength=len(numbers))).astype(np.int32)), pa.array(place[order].astype(np.int32))]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], names=["docs", "starts", "terms", "ends", "places"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = plain_words(text.as_py())
                if not words:
                    continue
                docs.append(doc)
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= segment_words:
                    yield segment()
                    numbers, docs, texts, size = _Numbers(), [], [], 0
        if texts:
            yield segment()

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    return rows.mapInArrow(build, SEGMENT)


class _Phrases:
    """All phrases of RUN words of a block of items, to be looked up in segments of an index."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        numbers = _Numbers()
        self.words = np.array([numbers[w] for _, words in items for w in words], np.int32)
        self.vocabulary = pa.array(list(numbers), pa.string())
        self.item_ids = np.array([i for i, _ in items], np.int64)
        self.item_words = np.array([len(w) for _, w in items], np.int64)
        self.first = np.cumsum(self.item_words) - self.item_words
        starts = [np.arange(f, f + n - RUN + 1) for f, n in zip(self.first, self.item_words)]
        self.starts = np.concatenate(starts)
        self.item = np.repeat(np.arange(len(items)), [len(s) for s in starts])

    def search(self, segment: dict[str, pa.Array]) -> tuple[np.ndarray, ...]:
        """doc_id, item_id, words of the item in exact phrases, in exact or near ones, words of the item, words from the first match to the last."""
        docs, starts, ends, places = (segment[n].to_numpy(zero_copy_only=False) for n in ("docs", "starts", "ends", "places"))
        number = pc.fill_null(pc.index_in(self.vocabulary, segment["terms"]), -2).to_numpy(zero_copy_only=False)  # -2: in no document, -1: between documents
        lengths = np.diff(ends, prepend=0)
        length = np.where(number >= 0, lengths[number], _ABSENT).astype(np.int64)[self.words]
        number = number[self.words]
        at = np.full(int(places.max()) + _GAP, -1, np.int32)  # the posting lists laid out by place
        at[places] = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)

        windows = np.lib.stride_tricks.sliding_window_view(length, RUN)[self.starts]
        absent = (windows == _ABSENT).sum(1)
        usable = np.flatnonzero(absent <= RUN - PROBES - 2)  # near phrases need six of eight words, exact ones all
        order = np.argsort(windows[usable], axis=1, kind="stable")  # the words of each phrase from the rarest on
        begin = self.starts[usable]
        count = length[begin + order[:, 0]]
        near, exact = [], []
        for chunk in np.split(np.arange(len(count)), np.flatnonzero(np.diff(np.cumsum(count) // 1_000_000)) + 1):
            n = count[chunk]
            phrase = np.repeat(chunk, n)
            nth = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
            term = number[begin[phrase] + order[phrase, 0]]
            start = places[ends[term] - lengths[term] + nth] - order[phrase, 0]
            for r in range(1, PROBES):  # intersect with the offset-adjusted lists of the next rarest words, within the slack
                offset = order[phrase, r]
                term, place = number[begin[phrase] + offset], start + offset
                hit = reduce(np.logical_or, (at[place + d] == term for d in range(-SLACK, SLACK + 1)))
                phrase, start = phrase[hit], start[hit]
            near.append((phrase, start))
            for r in range(1, RUN):  # the same lists, and those of the other words, at their very places
                offset = order[phrase, r]
                hit = at[start + offset] == number[begin[phrase] + offset]
                phrase, start = phrase[hit], start[hit]
            exact.append((phrase, start))
        widest = int(self.item_words.max()) + RUN

        def covered(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
            """Pairs of document and item, how many words of the item are covered, first and last place."""
            phrase, start = (np.concatenate(x) for x in zip(*found))
            item = self.item[usable[phrase]]
            doc = np.searchsorted(starts, start + RUN // 2, side="right") - 1
            pair = doc * len(self.item_ids) + item
            offset = begin[phrase] - self.first[item]
            each = np.unique((pair[:, None] * widest + offset[:, None] + np.arange(RUN)).ravel()) // widest
            pairs, words = np.unique(each, return_counts=True)
            slot = np.searchsorted(pairs, pair)
            low, high = np.full(len(pairs), np.iinfo(np.int64).max), np.zeros(len(pairs), np.int64)
            np.minimum.at(low, slot, start)
            np.maximum.at(high, slot, start + RUN)
            return pairs, words, high - low

        if not near or not sum(len(p) for p, _ in near):
            return tuple(np.empty(0, np.int64) for _ in range(6))
        pairs, near_words, span = covered(near)
        some, exact_words, exact_span = covered(exact)
        matched = np.zeros(len(pairs), np.int64)
        slot = np.searchsorted(pairs, some)  # exact matches are near ones as well
        matched[slot], span[slot] = exact_words, exact_span
        item = pairs % len(self.item_ids)
        return docs[pairs // len(self.item_ids)], self.item_ids[item], matched, near_words, self.item_words[item], span


def leak_matches(documents: DataFrame, items: DataFrame, share: float = SHARE, block_words: int = BLOCK_WORDS, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """doc_id, item_id, matched_words, near_words, item_words, span_words: documents and the items they contain exactly or nearly.

    `matched_words` counts the item's words that stand in the document in runs of RUN or more in the item's wording.
    `near_words` also counts those of phrases of RUN words of which the PROBES rarest stand within SLACK words of their
    places (proximity), and at most two of whose words are unknown to the index segment: reworded, cut or stretched
    passages. A row has at least `share` of `item_words` in `near_words`. `span_words` reaches from the first exact run (or, where
    there is none, near phrase) to the last.

    The corpus is read and tokenised once, whatever the number of items; the index is written in the shared folder.
    Items are looked up in blocks of at most `block_words` words: a task is sent one block, the result of each is written
    before the next is made, so neither the driver nor a task ever holds more than one.

    NULL or empty texts, items shorter than RUN words and empty tables give no rows; repeated rows give no further
    rows; texts are read whole; of both tables only the id and the text are read.
    """
    names = ["doc_id", "item_id", "matched_words", "near_words", "item_words", "span_words"]
    schema = ", ".join(f"{n} long" for n in names)
    index = staged(positional_index(documents, segment_words), "leak-index")
    parts = []
    for block in _blocks(items, block_words):
        phrases = _Phrases(block)

        def search(batches: Iterator[pa.RecordBatch], phrases: _Phrases = phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    found = phrases.search({n: batch.column(i)[k].values for i, n in enumerate(batch.schema.names)})
                    keep = found[3] >= share * found[4]
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep].astype(np.int64)) for x in found], names=names)

        parts.append(staged(index.mapInArrow(search, schema), "leak-matches"))
    if not parts:
        return documents.sparkSession.createDataFrame([], schema)
    best = F.max(F.struct("matched_words", "near_words", "item_words", "span_words")).alias("m")
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `leak_matches` with at least `share` of the item's words in exact phrases."""
    return leak_matches(documents, items, share, block_words).where(F.col("matched_words") >= F.lit(share) * F.col("item_words"))


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    block, size = [], 0
    for row in items.select("item_id", "item_text").where("item_id is not null and item_text is not null").distinct().toLocalIterator():
        words = plain_words(row[1])
        if len(words) < RUN:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield block
