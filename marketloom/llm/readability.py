"""Reading level of documents: classic formulas over sentence lengths and syllables, combined by their median."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from statistics import median

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.session import staged

LANGUAGES = ("en", "pt", "es")
# Function words that tell the three languages apart where the column doesn't.
_FUNCTION_WORDS = {
    "en": frozenset("the of and to is in that it for with was are this be as on by not which an".split()),
    "pt": frozenset("o a os as que do da em um uma não para com se por mais como dos das no na e é".split()),
    "es": frozenset("el la los las que del en un una no para con se por más como y es al su lo".split()),
}
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_BLOCK = re.compile(r"</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|th|table)\b[^<>]*>", re.I)
_DAMAGED = re.compile("[ÂÃ][\u0080-¿]")
_SENTENCE = re.compile(r"([.!?…]+)[\"'”’)\]]*(?=\s|$)|\n\s*\n")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
# Hyphenation-style rules of English: groups of vowels, endings that are silent, places where a group parts or joins.
_EN_GROUP = re.compile(r"[aeiouy]+")
_EN_SILENT = re.compile(r"(?:[^aeiouyl]|[aeiouy]l)e$|[^aeiouytd]ed$|[^aeiouyszxhgc]es$|(?<=[aeiou][^aeiouy])e(?=(?:ly|ment|ful|less|some)$)|(?<=bus)i(?=n)|(?<=ev)e(?=r[yi])")
_EN_SPLIT = re.compile(
    r"i[aou](?!us)|[aeiou]ing|(?<![pg])eo(?!u|pard)|geo(?=[gm])|ua(?=[lt])|[^aeiouy]les$|(?<=[aeiouy][^aeiouy])ea$"
    r"|(?<=cr)ea(?=t)|(?<=[^aeiouy]id)ea|(?<=^id)ea|(?<=^r)ea(?=[cl]t|l[ilms])|(?<=th)ea(?=t)|(?<=[pmn])oe(?=[mt])|(?<![tcsx])ie(?=t|n[ct])|(?<=sc)ie(?=n)|(?<=[^aeiouqg])ue(?=[lnt]$)|uou|[^aeiou]oi(?=ng)|(?<=[^aeiouy][lr])ia"
)
_EN_JOIN = re.compile(r"(?:ci|ti|si|gi)[aou]|[aeiouy]eau|(?<=[^aeiouy][lr])ia(?=g)")
_ROMANCE_GROUP = re.compile("[aeiouáéíóúàâêôãõüy]+")
_NASAL = re.compile("ã[eo]|õe")  # one syllable
_APART = re.compile("[iu](?:ã[eo]|õe)")  # two
_STRONG = frozenset("aeoáéóàâêôãõíú")
_MUTE_U = re.compile("(?<=[qg])u(?=[eiéíêy])")
_PT_HIATUS = re.compile("[iu][ao]s?$")
_PT_ACCENT = re.compile("[áéíóúâêôãõ]")


def english_syllables(word: str) -> int:
    """Syllables by rule: groups of vowels, less silent endings, plus vowels that are spoken apart."""
    n = len(_EN_GROUP.findall(word)) - len(_EN_SILENT.findall(word)) + len(_EN_SPLIT.findall(word)) - len(_EN_JOIN.findall(word))
    return max(1, n)


def spanish_syllables(word: str) -> int:
    """Syllables by the rules of hyphenation: strong and accented vowels part, weak ones lean on them; u is mute in que, gui."""
    n = 0
    for group in _ROMANCE_GROUP.findall(_MUTE_U.sub("", word)):
        strong = sum(c in _STRONG for c in group)
        nasal = len(_NASAL.findall(group)) - len(_APART.findall(group))
        n += max(1, strong - nasal)
    return max(1, n)


def portuguese_syllables(word: str) -> int:
    """As in Spanish, but an ending like -ia, -io, -ua of a word without an accent is stressed on its first vowel and parts."""
    return spanish_syllables(word) + (1 if _PT_HIATUS.search(word) and not _PT_ACCENT.search(word) and not word.endswith(("gua", "qua", "guas", "quo")) else 0)


class _Counts(dict):
    """word -> syllables, filled as words are met; started anew when it gets large."""

    def __init__(self, rule):
        super().__init__()
        self.rule = rule

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        n = self[word] = self.rule(word)
        return n


def _grades(lang: str, words: int, sentences: int, letters: int, syllables: int, long_words: int) -> list[float]:
    """Grade estimates by published formulas of the language; reading ease (0 to 100) counts as (121 - ease) / 8.

    English: Flesch-Kincaid, Gunning fog, SMOG, Coleman-Liau, automated readability, Flesch ease. Portuguese: the same in
    the versions fitted to Portuguese texts. Spanish: Crawford's grade, the eases of Fernandez Huerta and of Szigriszt
    Pazos, and SMOG rescaled for Spanish.
    """
    per_sentence, per_word, size, hard = words / sentences, syllables / words, letters / words, long_words / words
    smog = math.sqrt(30 * long_words / sentences)
    if lang == "es":
        eases = (206.84 - 60.0 * per_word - 1.02 * per_sentence, 206.835 - 62.3 * per_word - per_sentence)
        return [-20.5 / per_sentence + 4.9 * per_word - 3.407, *((121 - e) / 8 for e in eases), 0.74 * (1.043 * smog + 3.1291) - 2.51]
    if lang == "pt":
        ease = 227.0 - 1.04 * per_sentence - 72.0 * per_word
        return [
            0.36 * per_sentence + 10.4 * per_word - 18.0,
            0.49 * per_sentence + 19.0 * hard,
            1.12 * smog + 3.1,
            5.4 * size - 21.0 / per_sentence - 14.0,
            4.6 * size + 0.44 * per_sentence - 20.0,
            (121 - ease) / 8,
        ]
    ease = 206.835 - 1.015 * per_sentence - 84.6 * per_word
    return [
        0.39 * per_sentence + 11.8 * per_word - 15.59,
        0.4 * (per_sentence + 100 * hard),
        1.043 * smog + 3.1291,
        5.88 * size - 29.6 / per_sentence - 15.8,
        4.71 * size + 0.5 * per_sentence - 21.43,
        (121 - ease) / 8,
    ]


def reading_counts(text: str, lang: str | None, caches: dict[str, _Counts]) -> tuple[str, int, int, int, int, int, int]:
    """language, words of the whole text, then of its sentences: words, sentences, letters, syllables, words of three and more syllables.

    Markup and entities are dropped; block tags and empty lines end a sentence. A piece of fewer than four words that no
    mark ends (headings, table cells, signatures) is left out unless the text has nothing else.
    """
    if "<" in text:
        text = _TAG.sub(" ", _BLOCK.sub("\n\n", text))
    if "&" in text:
        text = html.unescape(text)
    if "Ã" in text or "Â" in text:
        text = _DAMAGED.sub(lambda m: bytes(map(ord, m.group())).decode("utf-8", "ignore"), text)
    parts = _SENTENCE.split(text.lower().replace("­", ""))  # a text, the mark that ended it or None, the next text
    pieces = [(p, mark) for s, mark in zip(parts[::2], (*parts[1::2], None)) if (p := _WORD.findall(s))]
    kept = [p for p, mark in pieces if mark or len(p) > 3] or [p for p, _ in pieces]
    words = [w for p in kept for w in p]
    if lang not in caches:
        votes = {k: sum(map(v.__contains__, words)) for k, v in _FUNCTION_WORDS.items()}
        lang = max(LANGUAGES, key=lambda k: votes[k])
    n = list(map(caches[lang].__getitem__, words))
    return lang, sum(len(p) for p, _ in pieces), len(words), len(kept), sum(map(len, words)), sum(n), sum(x > 2 for x in n)


def reading_scores(documents: DataFrame) -> DataFrame:
    """doc_id, source, lang, words (of the whole text), sentences, score: the median grade estimate of every document with a word."""
    schema = "doc_id long, source string, lang string, words long, sentences long, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches = {"en": _Counts(english_syllables), "pt": _Counts(portuguese_syllables), "es": _Counts(spanish_syllables)}
        for batch in batches:
            rows = []
            for doc, source, lang, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                lang, words, graded, sentences, *rest = reading_counts(text, (lang or "").strip().lower()[:2], caches)
                if words:
                    rows.append((doc, source, lang, words, sentences, float(median(_grades(lang, graded, sentences, *rest)))))
            columns = zip(*rows) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["doc_id", "source", "lang", "words", "sentences", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(score, schema)


def label_grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade: the median of the raters' latest grades; NULL grades and repeats don't count."""
    latest = (
        labels.where("doc_id is not null and grade between 1 and 5")
        .groupBy("doc_id", F.coalesce("rater", F.lit("")).alias("rater"))
        .agg(F.max(F.struct("rated_at", "grade")).alias("l"))
    )
    return latest.groupBy("doc_id").agg(F.expr("percentile(l.grade, 0.5)").alias("grade"))


def calibration(scores: DataFrame, labels: DataFrame) -> dict[str, list[tuple[float, float]]]:
    """language -> (median score, grade) knots, rising in both; "" holds those of all languages together.

    Computed over all labelled documents; at most (languages + 1) x 5 rows come to the driver. Labels grow with the
    documents, so both sides are shuffled (three slim columns) and neither is broadcast.
    """
    marked = scores.select("doc_id", "lang", "score").join(label_grades(labels).hint("merge"), "doc_id").withColumn("g", F.round("grade").cast("int"))
    rows = marked.select(F.explode(F.array("lang", F.lit(""))).alias("lang"), "g", "score").groupBy("lang", "g").agg(F.expr("percentile_approx(score, 0.5, 10000)").alias("s"), F.count("*").alias("n")).collect()
    out: dict[str, list[tuple[float, float]]] = {}
    for lang in sorted({r["lang"] for r in rows}):
        knots: list[list[float]] = []  # score, grade, weight; merged where scores don't rise
        for r in sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["g"]):
            knots.append([r["s"], float(r["g"]), r["n"]])
            while len(knots) > 1 and knots[-1][0] <= knots[-2][0]:
                b, a = knots.pop(), knots.pop()
                n = a[2] + b[2]
                knots.append([(a[0] * a[2] + b[0] * b[2]) / n, (a[1] * a[2] + b[1] * b[2]) / n, n])
        out[lang] = [(s, g) for s, g, _ in knots]
    return out


def _interpolated(score: Column, knots: list[tuple[float, float]]) -> Column:
    if not knots:
        return F.lit(None).cast("double")
    out = F.lit(knots[-1][1])
    for (s0, g0), (s1, g1) in reversed(list(zip(knots, knots[1:]))):
        out = F.when(score < s1, F.lit(g0) + (score - s0) * ((g1 - g0) / (s1 - s0))).otherwise(out)
    return F.when(score <= knots[0][0], F.lit(knots[0][1])).otherwise(out)


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, lang, words, score, level, grade: how demanding each document with text is.

    `score` is the median of the classic grade estimates, `level` its place on the raters' scale from 1 (easiest) to 5
    (interpolated between the median scores of the labelled documents of each grade, per language where that language
    has labels of two grades, else over all), `grade` the nearest whole level. Without labels level and grade are NULL.
    Documents without a word give no row; `lang` is the column's language, or the one whose function words prevail.
    """
    scores = staged(reading_scores(documents), "reading-scores")
    knots = calibration(scores, labels)
    everyone = knots.get("", [])
    level = _interpolated(F.col("score"), everyone)
    for lang in LANGUAGES:
        if len(knots.get(lang, [])) > 1:
            level = F.when(F.col("lang") == lang, _interpolated(F.col("score"), knots[lang])).otherwise(level)
    return scores.withColumn("level", level).select("doc_id", "source", "lang", "words", "score", "level", F.round("level").cast("int").alias("grade"))


def reading_profile(levels: DataFrame) -> DataFrame:
    """source, lang, grade, documents, words, share (of the documents of that source and language)."""
    source = F.coalesce(F.nullif(F.regexp_replace(F.lower(F.trim("source")), r"[\s_-]+", "_"), F.lit("")), F.lit("unknown"))
    groups = levels.groupBy(source.alias("source"), "lang", "grade").agg(F.count("*").alias("documents"), F.sum("words").alias("words"))
    return groups.withColumn("share", F.col("documents") / F.sum("documents").over(W.partitionBy("source", "lang")))
