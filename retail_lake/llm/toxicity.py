"""Toxicity: a learned weighted lexicon, matched by Aho-Corasick on folded text.

Folding writes a text as lower-case words parted by single spaces: digit substitutions
become the letters they stand for, and words with accents or homoglyphs follow once more
in plain Latin letters. The lexicon has
whole words and word beginnings, each with a log-odds weight learned from labelled
documents. Matches inside an exception phrase don't count, and of several terms in one
word the heaviest does. The sum of weights, by itself and per word of the document,
goes through a logistic curve to a score between 0 and 1.

Learning takes at most ``Limits.rows`` labelled documents of each label, those with the
smallest hash of ``doc_id``; one third of them calibrates the curve and the rest make
the lexicon. That sample bounds all that is learned; no term of it is left out for its rank.
The same rows give the same model in any partitioning and any size of batches. A phrase of
two words is an exception if harmless documents have it around a term and toxic ones never.
Scoring covers every document.

Results, by case: NULL and empty texts have the score of a text without matches;
repeated rows are scored each; a document or text with both labels is toxic; a row with a NULL ``doc_id`` is scored and not held out;
without labels the lexicon is empty and every score is the same; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.workspace import stage

# Letters of other scripts, and the Latin letters they look like.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
    "æ": "ae", "œ": "oe",
}
# Digits and signs written for letters.
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
# Phrases in which a term is harmless.
EXCEPTIONS = (
    "clown fish",
    "trash bag",
    "trash bin",
    "trash can",
    "pond scum",
    "circus clown",
    "pathetic fallacy",
)

_LETTERS = str.maketrans(HOMOGLYPHS)
_DIGITS = str.maketrans(SUBSTITUTIONS)
_SIGN_IN_WORD = re.compile(r"(?<=[a-z0-9])[@$!](?=[a-z0-9])")
_DIGIT_WORD = re.compile(r"(?<!\w)(?=\w*[^\W\d_])\w*[013-578]\w*")
_BETWEEN = re.compile(r"[\W_]+")
_MARKED_WORD = re.compile(r"(?a:\w*)[^\x00-\x7F ][^ ]*")
_ANY_DIGIT = re.compile(r"[013-578]")


@dataclass(frozen=True)
class Limits:
    """Bounds of learning; shares are of the toxic documents that make the lexicon."""

    rows: int = 4000  # labelled documents of each label
    least_precision: float = 0.80
    common: float = 0.03
    least_support: int = 3
    rare: float = 0.002
    beginnings: tuple[int, int] = (3, 8)  # letters


@dataclass(frozen=True)
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS


# --- folding and matching ------------------------------------------------

def _plain(text: str) -> str:
    """Without accents, and with look-alikes of other scripts as Latin letters."""
    marked = unicodedata.normalize("NFKD", text)
    return "".join([c for c in marked if not unicodedata.combining(c)]).translate(_LETTERS)


def fold(text: str) -> str:
    """Lower-case words of a text, each with a space before and after it.

    Digits and signs within words become letters. Words with letters beyond a to z follow
    once more in plain letters, so a term is found in either spelling.
    """
    text = _SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], text.lower())
    if _ANY_DIGIT.search(text):
        text = _DIGIT_WORD.sub(lambda m: m[0].translate(_DIGITS), text)
    out = " " + _BETWEEN.sub(" ", text).strip() + " "
    if not out.isascii():
        marked = " ".join(_MARKED_WORD.findall(out))
        out += _BETWEEN.sub(" ", _plain(marked)).strip() + " "
    return out


def terms_of(folded: str, beginnings: tuple[int, int]) -> set[str]:
    """Whole words as `` word `` and beginnings as `` be``."""
    out: set[str] = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        for size in range(beginnings[0], min(beginnings[1], len(word) - 1) + 1):
            out.add(" " + word[:size])
    return out


class Matcher:
    """Aho-Corasick over terms and exception phrases."""

    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...] = ()):
        self.machine = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.machine.add_word(term, (len(term), weight))
        for phrase in exceptions:
            folded = fold(phrase)
            self.machine.add_word(folded, (len(folded), None))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def weights(self, folded: str) -> dict[int, float]:
        """Heaviest term at each matched word, by where the word begins."""
        found: dict[int, float] = {}
        if self.empty:
            return found
        excepted = []
        for end, (size, weight) in self.machine.iter(folded):
            begin = end - size + 1
            if weight is None:
                excepted.append((begin, end))
            elif weight > found.get(begin, -math.inf):
                found[begin] = weight
        if excepted and found:
            excepted.sort()
            place, reach = 0, -1
            for at in sorted(found):
                while place < len(excepted) and excepted[place][0] <= at:
                    reach = max(reach, excepted[place][1])
                    place += 1
                if at < reach:
                    del found[at]
        return found


def features(folded: str, matcher: Matcher) -> tuple[float, float]:
    """The sum of weights, by itself and per hundred words, on a log scale."""
    total = sum(matcher.weights(folded).values())
    words = max(1, folded.count(" ") - 1)
    return math.log1p(total), math.log1p(100 * total / words)


def scores(model: Model, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(model.curve[0] + x @ np.array(model.curve[1:]))))


# --- learning ------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """True for a third of the documents, by a checksum of their id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(documents: DataFrame, labels: DataFrame, limits: Limits):
    """Labelled training documents, and how many labels of each kind there are."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(limits.rows) for k in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 x limits.rows narrow rows are broadcast.
    rows = texts.join(F.broadcast(picked), "doc_id")
    first = F.pmod(F.xxhash64(F.min("doc_id"), F.lit(7)), F.lit(3)) == 0
    once = rows.groupBy("text").agg(F.max("toxic").alias("toxic"), first.alias("curve"))
    return stage(_sketched(once), "toxicity"), totals


def _sketched(rows: DataFrame) -> DataFrame:
    """``lead`` is true for one text, that with the smallest digest, of each smallest word
    triple; near copies share it. Texts without a triple all lead."""

    @F.pandas_udf("string")
    def sketch(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            words = fold(text).split()
            least = min(zip(words, words[1:], words[2:], strict=False), default=None)
            out.append(" ".join(least) if least else None)
        return pd.Series(out, dtype="object")

    known = rows.withColumn("digest", F.sha2("text", 256)).withColumn("sketch", sketch("text"))
    # At most 2 x limits.rows texts, or those of rows that share such an id.
    same = Window.partitionBy("curve", F.coalesce("sketch", "digest"))
    return known.select(
        "toxic", "curve", "text", (F.col("digest") == F.min("digest").over(same)).alias("lead")
    )


def _term_counts(sample: DataFrame, beginnings: tuple[int, int]) -> DataFrame:
    """Documents of each label that have a term; near copies count once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                counts[toxic].update(terms_of(fold(text), beginnings))
            terms = list(counts[0] | counts[1])
            if terms:
                yield pd.DataFrame(
                    {
                        "term": terms,
                        "hits": [counts[1][t] for t in terms],
                        "misses": [counts[0][t] for t in terms],
                    }
                )

    counted = sample.where("NOT curve AND lead").mapInPandas(run, "term string, hits long, misses long")
    return counted.groupBy("term").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))


def _documents_with(sample: DataFrame, terms: list[str], common: set[int]) -> list[list[int]]:
    """Places in ``terms`` that each toxic document of the lexicon part has, if none is common."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for place, term in enumerate(terms):
            machine.add_word(term, place)
        machine.make_automaton()
        for batch in batches:
            found = [{p for _, p in machine.iter(fold(t))} for t in batch["text"]]
            places = [sorted(f) for f in found if f and not f & common]
            if places:
                yield pd.DataFrame({"places": places})

    rows = sample.where("NOT curve AND toxic = 1").select("text")
    return [r["places"] for r in rows.mapInPandas(run, "places array<int>").collect()]


def _harmless_phrases(sample: DataFrame, lexicon: dict[str, float], least: int) -> list[str]:
    """Two words around a match that several harmless documents have, and no toxic one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon)
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                counts[toxic].update(phrases_at(fold(text), matcher))
            phrases = list(counts[0] | counts[1])
            if phrases:
                hits, misses = ([counts[k][p] for p in phrases] for k in (1, 0))
                yield pd.DataFrame({"phrase": phrases, "hits": hits, "misses": misses})

    counted = sample.where("NOT curve AND lead").mapInPandas(
        run, "phrase string, hits long, misses long"
    )
    totals = counted.groupBy("phrase").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    good = totals.where((F.col("hits") == 0) & (F.col("misses") >= least)).select("phrase")
    return sorted(r["phrase"] for r in good.collect())


def phrases_at(folded: str, matcher: Matcher) -> set[str]:
    """The matched words with the word before, and with the word after."""
    out: set[str] = set()
    for begin in matcher.weights(folded):
        end = folded.find(" ", begin + 1)
        before, after = folded.rfind(" ", 0, begin), folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before + 1 : end])
        if after >= 0:
            out.add(folded[begin + 1 : after])
    return {phrase for phrase in out if " " in phrase.strip()}


def common_terms(hits: list[int], n_toxic: int, limits: Limits) -> list[int]:
    least = max(limits.least_support, limits.common * n_toxic)
    return [i for i in range(len(hits)) if hits[i] >= least]


def choose_terms(
    rows: list[list[int]], hits: list[int], misses: list[int], n_toxic: int, limits: Limits
) -> list[int]:
    """Terms that many toxic documents have, then those that cover the documents left.

    A term that only comes with another one, as the words of a much copied document
    do, covers nothing new and is not taken."""
    chosen = common_terms(hits, n_toxic, limits)
    taken = set(chosen)
    left = [set(r) for r in rows if not taken & set(r)]
    least = max(limits.least_support, limits.rare * n_toxic)
    while left:
        gain = Counter(i for r in left for i in r)
        if not gain:
            break
        best = min(gain, key=lambda i: (-gain[i], misses[i], i))
        if gain[best] < least:
            break
        chosen.append(best)
        left = [r for r in left if best not in r]
    return chosen


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton steps, with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    curve = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ curve, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge @ curve
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        curve = curve + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(c) for c in curve)


def fit(documents: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> Model:
    """Lexicon and curve from the labelled documents that are not held out."""
    written, totals = _sample(documents, labels, limits)
    model = _learned(written.rows, totals, limits)
    written.discard()
    return model


def _learned(sample: DataFrame, totals: dict[int, int], limits: Limits) -> Model:
    sizes = {
        (r["toxic"], r["curve"]): r["count"]
        for r in sample.groupBy("toxic", "curve").count().collect()
    }
    toxic, harmless = sizes.get((1, False), 0), sizes.get((0, False), 0)
    if not toxic:
        return Model()
    odds = lambda n, of: F.log((n + 0.5) / (of + 1.0 - n + 0.5))
    counted = _term_counts(sample, limits.beginnings)
    precise = counted.where(
        (F.col("hits") >= limits.least_support)
        & (
            F.col("hits") / toxic
            >= limits.least_precision
            * (F.col("hits") / toxic + F.col("misses") / max(1, harmless))
        )
    )
    weighed = precise.withColumn(
        "weight", odds(F.col("hits"), toxic) - odds(F.col("misses"), harmless)
    )
    top = weighed.orderBy(F.desc("hits"), "misses", F.length("term"), "term").collect()
    terms, hits = [r["term"] for r in top], [r["hits"] for r in top]
    common = set(common_terms(hits, toxic, limits))
    rows = _documents_with(sample, terms, common) if terms else []
    chosen = choose_terms(rows, hits, [r["misses"] for r in top], toxic, limits)
    lexicon = {terms[i]: float(max(top[i]["weight"], 0.1)) for i in chosen}
    learned = _harmless_phrases(sample, lexicon, limits.least_support) if lexicon else []
    exceptions = (*EXCEPTIONS, *learned)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            x = np.array([features(fold(t), matcher) for t in batch["text"]]).reshape(-1, 2)
            yield pd.DataFrame({"toxic": batch["toxic"], "a": x[:, 0], "b": x[:, 1]})

    measured = sample.where("curve").mapInPandas(measure, "toxic int, a double, b double").collect()
    if len({r["toxic"] for r in measured}) < 2:
        return Model(lexicon, (-4.0, 2.0, 2.0), exceptions)
    # In one order, so that sums are the same to the last digit.
    measured.sort(key=lambda r: (r["toxic"], r["a"], r["b"]))
    y = np.array([r["toxic"] for r in measured], float)
    # Each label weighs as much as it does among all labels.
    share = {k: totals[k] / max(1, (y == k).sum()) for k in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    x = np.array([(r["a"], r["b"]) for r in measured])
    return Model(lexicon, fit_curve(x, y, weight / weight.mean()), exceptions)


def score(text: Column, model: Model) -> Column:
    """Score of a text, from the text alone."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model.terms, model.exceptions)
        for batch in texts:
            x = np.array([features(fold(t), matcher) for t in batch]).reshape(-1, 2)
            yield pd.Series(scores(model, x))

    return scored(F.coalesce(text, F.lit("")))


def assess(documents: DataFrame, labels: DataFrame, least_score: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = fit(documents, labels)
    rows = documents.select("doc_id", score(F.col("text"), model).alias("score"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= least_score).cast("int").alias("predicted"),
    )
