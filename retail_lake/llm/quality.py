"""Quality rules, line first: bad lines go, then documents that lose too much.

Each line is judged by itself: navigation (a line of separators), symbol noise,
shouting, words said over and over, boilerplate phrases in a short line, and short lines
without any punctuation or number, as menus have. Lines
that fail are removed. A document is rejected if too many of its words went with
them, or by the base rules. Built-in expressions over one row; nothing is shuffled.

Results, by case: a NULL or empty text has no words, fails the base rules and is not
kept, its cleaned text is empty; repeated rows and rows with a NULL ``doc_id`` are judged
like any other row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Phrases of notices and menus.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "click here",
    "enable javascript",
    "log in",
    "privacy policy",
    "read more",
    "share this",
    "sign up",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are of words unless said otherwise."""

    least_words: int = 10
    most_repeated_percent: int = 20
    most_separators: float = 0.20
    most_symbols: float = 0.10  # of characters
    most_shouts: float = 0.30
    least_distinct: float = 0.20
    most_echoed: float = 0.40
    judged_for_repeats: int = 10
    short_line: int = 12
    most_lost: float = 0.40


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _count(line: Column, characters: str) -> Column:
    return F.length(line) - F.length(F.translate(line, characters, ""))


def _judged(line: Column) -> Column:
    """A line with its words, how many differ, and how many echo the word before."""
    words = words_of(line)
    echoes = F.zip_with(words, F.concat(F.array(F.lit("")), words), lambda a, b: a == b)
    return F.struct(
        line.alias("line"),
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct"),
        F.size(F.filter(echoes, lambda same: same)).alias("echoed"),
    )


def _failed(judged: Column, rules: Rules) -> Column:
    line, words = judged["line"], judged["words"]
    navigation = _count(line, "|»›·") > rules.most_separators * words
    noise = _count(line, SYMBOLS) > rules.most_symbols * F.length(line)
    shouting = (_count(line, "!") > rules.most_shouts * words) & (words > 1)
    repeated = (words >= rules.judged_for_repeats) & (
        (judged["distinct"] < rules.least_distinct * words)
        | (judged["echoed"] > rules.most_echoed * words)
    )
    notice = (words <= rules.short_line) & F.lower(line).rlike("|".join(BOILERPLATE))
    menu = (words > 1) & (words <= rules.short_line) & ~line.rlike(r"[\p{P}\p{S}\p{N}]")
    return navigation & (words > 1) | noise | shouting | repeated | notice | menu


def _repeat_words(windows: Column, n_windows: Column) -> Column:
    """Words covered by windows (sorted by hash, with positions) that occur twice."""
    alike = F.filter(
        F.sequence(F.lit(0), n_windows - 1),
        lambda j: F.coalesce(F.get(windows, j)["h"] == F.get(windows, j - 1)["h"], F.lit(False))
        | F.coalesce(F.get(windows, j)["h"] == F.get(windows, j + 1)["h"], F.lit(False)),
    )
    return F.array_sort(F.transform(alike, lambda j: F.get(windows, j)["i"]))


def assess(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts of the base rules, the cleaned text and the verdict on each document.

    Columns: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``n_lines``, ``n_failed_lines``, ``n_lost_words`` (all long),
    ``base_failed``, ``kept`` (boolean) and ``cleaned`` (the text without failed lines).
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        "text",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "text",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.transform("lines", _judged).alias("judged"),
    )
    rows = rows.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("hashes") - WINDOW),
                lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]),
            ),
        ),
    ).drop("hashes")
    # Few documents repeat a window: only theirs are sorted.
    rows = rows.withColumn("n_windows", F.size("windows")).withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.col("n_windows"),
            F.array_sort(
                F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    )
    rows = rows.withColumn(
        "starts",
        F.when(
            F.col("sorted").isNotNull(), _repeat_words(F.col("sorted"), F.col("n_windows"))
        ),
    ).drop("windows", "sorted", "n_windows")
    covered = F.aggregate(
        F.zip_with(
            "starts",
            F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))),
            lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    rows = rows.withColumn("passed", F.filter("judged", lambda x: ~_failed(x, rules)))
    passed_words = F.aggregate("passed", F.lit(0), lambda total, x: total + x["words"])
    rows = rows.select(
        "doc_id",
        "n_words",
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("starts").isNotNull(), covered), F.lit(0))
        .cast("long")
        .alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("passed")).cast("long").alias("n_failed_lines"),
        (F.col("n_words") - passed_words).cast("long").alias("n_lost_words"),
        F.array_join(F.transform("passed", lambda x: x["line"]), "\n").alias("cleaned"),
    )
    base = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.most_repeated_percent * F.col("n_words")
    )
    rows = rows.withColumn("base_failed", base)
    lost = F.col("n_lost_words") > rules.most_lost * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & ~lost)


def verdicts(assessed: DataFrame) -> DataFrame:
    """The counts and verdicts without the cleaned text."""
    return assessed.drop("cleaned")
