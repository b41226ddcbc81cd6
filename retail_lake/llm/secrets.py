"""Secret scan: fixed patterns, and a battery of randomness tests.

Three patterns find assigned, access-key and hexadecimal secrets. Besides them,
every long run of letters, digits and base64 signs is a candidate. Its encoding is
inferred from the characters it uses, and a battery tests whether it looks drawn at
random from that alphabet: chi-squared uniformity over symbols and over pooled
character classes, a runs test about the alphabet's middle, and lag-one serial
correlation, combined by Fisher's method. Each candidate also has a p-value under
the opposite hypothesis, ordinary text: its changes between character classes and
its evenness of symbols against the rates counted over all documents. Two
Benjamini-Hochberg steps over all candidates, separate for each band of lengths, keep
the shares of false discoveries below their levels: the first finds by the battery which
runs are no random draws (besides those beyond a fixed level), the second which of the
others are no ordinary text. So a run needs more evidence, and has to look more random,
when ordinary runs of its length are many. Where a base
span covers a part of a run, its free parts are candidates if they are long enough.

Results, by case: NULL and empty texts have no spans; repeated rows and rows with a
NULL ``doc_id`` are scanned like any other row; an empty table gives an empty result;
other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.workspace import stage

# The base patterns, their kinds in order, and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE_KINDS = ("assign", "access", "hex")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

RANDOM_KIND = "random"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets from the narrowest to the widest, in the order of their values.
ALPHABETS = (
    DIGITS,
    DIGITS + LOWER[:6],
    DIGITS + UPPER[:6],
    UPPER + DIGITS[2:8],
    LOWER,
    UPPER,
    DIGITS + LOWER,
    DIGITS + UPPER,
    LOWER + UPPER,
    UPPER + LOWER + DIGITS,
    UPPER + LOWER + DIGITS + "-_",
    UPPER + LOWER + DIGITS + "+/",
    UPPER + LOWER + DIGITS + "+/-_",
)
_MEMBERS = [np.isin(np.arange(128), [ord(c) for c in a]) for a in ALPHABETS]
_INDEX = []
for _alphabet in ALPHABETS:
    _at = np.full(128, -1)
    _at[[ord(c) for c in _alphabet]] = np.arange(len(_alphabet))
    _INDEX.append(_at)
#: Character classes: 0 none, 1 lower case, 2 upper case, 3 digit, 4 sign.
_CLASS = np.zeros(256, np.int8)
for _number, _letters in enumerate((LOWER, UPPER, DIGITS, "+/-_"), 1):
    _CLASS[[ord(c) for c in _letters]] = _number
_ALNUM = [ord(c) for c in LOWER + UPPER + DIGITS]
#: Shortest candidates of each band of lengths.
BANDS = (20, 32, 48, 80)
#: Steps of -log10 p: tenths. Evidence is counted up to p = 1e-30, and the battery's up to
#: 1e-10: no thresholds of a Benjamini-Hochberg step over real corpora lie beyond.
STEPS, MOST_STEPS, MOST_ODD = 10, 300, 100
#: Shortest candidate.
SHORTEST = 20


@dataclass(frozen=True)
class Levels:
    """Level of the battery for any run; shares of false discoveries allowed in a band, of
    runs that are refused as no random draws, and of secrets."""

    battery: float = 0.002
    false_refusals: float = 0.01
    false_discoveries: float = 0.01


@dataclass(frozen=True)
class Model:
    """Rates of ordinary text, and for each band the least evidence that counts, and the
    least against a random draw that refuses a run."""

    switch_rate: float
    symbol_shares: tuple[float, ...]
    thresholds: tuple[int, ...]
    levels: Levels
    odd: tuple[int, ...] = (27,) * len(BANDS)  # a fixed level of 0.002


# --- one text ------------------------------------------------------------

def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns. ``runs`` are the long runs, in
    which alone a hexadecimal secret can lie."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end()))
    for begin, end in runs:
        if end - begin >= LEAST_HEX:
            for m in HEX.finditer(text, begin, end):
                if len(m[0]) >= LEAST_HEX:
                    found.append((m.start(), 2, m.end()))
    found.sort()
    return found


def candidates(text: str, runs: list[tuple[int, int]], base: list) -> list[tuple[int, int]]:
    """Long runs, or their long parts, that no base span covers. Both lists are in order."""
    if not base:
        return runs
    taken: list[list[int]] = []  # the base spans' union
    for start, _, stop in base:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], stop)
        else:
            taken.append([start, stop])
    out, at = [], 0
    for begin, end in runs:
        while at < len(taken) and taken[at][1] <= begin:
            at += 1
        free, place = begin, at
        while place < len(taken) and taken[place][0] < end:
            if taken[place][0] - free >= SHORTEST:
                out.append((free, taken[place][0]))
            free = taken[place][1]
            place += 1
        # Only the last of them can reach into the next run.
        at = max(at, place - 1)
        if end - free >= SHORTEST:
            out.append((free, end))
    return out


def long_runs(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


# --- the battery ---------------------------------------------------------

def _log_upper_normal(z: float) -> float:
    """log P(Z >= z)."""
    if z < 30:
        return math.log(max(0.5 * math.erfc(z / math.sqrt(2)), 5e-324))
    return -z * z / 2 - math.log(z * math.sqrt(2 * math.pi))


def _log_chi_squared(x: float, df: int) -> float:
    """log P(X >= x), by the cube root of Wilson and Hilferty."""
    if df < 1 or x <= 0:
        return 0.0
    spread = 2 / (9 * df)
    return _log_upper_normal(((x / df) ** (1 / 3) - 1 + spread) / math.sqrt(spread))


def infer_alphabet(codes: np.ndarray) -> int:
    """The narrowest alphabet that has all characters."""
    return next(n for n, member in enumerate(_MEMBERS) if member[codes].all())


def log_p_random(codes: np.ndarray) -> float:
    """Combined log p of the battery: small if the run is no random draw."""
    number = infer_alphabet(codes)
    size, n = len(ALPHABETS[number]), len(codes)
    at = _INDEX[number][codes]
    counts = np.bincount(at, minlength=size)
    logs = [_log_chi_squared(float(size / n * (counts**2).sum() - n), size - 1)]
    of_alphabet = np.bincount(_CLASS[[ord(c) for c in ALPHABETS[number]]], minlength=5)
    expected = n * of_alphabet / size
    observed = np.bincount(_CLASS[codes], minlength=5)
    pooled = expected >= 2
    if pooled.sum() > 1:
        chi = ((observed - expected)[pooled] ** 2 / expected[pooled]).sum()
        logs.append(_log_chi_squared(float(chi), int(pooled.sum()) - 1))
    high = at >= size / 2
    n1 = int(high.sum())
    n2 = n - n1
    if n1 and n2:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * n1 * n2 / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        if variance > 0:
            logs.append(math.log(2) + _log_upper_normal(abs(runs - mean) / math.sqrt(variance)))
    centred = at - at.mean()
    power = float((centred**2).sum())
    if power > 0:
        serial = float((centred[1:] * centred[:-1]).sum()) / power
        logs.append(math.log(2) + _log_upper_normal(abs(serial + 1 / n) * math.sqrt(n)))
    logs = [min(0.0, p) for p in logs]
    # Fisher: -2 sum(log p) is chi-squared with twice as many degrees as tests.
    half = -sum(logs)
    tail = sum(math.exp(i * math.log(half) - math.lgamma(i + 1)) if half > 0 else i == 0
               for i in range(len(logs)))
    return min(0.0, -half + math.log(tail)) if tail > 0 else -half


def log_p_text(codes: np.ndarray, switch_rate: float, shares: np.ndarray) -> float:
    """log p that ordinary text looks as mixed and as even as this run."""
    n = len(codes)
    classes = _CLASS[codes]
    rate, seen = switch_rate, int((classes[1:] != classes[:-1]).sum()) / (n - 1)
    mixed = 0.0
    if seen > rate:
        mixed = -(n - 1) * (
            seen * math.log(seen / rate)
            + ((1 - seen) * math.log((1 - seen) / (1 - rate)) if seen < 1 else 0.0)
        )
    squares = int((np.bincount(codes, minlength=128) ** 2).sum())
    p2, p3 = float((shares**2).sum()), float((shares**3).sum())
    mean = n + n * (n - 1) * p2
    variance = 4 * n * (n - 1) * (n - 2) * (p3 - p2**2) + 2 * n * (n - 1) * (p2 - p2**2)
    even = _log_upper_normal((mean - squares) / math.sqrt(max(variance, 1e-9)))
    return min(0.0, math.log(2) + min(mixed, even))


def _codes(run: str) -> np.ndarray:
    return np.frombuffer(run.rstrip("=").encode("ascii"), np.uint8)


def evidence(run: str, switch_rate: float, shares: np.ndarray) -> tuple[int, int]:
    """Tenths of -log10 p of ordinary text, and of a random draw."""
    codes = _codes(run)
    if len(codes) < 2:  # signs of padding alone
        return 0, MOST_ODD
    log_p, odd = log_p_text(codes, switch_rate, shares), log_p_random(codes)
    tenths = -STEPS / math.log(10)
    return min(MOST_STEPS, int(log_p * tenths)), min(MOST_ODD, int(odd * tenths))


def band_of(length: int) -> int:
    return sum(length >= least for least in BANDS) - 1


# --- the corpus ----------------------------------------------------------

SCANNED = (
    "base array<struct<start:int,kind:int,end:int>>, runs array<struct<start:int,end:int,run:string>>,"
    " counts array<bigint>"
)


def _counts(texts: list[str]) -> np.ndarray:
    """Pairs of neighbouring alphanumerics, those that change class, and each symbol."""
    pairs = switches = 0
    symbols = np.zeros(256, np.int64)
    for text in texts:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        symbols += np.bincount(raw, minlength=256)
        kind = _CLASS[raw]
        kind[kind == 4] = 0
        both = (kind[1:] > 0) & (kind[:-1] > 0)
        pairs += int(both.sum())
        switches += int((both & (kind[1:] != kind[:-1])).sum())
    return np.concatenate([[pairs, switches], symbols[_ALNUM]])


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base, runs = [], []
        for text in batch["text"]:
            spans = long_runs(text)
            own = base_spans(text, spans)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            free = candidates(text, spans, own)
            runs.append([{"start": s, "end": e, "run": text[s:e]} for s, e in free])
        counts = [None] * len(batch)
        if counts:
            counts[0] = _counts(batch["text"].tolist())
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "base": base, "runs": runs, "counts": counts}
        )


def scan(documents: DataFrame) -> DataFrame:
    """Base spans and candidates of each document; every batch's counts on its first row."""
    # As text: beside a NULL, pandas would make long ids fractions and round them.
    kind = documents.schema["doc_id"].dataType
    own = F.col("doc_id").cast("string").alias("doc_id")
    texts = documents.select(own, F.coalesce("text", F.lit("")).alias("text"))
    scanned = texts.mapInPandas(_scan, f"doc_id string, {SCANNED}")
    return scanned.withColumn("doc_id", F.col("doc_id").cast(kind))


def _rates(scanned: DataFrame) -> tuple[float, tuple[float, ...]]:
    rows = (
        scanned.where("counts IS NOT NULL")
        .select(F.posexplode("counts").alias("place", "n"))
        .groupBy("place")
        .agg(F.sum("n").alias("n"))
        .collect()  # 64 rows
    )
    total = {r["place"]: r["n"] for r in rows}
    pairs, switches = total.get(0, 0), total.get(1, 0)
    symbols = np.array([total.get(i + 2, 0) for i in range(len(_ALNUM))], float) + 1
    return (switches + 1) / (pairs + 50), tuple(symbols / symbols.sum())


def _judged(run: dict, rate: float, shares: np.ndarray) -> dict:
    steps, odd = evidence(run["run"], rate, shares)
    band = band_of(len(run["run"]))
    return {"start": run["start"], "end": run["end"], "band": band, "steps": steps, "odd": odd}


def _with_evidence(scanned: DataFrame, rate: float, shares: tuple) -> DataFrame:
    """Candidates as ``start, end, band, steps, odd`` in place of their texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_symbols = np.array(shares)
        for batch in batches:
            batch["runs"] = [[_judged(r, rate, of_symbols) for r in runs] for runs in batch["runs"]]
            yield batch

    kind = scanned.schema["doc_id"].dataType
    own = F.col("doc_id").cast("string").alias("doc_id")
    judged = scanned.select(own, "base", "runs").mapInPandas(
        run,
        "doc_id string, base array<struct<start:int,kind:int,end:int>>, "
        "runs array<struct<start:int,end:int,band:int,steps:int,odd:int>>",
    )
    return judged.withColumn("doc_id", F.col("doc_id").cast(kind))


def _discoveries(counts: dict[int, int], level: float, most: int) -> int:
    """Benjamini-Hochberg over steps of -log10 p: the least that is a discovery."""
    total, seen, least = sum(counts.values()), 0, most + 1
    for step in sorted(counts, reverse=True):
        seen += counts[step]
        if step and 10 ** (-step / STEPS) <= level * seen / total:
            least = step
    return least


def _thresholds(judged: DataFrame, levels: Levels) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The least evidence of a secret, and of a run that is no random draw, by band. The
    first is among all runs of the band: those that are no random draws have none."""
    rows = (
        judged.select(F.explode("runs").alias("run"))
        .groupBy("run.band", "run.steps", "run.odd")
        .count()
        .collect()  # bands x steps x steps of the battery at most
    )
    least, odd = [], []
    for band in range(len(BANDS)):
        own = [(r["steps"], r["odd"], r["count"]) for r in rows if r["band"] == band]
        against: dict[int, int] = Counter()
        for _, step, n in own:
            against[step] += n
        fixed = math.ceil(-STEPS * math.log10(levels.battery))
        odd.append(min(fixed, _discoveries(against, levels.false_refusals, MOST_ODD)))
        passing: dict[int, int] = Counter()
        for step, by_battery, n in own:
            passing[step if by_battery < odd[-1] else 0] += n
        least.append(_discoveries(passing, levels.false_discoveries, MOST_STEPS))
    return tuple(least), tuple(odd)


def _fit(documents: DataFrame, levels: Levels) -> tuple[Model, DataFrame]:
    scanned = stage(scan(documents), "secrets").rows
    rate, shares = _rates(scanned)
    judged = _with_evidence(scanned, rate, shares)
    least, odd = _thresholds(judged, levels)
    return Model(rate, shares, least, levels, odd), judged


def fit(documents: DataFrame, levels: Levels = Levels()) -> Model:
    """Rates and thresholds from all documents."""
    return _fit(documents, levels)[0]


def find(documents: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """``doc_id`` and ``spans array<struct<kind, start, end>>`` in order; offsets are
    code points, the end is exclusive. Base spans have kinds assign, access and hex, those
    of the battery ``random``."""
    model, judged = _fit(documents, levels)
    least = F.array(*[F.lit(t) for t in model.thresholds])
    odd = F.array(*[F.lit(t) for t in model.odd])
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, RANDOM_KIND)])
    random = F.transform(
        F.filter(
            "runs",
            lambda r: (r["steps"] >= F.get(least, r["band"])) & (r["odd"] < F.get(odd, r["band"])),
        ),
        lambda r: F.struct(
            r["start"].alias("start"), F.lit(len(BASE_KINDS)).alias("kind"), r["end"].alias("end")
        ),
    )
    ordered = F.array_sort(F.concat("base", random))
    return judged.select(
        "doc_id",
        F.transform(
            ordered,
            lambda s: F.struct(
                F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        ).alias("spans"),
    )


def spans_in(text: str, model: Model) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all spans of one text under a fitted model."""
    runs = long_runs(text)
    base = base_spans(text, runs)
    shares = np.array(model.symbol_shares)
    for start, end in candidates(text, runs, base):
        steps, odd = evidence(text[start:end], model.switch_rate, shares)
        band = band_of(end - start)
        if steps >= model.thresholds[band] and odd < model.odd[band]:
            base.append((start, len(BASE_KINDS), end))
    return sorted(base)


def redact(documents: DataFrame, model: Model, mark: str = "[secret]") -> DataFrame:
    """The documents with each secret replaced by ``mark``. All columns stay."""

    def clean(text: str) -> str:
        out, at = [], 0
        for start, _, end in spans_in(text, model):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]]) if out else text

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(clean, na_action="ignore")

    return documents.withColumn("text", redacted("text"))


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != RANDOM_KIND)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in (*BASE_KINDS, RANDOM_KIND)
    ]
    return found.select(
        "doc_id",
        *counts[:3],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        counts[3],
    )
