"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For each sample
and term, gamma- and uniform-distributed numbers are drawn from hashes of the term
(improved consistent weighted sampling), and the term with the least value is kept with
its quantised weight. Two texts agree on a sample with a probability equal to
their generalised Jaccard similarity, sum of minima over sum of maxima of the weights.

Everything is built-in expressions. The value to minimise and the sample's hash share one
long, so that a plain hash aggregate finds all samples of a document at once. Documents
are dealt into ranges of ``doc_id``, once; words, weights and samples are then grouped
where the document is.

Results, by case: NULL and empty texts, and texts of white space, have one empty term, so
they have equal fingerprints; documents are in order of ``doc_id``, then text, and rows
with a NULL ``doc_id`` come lowest; repeated rows are documents of their own; a single
document is its own neighbour; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.workspace import stage

#: Samples of a fingerprint.
SAMPLES = 64
#: Ranges of ``doc_id`` for each shuffle partition, and the boundaries at which they
#: are cut by counted shares; within those they are of even width.
RANGES, BOUNDARIES = 4, 256

_HASH_BITS = 32
_STEPS = 1 << 24  # of the logarithm of a value
_LEAST = 60.0  # log values lie above minus this
#: The least value of a text of W words is above this over W with a probability of exp(-24),
#: 4e-11, a sample: terms that are surely above it need no logarithms.
_NEAR = 24.0


def _uniform(bits: Column) -> Column:
    """A number between 0 and 1 from 25 bits."""
    return (bits.bitwiseAND(F.lit((1 << 25) - 1)).cast("double") + 0.5) * 2.0**-25


def _salt(number: int) -> Column:
    """A long that is particular to ``number``."""
    digest = hashlib.blake2b(number.to_bytes(8, "big"), digest_size=8).digest()
    return F.lit(int.from_bytes(digest, "big", signed=True)).cast("long")


def sample(term: Column, log_weight: Column, number: int, near: Column) -> Column:
    """Value of a term (a hash) in one sample, above the hash of the term and its quantised
    weight. ``near`` is the weight times ``_NEAR``, over the words of the text.

    The value is log(c) - r * (t - beta + 1), where exp(-r) is u1 * u2, c is at least
    1 - u3 * u4, and r * (t - beta) at most the log of the weight. So its exponential is at
    least u1 * u2 * (1 - u3 * u4) / weight, and where that rules a term out the greatest
    value stands for it.
    """
    first = F.xxhash64(term.bitwiseXOR(_salt(2 * number)))
    second = F.xxhash64(term.bitwiseXOR(_salt(2 * number + 1)))
    u1, u2 = _uniform(first), _uniform(F.shiftrightunsigned(first, 25))
    u3, u4 = _uniform(second), _uniform(F.shiftrightunsigned(second, 25))
    # The 14 bits that are left of each hash.
    beta = _uniform(
        F.shiftleft(F.shiftrightunsigned(first, 50), 11).bitwiseOR(
            F.shiftrightunsigned(second, 53)
        )
    )
    r = -F.log(u1 * u2)  # gamma of shape 2
    c = -F.log(u3 * u4)
    t = F.floor(log_weight / r + beta)
    value = F.log(c) - r * (t - beta) - r
    steps = F.floor((value + _LEAST) * _STEPS).cast("long")
    steps = F.least(F.greatest(steps, F.lit(0)), F.lit((1 << 31) - 1))
    kept = F.xxhash64(second.bitwiseXOR(t)).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    least = u1 * u2 * (F.lit(1.0) - u3 * u4)
    far = F.lit(((1 << 31) - 1) << _HASH_BITS).bitwiseOR(
        second.bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    )
    return F.when(least <= near, F.shiftleft(steps, _HASH_BITS).bitwiseOR(kept)).otherwise(far)


def _ranges(documents: DataFrame) -> tuple[DataFrame, int]:
    """The documents with ``range_no``, which rises with ``doc_id``, and how many ranges."""
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = RANGES * partitions
    shares = min(count, BOUNDARIES)
    width = -(-count // shares)
    bounds = documents.agg(
        F.percentile_approx("doc_id", [i / shares for i in range(shares + 1)], 100 * shares)
    ).first()[0]
    if not bounds or width * shares == 1:
        return documents.withColumn("range_no", F.lit(0)), 1
    edges = F.array(*[F.lit(int(b)) for b in bounds[1:-1]])
    lows = F.array(*[F.lit(int(b)) for b in bounds])
    share = F.size(F.filter(edges, lambda e: e < F.col("doc_id")))
    rows = documents.withColumn("_share", F.when(F.col("doc_id").isNotNull(), share).otherwise(0))
    low, high = F.get(lows, F.col("_share")), F.get(lows, F.col("_share") + 1)
    part = F.floor((F.col("doc_id") - low).cast("double") * width / (high - low + 1))
    part = F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(width - 1))
    rows = rows.withColumn("range_no", (F.col("_share") * width + part).cast("int"))
    return rows.drop("_share"), width * shares


def _before(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The last document before each range, with that range's number; before the first
    range it is the last document of all. Where rows share its id, all of them."""
    lasts = rows.groupBy("range_no").agg(F.max("doc_id").alias("last_id"))
    order = Window.orderBy("range_no")  # as many rows as there are ranges
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = lasts.select(
        F.col("range_no").alias("for_no"),
        F.when(F.row_number().over(order) == 1, F.last("range_no").over(whole))
        .otherwise(F.lag("range_no").over(order))
        .alias("before_no"),
        F.when(F.row_number().over(order) == 1, F.last("last_id").over(whole))
        .otherwise(F.lag("last_id").over(order))
        .alias("before_id"),
    )
    found = texts.join(
        F.broadcast(named),
        F.col("doc_id").eqNullSafe(F.col("before_id")) & (F.col("range_no") == F.col("before_no")),
    )
    return found.select(F.col("for_no").alias("range_no"), "doc_id", "text")


def with_edits(documents: DataFrame) -> DataFrame:
    """``range_no``, ``place`` within it, ``doc_id``, ``text`` and ``edited``: the text whose
    last half is replaced by the beginning of the next document in falling ``doc_id``."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows, count = _ranges(rows)
    guests = _before(rows.select("doc_id", "range_no"), rows)
    both = rows.select("range_no", "doc_id", "text", F.lit(True).alias("own")).unionByName(
        guests.select("range_no", "doc_id", "text", F.lit(False).alias("own"))
    )
    dealt = both.repartitionById(count, F.col("range_no"))
    order = Window.partitionBy("range_no").orderBy("own", F.asc_nulls_first("doc_id"), "text")
    placed = dealt.select(
        "range_no",
        F.row_number().over(order).alias("place"),
        "doc_id",
        "text",
        "own",
        F.lag("text").over(order).alias("following"),
    ).where("own")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring("following", F.lit(1), half),
    )
    return placed.select("range_no", "place", "doc_id", "text", edited.alias("edited"))


def fingerprints(rows: DataFrame, keys: list[str], columns: list[str], samples: int) -> DataFrame:
    """``keys``, ``which`` (place in ``columns``) and samples ``s0, s1, ...`` of each text."""
    texts = F.array(
        *[F.struct(F.lit(n).alias("which"), F.col(c).alias("text")) for n, c in enumerate(columns)]
    )
    rows = rows.select(*keys, F.explode(texts).alias("item")).select(
        *keys, "item.which", F.split("item.text", r"[\x20\x09-\x0D]+").alias("words")
    )
    words = rows.select(*keys, "which", F.size("words").alias("n"), F.explode("words").alias("word"))
    # The empty word, before or after white space, is a term of texts without words only.
    count = F.count(F.lit(1))
    terms = words.groupBy(*keys, "which", "n", F.xxhash64("word").alias("term")).agg(
        F.log(count).alias("log_weight"), (count * _NEAR / F.col("n")).alias("near")
    )
    empty = F.xxhash64(F.lit(""))
    last = (F.col("term") == empty).cast("long") * F.lit((1 << 63) - 1)
    least = [
        F.min(
            sample(F.col("term"), F.col("log_weight"), i, F.col("near")).bitwiseOR(last)
        ).alias(f"s{i}")
        for i in range(samples)
    ]
    return terms.groupBy(*keys, "which").agg(*least)


def _text_of(samples: list[Column]) -> Column:
    mask = F.lit((1 << _HASH_BITS) - 1)
    return F.concat(*[F.lpad(F.lower(F.hex(s.bitwiseAND(mask))), 8, "0") for s in samples])


def likeness(left: Column, right: Column, samples: int) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [
        (F.substring(left, 8 * i + 1, 8) == F.substring(right, 8 * i + 1, 8)).cast("int")
        for i in range(samples)
    ]
    return sum(same[1:], same[0]) / samples


def compare(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to each
    other and to the next document's."""
    rows = with_edits(documents)
    keys = ["range_no", "place"]
    found = fingerprints(rows, keys, ["text", "edited"], samples).select(
        *keys, "which", _text_of([F.col(f"s{i}") for i in range(samples)]).alias("print")
    )
    both = found.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("print"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited_fingerprint"),
    )
    facts = rows.select(
        *keys,
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    done = stage(facts.join(both, keys), "fingerprints").rows
    order = Window.partitionBy("range_no").orderBy("place")
    lasts = done.groupBy("range_no").agg(F.max("place").alias("place")).join(done, keys)
    ends = Window.orderBy("range_no")  # as many rows as there are ranges
    whole = ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = lasts.select(
        F.col("range_no").alias("for_no"),
        F.coalesce(
            F.lag("fingerprint").over(ends), F.last("fingerprint").over(whole)
        ).alias("before_print"),
    )
    out = done.withColumn("lag_print", F.lag("fingerprint").over(order)).join(
        F.broadcast(before), F.col("range_no") == F.col("for_no")
    )
    following = F.coalesce("lag_print", "before_print")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), following, samples).alias("near_next"),
    )
