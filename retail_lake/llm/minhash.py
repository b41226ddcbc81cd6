"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of bands are made, each band of a few minhashes. The key of
table (i, j) joins band i of the first with band j of the second, so g + g bands
make g * g tables: the minhashes needed grow with the square root of the tables. With
the defaults 48 minhashes serve 144 tables, and two sets at the threshold of 0.75 share
a table with a probability of 0.9999.

Documents with the same shingles are one from the start. In each table a document
becomes a candidate with the first of its bucket over the whole corpus. Candidates are
confirmed on their full shingle sets, and links joined to components. Further rounds do
the same with a random first where a bucket still holds several components, until a round joins few.
The documents of the buckets that are left then go through an exact join (a prefix filter
on rare shingles), so that every pair that shares a table is joined or known to differ.

Results, by case: NULL texts and texts without words have no shingles and are linked
with nothing; a text of fewer than five words has all of them as one shingle; repeated
rows of a ``doc_id`` are one document and each gets its row; a row with a NULL ``doc_id``
is linked with nothing, has no component and is kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.llm.components import components
from retail_lake.llm.shingles import blocks, mix, multipliers, shingle_sets
from retail_lake.workspace import Staged, stage

WORDS = 5
#: Least similarity, in hundredths.
SIMILAR = 75
#: Bands of each collection, and minhashes of a band.
BANDS, ROWS = 12, 2
#: Documents that look up their buckets together.
CHUNK = 5_000
#: The exact join follows when a round joins less than one in so many of its documents.
FEW = 50


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def _bands(hashes: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Both collections, one line for each non-empty set."""
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, 2 * bands), np.uint64)
    if not len(full):
        return out
    mixers = multipliers(2 * bands * rows, 2)
    joiners = multipliers(rows, 3)
    for band in range(2 * bands):
        total = np.full(len(full), band, np.uint64)
        for row in range(rows):
            least = np.minimum.reduceat(hashes * mixers[band * rows + row], first[full])
            total += mix(least) * joiners[row]
        out[full, band] = mix(total)
    return out


def signatures(documents: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit digest of the set, and its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column(1))
            for begin, end in blocks(texts):
                hashes, first = shingle_sets(texts[begin:end], WORDS)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes, dtype=np.uint64)])
                again = mix(hashes + np.uint64(1))
                more = np.concatenate([np.zeros(1, np.uint64), np.cumsum(again, dtype=np.uint64)])
                lines = _bands(hashes, first, bands, rows)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(begin, end - begin),
                        "n_shingles": np.diff(first).astype(np.int64),
                        "digest1": np.diff(sums[first]).view(np.int64),
                        "digest2": np.diff(more[first]).view(np.int64),
                        "bands": pa.array([line.tobytes() for line in lines], pa.binary()),
                    }
                )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(
        run, "doc_id long, n_shingles long, digest1 long, digest2 long, bands binary"
    )


def _crossing(
    keys: np.ndarray, docs: np.ndarray, parts: np.ndarray, partners: int
) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, then at random, and pairs of documents of different components.

    In each bucket the documents outside its largest component are paired with those that
    follow them, in an order that is another one in each table.
    """
    order = np.lexsort((mix(keys ^ docs.astype(np.uint64)), keys))
    keys, docs, parts = keys[order], docs[order], parts[order]
    n = len(keys)
    if not n:
        return order, np.zeros((0, 2), np.int64)
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(begin, n))
    bucket = np.repeat(np.arange(len(begin)), size)
    # Runs of a component within a bucket; the longest is the last after sorting.
    by_part = np.lexsort((parts, bucket))
    p, q = parts[by_part], bucket[by_part]
    runs = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
    lengths = np.diff(np.append(runs, n))
    ranked = np.lexsort((lengths, q[runs]))
    last = np.flatnonzero(np.append(np.diff(q[runs][ranked]) != 0, True))
    largest = p[runs][ranked][last]
    outside = np.flatnonzero(parts != largest[bucket])
    first, many = begin[bucket[outside]], size[bucket[outside]]
    steps = np.arange(1, partners + 1)
    turn = (outside - first)[:, None] + steps
    other = (first[:, None] + turn % many[:, None]).ravel()
    own = np.repeat(outside, partners)
    differ = parts[other] != parts[own]
    own, other = docs[own[differ]], other[differ]
    return order, _distinct(np.column_stack([own, docs[other]]))


def _distinct(pairs: np.ndarray) -> np.ndarray:
    """Pairs of different documents, the smaller first, each once."""
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs.sort(axis=1)
    if not len(pairs):
        return pairs
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])]


def _table_keys(batch: pa.Table, bands: int, partitions: int):
    """Document, key and partition of every table, document by document.

    All tables of one band of the first collection go to one partition, so a pair is
    found by few of them. A band's hash has its number in it.
    """
    tables = multipliers(bands * bands, 4)
    ids = batch.column(0).to_numpy()
    raw = b"".join(batch.column(1).to_pylist())
    lines = np.frombuffer(raw, np.uint64).reshape(len(ids), 2 * bands)
    keys = lines[:, :bands, None] * tables[0] + lines[:, None, bands:] * tables[1]
    keys = mix(keys.reshape(len(ids), -1) + tables[None, :]).ravel()
    parts = (lines[:, :bands] % np.uint64(partitions)).astype(np.int32)
    return ids, keys, np.repeat(parts.ravel(), bands)


def _packed(name: str, parts: np.ndarray, columns: dict[str, np.ndarray], of: int) -> pa.Table:
    """One row for each part with the bytes of its items."""
    dealt = np.argsort(parts, kind="stable")
    own, first = np.unique(parts[dealt], return_index=True)
    cuts = np.append(first, len(parts))
    out = {name: own.astype(np.int64), "of": np.full(len(own), of, np.int64)}
    for column, values in columns.items():
        raw = values[dealt].tobytes()
        cells = [raw[8 * i : 8 * j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        out[column] = pa.array(cells, pa.binary())
    return pa.table(out)


def _partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _heads(keys: np.ndarray, docs: np.ndarray, groups: np.ndarray, turn: int):
    """Order by key and rank, where each key begins, that place for each entry, and which
    entries are of another component than the first of their key. Ranks are ids in turn 0 and
    random afterwards; they depend on nothing but document and key."""
    ids = docs.astype(np.uint64)
    order = np.lexsort((docs, mix(ids ^ keys ^ np.uint64(turn)), keys) if turn else (docs, keys))
    k, g = keys[order], groups[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = k[1:] != k[:-1]
    begin = np.flatnonzero(fresh)
    at = np.repeat(begin, np.diff(np.append(begin, len(k))))
    return order, begin, at, g != g[at]


def meetings(sets: DataFrame, turn: int, bands: int = BANDS) -> DataFrame:
    """Pairs of the first document ``a`` of a table's bucket over the whole corpus and another
    one ``b`` of it, if their ``component`` differs. A document of buckets with several
    components that has no such pair is paired with itself.

    Documents are dealt to chunks by id. A chunk asks for each of its keys, with its first
    document and one of another component, so a bucket brings few entries however many
    documents it holds; it gets the first of the corpus back and compares all its members.
    """
    partitions = _partitions(sets)
    chunks = sets.count() // CHUNK + 1
    dealt = sets.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"), "doc_id", "bands", "component"
    )

    def entries(table: pa.Table):
        ids, keys, parts = _table_keys(table.select(["doc_id", "bands"]), bands, partitions)
        groups = np.repeat(table.column("component").to_numpy(), bands * bands)
        return keys, np.repeat(ids, bands * bands), groups, parts

    def ask(table: pa.Table) -> pa.Table:
        keys, docs, groups, parts = entries(table)
        order, begin, at, other = _heads(keys, docs, groups, turn)
        others = np.flatnonzero(other)
        others = others[np.unique(at[others], return_index=True)[1]]
        sent = order[np.concatenate([begin, others])]
        columns = {"keys": keys[sent], "docs": docs[sent], "groups": groups[sent]}
        return _packed("part", parts[sent], columns, table.column("chunk")[0].as_py())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, groups, chunk = [], [], [], []
        for batch in batches:
            cells = batch.column("keys").to_pylist()
            keys += cells
            docs += batch.column("docs").to_pylist()
            groups += batch.column("groups").to_pylist()
            sizes = [len(cell) // 8 for cell in cells]
            chunk.append(np.repeat(batch.column("of").to_numpy(), sizes))
        if not keys:
            return
        key, chunk = np.frombuffer(b"".join(keys), np.uint64), np.concatenate(chunk)
        doc, group = (np.frombuffer(b"".join(x), np.int64) for x in (docs, groups))
        order, begin, at, other = _heads(key, doc, group, turn)
        several = np.zeros(len(order), bool)
        several[at[other]] = True
        asked = np.flatnonzero(several[at])
        first = at[asked]
        to = chunk[order[asked]]
        # A chunk may have sent two entries of a key.
        once = np.unique(np.column_stack([to, first]), axis=0)
        to, head = once[:, 0], order[once[:, 1]]
        columns = {"keys": key[head], "docs": doc[head], "groups": group[head]}
        for out in _packed("chunk", to, columns, 0).to_batches():
            yield out

    def compare(table: pa.Table, replies: pa.Table) -> pa.Table:
        keys, docs, groups, _ = entries(table)
        key = np.frombuffer(b"".join(replies.column("keys").to_pylist()), np.uint64)
        doc = np.frombuffer(b"".join(replies.column("docs").to_pylist()), np.int64)
        group = np.frombuffer(b"".join(replies.column("groups").to_pylist()), np.int64)
        if not len(key):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        order = np.argsort(key)
        at = order[np.minimum(np.searchsorted(key[order], keys), len(key) - 1)]
        hit = np.flatnonzero(key[at] == keys)
        a, b = doc[at[hit]], docs[hit]
        differ = group[at[hit]] != groups[hit]
        alone = np.setdiff1d(b, b[differ])
        pairs = np.unique(np.column_stack([a[differ], b[differ]]), axis=0)
        pairs = np.concatenate([pairs, np.column_stack([alone, alone])])
        return pa.table({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})

    asked = dealt.groupBy("chunk").applyInArrow(
        ask, "part long, of long, keys binary, docs binary, groups binary"
    )
    asked = asked.repartitionById(partitions, F.col("part").cast("int"))
    answers = asked.mapInArrow(
        answer, "chunk long, of long, keys binary, docs binary, groups binary"
    )
    return (
        dealt.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(compare, "a long, b long")
    )


def close_pairs(
    sets: DataFrame,
    documents: DataFrame,
    similar: int = SIMILAR,
    spent: list[Staged] | None = None,
) -> DataFrame:
    """Pairs ``a < b`` of ``sets`` (``doc_id``, ``component``) whose component differs: all
    that can be similar, and some that are not.

    Shingles are ordered by rarity. Two similar sets share a shingle in the part of each
    that lies before its last ``similar`` hundredths, and from the first one they share both
    must go on for long enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column(2))
            for begin, end in blocks(texts):
                hashes, first = shingle_sets(texts[begin:end], WORDS)
                counts = np.diff(first)
                own = {
                    name: np.repeat(batch.column(i).to_numpy()[begin:end], counts)
                    for i, name in enumerate(("doc", "component"))
                }
                sizes = np.repeat(counts, counts).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {**own, "n": sizes, "shingle": hashes.view(np.int64)}
                )

    spent = [] if spent is None else spent
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    rows = sets.join(texts, F.col("doc_id") == F.col("id")).select("doc_id", "component", "text")
    shingles = rows.dropDuplicates().mapInArrow(
        run, "doc long, component long, n long, shingle long"
    )
    shingles = _spent(shingles, "shingles", spent)
    counted = shingles.groupBy("shingle", "component").agg(F.count("*").alias("many"))
    known = counted.groupBy("shingle").agg(
        F.sum("many").alias("all"),
        F.count("*").alias("components"),
        # Of two components one at least is another than the one with the most documents.
        F.max_by("component", F.struct("many", "component")).alias("most"),
    )
    place = F.row_number().over(Window.partitionBy("doc").orderBy("all", "shingle"))
    ranked = shingles.join(known, "shingle").withColumn("place", place.cast("long"))
    early = ranked.where(
        (F.col("components") > 1) & (100 * (F.col("n") - F.col("place") + 1) >= similar * F.col("n"))
    )
    early = early.select("doc", "component", "n", "shingle", "place", "most")
    early = _spent(early, "early", spent)
    x, y = early.where("component <> most").alias("x"), early.alias("y")
    rest = F.least(F.expr("x.n - x.place"), F.expr("y.n - y.place")) + 1
    long_enough = (100 + similar) * rest >= similar * F.expr("x.n + y.n")
    return (
        x.join(y, F.expr("x.shingle = y.shingle AND x.component <> y.component") & long_enough)
        .select(F.expr("least(x.doc, y.doc) AS a"), F.expr("greatest(x.doc, y.doc) AS b"))
        .distinct()
    )


def confirm(pairs: DataFrame, documents: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _bytes(batch.column(2)), _bytes(batch.column(3))
            good = np.zeros(len(left), bool)
            # Pairs in blocks, the two texts of a pair side by side.
            both = [text for pair in zip(left, right, strict=True) for text in pair]
            sizes = [a + b for a, b in zip(left, right, strict=True)]
            for begin, end in blocks(sizes):
                hashes, first = shingle_sets(both[2 * begin : 2 * end], WORDS)
                counts = np.diff(first)
                pair = np.repeat(np.arange(2 * (end - begin)) // 2, counts)
                order = np.lexsort((hashes, pair))
                h, p = hashes[order], pair[order]
                same = (h[1:] == h[:-1]) & (p[1:] == p[:-1])
                shared = np.bincount(p[1:][same], minlength=end - begin)
                union = counts[::2] + counts[1::2] - shared
                good[begin:end] = (100 * shared >= similar * union) & (union > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))],
                names=["a", "b"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    # The member is fetched first; the often repeated first of a bucket comes last.
    rows = pairs.join(texts, pairs.b == texts.id).select("a", "b", F.col("text").alias("text_b"))
    rows = rows.join(texts, rows.a == texts.id).select("a", "b", "text", "text_b")
    return rows.mapInArrow(run, "a long, b long")


def _spent(df: DataFrame, label: str, spent: list[Staged]) -> DataFrame:
    """The rows of a staged table that is to be discarded in the end."""
    spent.append(stage(df, label))
    return spent[-1].rows


def _joined(
    pairs: DataFrame, documents: DataFrame, parts: DataFrame, spent: list[Staged]
) -> tuple[DataFrame, int]:
    """``parts`` (``doc_id``, ``component``) with the similar pairs joined, and how many
    components that took away."""
    of = parts.select(F.col("doc_id").alias("of"), "component").distinct()
    links = confirm(pairs, documents).join(of, F.col("a") == F.col("of"))
    links = links.select(F.col("component").alias("a"), "b")
    links = links.join(of, F.col("b") == F.col("of")).select("a", F.col("component").alias("b"))
    over = components(links.distinct())
    named = parts.join(over.rows, F.col("component") == F.col("node"), "left").select(
        "doc_id", F.coalesce("label", "component").alias("component")
    )
    named = _spent(named, "parts", spent)
    gone = over.rows.where("node <> label").count()
    over.discard()
    return named, gone


def cluster(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest ``doc_id`` reachable over links)
    and ``kept`` (true for that document)."""
    signed = stage(signatures(documents), "signatures").rows
    known = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    sets = ["n_shingles", "digest1", "digest2"]
    spent: list[Staged] = []
    classes = _spent(known.groupBy(*sets).agg(F.min("doc_id").alias("first_id")), "classes", spent)
    firsts = known.join(classes, [*sets]).where("doc_id = first_id").select("doc_id", "bands")
    sets_of = _spent(firsts, "sets", spent)
    parts = _spent(sets_of.select("doc_id", F.col("doc_id").alias("component")), "parts", spent)
    active, turn, few = sets_of.join(parts, "doc_id"), 0, False
    while not few:
        met = _spent(meetings(active, turn), "pairs", spent)
        pairs = met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        parts, joined = _joined(pairs.distinct(), documents, parts, spent)
        mine = met.select(F.col("b").alias("doc_id")).distinct()
        active = _spent(sets_of.join(mine, "doc_id").join(parts, "doc_id"), "active", spent)
        turn += 1
        few = turn > 1 and FEW * joined <= active.count()
    # What is left: documents in buckets that hold several components.
    rest = close_pairs(active.drop("bands"), documents, SIMILAR, spent)
    parts, _ = _joined(rest, documents, parts, spent)
    # Rows that repeat a document are one here.
    labels = parts.groupBy(F.col("doc_id").alias("of")).agg(F.min("component").alias("component_id"))
    labelled = classes.join(labels, F.col("first_id") == F.col("of")).select(*sets, "component_id")
    labelled = stage(labelled, "classes").rows
    for done in spent:
        done.discard()
    mine = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = signed.select("doc_id", *sets).join(labelled, [*sets], "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(mine, "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
