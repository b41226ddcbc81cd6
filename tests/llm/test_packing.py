import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from retail_lake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def pack(documents):
    return packing.pack_documents(documents, PATH, public_tokenizers.PATTERN)


def test_ids_equal_the_files_own_library(corpus):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    ours = packing.Tokenizer(PATH, public_tokenizers.PATTERN)
    for text in [*corpus.values(), "<|endoftext|> x", " " * 60_000 + "x"]:
        want = library.encode(text, add_special_tokens=False).ids
        assert ours.ids(text).tolist() == [*want, 0]


def test_each_id_lies_in_one_piece_and_windows_are_full(odd):
    rows = packing.digests(pack(odd)).collect()
    ours = packing.Tokenizer(PATH, public_tokenizers.PATTERN)
    ids = {r.doc_id: ours.ids(r.text or "") for r in odd.collect() if r.doc_id is not None}
    seen, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            assert r.doc_tokens == len(ids[r.doc_id])
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(part.astype("<u4").tobytes())
            seen[r.doc_id].append((r.start, r.length))
    for doc_id, pieces in seen.items():
        copies = 2 if doc_id == 3 else 1  # the row that repeats
        assert sum(n for _, n in pieces) == copies * len(ids[doc_id])
    assert set(seen) == set(ids)
    for pieces in windows.values():
        total = 0
        for offset, length in sorted(pieces):
            assert offset == total
            total += length
        assert total <= 1024 and total & (total - 1) == 0


def test_equal_remainders_leave_no_padding():
    stock = packing.Stock()
    for i in range(100):
        stock.add(i, 0, 600)
    windows = [*packing.pack(stock, packing.TIERS), *packing.pack_rest(stock)]
    assert sum(sum(p[2] for p in pieces) for _, pieces in windows) == 60_000
    assert all(sum(p[2] for p in pieces) == tier for tier, pieces in windows)
    assert sum(tier == 1024 for tier, _ in windows) == 60_000 // 1024


def test_step_groups_are_even():
    windows = [(1024, [(0, 0, n)]) for n in range(1, 65)]
    groups = packing.step_groups(windows, 8)
    cost = np.bincount(groups, weights=[w[1][0][2] ** 2 for w in windows])
    assert np.bincount(groups).tolist() == [8] * 8
    assert cost.max() < 1.1 * cost.min()


def test_empty_table(empty):
    assert pack(empty).count() == 0


def test_added_tokens_have_their_ids_as_by_the_librarys_defaults(spark):
    library = Tokenizer.from_file(PATH)
    name = "<|endoftext|>"
    texts = [f"a{name} x", name, name * 2, f" {name}\n\n{name} b", f"a{name[:-1]} b", f"{' ' * 20_001}{name}"]
    want = [[*library.encode(text, add_special_tokens=False).ids, 0] for text in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = defaultdict(list)
    for r in pack(frame).collect():
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, ids in enumerate(want):
        assert [x for _, part in sorted(pieces[i]) for x in part] == ids
    assert 50256 in want[0]
