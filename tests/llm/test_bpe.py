import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from retail_lake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "test", pat_str=PATTERN, mergeable_ranks=bpe.load(PATH).ranks, special_tokens={}
    )


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], np.uint32).tolist()


def test_random_and_long_pieces_equal_the_library(reference):
    rng = random.Random(1)
    encoder = bpe.Encoder(bpe.load(PATH), PATTERN)
    texts = ["", "a" * 3000, "ab" * 900 + "é" * 400, "\n" * 50 + "x", "\0\x01😀😀", "the The the"]
    alphabet = "aeothns éß漢字12  \n.,!'sd"
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(300))) for _ in range(200)]
    for text in texts:
        assert ids_of(encoder, text) == reference.encode_ordinary(text)


def test_merges_that_bring_a_lower_rank_back():
    """``bc`` (30) makes ``abc`` (5) possible, which goes before another ``bc``."""
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"bc": 30, b"abc": 5, b"bcbc": 4}
    vocabulary = bpe.Vocabulary(ranks)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            if not found or min(found)[0] == 10**9:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    pieces = ["".join(rng.choices("abc", k=rng.randrange(1, 30))).encode() for _ in range(300)]
    pieces += [b"abc" * 60, b"bc" * 70, b"abcbc" * 40, b"aabbc" * 30]
    ids, counts = bpe.merge_block(vocabulary, pieces)
    ends = np.cumsum(counts)
    for piece, end, count in zip(pieces, ends, counts, strict=True):
        assert ids[end - count : end].tolist() == plain(piece)


def test_small_windows_give_the_same_merges(monkeypatch, reference):
    monkeypatch.setattr(bpe, "WIDEST", 2)
    monkeypatch.setattr(bpe, "LEAST_WINDOW", 1)
    rng = random.Random(6)
    encoder = bpe.Encoder(bpe.load(PATH), PATTERN)
    texts = ["".join(rng.choices(["st", "in", "er", "a", "e", "on", "t"], k=rng.randrange(200))) for _ in range(80)]
    for text in [*texts, "st" * 500, "erst" * 300]:
        assert ids_of(encoder, text) == reference.encode_ordinary(text)


def test_a_long_pre_token_is_read_in_time_near_linear_in_its_length(reference):
    """All its pairs can bring a lower rank back. Before, 16 KB took 9 s."""
    vocabulary = bpe.load(PATH)
    for unit in (b"st", b"abcd", b"tion"):
        begun = time.monotonic()
        ids, _ = bpe.merge_block(vocabulary, [unit * 100_000])
        assert time.monotonic() - begun < 30
        assert vocabulary.decode(ids) == unit * 100_000
    text = "st" * 8_000
    assert ids_of(bpe.Encoder(vocabulary, PATTERN), text) == reference.encode_ordinary(text)


def test_queue_pops_the_lowest_rank_and_keeps_positions():
    queue = bpe.RankQueue(50_000)
    for rank, position in ((49_999, 1), (64, 2), (4096, 3), (64, 4), (0, 5)):
        queue.push(rank, position)
    assert [queue.pop() for _ in range(4)] == [(0, [5]), (64, [2, 4]), (4096, [3]), (49_999, [1])]
    assert queue.pop() is None


def test_every_row_comes_back(odd, empty, reference):
    rows = bpe.digests(bpe.encode(odd, PATH, PATTERN, back=True)).collect()
    texts = [r.text or "" for r in odd.select("text").collect()]
    assert len(rows) == len(texts)
    want = []
    for text in texts:
        ids = reference.encode_ordinary(text)
        joined = ",".join(map(str, ids)).encode()
        want.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(want) == sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert bpe.digests(bpe.encode(empty, PATH, PATTERN, back=True)).count() == 0


def test_decode_by_itself(odd):
    rows = bpe.decode(bpe.encode(odd, PATH, PATTERN), PATH).select("decoded").collect()
    texts = [(r.text or "").encode() for r in odd.select("text").collect()]
    assert sorted(bytes(r.decoded) for r in rows) == sorted(texts)
