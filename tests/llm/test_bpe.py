import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from strata.llm import bpe
from strata.llm.queries import BPE_FILE


@pytest.fixture(scope="module")
def reference():
    with open(BPE_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(BPE_FILE, "rb") as f:
        return bpe.Codec(bpe.load_ranks(f.read()), public_tokenizers.PATTERN)


def texts():
    rng = random.Random(0)
    out = ["", " ", "a", "it's  we'll\n\n x", "<|endoftext|>", "\x00\x1c\x1d\x85 　 x", "😀 日本語 नमस्ते é",
           "word " * 1000, "aaaaaaaaaaaaaaaaaaaa", "ther there others" * 50]
    out += ["".join(rng.choices("abtheino r \n'é9!", k=rng.randint(1, 300))) for _ in range(200)]
    out += ["".join(rng.choices(a, k=30_000)) for a in ("ab", "thaneriosdl", "a")]
    return out


def test_equals_the_library(codec, reference):
    for t in texts():
        ids = codec.encode(t)
        assert ids == reference.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_every_character(codec, reference):
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for at in range(0, len(every), 20_000):
        part = every[at:at + 20_000]
        assert codec.encode(part) == reference.encode_ordinary(part)


def test_smaller_rank_after_a_merge():
    """A merge may bring up a pair of smaller rank; it goes before what the bucket still holds."""
    ranks = {bytes([c]): c for c in range(97, 105)} | {b"bc": 300, b"abc": 10, b"abcb": 400, b"cbc": 200}
    own = bpe.Codec(ranks, r"\S+")
    want = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for _ in range(500):
        t = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        assert own.encode(t) == want.encode_ordinary(t), t


def test_slices_and_cache_bounds(monkeypatch, reference):
    monkeypatch.setattr(bpe, "SLICE", 7)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 4)
    with open(BPE_FILE, "rb") as f:
        own = bpe.Codec(bpe.load_ranks(f.read()), public_tokenizers.PATTERN)
    for t in texts()[:60]:
        assert own.encode(t) == reference.encode_ordinary(t)


def test_new_pieces_share_queues_in_small_groups(monkeypatch, reference):
    with open(BPE_FILE, "rb") as f:
        own = bpe.Codec(bpe.load_ranks(f.read()), public_tokenizers.PATTERN)
    sizes, merge = [], own.merge
    monkeypatch.setattr(own, "merge", lambda pieces: sizes.append(len(pieces)) or merge(pieces))
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("thaneriosdlé", k=rng.randint(5, 15))) for _ in range(3_000))
    assert own.encode(text) == reference.encode_ordinary(text)
    assert sum(sizes) > 2_000 and max(sizes) <= 500


def test_pieces_of_no_bytes_and_one_byte(codec):
    assert codec.merge([b"", b"t", b"", b"the", b"the", b""]) == [(), (codec.ranks[b"t"],), (),
                                                                  *[(codec.ranks[b"the"],)] * 2, ()]
    assert codec.merge([]) == [] and codec.merge([b""]) == [()]


def test_round_trip_and_columns(spark, reference):
    rows = [(1, "hello there", "x"), (1, "hello there", "x"), (None, "é", None), (3, None, "y"), (4, "", "z"),
            (5, "long " * 5000, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string")
    got = sorted((tuple(r) for r in bpe.round_trip(docs, BPE_FILE, public_tokenizers.PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    kept = bpe.round_trip(docs, BPE_FILE, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert all(list(r.token_ids) == reference.encode_ordinary(t or "") for r, (_, t, _) in zip(kept, rows))
    both = bpe.decode(bpe.encode(docs, BPE_FILE, public_tokenizers.PATTERN), BPE_FILE).collect()
    assert all(bytes(r.decoded) == (t or "").encode() for r, (_, t, _) in zip(both, rows))
    assert bpe.round_trip(docs.limit(0), BPE_FILE, public_tokenizers.PATTERN).count() == 0
