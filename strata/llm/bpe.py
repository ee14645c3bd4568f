"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte positions. Every adjacent pair that the
vocabulary can merge waits in the bucket of its merge rank; a bitmap with one
bit per rank, summarised 64:1 level by level, finds the smallest non-empty
rank by three find-first-set steps. Entries whose pair has changed since they
were queued are stale and skipped. No step rescans the pre-token, so a
pre-token of a million letters costs about as much per byte as a short one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_ENTRIES = 700_000   # distinct pre-tokens whose ids one Python worker keeps
CACHE_CHARS = 48          # longer pre-tokens are encoded each time
SLICE = 200_000           # pre-tokens handled at a time
TOGETHER = 500            # pre-tokens that share a queue: its lists stay in the processor's cache
ROWS = 1_000              # documents handled at a time


def load_ranks(data: bytes) -> dict[bytes, int]:
    """The rank file's content: one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Codec:
    """Encodes and decodes with one rank file; remembers the ids of pre-tokens it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.digits = [str(i) for i in range(size)]
        # the queue: a bit per rank, a bit per word of those, a bit per word of these
        self.low, self.mid, self.top = [0] * ((size >> 6) + 1), [0] * ((size >> 12) + 1), 0
        self.buckets: dict[int, list[int]] = {}
        self.two = np.array([ranks.get(bytes((i >> 8, i & 255)), -1) for i in range(1 << 16)])
        self.known: dict[str, tuple[int, ...]] = {}  # tuples: the collector need not walk them

    def push(self, rank: int, pos: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(pos)
        else:
            self.open(rank, [pos])

    def open(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        w = rank >> 6
        if not self.low[w]:
            v = w >> 6
            if not self.mid[v]:
                self.top |= 1 << v
            self.mid[v] |= 1 << (w & 63)
        self.low[w] |= 1 << (rank & 63)

    def pop(self) -> tuple[int, list[int]]:
        """The least rank, by find-first-set at each level, and its positions from left to right."""
        x = self.top
        v = (x & -x).bit_length() - 1
        x = self.mid[v]
        w = v << 6 | (x & -x).bit_length() - 1
        x = self.low[w]
        bit = x & -x
        rank = w << 6 | bit.bit_length() - 1
        self.low[w] = x = x ^ bit
        if not x:
            self.mid[v] = x = self.mid[v] ^ 1 << (w & 63)
            if not x:
                self.top ^= 1 << v
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each pre-token.

        All of them share one list and one queue, so a bucket is found once for
        its positions in many pre-tokens. No pair crosses a pre-token's end.
        Within a pre-token the least rank merges first, the leftmost of equals:
        when a merge brings up a smaller rank, what the bucket still holds of
        that pre-token is queued again.
        """
        data = b"".join(pieces)
        n = len(data)
        if not n:
            return [()] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        raw = np.frombuffer(data, np.uint8).astype(np.int64)
        first = np.full(n, -1)
        first[:-1] = self.two[raw[:-1] << 8 | raw[1:]]
        first[ends[lengths > 0] - 1] = -1
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        edges = np.flatnonzero(np.diff(first[order], prepend=-1))
        for group in np.split(order, edges[1:]) if len(order) else []:
            self.open(int(first[group[0]]), group.tolist())
        pair = first.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        head = bytearray(n + 1)  # 1 where a pre-token begins, and at the end
        for at in (*starts.tolist(), n):
            head[at] = 1
        rank_of, bucket_of = self.ranks.get, self.buckets.get
        while self.top:
            rank, positions = self.pop()
            held = 0  # positions before this one wait
            for i in positions:
                if pair[i] != rank:
                    continue  # stale
                if i < held:
                    self.push(rank, i)
                    continue
                j = after[i]
                after[i] = k = after[j]
                pair[j] = -1
                if head[k]:
                    pair[i] = -1
                else:
                    before[k] = i
                    pair[i] = r = rank_of(data[i:after[k]], -1)
                    if r >= 0:
                        bucket = bucket_of(r)
                        if bucket is None:
                            self.open(r, [i])
                        else:
                            bucket.append(i)
                        if r < rank:
                            held = head.index(1, k)
                if not head[i]:
                    p = before[i]
                    pair[p] = r = rank_of(data[p:k], -1)
                    if r >= 0:
                        bucket = bucket_of(r)
                        if bucket is None:
                            self.open(r, [p])
                        else:
                            bucket.append(p)
                        if r < rank:
                            held = head.index(1, k)
        out = []
        for i, end in zip(starts.tolist(), ends.tolist()):
            ids = []
            while i < end:
                k = after[i]
                ids.append(rank_of(data[i:k]))
                i = k
            out.append(tuple(ids))
        return out

    def learn(self, pieces: Iterable[str]) -> list[str]:
        """Make the ids of all ``pieces`` known; returns those too long to keep."""
        distinct = set(pieces)
        new = [p for p in distinct if p not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known.clear()
            new = list(distinct)
        rest, rest_bytes = [], []
        for p in new:
            data = p.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[p] = (rank,)
            else:
                rest.append(p)
                rest_bytes.append(data)
        for at in range(0, len(rest), TOGETHER):
            self.known.update(zip(rest[at:at + TOGETHER], self.merge(rest_bytes[at:at + TOGETHER])))
        return [p for p in rest if len(p) > CACHE_CHARS]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens, in lists of bounded length."""
        if len(text) <= SLICE:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, SLICE)):
            yield part

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[int, list[int]]]:
        """(number of the text, ids) for each part of each text, in order; empty texts have no part."""
        held, size = [], 0
        for at, text in enumerate(texts):
            for part in self.pieces(text):
                held.append((at, part))
                size += len(part)
                if size >= SLICE:
                    yield from self._flush(held)
                    held, size = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[int]]]:
        long = self.learn(chain.from_iterable(part for _, part in held))
        for at, part in held:
            if part:
                yield at, list(chain.from_iterable(map(self.known.__getitem__, part)))
        for p in long:
            del self.known[p]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(ids for _, ids in self.encode_all([text])))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(load_ranks(data), pattern)
    return _codecs[key]


def _vocabulary(spark: SparkSession, path: str):
    """The rank file, read once by the driver (a fixed file of about 1 MB) and sent to the workers."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
           out_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``out_col`` array<int>: the ids of the whole text.

    Each match of ``pattern`` is encoded by itself with the ranks of the file
    at ``path``; special tokens are ordinary text. A null text counts as empty
    (no ids). Rows are independent: repeated rows repeat, an empty table stays
    empty. ``out_col`` replaces a column of that name.
    """
    data = _vocabulary(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def ids(texts):
        import pandas as pd
        c = codec(data.value, pattern)
        return pd.Series([c.encode(t or "") for t in texts])

    return docs.withColumn(out_col, ids(F.col(text_col)))


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col`` binary: the bytes of the ids (null ids: empty bytes)."""
    data = _vocabulary(docs.sparkSession, path)

    @F.pandas_udf("binary")
    def text(ids):
        import pandas as pd
        c = codec(data.value, r"\S+|\s+")
        return pd.Series([c.decode([] if i is None else list(i)) for i in ids])

    return docs.withColumn(out_col, text(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``id_col``, n_tokens long, ids_sha256, decoded_sha256.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the
    bytes that the ids give back; ``keep_ids`` adds token_ids array<int>. Rows
    are independent; null text counts as empty; a null id is kept. Texts of
    any length are taken in slices of pre-tokens, so without ``keep_ids``
    memory follows the slice.
    """
    data = _vocabulary(docs.sparkSession, path)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * keep_ids]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(data.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                counts = [0] * batch.num_rows
                id_hash = [hashlib.sha256() for _ in counts]
                text_hash = [hashlib.sha256() for _ in counts]
                kept: list[list[np.ndarray]] = [[] for _ in counts]
                for i, ids in c.encode_all(t.as_py() for t in batch.column(1)):
                    if counts[i]:
                        id_hash[i].update(b" ")
                    counts[i] += len(ids)
                    id_hash[i].update(" ".join(map(c.digits.__getitem__, ids)).encode())
                    text_hash[i].update(c.decode(ids))
                    if keep_ids:
                        kept[i].append(np.array(ids, np.int32))
                columns = [batch.column(0), pa.array(counts, pa.int64()),
                           pa.array([h.hexdigest() for h in id_hash]), pa.array([h.hexdigest() for h in text_hash])]
                if keep_ids:
                    columns.append(pa.array([np.concatenate(k) if k else [] for k in kept], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(digests, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                           + ", token_ids array<int>" * keep_ids)
