"""Suffix-array dedup: bytes covered by a long string that starts anywhere else are removed.

The suffix array is made in two stages: suffixes smaller than their successor
are sorted directly, all others are induced by scanning the buckets of first
bytes from the least on. Adjacent suffixes are then compared for a common
prefix of the required length. Arrays are made over segments of the corpus that
may repeat (see ``dealt``); all equal strings meet in one of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, remove
from strata.llm.dealt import Kind, Unit, covered, merge

LENGTH = 400
GRAM = 64
SHARD = 256 << 10        # bytes of whole groups that share a suffix array
GAP = b"\xff"            # never part of UTF-8

_SYMBOLS = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Text:
    def __init__(self, data: bytes):
        self.data = data

    def __len__(self) -> int:
        return len(self.data)

    def values(self) -> np.ndarray:
        return _SYMBOLS[np.frombuffer(self.data, np.uint8)]

    def cut(self, a: int, b: int) -> bytes:
        return self.data[a:b]


def two_stage(data: bytes, depth: int) -> np.ndarray:
    """The suffix array of ``data``; suffixes that agree in ``depth`` bytes may stand in any order."""
    b = np.frombuffer(data, np.uint8)
    n = len(b)
    if not n:
        return np.array([], np.int64)
    # smaller[i]: suffix i < suffix i + 1 (the empty suffix is the least)
    step = np.zeros(n, np.int16)
    step[:-1] = np.diff(b.astype(np.int16))
    step[-1] = -1
    after = np.where(step != 0, np.arange(n), n)
    after = np.minimum.accumulate(after[::-1])[::-1]
    smaller = step[after] > 0

    # stage 1: sort these directly, by eight bytes first and then by what is tied
    own = np.flatnonzero(smaller)
    words = np.ndarray((n,), ">u8", data + bytes(8), strides=(1,))[own].astype(np.uint64)
    order = np.argsort(words, kind="stable")
    own, words = own[order], words[order]
    edge = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1], [True]])) if len(own) else np.array([0])
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if z - a > 1:
            own[a:z] = sorted(own[a:z].tolist(), key=lambda i: data[i + 8:i + depth])

    # stage 2: scan the buckets; whoever precedes a scanned suffix and is larger goes to the front of its bucket
    small = np.searchsorted(b[own], np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    front[data[-1]].append(np.array([n - 1]))  # induced by the empty suffix
    out = []
    for c in range(256):
        larger, wait = [], front[c]
        while wait:
            part = wait[0] if len(wait) == 1 else np.concatenate(wait)
            larger.append(part)
            before = part[part > 0] - 1
            before = before[~smaller[before] & (b[before] == c)]  # a run of one byte fills its own bucket
            wait = [before] if len(before) else []
        scan = np.concatenate([*larger, own[small[c]:small[c + 1]]])
        out.append(scan)
        before = scan[scan > 0] - 1
        before = before[~smaller[before] & (b[before] > c)]
        if len(before):
            first = b[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            for part in np.split(before, np.flatnonzero(np.diff(first)) + 1):
                front[b[part[0]]].append(part)
    return np.concatenate(out)


def repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which starts (of those with ``length`` bytes left) hold a string that starts at another place."""
    data = GAP.join(texts) + GAP
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    valid = np.zeros(len(data), bool)
    for a, t in zip(starts.tolist(), texts):
        valid[a:a + max(0, len(t) - length + 1)] = True
    order = two_stage(data, length)
    order = order[valid[order]]  # those that matter, in order: equal strings stay neighbours
    found = np.zeros(len(data), bool)
    if len(order) > 1:
        rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), length)
        # adjacent common prefixes: unequal ends decide most pairs, the rest is compared in full
        a, z = order[:-1], order[1:]
        b = np.frombuffer(data, np.uint8)
        may = np.flatnonzero((b[a] == b[z]) & (b[a + length - 1] == b[z + length - 1]) & (b[a + length // 2] == b[z + length // 2]))
        for at in range(0, len(may), 4096):
            m = may[at:at + 4096]
            same = (rows[a[m]] == rows[z[m]]).all(axis=1)
            found[a[m[same]]] = found[z[m[same]]] = True
    return [found[s:s + max(0, len(t) - length + 1)] for s, t in zip(starts.tolist(), texts)]


def resolve(hashes: np.ndarray, weights: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """Kind.resolve: groups with one content need no sorting, the others share arrays of about SHARD bytes."""
    times: dict[bytes, int] = {}
    group: dict[int, list[bytes]] = {}
    for h, w, t in zip(hashes.tolist(), weights.tolist(), texts):
        if t not in times:
            group.setdefault(h, []).append(t)
        times[t] = times.get(t, 0) + w
    flags: dict[bytes, np.ndarray] = {}
    held: list[bytes] = []

    def flush() -> None:
        if held:
            flags.update(zip(held, repeated(held, length)))
            held.clear()

    size = 0
    for members in group.values():
        if len(members) > 1 and any(times[t] == 1 for t in members):
            held += members
            size += sum(map(len, members))
            if size >= SHARD:
                flush()
                size = 0
    flush()
    return [np.ones(len(t) - length + 1, bool) if times[t] > 1 else
            flags[t] if t in flags else np.zeros(len(t) - length + 1, bool) for t in texts]


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, spans array<struct<start, end>> (bytes), and with
    ``keep_text`` kept binary.

    Texts are UTF-8 bytes, null is empty. A byte goes if a ``length``-byte
    string that covers it also starts anywhere else, in this text or another;
    matches don't cross texts, and are judged on the input, so every copy goes
    (removing all but one is ``rlz``'s rule). Rows that repeat an id are texts
    of their own; a text shorter than ``length`` keeps all; an empty table
    gives no rows. ``docs`` must yield the same rows when it is read again.
    """
    gram = gram or min(GRAM, max(1, length // 4))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = Kind(length, gram, Text, resolve, False)

    def finish(unit: Unit, runs: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(6)]
        for doc, own in zip(unit.docs, runs):
            spans, at, kept = merge(own, length), 0, []
            for a, z in spans:
                kept.append(doc.data[at:a])
                at = z
            kept = b"".join([*kept, doc.data[at:]])
            values = (len(doc), len(doc) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                      [{"start": a, "end": z} for a, z in spans], kept)
            for c, v in zip(columns, values):
                c.append(v)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        arrays = [pa.array(unit.ids), *(pa.array(c, t) for c, t in zip(columns, types))]
        return pa.RecordBatch.from_arrays(arrays[:7 if keep_text else 6], names[:7 if keep_text else 6])

    out, folder = covered(rows, kind, finish, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, "
                          "n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
                          + ", kept binary" * keep_text)
    out = cut(out)
    remove(docs.sparkSession, folder)
    return out.withColumnRenamed("id", id_col)
