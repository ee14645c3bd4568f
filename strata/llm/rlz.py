"""Substring dedup by relative Lempel-Ziv parsing.

A text is factored greedily against reference blocks made of texts with
smaller ids: a factor is the longest run of words found there, and the parse
goes on behind it. Factors of ``length`` words or more are duplicate spans;
where two factors meet, the windows that reach over the boundary are looked up
themselves. A block holds all segments that share an anchor (see ``dealt``),
so each segment is parsed against every block that can hold its words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, remove
from strata.llm.dealt import Kind, Unit, covered, merge

LENGTH = 13
GRAM = 5
NEVER = np.iinfo(np.int64).max  # stands for a null id: larger than any


class Words:
    def __init__(self, data: bytes):
        self.words = data.split()  # on bytes: the six ASCII white-space characters

    def __len__(self) -> int:
        return len(self.words)

    def values(self) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, self.words)), ">u8").astype(np.uint64)

    def cut(self, a: int, b: int) -> bytes:
        return b" ".join(self.words[a:b])


class Block:
    """Reference segments in the order of their ids, with an index of their windows."""

    def __init__(self, length: int):
        self.length, self.segments, self.index = length, [], {}

    def parse(self, words: list[bytes], least: int) -> np.ndarray:
        """Which windows of a segment start in a reference with an id below ``least``."""
        n = len(words) - self.length + 1
        out = np.zeros(n, bool)
        at = 0
        while at < n:
            hit = self.index.get(tuple(words[at:at + self.length]))
            if hit is None or hit[0] >= least:
                at += 1  # a literal word
                continue
            own, source = at + self.length, self.segments[hit[1]]
            other = hit[2] + self.length
            while own < len(words) and other < len(source) and words[own] == source[other]:
                own, other = own + 1, other + 1
            # a factor words[at:own]; the next window is the first that reaches over its end
            out[at:own - self.length + 1] = True
            at = own - self.length + 1
        return out

    def add(self, words: list[bytes], least: int) -> None:
        for p in range(len(words) - self.length + 1):
            self.index.setdefault(tuple(words[p:p + self.length]), (least, len(self.segments), p))
        self.segments.append(words)


def resolve(hashes: np.ndarray, weights: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """Kind.resolve: ``weights`` are the least ids; a window counts if an id below its segment's holds it."""
    least: dict[bytes, int] = {}
    group: dict[int, list[bytes]] = {}
    for h, w, t in zip(hashes.tolist(), weights.tolist(), texts):
        if t not in least:
            group.setdefault(h, []).append(t)
            least[t] = w
        else:
            least[t] = min(least[t], w)
    flags: dict[bytes, np.ndarray] = {}
    for members in group.values():
        if len(members) > 1:
            block = Block(length)
            for t in sorted(members, key=lambda t: (least[t], t)):
                words = t.split(b" ")
                flags[t] = block.parse(words, least[t])
                block.add(words, least[t])
    out = []
    for w, t in zip(weights.tolist(), texts):
        if w > least[t]:  # the whole segment stands in a text with a smaller id
            out.append(np.ones(t.count(b" ") + 2 - length, bool))
        else:
            out.append(flags[t] if t in flags else np.zeros(t.count(b" ") + 2 - length, bool))
    return out


def repeated_words(docs: DataFrame, length: int = LENGTH, gram: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, spans array<struct<start, end>> (words), and with
    ``keep_text`` kept string (the words that stay, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none. A word goes if a
    window of ``length`` words that covers it also starts in a text with a
    smaller id; windows are judged on the input. A null id is larger than any
    other; equal ids (and null ids among each other) remove nothing from one
    another. An empty table gives no rows. ``docs`` must yield the same rows
    when it is read again; ids are integers.
    """
    gram = gram or min(GRAM, max(1, length // 2))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NEVER))).alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    kind = Kind(length, gram, Words, resolve, True)

    def finish(unit: Unit, runs: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(5)]
        for doc, own in zip(unit.docs, runs):
            spans, at, kept = merge(own, length), 0, []
            for a, z in spans:
                kept += doc.words[at:a]
                at = z
            kept += doc.words[at:]
            line = b" ".join(kept)
            values = (len(doc), len(doc) - len(kept), hashlib.sha256(line).hexdigest(),
                      [{"start": a, "end": z} for a, z in spans], line.decode("utf-8") if keep_text else None)
            for c, v in zip(columns, values):
                c.append(v)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.string(), span, pa.string()]
        names = ["id", "n_words", "n_removed", "kept_sha256", "spans", "kept"]
        ids = [None if i == NEVER else i for i in unit.ids]
        arrays = [pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))]
        return pa.RecordBatch.from_arrays(arrays[:6 if keep_text else 5], names[:6 if keep_text else 5])

    out, folder = covered(rows, kind, finish, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
                          "spans array<struct<start:bigint,end:bigint>>" + ", kept string" * keep_text)
    out = cut(out)
    remove(docs.sparkSession, folder)
    return out.withColumnRenamed("id", id_col)
