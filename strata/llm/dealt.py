"""Finding equal windows of a corpus without moving its texts.

A window is a run of W symbols (bytes, words) of one text. Its anchor is the
leftmost of its k-symbol grams with the least hash, so equal windows have equal
anchors at the same place in them, wherever they stand. Neighbouring windows
mostly share an anchor; such a run and its symbols make a segment.

1. announce  each unit (some texts of one scan task) sends its distinct anchor
             hashes, packed, to the bucket of each hash;
   answer    the bucket returns two bits per hash: met elsewhere or not, and
             whether more than HOT segments share it;
2. present   the unit sends its distinct segments under hashes met elsewhere;
             of hot ones it sends a 128-bit digest of each window instead, to
             the bucket of the digest, so that the many segments at the edges
             of a passage that a third of all texts hold don't meet in one task;
   resolve   the bucket finds the equal windows and returns one bit for each;
3. apply     the unit turns the bits into covered symbols of each text.

Texts are read three times and never shuffled; what moves are eight bytes for
each distinct anchor of a unit, the segments that may repeat, and bits. What a
third of all texts share is one hash and few segments of each unit, whatever
the number of its copies. The bits lie in the shared folder, by scan task, and
a task that runs again reads them again. Tasks recognise their units by
checksums: a source that yields other rows on the next scan stops the job.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.warc import open_store
from strata.session import shared_dir

UNIT_BYTES = 8 << 20      # text of one unit (a longer text is a unit of its own)
BUCKET_BYTES = 16 << 20   # text for each bucket
BLOCK = 1 << 20           # symbols hashed at a time
HOT = 20_000              # segments under one anchor, equal ones of a unit counted once, that may meet in one task
PLACE = np.uint64(BLOCK - 1)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    steps = np.full(BLOCK + 1, base, np.uint64)
    back = np.full(BLOCK + 1, pow(base, -1, 1 << 64), np.uint64)
    steps[0] = back[0] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(back)


_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the values times powers, and a 64-bit hash of each run of k values."""
    if not _POWERS:
        _POWERS.extend(_powers())
    power, back = _POWERS
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=total[1:])
    return total, mix((total[k:] - total[:-k]) * back[:len(values) - k + 1])


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


@dataclass(frozen=True)
class Kind:
    """What a window is made of.

    ``prepare`` turns a text's bytes into an object whose ``values()`` are a
    uint64 per symbol and whose ``cut(a, b)`` are the bytes of symbols a..b;
    ``resolve`` takes a bucket's segments (hash, weight, windows, bytes) and
    returns a bool array per segment; ``weight`` is what a unit tells of a
    segment: how often it occurs, or the least id that holds it.
    """

    window: int
    gram: int
    prepare: Callable
    resolve: Callable
    least_id: bool


class Unit:
    """Some texts of one scan task, and their segments."""

    def __init__(self, number: int, kind: Kind, ids: list, texts: list):
        self.number, self.kind, self.ids = number, kind, ids
        self.docs = [kind.prepare((t or "").encode("utf-8")) for t in texts]
        self.doc, self.first, self.last, self.hash, self.content = self._segments()
        self.anchors, self.inverse = np.unique(self.hash, return_inverse=True)

    @cached_property
    def several(self) -> np.ndarray:
        """Whether the unit has more than one segment under each anchor."""
        return np.bincount(self.inverse, minlength=len(self.anchors)) > 1

    @cached_property
    def counts(self) -> np.ndarray:
        """How many different contents (by a hash) the unit would send under each anchor."""
        out = np.ones(len(self.anchors), np.int64)
        own = np.flatnonzero(self.several[self.inverse])  # elsewhere it is one
        anchor, content = self.inverse[own], self.content[own]
        order = np.lexsort((content, anchor))
        anchor, content = anchor[order], content[order]
        new = np.ones(len(own), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
        found = np.bincount(anchor[new], minlength=len(out))
        return np.where(found > 0, found, out)

    def _segments(self) -> tuple[np.ndarray, ...]:
        """Text number, first and last window start, anchor hash and content hash of each segment."""
        window, step = self.kind.window, BLOCK // 2
        pieces = [(d, at, min(step, len(doc) - window + 1 - at))
                  for d, doc in enumerate(self.docs) for at in range(0, len(doc) - window + 1, step)]
        found, held, size = [], [], 0
        for piece in pieces:
            need = piece[2] + window - 1
            if held and size + need > BLOCK:
                found.append(self._block(held))
                held, size = [], 0
            held.append(piece)
            size += need
        if held:
            found.append(self._block(held))
        if not found:
            return (*(np.array([], np.int64) for _ in range(3)), *(np.array([], np.uint64) for _ in range(2)))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _block(self, pieces: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
        window, gram = self.kind.window, self.kind.gram
        d, at, n = (np.array(c) for c in zip(*pieces))
        values = np.concatenate([self.docs[i].values()[a:a + m + window - 1] for i, a, m in pieces])
        starts = np.cumsum(n + window - 1) - (n + window - 1)
        total, hashes = gram_hashes(values, gram)
        place = np.arange(len(hashes), dtype=np.uint64)
        # the leftmost of equals: the place breaks ties
        owner = (window_min((hashes & ~PLACE) | place, window - gram + 1) & PLACE).astype(np.int64)
        own = np.concatenate([np.arange(s, s + m) for s, m in zip(starts.tolist(), n.tolist())])
        piece = np.repeat(np.arange(len(n)), n)
        anchor = owner[own]
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(piece) != 0)) + 1
        a, b = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(own)]]) - 1
        shift = (at - starts)[piece[a]]
        content = mix((total[own[b] + window] - total[own[a]]) * _POWERS[1][own[a]]) + (own[b] - own[a]).astype(np.uint64)
        return d[piece[a]], own[a] + shift, own[b] + shift, hashes[anchor[a]], content

    def _weigh(self, weights: list[int], e: int, d: int) -> None:
        """Note one more occurrence, in text ``d``, of the content numbered ``e``."""
        if e == len(weights):
            weights.append(self.ids[d] if self.kind.least_id else 1)
        elif self.kind.least_id:
            weights[e] = min(weights[e], self.ids[d])
        else:
            weights[e] += 1

    def covered_here(self, weight: int, d: int) -> bool:
        """Whether this unit alone covers what text ``d`` holds: an equal one under a smaller id, or a second one."""
        return self.ids[d] > weight if self.kind.least_id else weight > 1

    def windows(self, hot: np.ndarray) -> tuple[dict[bytes, int], dict[int, list[int]], list[int]]:
        """Distinct windows under hot anchors: digest -> number, the numbers of each segment's windows, weights."""
        index: dict[bytes, int] = {}
        of: dict[int, list[int]] = {}
        weights: list[int] = []
        known: dict[bytes, list[int]] = {}
        window = self.kind.window
        for s in np.flatnonzero(hot[self.inverse]).tolist():
            d, a, b = int(self.doc[s]), int(self.first[s]), int(self.last[s])
            content = self.docs[d].cut(a, b + window)
            own = known.get(content)
            if own is None:
                own = known[content] = [
                    index.setdefault(hashlib.blake2b(self.docs[d].cut(at, at + window), digest_size=16).digest(), len(index))
                    for at in range(a, b + 1)]
            of[s] = own
            # new numbers come in order, so each is weighed where it is first met
            for e in own:
                self._weigh(weights, e, d)
        return index, of, weights

    def entries(self, met: np.ndarray) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, list[int]]:
        """Distinct segments whose anchor counts as met: content -> number, and of each segment the number or -1;
        their hashes and weights."""
        chosen = np.flatnonzero(met[self.inverse])
        of = np.full(len(self.doc), -1)
        index: dict[bytes, int] = {}
        hashes, weights = [], []
        for s, d, a, b, h in zip(chosen.tolist(), self.doc[chosen].tolist(), self.first[chosen].tolist(),
                                 self.last[chosen].tolist(), self.hash[chosen].tolist()):
            content = self.docs[d].cut(a, b + self.kind.window)
            e = index.setdefault(content, len(index))
            of[s] = e
            if e == len(hashes):
                hashes.append(h)
            self._weigh(weights, e, d)
        return index, of, np.array(hashes, np.uint64), weights


def units(kind: Kind, batches: Iterator[pa.RecordBatch]) -> Iterator[Unit]:
    number, ids, texts, size = 0, [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            t = t.as_py()
            if ids and size + len(t or "") > UNIT_BYTES:
                yield Unit(number, kind, ids, texts)
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or "")
    if ids:
        yield Unit(number, kind, ids, texts)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes + np.uint64(0x632BE59BD9B4E019)) % np.uint64(buckets)).astype(np.int64)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, numbers of its members in order) for each bucket with members."""
    order = np.argsort(bucket, kind="stable")
    if len(order):
        for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            yield int(bucket[own[0]]), own


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one bucket after another (partitions are sorted by bucket)."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and row["bucket"] != held[0]["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


EMPTY = dict.fromkeys(("hashes", "weights", "lengths", "texts", "digests", "digest_weights"), b"")
PRESENT = "bucket int, task int, unit int, " + ", ".join(f"{c} binary" for c in EMPTY)
PRESENT_SCHEMA = pa.schema([*((c, pa.int32()) for c in ("bucket", "task", "unit")), *((c, pa.binary()) for c in EMPTY)])
REPLY = "task int, unit int, bucket int, crc bigint, bits binary"
REPLY_SCHEMA = pa.schema([("task", pa.int32()), ("unit", pa.int32()), ("bucket", pa.int32()),
                          ("crc", pa.int64()), ("bits", pa.binary())])


def _reply(row: dict, data: bytes, bits: np.ndarray) -> dict:
    return {"task": row["task"], "unit": row["unit"], "bucket": row["bucket"],
            "crc": zlib.crc32(data), "bits": np.packbits(bits).tobytes()}


class Replies:
    """The bits returned to one scan task, from the shared folder."""

    def __init__(self, folder: str, task: int):
        self.by: dict[int, dict[int, tuple[int, bytes]]] = {}
        store, at = open_store(f"{folder}/task={task}")
        if store.get_file_info(at).type != pafs.FileType.Directory:
            return
        for info in store.get_file_info(pafs.FileSelector(at)):
            if info.base_name.endswith(".parquet"):
                with store.open_input_file(info.path) as f:
                    for r in pq.ParquetFile(f).read(["unit", "bucket", "crc", "bits"]).to_pylist():
                        self.by.setdefault(r["unit"], {})[r["bucket"]] = (r["crc"], r["bits"])

    def bits(self, unit: int, bucket: int, data: bytes, n: int) -> np.ndarray:
        crc, bits = self.by.get(unit, {}).get(bucket, (None, b""))
        if crc != zlib.crc32(data):
            raise RuntimeError("the source's rows changed between two scans")
        return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _met(unit: Unit, replies: Replies, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the unit's anchors: met and few enough to bring their segments together; hot."""
    met = np.zeros(len(unit.anchors), bool)
    hot = met.copy()
    for bucket, own in _split(_bucket(unit.anchors, buckets)):
        bits = replies.bits(unit.number, bucket, unit.anchors[own].tobytes(), 2 * len(own))
        met[own], hot[own] = bits[:len(own)], bits[len(own):]
    return met & ~hot, hot


def _first(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest, by which it is dealt."""
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)


def covered(docs: DataFrame, kind: Kind, finish: Callable, schema: str) -> tuple[DataFrame, str]:
    """Rows of ``finish(unit, flags)`` for every unit of ``docs`` (id, text), and the folder that the rows read.

    ``flags`` is a list with, for each text, the sorted starts of its covered
    windows as runs (first, last). The caller removes the folder when the rows
    are no longer computed from it.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/dealt-{uuid.uuid4().hex}"
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))

    def announce(batches):
        task = TaskContext.get().partitionId()
        for u in units(kind, batches):
            rows = [(b, task, u.number, u.anchors[own].tobytes(), np.packbits(u.several[own]).tobytes(),
                     u.counts[own][u.several[own]].tobytes())
                    for b, own in _split(_bucket(u.anchors, buckets))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] * 3 + [pa.binary()] * 3)],
                    ["bucket", "task", "unit", "hashes", "several", "counts"])

    def answer(batches):
        for rows in _groups(batches):
            parts = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
            several = [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(p)).astype(bool)
                       for r, p in zip(rows, parts)]
            held = [np.ones(len(p), np.int64) for p in parts]
            for r, n, more in zip(rows, held, several):
                n[more] = np.frombuffer(r["counts"], np.int64)
            _, inverse = np.unique(np.concatenate(parts), return_inverse=True)
            # whether segments of several places have the hash, and how many would be sent under it
            places = np.bincount(inverse, 1 + np.concatenate(several))
            counts = np.bincount(inverse, np.concatenate(held))
            at = np.cumsum([len(p) for p in parts])[:-1]
            met, hot = np.split(places[inverse] > 1, at), np.split(counts[inverse] > HOT, at)
            yield pa.RecordBatch.from_pylist(
                [_reply(r, r["hashes"], np.concatenate([x, y])) for r, x, y in zip(rows, met, hot)], REPLY_SCHEMA)

    def present(batches):
        task = TaskContext.get().partitionId()
        replies = Replies(f"{folder}/met", task)
        for u in units(kind, batches):
            met, hot = _met(u, replies, buckets)
            index, _, hashes, weights = u.entries(met)
            contents = list(index)
            rows: dict[int, dict] = {}
            for b, own in _split(_bucket(hashes, buckets)):
                texts = [contents[e] for e in own.tolist()]
                rows[b] = {"hashes": hashes[own].tobytes(), "weights": np.array([weights[e] for e in own.tolist()], np.int64).tobytes(),
                           "lengths": np.array([len(t) for t in texts], np.int64).tobytes(), "texts": b"".join(texts)}
            index, _, weights = u.windows(hot)
            digests = list(index)
            for b, own in _split(_bucket(_first(digests), buckets)):
                rows.setdefault(b, {}).update(
                    digests=b"".join(digests[e] for e in own.tolist()),
                    digest_weights=np.array([weights[e] for e in own.tolist()], np.int64).tobytes())
            for b, r in rows.items():
                yield pa.RecordBatch.from_pylist([{"bucket": b, "task": task, "unit": u.number, **EMPTY, **r}], PRESENT_SCHEMA)

    def resolve(batches):
        for rows in _groups(batches):
            hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
            weights = np.concatenate([np.frombuffer(r["weights"], np.int64) for r in rows])
            texts = []
            for r in rows:
                ends = np.cumsum(np.frombuffer(r["lengths"], np.int64)).tolist()
                texts += [r["texts"][a:b] for a, b in zip([0, *ends], ends)]
            flags = kind.resolve(hashes, weights, texts, kind.window)
            known: dict[bytes, int] = {}
            own = []
            for r in rows:
                digests = [r["digests"][i:i + 16] for i in range(0, len(r["digests"]), 16)]
                own.append((digests, np.frombuffer(r["digest_weights"], np.int64).tolist()))
                for d, w in zip(*own[-1]):
                    known[d] = min(known.get(d, w), w) if kind.least_id else known.get(d, 0) + w
            at = 0
            for r, (digests, w) in zip(rows, own):
                n = len(r["hashes"]) // 8
                more = np.array([known[d] < x if kind.least_id else known[d] > 1 for d, x in zip(digests, w)], bool)
                yield pa.RecordBatch.from_pylist(
                    [_reply(r, r["texts"] + r["digests"], np.concatenate([*flags[at:at + n], more]))], REPLY_SCHEMA)
                at += n

    def apply(batches):
        task = TaskContext.get().partitionId()
        replies, found = Replies(f"{folder}/met", task), Replies(f"{folder}/found", task)
        for u in units(kind, batches):
            met, hot = _met(u, replies, buckets)
            index, of, hashes, weights = u.entries(met)
            windows, hot_of, window_weights = u.windows(hot)
            contents, digests = list(index), list(windows)
            n_windows = np.zeros(len(index), np.int64)
            own = np.flatnonzero(of >= 0)
            n_windows[of[own]] = u.last[own] - u.first[own] + 1
            flags: list = [None] * len(index)
            single = np.zeros(len(windows), bool)
            segments = dict(_split(_bucket(hashes, buckets)))
            others = dict(_split(_bucket(_first(digests), buckets)))
            none = np.array([], np.int64)
            for b in segments.keys() | others.keys():
                members, more = segments.get(b, none), others.get(b, none)
                n = n_windows[members]
                sent = b"".join([contents[e] for e in members.tolist()] + [digests[e] for e in more.tolist()])
                bits = found.bits(u.number, b, sent, int(n.sum()) + len(more))
                for e, x in zip(members.tolist(), np.split(bits[:int(n.sum())], np.cumsum(n)[:-1])):
                    flags[e] = x
                single[more] = bits[int(n.sum()):]
            runs: list[list[tuple[int, int]]] = [[] for _ in u.docs]
            found_runs = [_runs(x) for x in flags]
            for d, e, a, b in zip(u.doc[own].tolist(), of[own].tolist(), u.first[own].tolist(), u.last[own].tolist()):
                # only the least of this unit's copies has to ask the others
                if u.covered_here(weights[e], d):
                    runs[d].append((a, b))
                else:
                    runs[d] += [(a + x, a + y) for x, y in found_runs[e]]
            for s, numbers in hot_of.items():
                d, a = int(u.doc[s]), int(u.first[s])
                here = np.array([u.covered_here(window_weights[e], d) or bool(single[e]) for e in numbers])
                runs[d] += [(a + x, a + y) for x, y in _runs(here)]
            yield finish(u, runs)

    # a bucket is a partition of its own
    by_bucket = lambda df: df.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "task", "unit")
    save = lambda df, name: df.repartition("task").write.partitionBy("task").parquet(f"{folder}/{name}")
    save(by_bucket(docs.mapInArrow(announce, "bucket int, task int, unit int, hashes binary, several binary, counts binary"))
         .mapInArrow(answer, REPLY), "met")
    save(by_bucket(docs.mapInArrow(present, PRESENT)).mapInArrow(resolve, REPLY), "found")
    return docs.mapInArrow(apply, schema), folder


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    if flags.all():
        return [(0, len(flags) - 1)]
    if not flags.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).tolist()
    return [(x, y - 1) for x, y in zip(edge[::2], edge[1::2])]


def merge(runs: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Covered symbols as maximal spans (start, end) from runs of window starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + window))
        else:
            out.append((a, b + window))
    return out
