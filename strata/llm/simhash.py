"""SimHash near-dedup with BK-trees.

Distinct fingerprints are dealt into shards, one BK-tree each: a child hangs
on the edge that bears its Hamming distance to the parent, and a search
follows only edges within the radius of the query's own distance.

Shards are not cut at random and sent to every task, since each fingerprint
would then have to search all of them. Of ``bits`` + 2 blocks of a fingerprint
at least two are equal in any pair that links, so a tree holds the
fingerprints that agree in two given blocks, and it travels, by shuffle, to
the task that holds its queries. A shard of more than HOT fingerprints is
dealt once more by two blocks of its remaining bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, one_row_per_key
from strata.llm.components import components, split_join

SEED = 42
HOT = 20_000        # fingerprints of a shard that is dealt once more
WORDS = 200_000     # words of one text hashed at a time
SMALL = 48          # shards up to this size are searched node by node
QUERIES = 1_024     # queries of a large shard searched at a time

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)  # most significant first


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text; 0 without words."""
    words = (text or "").encode("utf-8").lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    counts, total = np.zeros((8, 256), np.int64), 0
    width = min(shingle, len(words))
    for at in range(0, len(words) - width + 1, WORDS):
        part = words[at:at + WORDS + width - 1]
        line = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part])
        starts = (ends - [len(w) + 1 for w in part])[:len(part) - width + 1].tolist()
        stops = (ends[width - 1:] - 1).tolist()
        hashes = b"".join(map(xxhash.xxh64_digest, [line[a:b] for a, b in zip(starts, stops)], repeat(SEED)))
        total += len(starts)
        octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        counts += np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    ones = np.einsum("ij,jk->ik", counts, _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_sha (of the text; tells rows that repeat an id apart), fp bigint."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(
        "id", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["id", "text_sha", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text_sha string, fp bigint")


class BKTree:
    """Children keyed by integer Hamming distance to the parent."""

    def __init__(self, bits: int):
        self.bits, self.values, self.children = bits, [], []

    def add(self, value: int) -> list[int]:
        """Insert a value; returns the nodes within the radius that were there before."""
        near, bits = [], self.bits
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (value ^ self.values[node]).bit_count()
            if d <= bits:
                near.append(node)
            stack += [c for key, c in self.children[node].items() if d - bits <= key <= d + bits]
        at, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while at != new:
            d = (value ^ self.values[at]).bit_count()
            at = self.children[at].setdefault(d, new)
        return near


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the labels of the pairs (a, b); labels point at the least index."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (up := label[label], (up != label).any())[1]:
            label = up


def _tree_arrays(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A BK-tree over all values: children in order of (parent, distance), and each node's first child by distance."""
    n = len(values)
    table = np.full((n, 65), -1, np.int32)
    sets = [np.arange(n)]
    while sets:
        own = sets.pop()
        node, rest = own[0], own[1:]
        if not len(rest):
            continue
        d = np.bitwise_count(values[rest] ^ values[node])
        order = np.argsort(d, kind="stable")
        rest, d = rest[order], d[order]
        cuts = np.flatnonzero(np.diff(d)) + 1
        parts = np.split(rest, cuts)
        table[node, d[np.concatenate([[0], cuts])]] = [p[0] for p in parts]
        sets += parts
    has = table >= 0
    first = np.zeros((n, 66), np.int64)
    first[:, 1:] = np.cumsum(has, axis=1)
    first += np.concatenate([[0], np.cumsum(has.sum(axis=1))])[:-1, None]
    return table[has].astype(np.int64), first


def shard_links(values: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint of a shard the index of the least one it is connected with inside the shard."""
    n = len(values)
    if n <= SMALL:
        label, tree = list(range(n)), BKTree(bits)
        for i, v in enumerate(values.tolist()):
            for j in tree.add(v):
                a, b = label[i], label[j]
                if a != b:
                    a, b = min(a, b), max(a, b)
                    label = [a if x == b else x for x in label]
        return np.array(label)
    label = np.arange(n)
    children, first = _tree_arrays(values)
    for at in range(0, n, QUERIES):
        query = np.arange(at, min(at + QUERIES, n))
        node = np.zeros(len(query), np.int64)
        while len(query):
            d = np.bitwise_count(values[query] ^ values[node]).astype(np.int64)
            hit = d <= bits
            label = _hook(label, query[hit], node[hit])
            low = first[node, np.maximum(d - bits, 0)]
            count = first[node, np.minimum(d + bits, 64) + 1] - low
            ends = np.cumsum(count)
            step = np.arange(ends[-1]) - np.repeat(ends - count, count)
            query, node = np.repeat(query, count), children[np.repeat(low, count) + step]
    return label


def _blocks(offsets: list[int], n: int) -> list[list[int]]:
    """Bit positions cut into n runs of about equal length."""
    cuts = [round(i * len(offsets) / n) for i in range(n + 1)]
    return [offsets[a:b] for a, b in zip(cuts, cuts[1:])]


def _value(fp: Column, offsets: list[int]) -> Column:
    """The bits at the given positions, run by run (positions of one block are adjacent or two runs)."""
    mask = sum(1 << o for o in offsets)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _keys(fp: Column, offsets: list[int], bits: int) -> list[list[int]]:
    return [a + b for a, b in combinations(_blocks(offsets, bits + 2), 2)]


def _shards(fps: DataFrame, bits: int) -> DataFrame:
    """(way, value, fp): each fingerprint under every choice of two blocks."""
    ways = _keys(F.col("fp"), list(range(64)), bits)
    return fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(w).alias("way"), _value(F.col("fp"), offsets).alias("value"))
        for w, offsets in enumerate(ways)])).alias("k")).select("k.way", "k.value", "fp")


def _reshard(hot: DataFrame, bits: int) -> DataFrame:
    """Hot shards dealt by two blocks of the bits in which their members may differ."""
    ways = _keys(F.col("fp"), list(range(64)), bits)
    sub = F.lit(None).cast("array<struct<way:int,value:bigint>>")
    for w, fixed in enumerate(ways):
        free = [o for o in range(64) if o not in fixed]
        sub = F.when(F.col("way") == w, F.array(*[
            F.struct(F.lit(len(ways) * (w + 1) + v).alias("way"), _value(F.col("fp"), fixed + more).alias("value"))
            for v, more in enumerate(_keys(F.col("fp"), free, bits))])).otherwise(sub)
    return hot.select("fp", F.explode(sub).alias("k")).select("k.way", "k.value", "fp")


def links(fps: DataFrame, bits: int) -> DataFrame:
    """(a, b) edges that connect all fingerprints (column fp, distinct) at ``bits`` or fewer differing bits.

    Each shard gives a star per connected group of its members, never all
    pairs, so there are at most as many edges as shard members.
    """
    shards = _shards(fps, bits)
    sizes = shards.groupBy("way", "value").agg(F.count(F.lit(1)).alias("n")).where(f"n > {HOT}")
    hot = cut(sizes)
    if not hot.isEmpty():
        mark = shards.join(hot, ["way", "value"], "left")
        shards = mark.where("n is null").drop("n").union(_reshard(mark.where("n is not null"), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list[np.ndarray] = []
        key: tuple[int, int] | None = None

        def search(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            label = shard_links(values.view(np.uint64), bits)
            own = np.flatnonzero(label != np.arange(len(values)))
            return values[own], values[label[own]]

        for batch in batches:
            way, value, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts = np.flatnonzero((way[1:] != way[:-1]) | (value[1:] != value[:-1])) + 1
            bounds = np.concatenate([[0], starts, [len(way)]]) if len(way) else np.array([0])
            left, right = [], []
            sizes = np.diff(bounds)
            for g in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
                a, b = bounds[g], bounds[g + 1]
                k = (int(way[a]), int(value[a]))
                if k != key:
                    if sum(map(len, held)) > 1:
                        x, y = search(np.concatenate(held))
                        left.append(x)
                        right.append(y)
                    held, key = [], k
                held.append(fp[a:b])
            if left:
                yield pa.RecordBatch.from_arrays([np.concatenate(left), np.concatenate(right)], schema=schema)
        if sum(map(len, held)) > 1:
            x, y = search(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], schema=schema)

    dealt = shards.repartition("way", "value").sortWithinPartitions("way", "value", "fp")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_groups(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: id, text_sha, fp bigint, root bigint (the least fingerprint of the component by value),
    component_id (the least id that the row's fingerprint reaches).

    Null and empty texts have fingerprint 0 and link like any other. Null ids
    are never the least unless a component has no other id. Equal fingerprints
    are one node, so a text that a third of all rows share is searched once.
    A text of any length counts whole: its shingles are hashed as they come, and
    only 64 sums are kept. An empty table gives no rows.
    """
    if not 0 <= bits <= 6:
        raise ValueError("bits must be between 0 and 6")
    rows = cut(fingerprints(docs, shingle, id_col, text_col))
    nodes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes.select("fp"), bits) if bits else
                       nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0))
    linked = cut(nodes.join(roots, nodes.fp == roots.node).select("fp", "least", "root"))
    least = linked.groupBy("root").agg(F.min("least").alias("reached"))
    reach = split_join(linked, least, "root").select("fp", "root", "reached")
    of = nodes.join(reach, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("reached")).alias("component_id"))
    return split_join(rows, of, "fp").select(F.col("id").alias(id_col), "text_sha", "fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_dedup(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least id.

    Of rows that repeat this id with the same text one stays; columns are
    those of ``docs``, whatever their names. Null and empty texts are near
    each other; texts of any length count whole; an empty table stays empty.
    """
    key = lambda i, sha: F.concat_ws("|", sha, F.coalesce(i.cast("string"), F.lit("~")))
    keep = (near_groups(docs, shingle, bits, id_col, text_col)
            .where(F.col(id_col).eqNullSafe(F.col("component_id")))
            .select(key(F.col(id_col), F.col("text_sha")).alias("k"), "root"))
    # rows of one id and one component but of different texts: the least text digest stays
    keep = keep.groupBy("root").agg(F.min("k").alias("k")).select("k")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    return one_row_per_key(docs, key(F.col(id_col), sha), keep)
