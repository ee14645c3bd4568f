"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns, held as one 16-byte digest per turn, so that
paths sort as bytes. Equal paths fold to one row with their count. Splitters
taken from a bounded sample cut the sorted paths into shards. A trie node that
is a prefix of some splitter may have members in several shards: these nodes
are the skeleton, which is broadcast. Every other node lies in one shard whole
and is finished there in one pass over the sorted paths; of skeleton nodes each
shard gives what it saw, and the parts are reduced.

Bounds: the sample has ``SAMPLE`` paths per shard and the skeleton at most
``SKELETON`` turns (splitters are cut to their share of it), whatever the
input. Turns are gathered by conversation as 16 bytes and a word count each,
never with their text: a conversation must fit a row of these.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD, cut
from strata.operators.joins import split_join

DIGEST = 16            # bytes of a turn's digest
SAMPLE = 40            # sampled paths per shard
SKELETON = 100_000     # turns of all splitters together
CHUNK = 1 << 20        # characters of a piece of a member list
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
FOUND = NODE + ", skeleton bigint, parent_skeleton bigint, words bigint"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat_ws("", F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, DIGEST)


def sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id long, turns array<struct<digest, words>> in order.

    Order is by turn, null first; rows with the same turn by digest. Null
    roles and texts count as empty. Rows without an id belong to no
    conversation. An empty table gives no rows. Turns are sorted over the
    whole cluster and meet as packed pieces, one per batch that holds some.
    """
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        turn_digest(F.col(role_col), F.col(text_col)).alias("digest"), words.cast("int").alias("words"))
    kind = rows.schema["turn"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring turns of a conversation as one row; ``n`` counts on, for pieces that begin alike."""
        n = 0
        for b in batches:
            ids = b.column(0).to_numpy()
            first = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1]) if len(ids) else np.array([], int)
            ends = pa.array(np.append(first, len(ids)), pa.int32())
            piece = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                [b.column(2), b.column(3)], ["digest", "words"]))
            at = pa.array(first)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), b.column(2).take(at),
                 pa.array(np.arange(n, n + len(first)), pa.int64()), piece], ["conv_id", "turn", "digest", "n", "piece"])
            n += len(first)

    # sorted by the whole cluster: a conversation that holds a third of all turns comes in packed pieces
    order = ("conv_id", "turn", "digest")
    pieces = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pack, f"conv_id bigint, turn {kind}, digest binary, n bigint, piece array<struct<digest:binary,words:int>>")
    return (pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "n", "piece"))).alias("t"))
            .select("conv_id", F.flatten(F.transform("t", lambda t: t["piece"])).alias("turns")))


class Skeleton:
    """Splitters and the trie of their prefixes; node 0 is the root."""

    def __init__(self, splitters: list[bytes]) -> None:
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        for s in splitters:
            at = 0
            for i in range(0, len(s), DIGEST):
                step = (at, s[i:i + DIGEST])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(at)
                at = self.child[step]

    def shard(self, path: bytes) -> int:
        return bisect_right(self.splitters, path)


def splitters(folded: DataFrame, shards: int) -> list[bytes]:
    """Up to ``shards - 1`` paths that cut the turns of a sample into even parts."""
    most = max(8, SKELETON // shards)
    sample = (folded.select(F.substring("path", 1, most * DIGEST).alias("p"),
                            (F.octet_length("path") / DIGEST + 1).alias("cost"), F.xxhash64("path").alias("h"))
              .orderBy("h", "p").limit(SAMPLE * shards).collect())
    rows = sorted((bytes(r["p"]), r["cost"]) for r in sample)
    total, seen, out = sum(c for _, c in rows), 0.0, []
    for p, c in rows:
        seen += c
        if p and seen * shards >= total * (len(out) + 1) and len(out) < shards - 1 and (not out or p > out[-1]):
            out.append(p)
    return out


class _Frame:
    __slots__ = ("depth", "skeleton", "words", "conv", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, skeleton: int, words: int) -> None:
        self.depth, self.skeleton, self.words = depth, skeleton, words
        self.conv: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = EMPTY
        self.waiting: list[list] = []  # finished children, until the least member is known


class ShardTrie:
    """One pass over the sorted paths of a shard; ``rows`` collects what is finished.

    Held are the open path and the finished children of its nodes.
    """

    def __init__(self, skeleton: Skeleton) -> None:
        self.skeleton = skeleton
        self.rows: list[list] = []
        self.stack: list[_Frame] = []
        self.path = b""

    def add(self, path: bytes, words: list[int], n: int, conv: int, ends: str) -> None:
        if not self.stack:
            self.stack.append(_Frame(0, 0, 0))
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same:same + DIGEST] == self.path[same:same + DIGEST]:
            same += DIGEST
        while len(self.stack) > same // DIGEST + 1:
            self._close()
        for i in range(same, len(path), DIGEST):
            above = self.stack[-1].skeleton
            at = self.skeleton.child.get((above, path[i:i + DIGEST]), -1) if above >= 0 else -1
            self.stack.append(_Frame(len(self.stack), at, words[i // DIGEST]))
        f = self.stack[-1]
        f.n += n
        f.conv = conv if f.conv is None else min(f.conv, conv)
        f.ends = ends
        self.path = path

    def finish(self) -> None:
        while self.stack:
            self._close()
        self.path = b""

    def _close(self) -> None:
        f = self.stack.pop()
        up = self.stack[-1] if self.stack else None
        for row in f.waiting:
            row[2] = f.conv
            self.rows.append(row)
        if f.skeleton >= 0:  # a part; whether it is a leaf, and what it saves, is known after the reduction
            self.rows.append([f.conv, f.depth, None, f.n, f.children, f.leaves, f.saved, f.ends,
                              f.skeleton, None, f.words])
        else:
            f.leaves += not f.children
            f.saved += (f.n - 1) * f.words
            row = [f.conv, f.depth, None, f.n, f.children, f.leaves, f.saved, f.ends, None, None, None]
            if up.skeleton >= 0:
                row[9] = up.skeleton
                self.rows.append(row)
            else:
                up.waiting.append(row)
            up.children += 1
        if up:
            up.n += f.n
            up.conv = f.conv if up.conv is None else min(up.conv, f.conv)
            up.leaves += f.leaves
            up.saved += f.saved


def member_digests(members: DataFrame) -> DataFrame:
    """(g, conv_id) -> g, ends: SHA-256 of the group's ids, ascending and comma-joined.

    The ids are sorted over the whole cluster and packed into pieces of about
    ``CHUNK`` characters where they lie, so a group that holds a third of all
    conversations reaches the one task that hashes it as a stream of pieces.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "first", "piece"]
        group, first, ids, size = None, None, [], 0
        out: list[tuple] = []
        for b in batches:
            for g, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (g != group or size >= CHUNK):
                    out.append((group, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    group, first = g, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))))
                out = []
        if ids:
            yield pa.RecordBatch.from_pydict({"g": [group], "first": [first], "piece": [",".join(ids)]})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, h = None, None
        for b in batches:
            done: list[tuple] = []
            for g, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if g != group:
                    if h:
                        done.append((group, h.hexdigest()))
                    group, h = g, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(piece.encode())
            if done:
                yield pa.RecordBatch.from_pydict({"g": [d[0] for d in done], "ends": [d[1] for d in done]})
        if h:
            yield pa.RecordBatch.from_pydict({"g": [group], "ends": [h.hexdigest()]})

    pieces = (members.select("g", "conv_id").repartitionByRange("g", "conv_id").sortWithinPartitions("g", "conv_id")
              .mapInArrow(pack, "g bigint, first bigint, piece string"))
    return pieces.repartition("g").sortWithinPartitions("g", "first").mapInArrow(hashed, "g bigint, ends string")


def prefix_trie(seqs: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of ``seqs`` (conv_id, turns as of ``sequences``), conversations being members
    of every node that they start with.

    Columns: conv_id (least member) and depth name the node; parent_conv_id
    (null for the root), n_convs, n_children, n_leaves, saved_tokens (over the
    node's subtree: (n_convs - 1) times the words of the node's last turn) and
    ends_sha256 (of the ids of the conversations that end there). Conversations
    without turns end at the root. No conversations, no nodes. A conversation
    that comes twice counts twice.
    """
    spark = seqs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = cut(seqs.select("conv_id", F.coalesce(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""),
                                                  F.lit("")).alias("hex"),
                            F.transform("turns", lambda t: t["words"].cast("int")).alias("words"))
                .select("conv_id", F.unhex("hex").alias("path"), "words"))
    folded = cut(paths.groupBy("path", "words").agg(F.min("conv_id").alias("g"), F.count(F.lit(1)).alias("n")))
    copies = folded.where("n > 1")
    ends = member_digests(split_join(paths.select("conv_id", "path"), copies.select("path", "g"), "path"))
    folded = split_join(folded, ends, "g", "left").withColumn(
        "ends", F.coalesce("ends", F.sha2(F.col("g").cast("string").cast("binary"), 256)))
    skeleton = spark.sparkContext.broadcast(Skeleton(splitters(folded, shards)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [skeleton.value.shard(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], [*b.schema.names, "shard"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, shard = ShardTrie(skeleton.value), None
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(6)]
            for path, words, n, conv, ends_sha, s in zip(*cols):
                if s != shard:
                    trie.finish()
                    shard = s
                trie.add(path, words, n, conv, ends_sha)
            if trie.rows:
                yield _found(trie.rows)
                trie.rows = []
        trie.finish()
        if trie.rows:
            yield _found(trie.rows)

    dealt = (folded.select("path", "words", "n", F.col("g").alias("conv"), "ends")
             .mapInArrow(deal, "path binary, words array<int>, n bigint, conv bigint, ends string, shard int"))
    found = cut(dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "path").mapInArrow(build, FOUND))
    parts = found.where("skeleton IS NOT NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("words").alias("words"),
        # one shard at most holds the path that ends here
        F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))), F.lit(EMPTY)).alias("ends_sha256"))
    top = _reduced(spark, parts, skeleton.value)
    owner = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))
    local = (found.where("skeleton IS NULL").join(owner, "parent_skeleton", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")))
    names = [c.split()[0] for c in NODE.split(", ")]
    return local.select(*names).unionByName(top.select(*names))


def _found(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in FOUND.split(", ")]
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)


def _reduced(spark: SparkSession, parts: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton nodes that exist, finished from the leaves up. At most ``SKELETON`` rows and the root
    (eight turns per shard at least) come to the driver."""
    rows = {r["skeleton"]: r.asDict() for r in parts.collect()}
    for at in sorted(rows, reverse=True):  # a child's number is greater than its parent's
        r = rows[at]
        r["own_leaf"], r["own_saved"] = r.get("own_leaf", 0), r.get("own_saved", 0)
        r["own_leaf"] += not r["n_children"]
        r["own_saved"] += (r["n_convs"] - 1) * r["words"]
        if at:
            up = rows[skeleton.parent[at]]
            up["n_children"] += 1
            for k in ("own_leaf", "own_saved"):
                up[k] = up.get(k, 0) + r[k]
    out = [(r["conv_id"], r["depth"], rows[skeleton.parent[at]]["conv_id"] if at else None, r["n_convs"],
            r["n_children"], r["n_leaves"] + r["own_leaf"], r["saved_tokens"] + r["own_saved"], r["ends_sha256"], at)
           for at, r in rows.items()]
    return spark.createDataFrame(out, NODE + ", skeleton bigint")
