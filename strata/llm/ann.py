"""Approximate nearest neighbours (largest inner product) with a hash-prefix forest.

Each tree gives every vector a long hash string, one bit per hyperplane, and
keeps the strings as a sorted array; vectors that share a prefix are one range
of it. A query descends to its longest match in every tree and then ascends,
one prefix length at a time in all trees together, until the ranges hold
enough candidates, which are scored exactly.

Rows are dealt into blocks of about BLOCK, each with a forest of its own over
all its rows, so that a task's memory is bounded whatever the input. Every
query visits every block: the work is queries times rows times ``share``. An
inner product is turned into an angle by one more component that brings all
vectors of a block to the same length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut
from strata.llm.components import split_join

BLOCK = 20_000      # rows of one forest
QUERIES = 25_000    # queries that meet a block in one task
TREES = 64
BITS = 48           # length of a hash string
SHARE = 0.6         # of a block's rows that a query scores at least
SEED = 42


class Forest:
    """Sorted arrays of hash strings over ``rows`` (n, d)."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.rows, self.bits = rows, bits
        self.length = np.sqrt((rows * rows).sum(axis=1).max())
        lift = np.sqrt(np.maximum(self.length ** 2 - (rows * rows).sum(axis=1), 0.0))
        whole = np.column_stack([rows, lift])
        self.mean = whole.mean(axis=0)
        rng = np.random.default_rng(seed)
        d = whole.shape[1]
        self.planes, self.order, self.keys = [], [], []
        for _ in range(trees):
            # rows of random rotations: the planes of one tree differ as much as they can
            parts = [np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(-(-bits // d))]
            self.planes.append(np.concatenate(parts, axis=1)[:, :bits])
            keys = self._keys(whole, self.planes[-1])
            order = np.argsort(keys, kind="stable")
            self.order.append(order)
            self.keys.append(keys[order])

    def _keys(self, whole: np.ndarray, planes: np.ndarray) -> np.ndarray:
        signs = (whole - self.mean) @ planes > 0
        return signs @ (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))

    def search(self, queries: np.ndarray, k: int, share: float) -> list[np.ndarray]:
        """For each query the row numbers of its k best candidates and any that tie with the last."""
        n = len(self.rows)
        scale = self.length / np.sqrt((queries * queries).sum(axis=1))
        whole = np.column_stack([queries * scale[:, None], np.zeros(len(queries))])
        keys = [self._keys(whole, p) for p in self.planes]
        enough = min(n, max(k, int(np.ceil(share * n))))
        low = np.empty((self.bits + 1, len(self.keys), len(queries)), np.int64)
        high = np.empty_like(low)
        for level in range(self.bits + 1):  # the range of rows that share the first ``level`` bits
            drop = np.uint64(self.bits - level)
            for t, (own, tree) in enumerate(zip(keys, self.keys)):
                start = (own >> drop) << drop
                low[level, t] = np.searchsorted(tree, start, "left")
                high[level, t] = np.searchsorted(tree, start + ((np.uint64(1) << drop) - np.uint64(1)), "right")
        total = (high - low).sum(axis=1)
        found = []
        mark = np.zeros(n, bool)
        for q in range(len(queries)):
            # below this level the ranges together can't hold enough
            level = int(np.flatnonzero(total[:, q] >= enough)[-1])
            while True:
                for order, a, b in zip(self.order, low[level, :, q].tolist(), high[level, :, q].tolist()):
                    mark[order[a:b]] = True
                own = np.flatnonzero(mark)
                if len(own) >= enough or not level:
                    break
                level -= 1
            mark[own] = False
            score = self.rows[own] @ queries[q]
            if len(own) > k:
                last = np.partition(score, len(own) - k)[len(own) - k]
                own = own[score >= last - 1e-9 * max(1.0, abs(last))]
            found.append(own)
        return found


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>): one row per id with a usable vector.

    Null ids, null, empty and zero vectors, and those with a null or
    non-finite component take no part; of an id's several vectors the least
    (in array order) counts.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (vectors.select(F.col(id_col).alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine)
                   & F.exists("v", lambda x: x != 0.0))
            .groupBy("id").agg(F.min("v").alias("v")))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE,
            trees: int = TREES, bits: int = BITS, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found; all candidates if fewer.

    ``queries`` has the same two columns. A candidate with the query's id is
    not its neighbour; vectors of another dimension are no candidates. Ties go
    to the smaller id. Of equal vectors only the k + 1 least ids can appear,
    so only they are dealt, and equal queries are searched once: a vector that
    a third of all rows share costs no more than another. Empty tables give no
    rows.
    """
    rows = cut(clean(vectors, id_col, vector_col))
    asked = cut(clean(queries, id_col, vector_col))
    n_blocks = max(1, -(-rows.count() // BLOCK))
    same = Window.partitionBy("v").orderBy("id")
    data = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    distinct = asked.groupBy("v").agg(F.min("id").alias("q"))
    n_slices = max(1, -(-asked.count() // QUERIES))
    # a part is one block of rows and one slice of the queries, and a partition of its own
    part = lambda block, piece: (block * F.lit(n_slices) + piece).cast("int").alias("part")
    left = data.select(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice"), "id", "v").select(
        part(F.col("block"), F.col("slice")), F.size("v").alias("dim"), F.lit(0).alias("asks"), "id", "v")
    right = distinct.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"),
                            F.pmod(F.xxhash64("q"), F.lit(n_slices)).alias("slice"), F.col("q").alias("id"), "v").select(
        part(F.col("block"), F.col("slice")), F.size("v").alias("dim"), F.lit(1).alias("asks"), "id", "v")
    dealt = left.union(right).repartitionById(n_blocks * n_slices, "part").sortWithinPartitions("part", "dim", "asks", "id")

    def search(ids: np.ndarray, x: np.ndarray, asked_ids: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        out_q, out_id, out_s = [], [], []
        forest = Forest(x, trees, bits)
        for at in range(0, len(y), 256):
            for q, vector, own in zip(asked_ids[at:at + 256], y[at:at + 256],
                                      forest.search(y[at:at + 256], k + 1, share)):
                # row by row in one order of addition, so that equal vectors get equal scores
                score = (x[own] * vector).sum(axis=1)
                best = np.lexsort([ids[own], -score])[:k + 1]
                out_q.append(np.full(len(best), q))
                out_id.append(ids[own][best])
                out_s.append(score[best])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (out_q, out_id, out_s)],
                                          ["q", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by part and dimension, those that ask behind the others."""
        key, held = None, ([], [], [], [])

        def close() -> Iterator[pa.RecordBatch]:
            if held[0] and held[2]:
                yield search(*(np.concatenate(h) for h in held))

        for b in batches:
            keys = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()])
            asks, ids = b.column(2).to_numpy(), b.column(3).to_numpy()
            ends = np.concatenate([np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, [len(keys)]])
            flat, at = b.column(4).flatten().to_numpy(), 0
            for first, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                if key is not None and tuple(keys[first]) != key:
                    yield from close()
                    held = ([], [], [], [])
                key = tuple(keys[first])
                v = flat[at:at + (end - first) * key[1]].reshape(-1, key[1])
                at += (end - first) * int(key[1])
                for side, own in ((0, asks[first:end] == 0), (2, asks[first:end] == 1)):
                    if own.any():
                        held[side].append(ids[first:end][own])
                        held[side + 1].append(v[own])
        yield from close()

    found = dealt.mapInArrow(run, "q bigint, id bigint, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
             .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near")))
    # each query gets its vector's list, without itself
    of = split_join(split_join(asked, distinct, "v").select(F.col("id").alias("query_id"), "q"), lists, "q")
    own = F.filter("near", lambda x: x["id"] != F.col("query_id"))
    return (of.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                    F.col("x.score").alias("score")))
