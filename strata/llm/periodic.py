"""Runs of periodic words by a sparse diagonal programme.

The full programme counts, for word i and lag q, how many words up to i equal
the word q before; a diagonal q that ends after enough matches is a run of
period q. Only lags to earlier occurrences of a word are ever touched. So that
frequent words do not open a diagonal for every pair of places, lags in
[k, 2k) (k = 1, 2, 4, ...) are opened by earlier occurrences of the k words
that begin there, the nearest three: in a run of at least four periods q in
[k, 2k), any q consecutive places hold one whose k words have no period of
k/2 or less, and the occurrences of such words are more than k/2 apart, so at
most three lie nearer than 2k. A word then opens three lags per level at most,
and work stays near n log n even if one word fills the text.

An opened diagonal is counted on from where it opened, and back to where it
began, until a word differs; if it is long enough, its run is emitted there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 1 << 20   # bytes of text taken at once; a longer text is taken alone


def _same(words: np.ndarray, at: int, lag: int, step: int, low: int, high: int) -> int:
    """How many words from ``at`` on (in direction ``step``) equal those ``lag`` before them, within [low, high)."""
    count, width = 0, 16
    while True:
        if step > 0:
            end = min(at + width, high)
            a, b = words[at:end], words[at - lag:end - lag]
        else:
            end = max(at - width + 1, low + lag)
            a, b = words[end:at + 1][::-1], words[end - lag:at + 1 - lag][::-1]
        if not len(a):
            return count
        differ = a != b
        first = int(differ.argmax())
        if differ[first]:
            return count + first
        count += len(a)
        at, width = at + step * len(a), width * 4


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = 6, periods: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in ``words``, sorted by start, then period.

    Text t is ``words[bounds[t]:bounds[t + 1]]``; equal numbers must not occur
    in two texts. A run is a stretch with smallest period q of ``max(least,
    periods * q)`` words or more that can't be extended; ``periods`` is at
    least 4 (fewer would need more occurrences per level).
    """
    if periods < 4:
        raise ValueError("at least four periods")
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    longest = int(np.diff(bounds).max(initial=0))
    rank, alive, k = words, np.arange(n), 1  # rank[i] names the k words from alive[i] on
    while len(alive) and periods * k <= longest:
        order = np.argsort(rank, kind="stable")
        at, name = alive[order], rank[order]
        starts, lags = [], []
        for back in range(1, min(4, len(at))):
            lag = at[back:] - at[:-back]
            hit = (name[back:] == name[:-back]) & (lag >= k) & (lag < 2 * k)
            starts.append(at[back:][hit])
            lags.append(lag[hit])
        if starts:
            _diagonals(words, bounds, np.concatenate(starts), np.concatenate(lags), least, periods, found)
        # k words that occur once in their text are in no run of a longer period
        repeated = np.zeros(len(at), bool)
        equal = name[1:] == name[:-1]
        repeated[1:] |= equal
        repeated[:-1] |= equal
        index = np.full(n + 1, -1)
        index[alive] = rank
        keep = np.sort(at[repeated])
        # a run of the next level is a stretch of places that are all kept
        if len(keep):
            cuts = np.flatnonzero(np.diff(keep) != 1) + 1
            sizes = np.diff(np.concatenate([[0], cuts, [len(keep)]]))
            keep = keep[np.repeat(sizes >= 2 * k * periods - k, sizes)]
        second = index[np.minimum(keep + k, n)]
        alive, first = keep[second >= 0], index[keep][second >= 0]
        second = second[second >= 0]
        # names of 2k words: pairs of names, numbered anew (words of two texts never pair up, as names differ by text)
        _, rank = np.unique(first * np.int64(max(1, int(index.max()) + 1)) + second, return_inverse=True)
        k *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _diagonals(words: np.ndarray, bounds: np.ndarray, at: np.ndarray, lags: np.ndarray, least: int, periods: int,
               found: dict[tuple[int, int], int]) -> None:
    """Follow each opened diagonal; the smallest lag of a stretch is its period."""
    n = len(words)
    # the first place that opens a diagonal of a run has at least 2q matches before it, here tried at a few of them
    ok = at + 2 * lags <= n
    at, lags = at[ok], lags[ok]
    for part in (1, 2, 4, 6, 7):
        ahead = at + np.maximum(2 * lags * part // 8, 1) * (lags > 1)
        ok = words[ahead] == words[ahead - lags]
        at, lags = at[ok], lags[ok]
    order = np.lexsort((at, lags))
    done_lag, done_end = -1, -1
    for i, q in zip(at[order].tolist(), lags[order].tolist()):
        if q == done_lag and i < done_end:
            continue
        t = int(np.searchsorted(bounds, i, side="right")) - 1
        low, high = int(bounds[t]), int(bounds[t + 1])
        end = i + _same(words, i, q, 1, low, high)
        start = i - _same(words, i - 1, q, -1, low, high) - q
        done_lag, done_end = q, end
        if end - start >= max(least, periods * q):
            found[start, end] = min(q, found.get((start, end), q))


def collapse(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _slices(col: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, count) of neighbouring rows of about ``BATCH`` bytes together."""
    first, size = 0, 0
    for i, b in enumerate(pa.compute.binary_length(col).to_pylist()):
        if i > first and size + (b or 0) > BATCH:
            yield first, i - first
            first, size = i, 0
        size += b or 0
    if len(col) > first:
        yield first, len(col) - first


def text_runs(texts: list[bytes | None], least: int = 6, periods: int = 4) -> Iterator[tuple[list[bytes], list]]:
    """Words and runs of each text, words being parted by ASCII white space."""
    split = [(t or b"").split() for t in texts]
    numbers: list[np.ndarray] = []
    base = 0
    for ws in split:
        seen: dict[bytes, int] = {}
        numbers.append(np.array([seen.setdefault(w, len(seen)) for w in ws], np.int64) + base)
        base += len(seen)
    bounds = np.concatenate([[0], np.cumsum([len(ws) for ws in split])]).astype(np.int64)
    runs = find_runs(np.concatenate(numbers) if numbers else np.zeros(0, np.int64), bounds, least, periods)
    starts = np.searchsorted(np.array([r[0] for r in runs], np.int64), bounds)
    for i, ws in enumerate(split):
        low = int(bounds[i])
        yield ws, [(s - low, length, q) for s, length, q in runs[starts[i]:starts[i + 1]]]


def periodic_runs(docs: DataFrame, least: int = 6, periods: int = 4, id_col: str = "doc_id", text_col: str = "text",
                  keep_runs: bool = True, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: id, n_runs, the strongest run (start, length, period, exponent_milli; null without runs),
    runs_sha256, collapsed_sha256 and, if asked for, runs array<struct<start, length, period>> and the
    collapsed text.

    The strongest run is that of the greatest length/period as an exact ratio, then of the smallest start, then
    period. runs_sha256 is of ``start,length,period`` and a line feed for each run; collapsed_sha256 of
    the words that stay (each run keeps its first period) joined by one space. Words are parted by
    ``[\\x20\\x09-\\x0D]+``; a null text has none. Rows are independent: ids may repeat or be null. Texts of any
    length are taken whole; memory follows the longest.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for first, count in _slices(texts):
                rows = []
                for ws, runs in text_runs(texts.slice(first, count).to_pylist(), least, periods):
                    best = (None, None, None)
                    for s, length, q in runs:
                        if best[0] is None or length * best[2] > best[1] * q:
                            best = (s, length, q)
                    stay = ws
                    if runs:
                        stay = [w for w, k in zip(ws, collapse(runs, len(ws)).tolist()) if k]
                    text = b" ".join(stay)
                    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
                    rows.append((len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                                 hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
                                 [dict(start=s, length=n, period=q) for s, n, q in runs], text))
                cols = list(zip(*rows))
                out = [batch.column(0).slice(first, count), *[pa.array(c, pa.int64()) for c in cols[:5]],
                       pa.array(cols[5]), pa.array(cols[6])]
                names = [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                         "collapsed_sha256"]
                if keep_runs:
                    out.append(pa.array(cols[7], run_type))
                    names.append("runs")
                if keep_text:
                    out.append(pa.array(cols[8], pa.binary()).cast(pa.string()))
                    names.append("collapsed")
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(
        scan, f"`{id_col}` {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string"
        + ", runs array<struct<start:bigint,length:bigint,period:bigint>>" * keep_runs + ", collapsed string" * keep_text)
