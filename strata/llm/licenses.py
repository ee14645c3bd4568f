"""License scan by ordered signature rules.

Each text becomes its lower-case words joined by single blanks. A rule's
expression runs only where all of its words occur (one set intersection per
text decides for all rules). Detections are visited in the order of the rules,
strongest first, and one that lies within a detection already kept is
suppressed, so "gnu general public license version 3" is not also reported as
a bare name. Rows are independent: no exchange, no state.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.license_rules import BASE, GROUPS

# bytes of UTF-8: A-Z to a-z, other ASCII that is no letter or digit to a blank
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    needs: frozenset[bytes]
    pattern: re.Pattern
    confidence: float
    base: bool


@dataclass(frozen=True)
class Detection:
    rule: int
    label: str
    first: int      # number of its first word
    words: int
    confidence: float


def read_rules(groups: list[tuple[str, float]]) -> list[Rule]:
    """Rules in order. Expressions stand between blanks, and matches may share the blank between them."""
    out: list[Rule] = []
    for text, confidence in groups:
        for line in text.strip().splitlines():
            label, needs, expression = (part.strip() for part in line.split("|", 2))
            out.append(Rule(len(out), label, frozenset(needs.encode().split()),
                            re.compile(b" (?:" + expression.encode() + b")(?= )"), confidence,
                            BASE.get(expression) == label))
    return out


@lru_cache(maxsize=1)
def _rules() -> tuple[list[Rule], frozenset[bytes]]:
    rules = read_rules(GROUPS)
    return rules, frozenset().union(*(r.needs for r in rules))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def detect(words: list[bytes]) -> list[tuple[Rule, int, int]]:
    """(rule, first word, number of words) of every match of every rule, in the order of the rules."""
    rules, keywords = _rules()
    here = keywords.intersection(words)
    active = [r for r in rules if r.needs <= here] if here else []
    if not active:
        return []
    text = b" " + b" ".join(words) + b" "
    found = [(r, m.start(), m.end()) for r in active for m in r.pattern.finditer(text)]
    if not found:
        return []
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    first = np.searchsorted(blanks, [f[1] for f in found]).tolist()
    after = np.searchsorted(blanks, [f[2] for f in found]).tolist()
    return [(r, a, b - a) for (r, _, _), a, b in zip(found, first, after)]


def suppress(found: list[tuple[Rule, int, int]]) -> list[Detection]:
    """Detections that lie in none that an earlier rule (or the same one, further left) has made."""
    kept: list[Detection] = []
    starts: list[int] = []  # kept stretches that lie in no other kept one: both ends ascend
    ends: list[int] = []
    for r, a, n in sorted(found, key=lambda f: (f[0].number, f[1])):
        i = bisect_right(starts, a)
        if i and ends[i - 1] >= a + n:
            continue
        kept.append(Detection(r.number, r.label, a, n, r.confidence))
        low, high = bisect_left(starts, a), bisect_right(ends, a + n)
        if high > low:  # stretches within the new one no longer decide anything
            del starts[low:high], ends[low:high]
        starts.insert(low, a)
        ends.insert(low, a + n)
    return sorted(kept, key=lambda d: (d.first, d.rule))


def confidence(kept: list[Detection]) -> float:
    """1 - product of (1 - best confidence) over the labels found; 0 without any."""
    best: dict[str, float] = {}
    for d in kept:
        best[d.label] = max(best.get(d.label, 0.0), d.confidence)
    miss = 1.0
    for c in sorted(best.values()):
        miss *= 1.0 - c
    return 1.0 - miss


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_detections: bool = True) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score and, if
    asked for, detections array<struct<rule, label, first, words, confidence>> (those not suppressed).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lowered. n_base counts every place of the
    base phrases, suppressed or not; first_word and last_word are their smallest and largest first word (null
    without any). base_labels and labels (those of kept detections and the base ones) are distinct, sorted and
    comma-joined, '' if none. A null text has no words. Rows are independent: ids may repeat or be null. Whole
    texts are read whatever their length; memory follows the text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found_type = pa.list_(pa.struct([("rule", pa.int32()), ("label", pa.string()), ("first", pa.int64()),
                                     ("words", pa.int64()), ("confidence", pa.float64())]))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [found_type] * keep_detections
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
             *["detections"] * keep_detections]

    def row(text: bytes | None) -> tuple:
        words = words_of(text)
        found = detect(words)
        base = [(r, a) for r, a, _ in found if r.base]
        kept = suppress(found)
        base_labels = {r.label for r, _ in base}
        places = [a for _, a in base]
        out = (len(words), len(base), min(places, default=None), max(places, default=None),
               ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {d.label for d in kept})), confidence(kept))
        return (*out, [vars(d) for d in kept]) if keep_detections else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [row(t.as_py()) for t in batch.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), types)]], names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double"
        + ", detections array<struct<rule:int,label:string,first:bigint,words:bigint,confidence:double>>" * keep_detections)
