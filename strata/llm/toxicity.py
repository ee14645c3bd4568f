"""Toxicity scoring behind noisy-channel deobfuscation.

Places where a text may hide a word (leetspeak inside a word, letters set
apart, letters repeated) become character lattices; Viterbi search under a
character trigram model of the corpus picks the likeliest plain reading, and
the restored text is scored. Text without such a place has a lattice of one
path and stays as it is.

Three jobs: the trigram counts of all documents (28**3 numbers at most), the
word statistics of a bounded sample of labelled documents, and the scoring.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_bucket, cut

K = 28           # symbols: 0 no letter, 1-26 a-z (accents folded), 27 any other letter
OTHER = 27
BLOCK = 1 << 20  # characters of one text handled at a time

# What a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "2": "z", "6": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
SHORT = 3                 # letters of a fragment that rarely is a word of its own
TRAILS, LEADS = "!*0123456789", "(*$@+0123456789"  # signs that plain text puts after or before a word
SUB, KEEP, LEAD, TRAIL, DROP, REPEAT, BREAK = 0.7, 8.0, 3.0, 1.0, 0.4, 0.3, 3.0  # costs of the channel, in nats


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point of the basic plane: symbol; class (1 letter, 2 sign of LEET); letter that it may say.

    The last is 0 for what may stand between letters; i, l and their signs say i.
    """
    symbol, kind, says = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            base = unicodedata.normalize("NFD", ch)[0].lower()
            symbol[c] = ord(base) - 96 if "a" <= base <= "z" else OTHER
            kind[c] = 1
            says[c] = ord(base) if symbol[c] < OTHER else ord(ch.lower()[0])
        elif ch in LEET:
            kind[c] = 2
            says[c] = 0 if ch == "*" else ord(LEET[ch][0])
    says[says == ord("l")] = ord("i")
    return symbol, kind, says


SYMBOL, KIND, SAYS = _tables()
SYMBOLS = SYMBOL.tolist()
BLANK = np.isin(np.arange(1 << 16), [9, 10, 11, 12, 13, 32])


def _points(text: str) -> np.ndarray:
    """Code points; those beyond the basic plane count as one letter of no script."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)


def symbols(text: str) -> np.ndarray:
    """The text as symbols, runs of non-letters as one 0, with 0 at both ends."""
    s = np.concatenate([[0], SYMBOL[_points(text)], [0]]).astype(np.int32)
    return s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]


def count_trigrams(text: str, counts: np.ndarray) -> None:
    for at in range(0, max(len(text), 1), BLOCK):
        s = symbols(text[at:at + BLOCK])
        if len(s) > 2:
            counts += np.bincount((s[:-2] * K + s[1:-1]) * K + s[2:], minlength=K ** 3)


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of the third symbol after two others, from the whole texts of all rows.

    Each task adds up its own texts; at most 28**3 sums reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(K ** 3, np.int64)
        for b in batches:
            for t in b.column(0):
                count_trigrams(t.as_py() or "", counts)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], ["gram", "n"])

    sums = (docs.select(F.col(text_col).alias("t")).mapInArrow(run, "gram bigint, n bigint")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(K ** 3)
    for r in sums:
        counts[r.gram] = r.n
    return log_model(counts)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Trigram, bigram and unigram shares, mixed 0.75, 0.2 and 0.05."""
    c3 = counts.reshape(K, K, K)
    c2 = c3.sum(axis=0)
    c1 = c2.sum(axis=0)
    share = lambda c: c / np.maximum(c.sum(axis=-1, keepdims=True), 1)
    return np.log(0.75 * share(c3) + 0.2 * share(c2) + 0.05 * (0.99 * share(c1) + 0.01 / K)).ravel()


def suspicious(text: str, model: np.ndarray, points: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spans (start, end) to decode, apart from each other and in order.

    A sign next to a letter opens its token, a letter three times in a row its
    word. A doubled letter opens its word if the channel would rather have it
    once: its two readings differ in three terms only, since both leave the
    same last two symbols, so other words would decode to themselves.
    """
    points = _points(text) if points is None else points
    kind = KIND[points]
    letter = kind == 1
    if not letter.any():
        return []
    sign = kind == 2
    marks = np.flatnonzero((letter[1:] & sign[:-1]) | (letter[:-1] & sign[1:]))
    spans = []
    low = text.lower()
    p = _points(low) if len(low) == len(text) else points
    same = np.concatenate([[False], letter[1:] & (p[1:] == p[:-1]), [False]])  # a letter as the one before it
    twice = np.flatnonzero(same[:-1])
    if len(twice):
        s = np.concatenate([[0], SYMBOL[points] * letter, [0]]).astype(np.int64)  # s[i + 1] is the symbol of i
        before, own, after = s[twice - 1], s[twice], s[twice + 2]
        kept = model[(before * K + own) * K + own] + model[(own * K + own) * K + after]
        once = model[(before * K + own) * K + after] - REPEAT
        twice = twice[same[twice + 1] | same[twice - 1] | (once > kept)]
        if len(twice):
            ends = np.flatnonzero(~letter)
            for w in np.unique(np.searchsorted(ends, twice)).tolist():
                spans.append((int(ends[w - 1]) + 1 if w else 0, int(ends[w]) if w < len(ends) else len(text)))
    # three or more single letters or signs, at least one of them a letter, with anything between them
    alone = np.concatenate([[False], SAYS[points] > 0, [False]])
    starts, ends = np.flatnonzero(alone[1:-1] & ~alone[:-2]), np.flatnonzero(alone[1:-1] & ~alone[2:])
    run = np.flatnonzero(np.diff(np.concatenate([[False], starts == ends, [False]]).astype(np.int8)))
    for first, last in zip(run[::2].tolist(), (run[1::2] - 1).tolist()):
        if last - first >= 2 and letter[starts[first:last + 1]].any():
            spans.append((int(starts[first]), int(starts[last]) + 1))
    if len(marks):
        blank = np.flatnonzero(BLANK[points])
        where = np.searchsorted(blank, marks)
        for w in np.unique(where).tolist():
            a = int(blank[w - 1]) + 1 if w else 0
            b = int(blank[w]) if w < len(blank) else len(text)
            spans.append(_core(text, a, b))
    return _merged(spans)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if b <= a:
            continue
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _core(text: str, a: int, b: int) -> tuple[int, int]:
    """A token without the punctuation around it; signs stay on both sides."""
    while a < b and not (text[a].isalnum() or text[a] in LEET):
        a += 1
    while b > a and not (text[b - 1].isalnum() or text[b - 1] in LEET):
        b -= 1
    return a, b


def _between(ch: str) -> bool:
    return not (KIND[ord(ch)] if ord(ch) < 1 << 16 else ch.isalpha())


class Lattice:
    """Steps through a span; what they ask of their surroundings is found in two sweeps over it.

    ``plain``: signs around a token may be its punctuation or its number at a lower cost.
    """

    def __init__(self, span: str, plain: bool = True):
        n = len(span)
        self.plain = plain
        self.low = [c.lower() for c in span]
        apart = [_between(c) for c in span]
        self.run, self.gap = [1] * (n + 1), [0] * (n + 2)      # equal characters, and no letter or sign, from here on
        right, self.trail = [0] * (n + 2), [True] * (n + 1)    # letters and signs; only TRAILS up to the token's end
        for i in range(n - 1, -1, -1):
            if i + 1 < n and self.low[i] == self.low[i + 1]:
                self.run[i] = self.run[i + 1] + 1
            if apart[i]:
                self.gap[i] = self.gap[i + 1] + 1
            else:
                right[i] = right[i + 1] + 1
            self.trail[i] = span[i].isspace() or (span[i] in TRAILS and self.trail[i + 1])
        left, self.lead = [0] * (n + 1), [True] * (n + 1)      # of what ends before here
        for i in range(n):
            left[i + 1] = 0 if apart[i] else left[i] + 1
            self.lead[i + 1] = span[i].isspace() or (span[i] in LEADS and self.lead[i])
        self.left, self.right = left, right

    def steps(self, i: int) -> list[tuple[int, tuple[int, ...], float]]:
        """Steps from position i: (characters used, symbols said, cost)."""
        ch, run = self.low[i], self.run[i]
        point = ord(ch[0])
        s = SYMBOLS[point] if point < 1 << 16 else OTHER * ch.isalpha()
        if s:
            out = [(1, (s,), 0.0)]
            if run > 1:
                out.append((run, (s,), REPEAT))
            if run > 2:
                out.append((run, (s, s), 2 * REPEAT))
            return out
        if ch not in LEET:
            run = 1 + self.gap[i + 1]
            # between short fragments a break is odd; beside a longer one it is plain text
            odd = self.left[i] <= SHORT and self.right[i + run] <= SHORT
            return [(run, (0,), BREAK if odd else 0.0), (run, (), DROP)]
        out = [(1, (0,), BREAK if ch == "*" else KEEP)]
        if self.plain and ch in TRAILS and self.trail[i]:
            out = [(run, (0,), TRAIL)]
        elif self.plain and ch in LEADS and self.lead[i + 1]:
            out = [(run, (0,), LEAD)]
        if ch == "*":
            out.append((1, (), DROP))
        for c in LEET.get(ch, ""):
            x = ord(c) - 96
            cost = SUB + LEET_COST[ch]
            out.append((1, (x,), cost))
            if run > 1:
                out += [(run, (x,), cost + REPEAT), (run, (x, x), cost + REPEAT)]
        return out


LEET_COST = {ch: math.log(len(letters)) for ch, letters in LEET.items()}
SETTLE = 4096  # positions after which what all paths share is written out


def decode(span: str, model: list[float], keep: bool = False, plain: bool = True) -> str:
    """The cheapest reading of a span; 0 is written as a space and OTHER as the character itself.

    With ``keep``, a character that is said unchanged is written as it stands.

    Viterbi over (position, last two symbols); the work per character is
    bounded by the number of symbol pairs that its lattice allows. Every
    ``SETTLE`` positions the part that all open paths have in common is
    written out, so a long span holds no more than the part still open.
    """
    n = len(span)
    lattice = Lattice(span, plain)
    at: dict[int, dict] = {0: {0: (0.0, None, 0, ())}}  # by position; a state is first symbol * K + second
    out, settled, check = [], (0, 0), SETTLE
    for i in range(n):
        here = at.get(i)
        if not here:
            continue
        if i >= check:
            settled = _settle(span, at, i, settled, keep, out)
            check = i + SETTLE
        for step, said, cost in lattice.steps(i):
            to = at.get(i + step)
            if to is None:
                to = at[i + step] = {}
            for state, before in here.items():
                total, end = before[0] + cost, state
                for s in said:
                    if s or end % K:  # runs of non-letters count once
                        end = end * K + s
                        total -= model[end]
                        end %= PAIRS
                old = to.get(end)
                if old is None or total < old[0]:
                    to[end] = (total, i, state, said)
    last = min(at[n].items(), key=lambda kv: kv[1][0] - (model[kv[0] * K] if kv[0] % K else 0.0))[0]
    out += _written(span, at, n, last, settled[0], keep)
    return "".join(out)


PAIRS = K * K


def _written(span: str, at: dict[int, dict], i: int, state: int, stop: int, keep: bool) -> list[str]:
    """What the path into this state says from position ``stop`` on."""
    out = []
    while i > stop:
        _, back, before, said = at[i][state]
        if keep and said and said[0] == 0:
            out.append(span[back:i])
        elif keep and said and KIND[min(ord(span[back]), 0xFFFF)] & 1:
            out.append(span[back:back + len(said)])
        else:
            out.append("".join(" " if s == 0 else chr(s + 96) if s < OTHER else span[back] for s in said))
        i, state = back, before
    return out[::-1]


def _settle(span: str, at: dict[int, dict], i: int, settled: tuple[int, int], keep: bool,
            out: list[str]) -> tuple[int, int]:
    """Write out what all paths open at position i share, and forget it; returns where that ends."""
    open_ends = [(j, state) for j, states in at.items() if j >= i for state in states]
    path = set()
    j, state = open_ends[0]
    while j > settled[0]:
        path.add((j, state))
        _, j, state = at[j][state][:3]
    path.add((j, state))
    common = open_ends[0]
    for j, state in open_ends:
        while (j, state) not in path:
            _, j, state = at[j][state][:3]
        common = min(common, (j, state))
    out += _written(span, at, *common, settled[0], keep)
    for j in [j for j in at if j < common[0]]:
        del at[j]
    return common


class Restorer:
    """Restores texts under one model; remembers short spans."""

    def __init__(self, model: np.ndarray):
        self.array, self.model, self.known = model, model.tolist(), {}

    def span(self, span: str) -> tuple[str, str]:
        """The reading of a span, and the one in which no sign around a token is punctuation."""
        got = self.known.get(span)
        if got is None:
            got = self._read(span)
            if len(span) <= 64:
                if len(self.known) > 100_000:
                    self.known.clear()
                self.known[span] = got
        return got

    def _read(self, span: str) -> tuple[str, str]:
        if span.isalpha() and not THRICE.search(span):
            once = self._undouble(span)
            return once, once
        got = decode(span, self.model, True)
        around = span[0] in LEADS or span[-1] in TRAILS or AROUND.search(span)
        return got, decode(span, self.model, True, False) if around else got

    def _undouble(self, word: str) -> str:
        """decode() of a word whose only choices are doubled letters, each one apart from the others."""
        model, low = self.model, word.lower()
        s = [0, *[SYMBOLS[min(ord(c), 0xFFFF)] for c in word], 0]  # s[i + 1] is the symbol of i
        out = [word[0]]
        for i in range(1, len(word)):
            if low[i] == low[i - 1]:
                a, b, c = s[i - 1], s[i], s[i + 2]
                if model[(a * K + b) * K + c] - REPEAT > model[(a * K + b) * K + b] + model[(b * K + b) * K + c]:
                    continue
            out.append(word[i])
        return "".join(out)

    def read(self, text: str, points: np.ndarray | None = None) -> tuple[str, list[str], list[str]]:
        """The restored text, the spans that were replaced in it, and other readings of spans."""
        out, spans, others, done = [], [], [], 0
        known, span = self.known, self.span
        for a, b in suspicious(text, self.array, points):
            own = text[a:b]
            got, other = known.get(own) or span(own)
            if other != got:
                others.append(other)
            if got != own:
                out += [text[done:a], got]
                spans.append(own)
                done = b
        return "".join([*out, text[done:]]), spans, others

    def restore(self, text: str) -> tuple[str, list[str]]:
        return self.read(text)[:2]


THRICE = re.compile(r"(.)\1\1", re.IGNORECASE | re.DOTALL)
AROUND = re.compile(r"(?:^|\s)[(*$@+0-9]|[!*0-9](?:\s|$)")
WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8)


def fold(text: str) -> str:
    """Lower case, letters of a-z without their accents, as a decoded sign says them; other letters stay."""
    text = text.lower()
    if text.isascii():
        return text
    c = np.frombuffer(unicodedata.normalize("NFC", text).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(c < 1 << 16, BARE[np.minimum(c, 0xFFFF)], c).tobytes().decode("utf-32-le", "surrogatepass")


BARE = np.where((0 < SYMBOL) & (SYMBOL < OTHER) & (np.arange(1 << 16) > 127), SYMBOL + 96,
                np.arange(1 << 16)).astype(np.uint32)


def word_features(text: str) -> set[str]:
    """Whole words ('word ') and word beginnings ('word') of a restored text, folded."""
    words = set(WORDS.findall(fold(text)))
    out = {w + " " for w in words}
    for k in PREFIXES:
        out.update(w[:k] for w in words if len(w) >= k)
    return out


def joinable(features: Iterable[str]) -> ahocorasick.Automaton | None:
    """What whole words say by SAYS, repeated letters once; the value tells whether one is a beginning too.

    Mere beginnings are left to plain text: 'los ta' would say many of them.
    """
    says: dict[str, list] = {}
    features = set(features)
    for f in features:
        if not f.endswith(" "):
            continue
        c = SAYS[_points(f.strip())]
        c = c[np.concatenate([[True], c[1:] != c[:-1]])].tobytes().decode("utf-32-le") if len(c) and c.all() else ""
        if len(c) > 1:
            says[c] = [len(c), says.get(c, [0, False])[1] or f[:-1] in features]
    if not says:
        return None
    out = ahocorasick.Automaton()
    for c, value in says.items():
        out.add_word(c, tuple(value))
    out.make_automaton()
    return out


def split_words(text: str, features: ahocorasick.Automaton | None,
                points: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spans of two or more fragments whose letters and signs may say a feature; the decoder decides.

    A span begins with a fragment; it ends with one, or has the rest of the last one if a word said is a beginning too.
    """
    if features is None:
        return []
    points = _points(text) if points is None else points
    says = SAYS[points]
    unit = np.flatnonzero(says)
    if not len(unit):
        return []
    c = says[unit]
    new = np.concatenate([[True], c[1:] != c[:-1]])
    group = np.cumsum(new) - 1
    letter = np.concatenate([[False], KIND[points] == 1, [False]])
    first, last = np.full(group[-1] + 1, -1), np.full(group[-1] + 1, -1)
    at = np.flatnonzero(~letter[unit])          # no letter before it
    first[group[at]] = unit[at]
    at = np.flatnonzero(~letter[unit + 2])      # no letter after it
    last[group[at]] = unit[at]
    final = unit[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(unit) - 1]])]
    gaps, out = np.cumsum(says == 0), set()
    starts = (first >= 0).tobytes()
    for end, (n, prefix) in features.iter(c[new].tobytes().decode("utf-32-le")):
        if not starts[end - n + 1]:
            continue
        a, b = int(first[end - n + 1]), int(last[end])
        if b < 0 and prefix:
            b = int(final[end])
            while b + 1 < len(text) and says[b + 1]:
                b += 1
        if b > a and gaps[b] > gaps[a]:
            out.add((a, b + 1))
    return sorted(out)


@dataclass
class Model:
    """``weights``: feature -> probability that a document with it is toxic; ``base``: of one with none."""

    language: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    base: float = 0.0
    plain: set[str] = field(default_factory=set)  # features that clean fragments say too: no join counts for them


class Scorer:
    def __init__(self, model: Model):
        self.model, self.restorer = model, Restorer(model.language)
        self.automaton = None
        if model.weights:
            self.automaton = ahocorasick.Automaton()
            for f in model.weights:
                self.automaton.add_word(f.strip(), f.strip())
            self.automaton.make_automaton()
        self.apart = joinable(set(model.weights) - model.plain)

    def found(self, text: str) -> set[str]:
        if self.automaton is None:
            return set()
        text = fold(text)
        out = set()
        for end, word in self.automaton.iter(text):
            start = end - len(word) + 1
            if start and text[start - 1].isalpha():
                continue
            if word in self.model.weights:
                out.add(word)
            if word + " " in self.model.weights and not text[end + 1:end + 2].isalpha():
                out.add(word + " ")
        return out

    def joined(self, text: str, points: np.ndarray | None = None) -> set[str]:
        """The features that fragments of the text say."""
        said = [w for a, b in split_words(text, self.apart, points) for w in self.restorer.span(text[a:b])]
        return self.found(" ".join(said)) - self.model.plain if said else set()

    def score(self, text: str | None) -> float:
        """1 minus the product of the features' clean probabilities; the base rate when none is there."""
        text = text or ""
        points = _points(text)
        restored, spans, others = self.restorer.read(text, points)
        found = self.found(restored)
        found |= self.joined(text, points)
        if spans or others:
            found |= self.found(" ".join([*spans, *others]))
        if not found:
            return self.model.base
        clean = 1.0
        for f in sorted(found):
            clean *= 1.0 - self.model.weights[f]
        return max(1.0 - clean, self.model.base)


SHINGLE = 3


def signature(text: str) -> list[int]:
    """Four min-hashes over the text's word triples; near copies share at least two of them."""
    words = WORDS.findall(text.lower())
    if not words:
        return [0, 0, 0, 0]
    h = np.array([zlib.crc32(" ".join(words[i:i + SHINGLE]).encode()) for i in range(max(len(words) - SHINGLE + 1, 1))],
                 np.uint64)
    mix = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]
    return [int(((h * np.uint64(m)) >> np.uint64(1)).min()) for m in mix]


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 8_000, max_clean: int = 20_000,
        support: int = 5, features: int = 2_000, precision: float = 0.9, chance: float = 1e-6,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The language model of all ``docs`` and word weights from a bounded sample of ``labels``.

    The sample holds at most ``max_toxic`` and ``max_clean`` labelled ids, those
    with the least md5; an id with several labels is toxic if one says so; null
    ids or labels teach nothing. Of near copies in the sample one teaches (else
    every word of a document copied a thousand times would look telling). A
    feature counts if ``support`` toxic documents hold it, at least
    ``precision`` of its documents, weighted back to all labels, are toxic, and
    so many would be toxic with a probability below ``chance`` (Chernoff bound)
    if it said nothing; at most ``features`` are kept, those with most
    documents. Without labels every score is the base rate.
    """
    language = language_model(docs, text_col)
    truth = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    sizes = {r.y: r.n for r in truth.where("y in (0, 1)").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    model = Model(language, {}, (sizes.get(1, 0) + 0.5) / (total + 1) if total else 0.0)
    if len(sizes) < 2:
        return model
    pick = lambda y, n: truth.where(F.col("y") == y).orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(n)
    chosen = pick(1, max_toxic).union(pick(0, max_clean))
    # of the rows that repeat an id, the text with the least sha256 teaches
    text = F.coalesce(F.col("t"), F.lit(""))
    # all are bounded by max_toxic + max_clean: the ids that are broadcast, the rows written and those collected
    sample = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
                 .join(F.broadcast(chosen), "id").groupBy("id", "y")
                 .agg(F.min_by("t", F.sha2(text.cast("binary"), 256)).alias("t")).select("id", "y", "t"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [signature(t.as_py() or "") for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.list_(pa.int64()))],
                                             ["id", "y", "s"])

    kind = sample.schema["id"].dataType.simpleString()
    seen: dict[tuple[int, int, int], int] = {}
    used, held = [], Counter()
    for r in sorted(sample.mapInArrow(sign, f"id {kind}, y int, s array<bigint>").collect()):
        marks = [(r.y, k, v) for k, v in enumerate(r.s)]
        shared = Counter(seen[m] for m in marks if m in seen)
        if not shared or max(shared.values()) < 2:
            used.append(r.id)
            held[r.y] += 1
        first = shared.most_common(1)[0][0] if shared and max(shared.values()) > 1 else len(used)
        for m in marks:
            seen.setdefault(m, first)
    scale = {y: sizes[y] / max(held[y], 1) for y in (0, 1)}
    taught = docs.sparkSession.createDataFrame([(i,) for i in used], f"id {kind}")
    sample = sample.join(F.broadcast(taught), "id", "left_semi").select("y", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, sums = Restorer(language), (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = [*sums[0], *(k for k in sums[1] if k not in sums[0])]
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([sums[1][k] for k in keys], pa.int64()),
                 pa.array([sums[0][k] for k in keys], pa.int64())], ["f", "toxic", "clean"])
            sums[0].clear()
            sums[1].clear()
            return out

        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                sums[y].update(word_features(restorer.restore(t.as_py() or "")[0]))
                if len(sums[0]) + len(sums[1]) > 200_000:
                    yield flush()
        yield flush()

    if not held[0] or not held[1]:
        return model
    # n * KL(share of toxic among the feature's documents || share in the sample)
    n, p0 = F.col("toxic") + F.col("clean"), held[1] / (held[0] + held[1])
    share = F.col("toxic") / n
    surprise = n * (share * F.log(share / p0)
                    + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - p0))).otherwise(0.0))
    # a toxic document weighs sizes[1] / held[1], a clean one sizes[0] / held[0]
    toxic, clean = F.col("toxic") * scale[1], F.col("clean") * scale[0]
    for r in (sample.mapInArrow(count, "f string, toxic bigint, clean bigint").groupBy("f")
              .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where((F.col("toxic") >= support) & (toxic >= precision * (toxic + clean))
                     & (share > p0) & (surprise >= -math.log(chance)))
              .orderBy(F.desc("toxic"), "clean", "f").limit(features).collect()):
        model.weights[r.f] = (r.toxic * scale[1] + 0.5) / (r.toxic * scale[1] + r.clean * scale[0] + 1)
    model.base = min(model.base, 0.49)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, sums = Scorer(model), (Counter(), Counter())
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                sums[y].update(scorer.joined(t.as_py() or ""))
        keys = sorted({*sums[0], *sums[1]})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([sums[1][k] for k in keys], pa.int64()),
                                          pa.array([sums[0][k] for k in keys], pa.int64())], ["f", "toxic", "clean"])

    # the sample's fragments are held to the same precision as its words; at most ``features`` rows
    model.plain = {r.f for r in sample.mapInArrow(join, "f string, toxic bigint, clean bigint").groupBy("f")
                   .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                   .where((F.col("clean") > 0) & (toxic < precision * (toxic + clean))).select("f").collect()}
    return model


ROWS = 512  # rows of a batch that are scored and passed on at once


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score double and predicted int (score >= 0.5) for each row.

    Null and empty texts hold no feature and get the base rate. Rows are
    independent; an empty table stays empty.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_t"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 28**3 numbers and at most ``features`` words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in batches:
            s = [scorer.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())],
                [id_col, "score", "predicted"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, score double, "
                                f"predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic by a model fitted on the training folds of ``labels``.

    Rows pass through the workers once, with the columns that they have (whatever their names), and come back
    in slices of ``ROWS``, so that no task holds a second copy of a large batch. Null and empty texts stay;
    an empty table stays empty; a text of any length is scored whole.
    """
    model = fit(docs, training(labels, id_col), id_col=id_col, text_col=text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                yield b.filter(pa.array([scorer.score(t.as_py()) < 0.5 for t in b.column(text)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labelled rows that may be learned from: crc32 of the id modulo 5 is not 0."""
    return labels.where(crc_bucket(F.col(id_col), 5) != 0)
