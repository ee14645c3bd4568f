"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the product
(binding) of its letters' vectors, each rotated (permuted) by its distance
from the n-gram's end; a text is the sum (bundle) of its n-grams; a language
is the bundle of its training texts. A text belongs to the language whose
bundle has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 2_048
N = 3
SEED = 42
BLOCK = 1 << 18          # characters of one text handled at a time
GRAMS = 12_000           # n-gram vectors that one Python worker keeps (4 bytes a dimension)
TEXTS = 64               # blocks of texts bundled by one product
LANGUAGES = 10_000       # prototypes that may be sent to the workers


class Encoder:
    """Letter and n-gram vectors, made on demand from the seed and kept within bounds."""

    def __init__(self, dim: int = DIM, n: int = N, seed: int = SEED):
        self.dim, self.n, self.seed = dim, n, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.kept = np.empty((GRAMS, dim), np.float32)
        self.taken = np.empty((GRAMS // 4, dim), np.float32)

    def letter(self, point: int) -> np.ndarray:
        got = self.letters.get(point)
        if got is None:
            if len(self.letters) >= GRAMS:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=[self.seed, point])).integers(0, 2, self.dim, np.int8)
            got = self.letters[point] = (2 * bits - 1).astype(np.int8)
        return got

    def gram(self, code: int) -> np.ndarray:
        """The vector of an n-gram: letters bound after rotation by their place."""
        out = np.ones(self.dim, np.int8)
        for place in range(self.n):
            out = out * np.roll(self.letter(code >> 21 * place & 0x1FFFFF), place)
        return out

    def codes(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct n-grams and their counts, block by block; words are set off by one space."""
        step = BLOCK
        for at in range(0, len(text), step):
            # blocks overlap by the n - 1 characters that an n-gram may begin with
            piece = text[max(0, at - self.n + 1):at + step].lower()
            points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            points = np.where(_is_letter(points), points, 32)
            if at == 0:
                points = np.concatenate([[32], points])
            if at + step >= len(text):
                points = np.concatenate([points, [32]])
            points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
            if len(points) < self.n:
                continue
            code = np.zeros(len(points) - self.n + 1, np.int64)
            for place in range(self.n):
                code |= points[self.n - 1 - place:len(points) - place] << 21 * place
            # a lone boundary says nothing
            yield np.unique(code, return_counts=True)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of these n-grams (at most GRAMS // 4 at once), until the next call."""
        missing = [c for c in codes.tolist() if c not in self.rows]
        if len(self.rows) + len(missing) > GRAMS:
            self.rows.clear()
            missing = codes.tolist()
        for c in missing:
            self.rows[c] = at = len(self.rows)
            self.kept[at] = self.gram(c)
        rows = [self.rows[c] for c in codes.tolist()]
        return np.take(self.kept, rows, axis=0, out=self.taken[:len(rows)], mode="clip")

    def bundle(self, text: str) -> np.ndarray:
        return self.bundles([text])[0]

    def bundles(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The bundle of each text.

        Up to TEXTS blocks share one product of their counts by the vectors of
        the n-grams that any of them has, so a vector is fetched once for all.
        Counts of a block are below 2**24: single precision is exact.
        """
        out: list[np.ndarray] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for text in texts:
            out.append(np.zeros(self.dim))
            for codes, counts in self.codes(text):
                held.append((out[-1], codes, counts))
                size += len(codes)
                if len(held) == TEXTS or size >= BLOCK:
                    self._add(held)
                    held, size = [], 0
        if held:
            self._add(held)
        return out

    def _add(self, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        block = np.repeat(np.arange(len(held)), [len(codes) for _, codes, _ in held])
        counts = np.concatenate([k for _, _, k in held])
        codes, place = np.unique(np.concatenate([c for _, c, _ in held]), return_inverse=True)
        step = GRAMS // 4
        for at in range(0, len(codes), step):
            part = codes[at:at + step]
            own = (place >= at) & (place < at + step)
            times = np.zeros((len(held), len(part)), np.float32)
            times[block[own], place[own] - at] = counts[own]
            for (out, _, _), v in zip(held, times @ self.vectors(part)):
                out += v


_LETTER: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _LETTER[points]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def prototypes(docs: DataFrame, dim: int = DIM, n: int = N, seed: int = SEED, text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """(lang, vector array<bigint>): the bundle of all texts of each non-null language.

    Each task adds up its own texts by language; the sums are added by
    (language, dimension), so neither a language that has most of the rows nor
    the number of tasks meets in one place. Texts without a letter add nothing;
    a language with no letter at all has no prototype. Components are whole
    numbers, so the order of adding does not matter.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dim, n, seed)
        counts: dict[str, dict[int, int]] = {}
        sums: dict[str, np.ndarray] = {}

        def fold() -> None:
            for lang, grams in counts.items():
                codes, total = np.array(list(grams)), np.array(list(grams.values()), np.float64)
                out = sums.setdefault(lang, np.zeros(dim))
                for at in range(0, len(codes), GRAMS // 4):
                    out += total[at:at + GRAMS // 4] @ encoder.vectors(codes[at:at + GRAMS // 4])
            counts.clear()

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_py() or ""
                if not has_letter(text):
                    continue
                own = counts.setdefault(lang, {})
                for codes, times in encoder.codes(text):
                    for c, k in zip(codes.tolist(), times.tolist()):
                        own[c] = own.get(c, 0) + k
            if sum(map(len, counts.values())) > 100_000:
                fold()
        fold()
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)),
                                              pa.array(np.rint(v).astype(np.int64))], ["lang", "k", "v"])

    parts = rows.mapInArrow(run, "lang string, k int, v bigint").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    return parts.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))),
                                                 lambda x: x["v"]).alias("vector"))


def identify(docs: DataFrame, model: DataFrame, dim: int = DIM, n: int = N, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score for each row: the nearest prototype and the cosine with it, not below 0.

    A null text or one without a letter is ``und`` with score 0; so is every
    text when there is no prototype. Ties go to the language that comes first.
    Rows are independent; an empty table stays empty. The prototypes of at
    most LANGUAGES languages are sent to the workers.
    """
    rows = model.orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    names = [r.lang for r in rows]
    matrix = np.array([r.vector for r in rows], np.float64).reshape(len(rows), dim)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    sent = docs.sparkSession.sparkContext.broadcast((names, matrix))
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = sent.value
        encoder = Encoder(dim, n, seed)
        for b in batches:
            langs, scores = ["und"] * b.num_rows, [0.0] * b.num_rows
            for at in range(0, b.num_rows if names else 0, TEXTS):
                part = b.column(1).slice(at, TEXTS)
                for i, (t, v) in enumerate(zip(part, encoder.bundles(t.as_py() or "" for t in part)), at):
                    if not has_letter(t.as_py() or ""):
                        continue
                    cosine = matrix @ v / max(float(np.linalg.norm(v)), 1e-300)
                    best = int(np.argmax(cosine))
                    langs[i], scores[i] = names[best], min(max(float(cosine[best]), 0.0), 1.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [id_col, "lang_pred", "score"])

    return texts.mapInArrow(run, f"`{id_col}` {texts.schema[id_col].dataType.simpleString()}, "
                                 "lang_pred string, score double")
