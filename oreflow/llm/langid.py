"""Language by hyperdimensional profiles.

Each letter has a random vector of +1 and -1.  An n-gram is the product of its
letters' vectors, each permuted (rotated) by its place; a text is the sum of its
n-grams.  The sums of the texts of a language make its prototype.  A text gets the
language whose prototype, less the mean of all, has the greatest cosine with it.

All sums are of whole numbers and so the same in any order.  A text's n-grams are
counted first; the vectors come in as one product of counts with n-gram vectors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bucket_of, with_fields

DIMENSIONS = 1024
GRAM = 3
SEED = 7
UNKNOWN = "und"
#: Sharpness of the score: a softmax over cosines.
SHARPNESS = 12.0
#: So many lang values are learned, those with the most texts (ties: the lesser name).
MOST_LANGUAGES = 5000
#: Distinct n-grams whose vectors are held at once.
BLOCK = 8192
#: Characters that are counted at once.
PORTION = 1 << 18
#: Rows whose bucket (crc32 of doc_id as text, modulo) is this are never learned from.
FOLDS, HELD_OUT = 4, 2

_BORDER = 0  # stands for all that lies between words


class Space:
    """Letter vectors, made from their code points when first met, and texts as their sums."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, seed: int = SEED):
        self.dimensions, self.gram, self.seed = dimensions, gram, seed
        self._row: dict[int, int] = {}
        self._letters = np.zeros((0, gram, dimensions), np.int8)
        code_points = np.arange(0x110000)
        alpha = np.zeros(0x110000, bool)
        alpha[: 0xD800] = [chr(i).isalpha() for i in code_points[:0xD800]]
        alpha[0xE000:] = [chr(i).isalpha() for i in code_points[0xE000:]]
        self._code = np.where(alpha, code_points, _BORDER)

    def _vectors(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers of the letters' vectors."""
        unique, inverse = np.unique(codes, return_inverse=True)
        fresh = [c for c in unique.tolist() if c not in self._row]
        if fresh:
            if len(self._row) + len(fresh) > 20_000:
                self._row, fresh = {}, unique.tolist()
                self._letters = self._letters[:0]
            made = np.empty((len(fresh), self.gram, self.dimensions), np.int8)
            for at, code in enumerate(fresh):
                bits = np.random.default_rng((self.seed, code)).integers(0, 2, self.dimensions)
                vector = (2 * bits - 1).astype(np.int8)
                made[at] = [np.roll(vector, self.gram - 1 - place) for place in range(self.gram)]
                self._row[code] = len(self._row)
            self._letters = np.concatenate([self._letters, made])
        return np.array([self._row[c] for c in unique.tolist()], np.int64)[inverse]

    def letters(self, text: str) -> np.ndarray:
        """Code points of the lower-cased letters, with one border around and between words."""
        data = text.lower().encode("utf-32-le", "replace")
        codes = self._code[np.frombuffer(data, "<u4")]
        codes = np.concatenate([[_BORDER], codes, [_BORDER]])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != _BORDER) | (codes[:-1] != _BORDER)
        return codes[keep]

    def sums(self, groups: list[tuple[int, np.ndarray]], number: int) -> np.ndarray:
        """For each of ``number`` groups the sum of the n-grams of its letters."""
        out = np.zeros((number, self.dimensions), np.float64)
        held, size = [], 0
        for group, codes in groups:
            for at in range(0, max(1, len(codes) - self.gram + 1), PORTION):
                part = codes[at : at + PORTION + self.gram - 1]
                held.append((group, part))
                size += len(part)
                if size >= PORTION:
                    self._add(held, out)
                    held, size = [], 0
        self._add(held, out)
        return out

    def _add(self, parts: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        parts = [(g, codes) for g, codes in parts if len(codes) >= self.gram]
        if not parts:
            return
        groups, where = np.unique([g for g, _ in parts], return_inverse=True)
        windows, owner = [], []
        for (_, codes), at in zip(parts, where.tolist(), strict=True):
            grams = np.lib.stride_tricks.sliding_window_view(codes, self.gram)
            grams = grams[(grams[:, 1:-1] != _BORDER).all(1)]
            windows.append(grams)
            owner.append(np.full(len(grams), at))
        grams, owner = np.concatenate(windows), np.concatenate(owner)
        rows = self._vectors(grams.ravel()).reshape(grams.shape)
        key = rows[:, 0]
        for place in range(1, self.gram):
            key = key * len(self._row) + rows[:, place]
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(first) > BLOCK:
            by_gram = np.argsort(inverse, kind="stable")
            inverse, owner = inverse[by_gram], owner[by_gram]
        for low in range(0, len(first), BLOCK):
            block = first[low : low + BLOCK]
            at, until = (0, len(inverse)) if len(first) <= BLOCK else np.searchsorted(inverse, [low, low + BLOCK])
            vectors = self._letters[rows[block, 0], 0]
            for place in range(1, self.gram):
                vectors = vectors * self._letters[rows[block, place], place]
            vectors = vectors.astype(np.float32)
            # the groups that have such n-grams, some at a time
            for some in range(0, len(groups), BLOCK // 8):
                own, cell = owner[at:until], inverse[at:until] - low
                if len(groups) > BLOCK // 8:
                    inside = (own >= some) & (own < some + BLOCK // 8)
                    own, cell = own[inside], cell[inside]
                number = min(BLOCK // 8, len(groups) - some)
                cells = np.bincount((own - some) * len(block) + cell, minlength=number * len(block))
                counts = cells.reshape(number, len(block)).astype(np.float32)
                out[groups[some : some + number]] += counts @ vectors


_SPACES: dict[tuple[int, int, int], Space] = {}


def space(dimensions: int, gram: int, seed: int) -> Space:
    key = (dimensions, gram, seed)
    if key not in _SPACES:
        _SPACES[key] = Space(*key)
    return _SPACES[key]


def prototypes(
    labelled: DataFrame, dimensions: int = DIMENSIONS, gram: int = GRAM, seed: int = SEED
) -> dict[str, np.ndarray]:
    """The sum of all texts of each lang; rows with null lang or text teach nothing.

    Each task adds up its own texts; the driver gets one vector a language, of the
    MOST_LANGUAGES with the most texts: a lang column of more values teaches those.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space(dimensions, gram, seed)
        total: dict[str, np.ndarray] = {}
        texts_of: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            vectors = pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))
            n = pa.array([texts_of[lang] for lang in total], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(total)), n, vectors], names=["lang", "n", "vector"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            number = {name: at for at, name in enumerate(names)}
            texts = batch.column("text").to_pylist()
            groups = ((number[l], own.letters(t)) for l, t in zip(langs, texts, strict=True))
            for name, vector in zip(names, own.sums(groups, len(names)), strict=True):
                total[name] = total.get(name, 0) + vector
            texts_of.update(langs)
            if len(total) > 1000:
                yield rows()
                total.clear()
                texts_of.clear()
        if total:
            yield rows()

    parts = labelled.select("lang", "text").where("lang is not null and text is not null")
    parts = parts.mapInArrow(add, "lang string, n long, vector array<double>")
    summed = parts.select("lang", "n", F.posexplode("vector").alias("at", "x"))
    summed = summed.groupBy("lang", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    whole = summed.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("v"),
        F.max("n").alias("n"),
    )
    found = whole.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    return {row["lang"]: np.array(row["v"]) for row in sorted(found, key=lambda r: r["lang"])}


class Judge:
    """Cosines of texts with prototypes."""

    def __init__(self, of: dict[str, np.ndarray], sharpness: float = SHARPNESS):
        self.names = [name for name, v in of.items() if np.any(v)]
        rows = np.array([of[name] / np.linalg.norm(of[name]) for name in self.names])
        if len(rows) > 1:
            rows = rows - rows.mean(0)
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
        self._rows, self._sharpness = rows, sharpness

    def __call__(self, sums: np.ndarray) -> list[tuple[str, float]]:
        if not self.names:
            return [(UNKNOWN, 0.0)] * len(sums)
        norms = np.linalg.norm(sums, axis=1)
        cosines = sums @ self._rows.T / np.maximum(norms, 1e-12)[:, None]
        likely = np.exp(self._sharpness * (cosines - cosines.max(1, keepdims=True)))
        likely /= likely.sum(1, keepdims=True)
        best = cosines.argmax(1)
        return [
            (self.names[b], float(min(1.0, likely[at, b]))) if norms[at] else (UNKNOWN, 0.0)
            for at, b in enumerate(best.tolist())
        ]


def predict(
    documents: DataFrame,
    of: dict[str, np.ndarray],
    dimensions: int = DIMENSIONS,
    gram: int = GRAM,
    seed: int = SEED,
) -> DataFrame:
    """``documents`` with lang_pred and score (in place of such columns); only ``text`` is looked at.

    Null texts and texts without a letter are ``und``, score 0, as is all if nothing
    was learned.  Equal cosines: the lesser name.
    """
    documents = documents.drop("lang_pred", "score")
    judge = documents.sparkSession.sparkContext.broadcast(Judge(of))
    schema = with_fields(documents, "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space(dimensions, gram, seed)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            groups = ((at, own.letters(t)) for at, t in enumerate(texts) if t)
            found = judge.value(own.sums(groups, len(texts)))
            names, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return documents.mapInArrow(run, schema)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    held_out = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    learned = prototypes(documents.where(~held_out))
    return predict(documents.select("doc_id", held_out.alias("held_out"), "text"), learned).drop("text")
