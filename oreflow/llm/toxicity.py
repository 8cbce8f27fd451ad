"""Toxicity by multiple-instance learning with noisy-or.

A text is a bag of sentences.  A sentence is toxic with probability
p = sigmoid(bias + weights of its words), where a word weighs what its letter n-grams and
the word as a whole do (so endings and made-up forms don't hide a stem); the text is toxic if any sentence is.
The bias counts once a text and a sentence by what it has above the bias, so plain
sentences add nothing, however many there are: with q = 1 - sigmoid(bias),
P = 1 - q * product of min(1, (1 - p) / q).  Labels are of texts alone; fitting the likelihood of
P finds the sentences that account for them, and scoring says which these are.

The classifier is fitted on a bounded sample of the labelled rows that have a text:
SAMPLE texts of either label, chosen by a hash of doc_id and text, in one task.
Scores then need no shuffle.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import bucket_of, slices, staged, with_fields

#: Bounds of the sample, for each label: texts, and characters of all of them before the
#: last one.  A text that is longer than all may be together is not learned from.
SAMPLE = 3000
SAMPLE_CHARS = 20_000_000
#: Length of the n-grams; word ends count as letters.
GRAM = 4
#: Only features whose texts tell the labels apart have weights: by the likelihood
#: ratio statistic at least, and the FEATURES with the most of it.
LEAST_RATIO = 20.0
FEATURES = 5000
ROUNDS = 300
RATE = 0.5
#: Pull of the weights to zero, and what counts as zero when the fit is done.
DECAY = 2e-6
NEGLIGIBLE = 0.01
FIRST_BIAS = -5.0
FOLDS, HELD_OUT = 5, 0
#: A sentence of at least this probability is reported.
OFFENDING = 0.5
RUN_CHARS = 1 << 19

#: Distinct words whose weight a task remembers.
KNOWN_WORDS = 400_000

_HASHES = 1 << 40
_LEAST_LOGIT = math.log(OFFENDING / (1 - OFFENDING))
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, words) of each sentence; words in lower case."""
    for found in _SENTENCE.finditer(text):
        words = set(_WORD.findall(found.group().lower()))
        if words:
            yield found.start(), found.end(), words


def features(word: str) -> set[str]:
    """What a word is scored by: its n-grams and itself, both with its ends marked."""
    marked = f"^{word}$"
    return {marked, *(marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1))}


class _Runs:
    """Whole numbers in runs, one behind the other: a list of lists in a few bytes a number."""

    def __init__(self) -> None:
        self.flat, self.ends = array("i"), array("q", [0])

    def add(self, run: Iterable[int]) -> None:
        self.flat.extend(run)
        self.ends.append(len(self.flat))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of these numbers in a row, and how long each is."""
        flat, ends = np.frombuffer(self.flat, np.int32), np.frombuffer(self.ends, np.int64)
        sizes = ends[numbers + 1] - ends[numbers]
        upto = np.cumsum(sizes)
        where = np.arange(upto[-1] if len(upto) else 0) + np.repeat(ends[numbers + 1] - upto, sizes)
        return flat[where], sizes


def _telling(texts: list[np.ndarray], labels: list[int], made_of: _Runs, names: list[str]) -> np.ndarray:
    """Features whose presence in a text says most of its label (G statistic), by name."""
    have = np.zeros((2, len(names)))
    for words, label in zip(texts, labels, strict=True):
        have[label, np.unique(made_of.of(np.unique(words))[0])] += 1
    number = np.bincount(labels, minlength=2).astype(float)[:, None]
    cells = np.array([have, number - have])
    expected = cells.sum(1, keepdims=True) * number / number.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * np.nansum(np.where(cells > 0, cells * np.log(cells / expected), 0), axis=(0, 1))
    best = np.argsort(-ratio, kind="stable")[:FEATURES]
    return np.array(sorted(best[ratio[best] >= LEAST_RATIO].tolist(), key=names.__getitem__), np.int64)


def fit(texts: list[str], labels: list[int], shares: tuple[float, float]) -> tuple[float, dict[str, float]]:
    """Bias and weights of features.  ``shares``: how common labels 0 and 1 are outside the sample.

    Words, features and sentences are numbers from here on, in arrays.
    """
    known: dict[str, int] = {}
    bags = [_Runs() for _ in texts]  # a run is a sentence's words
    for text, bag in zip(texts, bags, strict=True):
        for _, _, words in sentences(text):
            bag.add(sorted(known.setdefault(w, len(known)) for w in sorted(words)))
    number: dict[str, int] = {}
    made_of = _Runs()  # a run is a word's features
    for w in known:
        made_of.add([number.setdefault(f, len(number)) for f in sorted(features(w))])
    del known
    names = list(number)
    del number
    telling = _telling([np.frombuffer(bag.flat, np.int32) for bag in bags], labels, made_of, names)
    place = np.full(len(names), -1, np.int32)
    place[telling] = np.arange(len(telling))
    names = [names[at] for at in telling.tolist()]
    of_text, word, of_sentence, count = [], [], [], 0
    for at, bag in enumerate(bags):
        own, sizes = made_of.of(np.frombuffer(bag.flat, np.int32))
        sentence = np.repeat(np.arange(len(bag.ends) - 1), np.diff(np.frombuffer(bag.ends, np.int64)))
        own, sentence = place[own], np.repeat(sentence, sizes)
        own, sentence = own[own >= 0], sentence[own >= 0]
        order = np.lexsort((own, sentence))
        # sentences without one are at the bias, whatever that is
        kept, sentence = np.unique(sentence[order], return_inverse=True)
        word.append(own[order].astype(np.int32))
        of_sentence.append((sentence + count).astype(np.int32))
        of_text.append(np.full(len(kept), at))
        count += len(kept)
    none = np.zeros(0, np.int64)
    of_text, word, of_sentence = (np.concatenate([none, *x]) for x in (of_text, word, of_sentence))
    del made_of, place
    y, worded = np.array(labels, np.float64), np.array([len(bag.flat) > 0 for bag in bags], np.float64)
    heft = np.where(y == 1, shares[1] / max(1, y.sum()), shares[0] / max(1, (1 - y).sum()))
    weights, bias = np.zeros(len(names)), FIRST_BIAS
    squares, bias_squares = np.full(len(names), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = bias + np.bincount(of_sentence, weights[word], minlength=count)
        p, at_bias = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        counts = z >= bias
        base = np.logaddexp(0, bias)
        above = np.where(counts, np.logaddexp(0, z) - base, 0.0)
        none = np.bincount(of_text, above, minlength=len(y)) + base * worded  # -log of no toxic one
        none = np.exp(-none)
        pull = heft * worded * np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        slope = pull[of_text] * p * counts
        by_word = np.bincount(word, slope[of_sentence], minlength=len(names)) + DECAY * heft.sum() * weights
        squares += by_word**2
        weights -= RATE * by_word / np.sqrt(squares)
        by_bias = at_bias * pull.sum() + (pull[of_text] * (p - at_bias) * counts).sum()
        bias_squares += by_bias**2
        bias -= RATE / 4 * by_bias / np.sqrt(bias_squares)
    keep = np.abs(weights) >= NEGLIGIBLE
    return float(bias), {n: float(w) for n, w, k in zip(names, weights, keep, strict=True) if k}


def train(documents: DataFrame, labels: DataFrame) -> tuple[float, dict[str, float]] | None:
    """A model from documents (doc_id, text) and labels (doc_id, toxic); None without both labels.

    Labels are 0 or 1, others teach nothing; of repeated labels of a doc_id the
    greater counts.  Texts of repeated doc_ids are all learned from, rows that repeat
    both once.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashes = F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b")
    rows = documents.select("doc_id", *hashes, F.length("text").alias("chars"))
    rows = rows.where(F.col("chars") <= SAMPLE_CHARS).distinct().join(known, "doc_id")
    rows = staged(rows.select("a", "b", "chars", "toxic"), "labelled")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None

    def picked(label: int) -> DataFrame:
        # few more than SAMPLE by their hash, so that these alone are put in order
        share = F.lit(max(1, min(_HASHES, 2 * SAMPLE * _HASHES // counts[label])))
        some = rows.where((F.col("toxic") == label) & (F.pmod("a", F.lit(_HASHES)) < share))
        return some.orderBy("a", "b").limit(SAMPLE)

    before = Window.partitionBy("toxic").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    chosen = picked(0).unionByName(picked(1)).withColumn("before", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    chosen = F.broadcast(chosen.where(F.col("before") < SAMPLE_CHARS).select("a", "b", "toxic"))  # 2 * SAMPLE rows at most
    sample = documents.select("text", *hashes).join(chosen, ["a", "b"]).groupBy("a", "b")
    sample = sample.agg(F.any_value("text").alias("text"), F.any_value("toxic").alias("toxic"))
    total = sum(counts.values())
    shares = (counts[0] / total, counts[1] / total)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["toxic", "text"])
        if rows["toxic"].nunique() < 2:
            return pd.DataFrame({"word": [], "weight": []})
        bias, weights = fit(rows["text"].tolist(), rows["toxic"].tolist(), shares)
        return pd.DataFrame({"word": [None, *weights], "weight": [bias, *weights.values()]})

    fitted = sample.select("text", "toxic").groupBy(F.lit("model")).applyInPandas(one, "word string, weight double")
    rows = {r["word"]: r["weight"] for r in fitted.collect()}
    return (rows.pop(None), rows) if rows else None


class _Weights(dict):
    """The weight of a word, worked out when first asked for."""

    def __init__(self, weights: dict[str, float]):
        self._weights = weights

    def __missing__(self, word: str) -> float:
        get = self._weights.get
        self[word] = total = math.fsum(get(f, 0.0) for f in features(word))
        return total

    def thin(self) -> None:
        if len(self) > KNOWN_WORDS:
            self.clear()


def score(documents: DataFrame, model: tuple[float, dict[str, float]] | None) -> DataFrame:
    """``documents`` with score, predicted and the offending sentences (in place of such columns).

    ``offending``: (start, end, p) of the sentences whose own probability is at
    least OFFENDING; places in characters.  Null and empty texts have no sentence
    and score 0, as has all without a model.
    """
    bias, weights = model or (-np.inf, {})
    shared = documents.sparkSession.sparkContext.broadcast((bias, weights))  # FEATURES at most
    documents = documents.drop("score", "predicted", "offending")
    offending = "offending array<struct<start:int,end:int,p:double>>"
    schema = with_fields(documents, f"score double, predicted int, {offending}")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def judge(text: str, weigh: _Weights) -> tuple[float, list[dict]]:
        none, offending, bias = 0.0, [], shared.value[0]
        base = math.log1p(math.exp(bias))
        for start, end, words in sentences(text):
            z = bias + math.fsum(map(weigh.__getitem__, words))
            none = none or base
            if z > bias:
                none += (math.log1p(math.exp(z)) if z < 30 else z) - base
            if z >= _LEAST_LOGIT:
                offending.append({"start": start, "end": end, "p": 1 / (1 + math.exp(-z))})
        return -math.expm1(-none), offending

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = _Weights(shared.value[1])
        for batch in batches:
            for first, texts in slices(batch, "text", RUN_CHARS):
                weigh.thin()
                found = [judge(text, weigh) for text in texts]
                scores = [s for s, _ in found]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(scores, pa.float64()),
                        pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                        pa.array([o for _, o in found], kind),
                    ],
                    names=[*part.schema.names, "score", "predicted", "offending"],
                )

    return documents.mapInArrow(run, schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, offending; learned from labels not held out."""
    held_out = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    model = train(documents, labels.where(~held_out))
    return score(documents.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
