"""Spelling variants: words one edit apart, by pivotal grams.

Deng, Li, Feng: A Pivotal Prefix Based Filtering Algorithm for String Similarity
Search (SIGMOD 2014), here as a join of a vocabulary with itself.  A word's
bigrams are ordered by rarity over the vocabulary.  Its *prefix* are the first
three (and further places of the third); two disjoint ones of these, the cheapest
by dynamic programming, are its *pivots*.  One edit spoils one pivot at most, so
the other stands in the partner too, at most one place off, and, if the partner's
prefix reaches as far in the order, inside that prefix.  What limits the place
limits more: the edit lies on one side of a pivot that it spares, so all of the
word on the other side is the same.  Pivots therefore meet prefixes by bigram,
length, place and the part of the word that must be equal, at the lengths and
places that one edit allows.  What meets is verified by the edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A run loses a code point where this divides its hash.
SPOILED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
EDITS = 1
GRAM = 2
#: Grams of a prefix: so many that EDITS + 1 of them are disjoint.
PREFIX = GRAM * EDITS + 1
#: Longer texts are searched in parts, cut where no word is.
PART_CHARS = 1 << 20
#: A task passes on what it has counted when it knows so many words.
KNOWN_WORDS = 200_000
#: One edit takes away GRAM grams at most and brings as many.
MARKS_OFF = 2 * GRAM * EDITS
#: Words up to this length are compared where their keys meet.
SHOWN = 64


def _parts(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PART_CHARS:
        cut = _BREAK.search(text, start + PART_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def words_of(doc_id: object, text: str, spoiled: int = SPOILED) -> Counter:
    """The words of one text with their counts; words too short to matter are left out."""
    runs: Counter = Counter()
    for part in _parts(text):
        runs.update(RUN.findall(part))
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, count in runs.items():
        size = len(run)
        if size < LEAST_LENGTH:
            continue
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        code = zlib.crc32(word.encode(), seed)
        if code % spoiled == 0:
            at = code % size
            word = word[:at] + word[at + 1 :]
            if size <= LEAST_LENGTH:
                continue
        words[word] += count
    return words


def vocabulary(documents: DataFrame) -> DataFrame:
    """(id, word, n): distinct words that are long and frequent enough; the ids are any numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def drained() -> pa.RecordBatch:
            rows = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(rows, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if text:
                    held.update(words_of(doc_id, text))
            if len(held) > KNOWN_WORDS:
                yield drained()
        if held:
            yield drained()

    counted = documents.select("doc_id", "text").mapInArrow(count, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    return staged(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Places of each bigram in the vocabulary: at most 8100, as words have 90 letters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                held.update(map("".join, zip(word, word[1:], strict=False)))
        rows = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, names=["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram string, n long")
    return {row["gram"]: row["n"] for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def pivots(grams: list[tuple[int, int]], wanted: int = EDITS + 1) -> list[int]:
    """Places of ``wanted`` disjoint grams of the least total cost, out of (place, cost).

    chosen[k] is the cheapest choice of k grams among those looked at; a gram goes
    with the cheapest choice of k - 1 that ends before it begins.
    """
    grams = sorted(grams)
    chosen: list[list[tuple[float, tuple[int, ...]]]] = [[(0, ())] + [(float("inf"), ())] * wanted]
    behind = 0
    for i, (place, cost) in enumerate(grams):
        while grams[behind][0] + GRAM <= place:
            behind += 1
        before, now = chosen[behind], list(chosen[i])
        for k in range(1, wanted + 1):
            total = before[k - 1][0] + cost
            if total < now[k][0]:
                now[k] = (total, (*before[k - 1][1], place))
        chosen.append(now)
    return list(chosen[-1][wanted][1])


def signature(
    word: str, ranks: dict[str, int], costs: dict[str, int]
) -> tuple[int, list[int], list[int], int]:
    """(rank of the prefix's last gram, keys to look for, keys to be found by, marks).

    A key stands for a gram, its place, the word's length and the part of the word
    that must be the same.  One edit lies before the later pivot's end, then all from
    that pivot on is unchanged, or it lies behind the earlier pivot, then all up to
    that pivot's end is.  The marks have a bit for each gram, by its rank: one edit
    changes ``MARKS_OFF`` of them at most.
    """
    size = len(word)
    ranked = [(ranks[word[i : i + GRAM]], i) for i in range(size - GRAM + 1)]
    first = sorted(ranked)[:PREFIX]
    last = first[-1][0]
    early, late = pivots([(place, costs[word[place : place + GRAM]]) for _, place in first])
    head, tail = word[: early + GRAM], word[late:]
    asked = [_key("h", size + by, early, head) for by in (-1, 0, 1)]
    asked += [_key("t", size + by, late + by, tail) for by in (-1, 0, 1)]
    given = []
    for rank, place in ranked:
        if rank <= last:
            given.append(_key("h", size, place, word[: place + GRAM]))
            given.append(_key("t", size, place, word[place:]))
    marks = 0
    for rank, _ in ranked:
        marks |= 1 << rank * 29 % 63
    return last, asked, given, marks


def _key(side: str, length: int, place: int, part: str) -> int:
    """Equal for what must be equal; words whose keys agree by chance are told apart later."""
    return xxhash.xxh64_intdigest(f"{side}{length},{place},{part}") - (1 << 63)


def _signatures(words: DataFrame) -> DataFrame:
    """(id, last, asked, given, marks, shown) of every word; ``shown`` is the word, unless it is long."""
    costs = gram_counts(words)
    order = sorted(costs, key=lambda gram: (costs[gram], gram))
    shared = words.sparkSession.sparkContext.broadcast(({g: i for i, g in enumerate(order)}, costs))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, costs = shared.value
        for batch in batches:
            spelled = batch.column("word").to_pylist()
            signed = [signature(word, ranks, costs) for word in spelled]
            keys = [pa.array([s[k] for s in signed], pa.list_(pa.int64())) for k in (1, 2)]
            shown = [word if len(word) <= SHOWN else None for word in spelled]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([s[0] for s in signed], pa.int32()),
                    *keys,
                    pa.array([s[3] for s in signed], pa.int64()),
                    pa.array(shown, pa.string()),
                ],
                names=["id", "last", "asked", "given", "marks", "shown"],
            )

    schema = "id long, last int, asked array<long>, given array<long>, marks long, shown string"
    return staged(words.select("id", "word").mapInArrow(sign, schema), "signatures")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): ids of the pairs of words that are one edit apart, each pair once.

    ``words`` has (id, word, n), distinct words of 4 or more letters of ``RUN``.
    """
    signed = _signatures(words)
    asks = signed.select(F.explode("asked").alias("key"), "id", "last", "marks", "shown")
    gives = signed.select(
        F.explode("given").alias("key"),
        F.col("id").alias("of"),
        F.col("last").alias("reach"),
        F.col("marks").alias("marks_of"),
        F.col("shown").alias("shown_of"),
    )
    alike = F.bit_count(F.col("marks").bitwiseXOR(F.col("marks_of"))) <= MARKS_OFF
    # long words do not travel with every key; theirs are verified below
    close = F.coalesce(F.levenshtein("shown", "shown_of", EDITS) == 1, F.lit(True))
    own = (F.col("last") <= F.col("reach")) & (F.col("id") != F.col("of"))
    met = asks.join(gives, "key").where(own & alike & close)
    met = met.select(F.least("id", "of").alias("a"), F.greatest("id", "of").alias("b")).distinct()
    for side in ("a", "b"):
        met = met.join(words.select(F.col("id").alias(side), F.col("word").alias(f"word_{side}")), side)
    return met.where(F.levenshtein("word_a", "word_b", EDITS) == 1).select("a", "b")


def _roots(links: DataFrame) -> DataFrame:
    """(id, to) -> (id, last): forms followed to the end, twice as far each round.

    A form has at least twice its word's occurrences, so there are no rings and the
    rounds are few.
    """
    while True:
        on = links.select(F.col("id").alias("to"), F.col("to").alias("further"))
        moved = staged(
            links.join(on, "to", "left").select(
                "id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")
            ),
            "forms",
        )
        links = moved.select("id", "to")
        if not moved.where("moved").limit(1).count():
            return links


def variants(documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    ``form`` is the near word with most occurrences (of equal ones the smallest in
    code-point order) if it has twice as many as the word; ``root`` is where the
    forms lead in the end.  Null and empty texts have no words; a null doc_id counts
    as an empty one; repeated rows count each; texts and words of any length are
    read whole; further columns are not read.  No words: no rows.
    """
    words = vocabulary(documents)
    pairs = staged(near_words(words), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partner = words.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near", "b")).alias("best")
    near = both.join(partner, "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), best)
    has_form = -F.col("best.least") >= 2 * F.col("n")
    judged = staged(
        words.join(near, "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.least")).alias("form_n"),
            F.when(has_form, F.col("best.b")).alias("to"),
        ),
        "judged",
    )
    last = _roots(judged.where("to is not null").select("id", "to"))
    ends = words.select(F.col("id").alias("to"), F.col("word").alias("root"))
    rooted = last.join(ends, "to").select("id", "root")
    return judged.join(rooted, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
