"""Merkle manifest, spelling variants and histogram packing against brute force and odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from oreflow.llm import histpack, merkle, spelling, tokens

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest ---------------------------------------------------------------


def leaf_of(row, text):
    def item(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return sha("".join(item(v) for v in (row[0], row[3], row[2], row[4], text)))


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return found


def plain_audit(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
    trees = [levels([leaf_of(r, r[1]) for r in groups[lang]]) for lang in langs]
    crown = levels([tree[-1][0] for tree in trees])
    out = []
    for k, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = text.translate(lower)
            now, siblings = leaf_of(row, text), []
            for tree, at in ((trees[k], i), (crown, k)):
                for level in tree[:-1]:
                    run, place = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    siblings += run[:place] + run[place + 1 :]
                    now = sha("".join([*run[:place], now, *run[place + 1 :]]))
                    at //= 8
            root = crown[-1][0]
            out.append((row[0], leaf_of(row, row[1]), trees[k][-1][0], root, sha("".join(siblings)), now, now == root))
    return out


def ordered(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 9}, {"en": 513, "é": 64, "z": 1, None: 3}])
def test_manifest_and_proofs(spark, sizes):
    rng, rows = random.Random(5), []
    for lang, count in sizes.items():
        for _ in range(count):
            rows.append((len(rows) * 7 % 997, f"Text {rng.random()} É", lang, rng.choice(["s", None]), 3))
    rng.shuffle(rows)
    found = merkle.audit(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert ordered(found) == ordered(plain_audit(rows))
    assert any(not row.verified for row in found) or len(rows) == 1


def test_more_groups_than_one_subtree(spark):
    rows = [(i, "A", f"l{i % 600}", "s", 1) for i in range(1300)]
    assert ordered(merkle.audit(spark.createDataFrame(rows, DOCUMENTS)).collect()) == ordered(plain_audit(rows))


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "B", None, "", 0), (1, "", "", None, None)]
    rows += [(1, "Same", "en", "s", 4)] * 11 + [(2, "X" * 300_000 + "é", "en", "s", 1), (2, "other", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumns({"grp": F.lit(1), "digest": F.lit("x"), "at": F.lit(2)})
    found = merkle.audit(docs).collect()
    assert ordered(found) == ordered(plain_audit(rows))
    assert merkle.audit(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_lower_levels_are_not_written(spark):
    """Of the levels only every third is stored: 600 leaves, 2 nodes above them, a root."""
    leaves = spark.range(600).select(
        F.lit("g").alias("grp"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("o")
    )
    forest = merkle._forest(leaves, ["o"], ())
    assert [level.count() for level in forest.levels] == [600, 2, 1]


# --- Spelling variants -------------------------------------------------------------


def plain_variants(rows):
    import re

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if code % 97 == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        a, b = sorted((a, b), key=len)
        i = next((k for k, c in enumerate(a) if c != b[k]), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best and words[best] >= 2 * n else None
    out = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words[form[word]] if form[word] else None))
    return out


def test_variants_of_random_words(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choice("abceé") for _ in range(rng.randint(5, 8))) for _ in range(60)]

    def varied(word):
        at, kind = rng.randrange(len(word)), rng.randrange(4)
        letter = rng.choice("abceÉé")
        return [word, word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]

    rows = [(i, " ".join(varied(rng.choice(stems[: 3 + i % 57])) for _ in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(spelling.variants(docs).collect()) == ordered(plain_variants(rows))


def test_forms_are_followed_to_the_end(spark):
    counts = {"aaaaa": 300, "aaaab": 140, "aaabb": 60, "aabbb": 25, "abbbb": 11, "bbbbb": 5}
    rows = [(None, " ".join(word for word, n in counts.items() for _ in range(n)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row.word: row for row in spelling.variants(docs).collect()}
    assert ordered(found.values()) == ordered(plain_variants(rows))
    assert {row.root for row in found.values()} == {"aaaaa"}


def test_variants_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART_CHARS", 50)
    long = "x" * 5000
    texts = [None, "", "1234 !?", "abc", f"{long} {long}y", f"{long} {long}y", f"{long}. {long}y", "aaaaaaa aaaaaa " * 40]
    rows = [*enumerate(texts), (7, texts[-1]), (None, "Ünïcö ünïcö ünïcò " * 3), (None, "÷×÷×÷ " * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "id": F.lit(2)})
    assert ordered(spelling.variants(docs).collect()) == ordered(plain_variants(rows))
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(4)
    for _ in range(300):
        grams = [(place, rng.randint(1, 9)) for place in sorted(rng.sample(range(9), rng.randint(3, 6)))]
        pairs = [(a + b, (p, q)) for p, a in grams for q, b in grams if q >= p + 2]
        found = spelling.pivots(grams)
        costs = dict(grams)
        assert found[1] >= found[0] + 2
        assert sum(costs[p] for p in found) == min(pairs)[0]


# --- Histogram packing -------------------------------------------------------------


def plain_ids(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    return [own.encode(text or "", add_special_tokens=False).ids + [1] for text in texts]


def test_word_chunks_give_the_ids_of_whole_texts():
    rng = random.Random(7)
    alphabet = " \n\t\r a'sBé1.,;:!?\u0301\x1cİΣß字😀-\x01\"K"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["A word, and. Another! \"quoted.\" don't, it's. X.Y. z; q:", "word. " * 50, "ÀB, Ça. va?\nOui!"]
    own = tokens.ChunkEncoder(WORD_BPE, tokens.word_chunks)
    assert [ids.tolist() + [1] for ids in own.encode(texts)] == plain_ids(texts)


def check_packed(rows, texts, capacity):
    """Every id in one piece, sequences without gaps, none padded."""
    ids = plain_ids(texts)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        part = ids[row.doc_id][row.start : row.start + row.length]
        assert len(part) == row.length > 0
        assert row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert row.doc_tokens == len(ids[row.doc_id])
        pieces[row.doc_id].append((row.start, row.length))
        sequences[row.sequence_id].append((row.offset, row.length))
    for runs, sizes in ((pieces, [len(i) for i in ids]), (sequences, None)):
        for key, parts in runs.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            if sizes:
                assert at == sizes[key]
            else:
                assert at == capacity or at & (at - 1) == 0
    assert len(pieces) == len(texts)
    total = sum(map(len, ids))
    assert len(sequences) == total // capacity + (total % capacity).bit_count()


@pytest.mark.parametrize("capacity", [16, 64, 100])
def test_histogram_packing(spark, capacity):
    rng = random.Random(capacity)
    texts = [" ".join(rng.choices("a bird sang loudly über alles 字 x9".split(), k=rng.randint(0, 90))) for _ in range(300)]
    texts += [None, "", " ", "word " * 3000] + ["same length here"] * 400
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    docs = docs.withColumns({"length": F.lit("x"), "offset": F.lit(1), "part": F.lit(2)})
    check_packed(histpack.pack_documents(docs, WORD_BPE, capacity).collect(), texts, capacity)


def test_histogram_packing_of_odd_tables(spark):
    assert histpack.pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).collect() == []
    rows = [(None, "one two"), (None, "one two"), (3, None), (3, "three")]
    found = histpack.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), WORD_BPE).collect()
    assert Counter(row.doc_id for row in found)[None] >= 2
    total = sum(len(i) for i in plain_ids(text for _, text in rows))
    assert sum(row.length for row in found) == total


def test_plan_uses_up_the_histogram():
    rng = random.Random(9)
    for capacity in (32, 100):
        counts = {n: rng.choice([1, 2, 50, 10_000]) for n in range(1, capacity + 1) if rng.random() < 0.6}
        drawn = histpack.plan(counts, capacity)
        used = Counter(drawn.strung)
        for parts, times in drawn.patterns:
            assert sum(length * copies for length, copies in parts) == capacity
            for length, copies in parts:
                used[length] += copies * times
        assert used == Counter(counts)


def test_least_squares_comes_near_the_histogram():
    counts = np.zeros(65, np.int64)
    counts[1:65] = np.random.default_rng(1).integers(100, 200, 64)
    kinds, copies = histpack.combinations(np.arange(1, 65), 64)
    x = histpack.solve(kinds, copies, counts)
    made = np.bincount(kinds.ravel(), weights=(copies * x[:, None]).ravel(), minlength=65)
    assert (x >= 0).all()
    assert np.abs(made - counts)[1:].sum() < 0.05 * counts.sum()
