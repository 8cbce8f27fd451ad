"""The operators against brute force, exact round trips and odd rows."""

import base64
import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from oreflow.llm import balltree, bytebpe, hnsw, langid, linededup, packing, seekable, simhash, tokens, toxicity, warc
from oreflow.llm.common import staged
from oreflow.llm.components import components

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "\n", "word", "Two words", "a  b\n\n c\td", "\x01mark\x01", "naïve café Straße İ", "字中😀‍👩",
    "<|endoftext|> is text", "1234 5,678.9 don't I'll", " lead and trail \n", "\x1c\x85 x", "x" * 3000,
]
SCHEMA = "doc_id long, text string"


def documents(spark, texts, extra=""):
    return spark.createDataFrame(list(enumerate(texts)), SCHEMA)


def random_texts(number, seed=1, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(80)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(0, words))) for _ in range(number)]


def tokenizer(path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


@pytest.mark.parametrize(("path", "chunks"), [(WORD_BPE, tokens.blank_chunks), (BYTE_BPE, tokens.spaced_chunks)])
def test_chunks_give_the_ids_of_whole_texts(path, chunks, monkeypatch):
    rng = random.Random(3)
    alphabet = " \n\t\r a'sBé1.́\x1c\x85İΣß字😀-\x01"
    texts = [t for t in ODD if t] + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    plain, own = tokenizer(path), tokens.ChunkEncoder(path, chunks)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in own.encode(texts)] == expected
    monkeypatch.setattr(tokens, "KNOWN_CHUNKS", 50)  # forgets again and again
    monkeypatch.setattr(tokens, "RUN_CHARS", 200)
    assert [ids.tolist() for ids in own.encode(texts)] == expected
    long_text = " ".join(texts[len(ODD) :])
    assert own.encode([long_text])[0].tolist() == plain.encode(long_text, add_special_tokens=False).ids


def test_words_that_a_blank_opens_are_encoded_without_marks(monkeypatch):
    own, plain = tokens.ChunkEncoder(BYTE_BPE, tokens.spaced_chunks), tokenizer(BYTE_BPE)
    seen = []
    encode = own._plain
    monkeypatch.setattr(own, "_plain", lambda strings: seen.extend(strings) or encode(strings))
    texts = ["It's Ġ odd\0 and don't, 1234 \x01 é😀 end.\nNext one", *random_texts(50)]
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in own.encode(texts)] == expected
    # only first words and those with a line end in them stand between marks
    marked = "".join(s for s in seen if "\n\x01\n" in s)
    assert " odd" not in marked and sum(map(len, seen)) < 3 * len(set(" ".join(texts).split())) * 8


# --- 1: packing


def test_patterns_use_all_pieces_and_fill_exactly():
    rng = random.Random(5)
    for capacity in (16, 64, 200):
        counts = Counter(rng.randint(1, capacity) for _ in range(2000))
        used, sequences = Counter(), 0
        for parts, times in packing.patterns(dict(counts), capacity):
            assert sum(length * copies for length, copies in parts) <= capacity
            sequences += times
            for length, copies in parts:
                used[length] += copies * times
        assert used == counts
        least = -(-sum(length * n for length, n in counts.items()) // capacity)
        assert sequences <= least + max(2, least // 50)  # lengths are no easy ones here


def test_packing_of_documents(spark):
    texts = [*ODD, *random_texts(60), " ".join(random_texts(200, 9)), *["same"] * 40]
    rows = packing.pack_documents(documents(spark, texts), WORD_BPE, 64).collect()
    plain = tokenizer(WORD_BPE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in enumerate(texts):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        parts = [ids[i : i + 64] for i in range(0, len(ids), 64)]
        crc = [zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces] == [
            (i, 64 * i, len(p), c) for i, (p, c) in enumerate(zip(parts, crc, strict=True))
        ]
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = list(itertools.accumulate(r.length for r in pieces))
        assert [r.offset for r in pieces] == [0, *ends[:-1]] and ends[-1] <= 64


def test_packing_hot_length_in_shares_repeated_rows_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE", 7)
    pieces = spark.createDataFrame([(i % 50, 0, 3) for i in range(100)], "doc_id long, piece int, length int")
    rows = packing.pack(pieces, ["doc_id", "piece"], 10).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 100
    assert len({r.sequence_id for r in rows}) == 34
    assert packing.pack_documents(documents(spark, []), WORD_BPE).count() == 0


# --- 2: language


def test_language_by_profiles(spark):
    letters = {"x": "aeiou", "y": "mnpqr", "z": "stvwß"}
    rng = random.Random(2)
    rows = []
    for i in range(120):
        lang = "xyz"[i % 3]
        text = " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(20))
        rows.append((i, text, lang, "ignored"))
    rows += [(500, None, "x", ""), (501, "12 34 !", "y", ""), (502, "aeiou aeiou", None, ""), (503, "", "z", "")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    found = {r.doc_id: r for r in langid.identify(table).collect()}
    assert all(found[i].lang_pred == "xyz"[i % 3] and 0 <= found[i].score <= 1 for i in range(120))
    assert found[502].lang_pred == "x"
    assert {found[i].lang_pred for i in (500, 501, 503)} == {"und"}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert {r.lang_pred for r in langid.identify(table.withColumn("lang", F.lit(None).cast("string"))).collect()} <= {"und"}
    assert langid.identify(table.limit(0)).count() == 0


def test_many_distinct_grams_are_worked_on_in_blocks(monkeypatch):
    import tracemalloc

    rng = random.Random(4)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(512)) for _ in range(512)]
    own = langid.Space()
    whole = [(at, own.letters(t)) for at, t in enumerate(texts)]
    own.sums(whole[:1], 1)
    tracemalloc.start()
    found = own.sums(whole, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    for at in (0, 100, 511):
        assert (found[at] == own.sums([(0, whole[at][1])], 1)[0]).all()
    monkeypatch.setattr(langid, "BLOCK", 16)
    assert (own.sums(whole[:50], 50) == found[:50]).all()
    long_text = own.letters("".join(texts) * 2)  # beyond a portion
    monkeypatch.setattr(langid, "PORTION", 1 << 12)
    by_part = own.sums([(0, long_text)], 1)
    monkeypatch.setattr(langid, "PORTION", 1 << 20)
    assert (own.sums([(0, long_text)], 1) == by_part).all()


def test_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [("aaa", "x"), ("aba", "x"), ("ccc", "z"), ("bbb", "y"), ("", "w"), ("ddd", None)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(langid.prototypes(labelled)) == ["w", "x"]  # of equal numbers the lesser name
    assert langid.prototypes(labelled.limit(0)) == {}


def test_sums_are_those_of_the_definition():
    space = langid.Space(64)
    text = "Ab, cab é"
    codes = space.letters(text)
    assert codes.tolist() == [0, *map(ord, "ab"), 0, *map(ord, "cab"), 0, ord("é"), 0]
    total = np.zeros(64)
    got = space.sums([(0, codes)], 1)[0]
    vector = {c: space._letters[row] for c, row in space._row.items()}
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        if b:
            total += vector[a][0].astype(int) * vector[b][1] * vector[c][2]
    assert (got == total).all()
    assert (vector[ord("a")][0] == np.roll(vector[ord("a")][2], 2)).all()


# --- 3: SimHash


def brute_fingerprint(text):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, monkeypatch):
    base = random_texts(30, 4, 200)
    rng = random.Random(6)
    texts = [*ODD, *base, *base[:10]]
    for text in base:
        words = text.split()
        for _ in range(3):
            if words:
                texts.append(" ".join([*words, rng.choice(words)]))
    expected = [brute_fingerprint(t or "") for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in itertools.combinations(range(len(texts)), 2):
            if (expected[i] ^ expected[j]).bit_count() <= 2:
                root[i] = root[j] = min(root[i], root[j])
    rows = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    assert [rows[i].fingerprint for i in range(len(texts))] == [f"{v:016x}" for v in expected]
    assert [rows[i].component_id for i in range(len(texts))] == root
    monkeypatch.setattr(simhash, "RUN_CHARS", 30)
    assert [int.from_bytes(simhash.fingerprint(t or ""), "big") for t in texts] == expected


def test_grid_finds_all_pairs(spark):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        values |= {v ^ 1 << rng.randrange(64), v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).distinct().collect()
    close = {
        (min(a, b), max(a, b))
        for a, b in itertools.combinations(signed, 2)
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    }
    assert {(r.u, r.v) for r in found} == close


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (50, None), (1, 0)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 4: toxicity


def test_toxicity_finds_the_sentences(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i, text in enumerate(random_texts(400, 11, 40)):
        bad = i % 4 == 0
        stem = rng.choice(["grumpish", "grumpo", "grumpel"])
        rows.append((i, f"{text}. well done. {f'you {stem} thing. ' if bad else ''}and so on.", "en", 1.0))
        labels.append((i, int(bad)))
    rows += [(900, None, "en", 0.0), (901, "", None, 0.0)]
    labels += [(900, None), (901, 7), (None, 1), (3, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    found = {r.doc_id: r for r in toxicity.toxicity(table, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i in range(400) if found[i].held_out]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert sum(found[i].predicted == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    hit = next(i for i in held if i % 4 == 0)
    assert any("grump" in rows[hit][1][s.start : s.end] for s in found[hit].offending)
    assert found[900].score == found[901].score == 0.0
    none = toxicity.toxicity(table, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.predicted for r in none} == {0}


def test_scores_are_the_noisy_or_of_sentences(spark):
    import math
    import re

    rng = random.Random(12)
    bias, weights = -6.0, {"bad": 5.0, "^bad": 2.5, "^badly$": 1.0, "good": -3.0, "rott": 7.5}
    words = ["bad", "badly", "good", "goody", "rotten", "plain", "Word", "abadx", "Rott"]
    texts = [
        "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "! ", "?\n", "\n"]) for _ in range(rng.randint(0, 25)))
        for _ in range(200)
    ]
    texts += [t or "" for t in ODD]

    def weight(word):
        marked = f"^{word}$"
        grams = {marked[i : i + 4] for i in range(len(marked) - 3)}
        return sum(weights.get(f, 0.0) for f in grams | {marked})

    def brute(text):
        """1 less the chance that no sentence is toxic; a sentence at or below the bias adds nothing, the bias once."""
        none = 1.0
        for sentence in re.findall(toxicity._SENTENCE, text):
            found = set(re.findall(toxicity._WORD, sentence.lower()))
            if found:
                least = 1 - 1 / (1 + math.exp(-bias))
                none = min(none, least)
                z = bias + sum(map(weight, found))
                if z > bias:
                    none *= (1 - 1 / (1 + math.exp(-z))) / least
        return 1 - none

    rows = {r.doc_id: r for r in toxicity.score(documents(spark, texts), (bias, weights)).collect()}
    for at, text in enumerate(texts):
        assert rows[at].score == pytest.approx(brute(text), abs=1e-12)
        assert rows[at].predicted == int(rows[at].score >= 0.5)
    assert 20 < sum(r.predicted for r in rows.values()) < 200


def test_the_fit_holds_its_sample_in_little_memory():
    texts = random_texts(150, words=4000)  # one word a sentence
    texts = [". ".join([*text.split(), *["Zzugh"] * (at % 2)]) for at, text in enumerate(texts)]
    tracemalloc.start()
    _, weights = toxicity.fit(texts, [at % 2 for at in range(150)], (0.9, 0.1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert weights["^zzugh$"] > 0
    assert most < 10 * sum(map(len, texts))


def test_toxicity_does_not_grow_with_length(spark):
    rng = random.Random(8)
    texts = random_texts(200, 12, 40)
    rows = [(i, f"{t}. {'you grumpish thing. ' if i % 4 == 0 else ''}and so on.") for i, t in enumerate(texts)]
    labels = [(i, int(i % 4 == 0)) for i in range(200)]
    long = ". ".join(" ".join(rng.choices(texts[1].split() + ["well", "done"], k=9)) for _ in range(30_000))
    # long texts are learned from, labels without a text take no place of the sample
    rows += [(500, long), (501, f"{long}. you grumpish thing."), (502, f"{long}. so")]
    labels += [(502, 0), *((i, 0) for i in range(1000, 1400))]
    table = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.train(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert [found[i].predicted for i in (500, 501, 502)] == [0, 1, 0]
    assert sum(found[i].predicted == int(i % 4 == 0) for i in range(200)) >= 198


# --- 5: line dedup


def brute_lines(texts):
    def words(line):
        return frozenset(line.lower().replace("\r", " ").split())

    seen, out = [], []
    for text in texts:
        kept = []
        for line in text.split("\n") if text is not None else []:
            own = words(line)
            if not (own and any(5 * len(own & s) >= 4 * len(own | s) for s in seen)):
                kept.append(line)
            if own:
                seen.append(own)
        out.append(None if text is None else "\n".join(kept))
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(12)
    lines = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts = []
    for _ in range(80):
        own = []
        for line in rng.sample(lines, 3):
            words = line.split(" ")
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = "changed"
            own.append(" ".join(words))
        texts.append("\n".join([*own, f"own line {rng.random()} of words that no other has", "", "short"]))
    texts += [t for t in ODD if t != "x" * 3000]
    table = spark.createDataFrame([(i, t, 5, i) for i, t in enumerate(texts)], f"{SCHEMA}, n_removed int, at int")
    rows = {r.doc_id: r for r in linededup.dedup_lines(table).collect()}
    assert [rows[i].text for i in range(len(texts))] == brute_lines(texts)
    assert all(rows[i].at == i for i in rows)
    assert linededup.dedup_lines(documents(spark, [])).count() == 0


def test_lines_of_repeated_and_null_ids(spark):
    table = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")], SCHEMA)
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in linededup.dedup_lines(table).collect())
    assert rows == [(False, 0, "a b c"), (True, 1, ""), (True, 1, ""), (True, 2, "")]


def test_lines_of_repeated_and_null_ids_with_different_texts(spark):
    def kept(*rows):
        found = linededup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
        return sorted((r.doc_id or 0, r.text, r.n_removed) for r in found)

    assert kept((1, "a\nb"), (1, "c\na")) == [(1, "a\nb", 0), (1, "c", 1)]
    words = [" ".join(f"{name}{i}" for i in range(30)) for name in "pqrstu"]
    near = [f"{text} more" for text in words]
    # repeated and nearly repeated lines at all places of rows without an id
    rows = [(None, f"{words[0]}\n{words[1]}"), (None, f"{words[2]}\n{near[0]}"), (None, f"own\n{words[3]}\n{near[2]}")]
    rows += [(9, f"{words[4]}\n{words[3]}"), (9, f"{near[1]}\n{words[5]}"), (9, "x\ny"), (9, "x\ny")]
    expected = [
        (0, words[2], 1), (0, f"own\n{words[3]}", 1), (0, f"{words[0]}\n{words[1]}", 0),
        (9, words[4], 1), (9, words[5], 1), (9, "x\ny", 0), (9, "x\ny", 0),
    ]
    assert kept(*rows) == sorted(expected)
    # at one place of one id one of the two stays
    assert [n for *_, n in kept((None, words[0]), (None, f"{words[0]}\nown"))] in ([0, 1], [1, 0])


def test_one_changed_word_of_forty(spark):
    words = [f"w{i}" for i in range(40)]
    changed = [" ".join([*words[:k], "other", *words[k + 1 :]]) for k in (0, 7, 20, 39)]
    texts = [" ".join(words), *changed, "\t".join(words) + "\r", " ".join(words[9:]), " ".join(words[:32])]
    found = {r.doc_id: r for r in linededup.dedup_lines(documents(spark, texts)).collect()}
    assert [found[i].n_removed for i in range(8)] == [0, 1, 1, 1, 1, 1, 0, 1]


def test_lines_are_numbered_by_place_and_keep_only_their_prefix(spark):
    texts = ["\n".join(text.split(". ")) for text in random_texts(40)]
    rows = spark.createDataFrame([(f % 7 or None, t) for f, t in enumerate(texts)], "doc_id long, text string")
    first = linededup._collapsed(linededup._lines(rows)).collect()
    places = [((r.doc_id is not None, r.doc_id), r.at, r.row) for r in sorted(first, key=lambda r: r.id)]
    assert places == sorted(places) and len({r.id for r in first}) == len(first)
    assert all(len(r.codes) <= r.n - -(-4 * r.n // 5) + 2 for r in first)


def test_staging_leaves_no_shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = held.getAllBlocks().size()
    counted = staged(spark.range(5000).groupBy((F.col("id") % 9).alias("k")).count(), "counted")
    assert counted.count() == 9
    assert held.getAllBlocks().size() <= before + 3  # those of count() above


def test_frequent_words_and_long_lines(spark, monkeypatch):
    rng = random.Random(31)
    texts = []
    for _ in range(150):
        size = rng.choice([1, 2, 3, 4, 5, 9, 20, 45])
        texts.append(" ".join(rng.choices([f"w{i}" for i in range(12 if size < 9 else 60)], k=size)))
        if rng.random() < 0.5:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    long = [f"l{i}" for i in range(20_000)]
    texts += [" ".join(long), " ".join(long[:-4_000]), " ".join(long[:-4_001])]
    monkeypatch.setattr(linededup, "FREQUENT", 2)  # so that nearly all entries are of two words
    monkeypatch.setattr(linededup, "SMALL", 3)  # and many are large
    found = {r.doc_id: r.text for r in linededup.dedup_lines(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute_lines(texts)


def test_lines_run_no_python(spark):
    plan = linededup.dedup_lines(documents(spark, ["a b", "a b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- 6: WARC


def test_warc_round_trip(spark):
    pages = [(i, f"http://x.org/{i}?q=a b\r\nInjected: 1", f"<p>{'é' * (i % 3)}\r\n\r\n") for i in range(30)]
    pages += [(40, None, None), (41, "http://[bad", ""), (None, "http://n", "<p>\r\n\r\n"), (50, "http://r", "r"), (50, "http://r", "r")]
    rows = warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(rows) == len(pages)
    first = {}
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(html or "", page_id)
    content = {p[0]: (p[2] or "").encode() for p in pages}
    for r in rows:
        payload = content[r.page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if r.page_id != 50:
            own = first[payload.decode()] == r.page_id
            assert (r.record_type, r.refers_to) == (("response", None) if own else ("revisit", first[payload.decode()]))
    assert sorted((r.record_type, r.refers_to) for r in rows if r.page_id == 50) == [("response", None), ("revisit", 50)]


def test_warc_one_leader_of_rows_dealt_over_tasks(spark):
    html = "".join(random.Random(3).choices("abcdefghij", k=4000))
    pages = spark.range(0, 600, 1, 12).select(
        F.when(F.col("id") < 500, F.lit(None)).otherwise(F.col("id")).alias("page_id"),
        F.lit("http://h").alias("url"),
        F.when((F.col("id") < 400) | (F.col("id") == 7), F.lit(html)).otherwise(F.concat(F.lit("own text "), "id")).alias("html"),
    )
    skew = "spark.sql.adaptive.skewJoin."
    settings = {f"{skew}skewedPartitionThresholdInBytes": "1k", f"{skew}skewedPartitionFactor": "1"}
    settings |= {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = warc.round_trip(pages, least_payload=10).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(rows) == 600
    assert sum(r.record_type == "response" and r.payload_bytes == len(html) for r in rows) == 1


def test_warc_of_odd_urls_and_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 7)
    urls = ["http://exa\u2100mple.com/", "http://[::1/x", "http://[nowhere]/", "//", "not a url", "http://a.b/c?d"]
    pages = [(i, url, f"page {i}") for i, url in enumerate(urls)]
    pages += [(50, "http://same/", "twice")] * 40 + [(None, None, None)] * 30 + [(50, "http://else/", "twice"), (7, None, "")]
    pages += [(90, "http://long/", "x" * 3_000_000), (91, "http://long/", "x" * 3_000_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    table = table.withColumns({"size": F.lit(1), "first": F.lit("x"), "n": F.lit(2)})
    rows = warc.round_trip(table).collect()
    assert Counter(r.page_id for r in rows) == Counter(p for p, _, _ in pages)
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in rows)
    assert kinds[(50, "response", None)] == 1 and kinds[(50, "revisit", 50)] == 40
    assert kinds[(7, "response", None)] == 1 and kinds[(None, "revisit", 7)] == 30
    assert kinds[(90, "response", None)] == kinds[(91, "revisit", 90)] == 1
    sizes = {p: len((html or "").encode()) for p, _, html in pages}
    assert all(r.payload_bytes == sizes[r.page_id] for r in rows)


def test_warc_assembly_keeps_what_belongs_together(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "one"), (2, "http://b/", "two")], "page_id long, url string, html string")
    records = warc.read_records(warc.write_archives(pages, str(tmp_path / "w"), least_payload=10))
    rows = warc.assemble(records).collect()
    assert sorted(bytes(r.response.payload) for r in rows) == [b"one", b"two"]
    assert all(len(r.requests) == len(r.metadata) == 1 for r in rows)
    assert all(r.requests[0].record_id.startswith(r.record_id[:-1]) for r in rows)
    lone = records.where("type <> 'request'")
    assert all(r.requests == [] for r in warc.assemble(lone).collect())
    assert warc.round_trip(pages.limit(0)).count() == 0


# --- 7: embeddings


def test_hnsw_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 90)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    vectors = [centres[i % 40] + rng.normal(size=16) * (0.05 if i % 2 else 0.4) for i in range(400)]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[1][1], 1) for i in range(6)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (2004, rows[1][1], None)]
    found = {r.vec_id: r for r in hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    usable = [r for r in rows if r[0] < 2000]
    units = np.array([r[1] for r in usable])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    label = np.array([r[2] for r in usable])
    close = (units @ units.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(close, False)
    root = np.arange(len(usable))
    for _ in usable:
        for i, j in np.argwhere(close):
            root[i] = root[j] = min(root[i], root[j])
    got = [found[r[0]] for r in usable]
    assert sum(g.n_links for g in got) >= 0.97 * close.sum()
    assert all(g.n_links <= n for g, n in zip(got, close.sum(1), strict=True))
    same = [g.component_id == usable[root[i]][0] for i, g in enumerate(got)]
    assert np.mean(same) >= 0.97 and len(found) == len(rows)
    assert all(found[i].n_links == 0 and found[i].kept for i in range(2000, 2005))


def test_audit_widens_where_links_are_rare(monkeypatch):
    rng = np.random.default_rng(8)

    def units(rows):
        return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)

    shard = units(rng.normal(size=(1500, 24)))
    graph = hnsw.Graph.build(shard)
    graph.layers[-1][1][:, 3:] = -1  # a poor graph
    queries = units(rng.normal(size=(1500, 24)))
    at = rng.choice(1500, 60, replace=False)  # links that a sample of 48 hardly holds
    queries[at] = units(shard[at] + 0.02 * rng.normal(size=(60, 24)))
    true = set(zip(*(x.tolist() for x in np.nonzero(queries @ shard.T >= 0.98)), strict=True))
    sample = set(np.linspace(0, 1499, hnsw.AUDITED).astype(int).tolist())
    monkeypatch.setattr(hnsw, "FIRST_BEAM", 4)

    def recall(pairs):
        return len(true & set(zip(*(x.tolist() for x in pairs), strict=True))) / len(true)

    assert len(true) >= 60 and len({q for q, _ in true} & sample) <= 6
    assert recall(graph.within(queries, 0.98, 4)) < 0.9
    assert recall(hnsw.audited(graph, queries, 0.98)) >= 0.99


def test_a_wide_beam_opens_several_nodes_at_once():
    class Counted(np.ndarray):
        looks = 0

        def __getitem__(self, at):
            Counted.looks += 1
            return np.asarray(self)[at]

    units = np.random.default_rng(5).normal(size=(1500, 16)).astype(np.float32)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    graph = hnsw.Graph.build(units)
    nodes, links = graph.layers[-1]
    graph.layers[-1] = (nodes, links.view(Counted))
    width, queries = 96, units[:40]
    ids, sims = graph._beam(queries, graph._descend(queries, len(graph.layers) - 1), graph.layers[-1][1], width)
    assert Counted.looks < width  # one a round: each node by itself took more rounds than the beam is wide
    assert all(len(set(row)) == width for row in ids.tolist())
    true = np.argsort(-(queries @ units.T), axis=1)[:, :4]
    assert np.mean([set(t) <= set(row) for t, row in zip(true.tolist(), ids.tolist(), strict=True)]) >= 0.95


def test_hnsw_of_equal_vectors_and_nothing(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in (5, 3, 9)], "vec_id long, embedding array<double>, label int")
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(table).collect()}
    assert rows == {3: (2, 3, True), 5: (2, 3, False), 9: (2, 3, False)}
    assert hnsw.near_duplicates(table.limit(0)).count() == 0


# --- 8: top-k


def test_ball_tree_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(balltree, "SHARD", 60)
    monkeypatch.setattr(balltree, "BLOCK", 4)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(300)]
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("inf")] * 6), (None, rows[0][1]), (7, rows[7][1])]
    found = balltree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).collect()
    ints = np.floor(256 * np.array([r[1] for r in rows[:300]]))
    expected = []
    for q in range(0, 300, 50):
        scores = sorted((-int(s), i) for i, s in enumerate(ints @ ints[q]) if i != q)[:5]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, found)) == expected


def test_ball_tree_of_few(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    rows = sorted(map(tuple, balltree.nearest(table, every=50).collect()))
    assert rows == [(0, 1, 1, 65536), (0, 2, 2, 65536)]
    assert balltree.nearest(table.limit(0), every=50).count() == 0


# --- 9: byte-level BPE


def test_transducer_against_tiktoken(monkeypatch):
    import tiktoken

    own = bytebpe.Codec(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + random_texts(50) + ["-" * 700, "=-" * 300, " " * 500 + "x"]
    texts += ["".join(rng.choices(" \n\ta'sBé1.́İß字😀-theing", k=rng.randint(0, 60))) for _ in range(500)]
    for text in texts:
        ids = own.encode(text)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert own.decode(ids, 3) == text
    monkeypatch.setattr(bytebpe, "TRANSITIONS", 40)
    monkeypatch.setattr(bytebpe, "KNOWN_WORDS", 10)
    monkeypatch.setattr(bytebpe, "PORTION", 16)
    def sha(data):
        return hashlib.sha256(data).hexdigest()

    for _ in range(2):
        expected = [plain.encode_ordinary(t) for t in texts]
        expected = [(len(i), sha(" ".join(map(str, i)).encode()), sha(t.encode())) for i, t in zip(expected, texts)]
        assert list(own.round_trips(texts)) == expected
        assert len(own._words) <= 10 + len(set().union(*(own._pattern.findall(t) for t in texts)))
    # states are forgotten while words are read, and all words read right after
    words = {w for t in texts for w in own._pattern.findall(t)}
    longest = max(len(w.encode()) for w in words)
    for word in sorted(words):
        assert own.transducer.encode(word.encode()) == plain.encode_ordinary(word)
        assert len(own.transducer._moves) <= 40 + longest


def test_utf8_in_portions():
    rng = random.Random(2)
    odd = [0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xC0, 0xFF, 0xE4]
    for _ in range(2000):
        data = bytes(rng.choices(odd, k=rng.randint(0, 9)))
        stream = bytebpe.Utf8Stream()
        text = "".join([*(stream.feed(data[i : i + 2]) for i in range(0, len(data), 2)), stream.end()])
        assert text == data.decode("utf-8", "replace")


def test_digests(spark):
    import tiktoken

    ranks = bytebpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in bytebpe.digests(documents(spark, ODD), RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(ODD):
        ids = plain.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bytebpe.encode_documents(documents(spark, ODD), RANKS, public_tokenizers.PATTERN)
    decoded = bytebpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.text for r in decoded} == {i: t or "" for i, t in enumerate(ODD)}


# --- 10: token files


def test_token_files(spark, tmp_path):
    texts = [*ODD, *random_texts(40)]
    table = spark.createDataFrame([(3 * i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")], f"{SCHEMA}, path string")
    listed = seekable.write_documents(table, BYTE_BPE, str(tmp_path / "files"))
    rows = sorted(seekable.read_documents(listed).collect(), key=lambda r: r.start)
    plain, start = tokenizer(BYTE_BPE), 0
    assert [r.doc_id for r in rows] == [None, *(3 * i for i in range(len(texts)))]
    for r, text in zip(rows, ["no id", *texts], strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    wanted = {r.doc_id: r.ids for r in seekable.find_documents(listed, [6, 9, None, 7]).collect()}
    assert wanted == {r.doc_id: r.ids for r in rows if r.doc_id in (6, 9, None)}
    assert seekable.round_trip(table.limit(0), BYTE_BPE).count() == 0


def test_reader_decompresses_only_what_is_asked_for(tmp_path):
    import pyarrow as pa
    import zstandard

    path = str(tmp_path / "one.zst")
    with pa.OSFile(path, "wb") as stream:
        writer = seekable.Writer(stream, 4, frame_ids=50)
        for i in range(40):
            writer.add(i, np.arange(10 * i, 10 * i + 20, dtype=np.uint32))
        writer.close()
    with pa.OSFile(path) as stream:
        reader = seekable.Reader(stream)
        assert len(reader.ranges) == 20
        (found,) = reader.find([7])
        assert found.ids.tolist() == list(range(70, 90)) and reader.decompressed == 1
    data = (tmp_path / "one.zst").read_bytes()
    assert len(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()) > 0
    (tmp_path / "bad.zst").write_bytes(data[:30] + bytes([data[30] ^ 1]) + data[31:])
    with pa.OSFile(str(tmp_path / "bad.zst")) as stream, pytest.raises(Exception):  # noqa: B017
        list(seekable.Reader(stream).documents())


def test_hnsw_of_ids_with_several_vectors(spark):
    v, w, z = [1.0, 0.0, 0.0], [0.999, 0.02, 0.0], [-1.0, 0.0, 0.0]
    rows = [(5, v, 1), (5, w, 1), (5, z, 1), (2, [-0.999, 0.0, 0.02], 1), (9, z, 1)]
    found = hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [
        (2, 2, 2), (5, 1, 5), (5, 1, 5), (5, 2, 2), (9, 2, 2)
    ]


def test_ball_tree_of_huge_components(spark, monkeypatch):
    """Scores beyond 2^53 are exact, and ties among them go to the lesser id."""
    monkeypatch.setattr(balltree, "SHARD", 4)
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-400_000, 400_000)) for _ in range(3)]) for i in range(40)]
    rows += [(100, [400_000.0, 1.0, 0.0]), (101, [400_000.0, 1.0, 0.0]), (102, [400_000.0, 1.00390625, 0.0]), (150, [0.0, 0.0, 0.0])]
    ints = {i: [int(256 * x) for x in e] for i, e in rows}
    expected = []
    for q in (i for i in ints if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[c], strict=True)), c) for c in ints if c != q)
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(scores[:5], 1)]
    found = balltree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    huge = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in balltree.nearest(huge, every=50).orderBy("rank").collect()] == [1, 2]
