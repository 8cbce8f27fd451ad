"""The pipeline, stage by stage, against a version that goes document by document."""

import random
import sys
from pathlib import Path

import pytest
from test_llm import brute_fingerprint, brute_lines, tokenizer, WORD_BPE

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, n_removed int"
LETTERS = {"x": "aeiou", "y": "mnpqr"}


def corpus():
    rng = random.Random(21)

    def sentence(lang, words=12):
        return " ".join("".join(rng.choices(LETTERS[lang], k=rng.randint(3, 7))) for _ in range(words))

    rows, labels = [], []
    shared = sentence("x", 60)
    for i in range(160):
        lang = "xy"[i % 2]
        toxic = i % 8 == 3
        lines = [f"{sentence(lang)}. {'zzgrump zzgrumpo. ' if toxic else ''}{sentence(lang)}." for _ in range(4)]
        if i % 10 == 0:
            lines.insert(1, shared)
        rows.append((i, "\n".join(lines), lang))
        labels.append((i, int(toxic)))
    whole = rows[4][1]
    rows += [(200, whole, "x"), (201, whole, "x"), (202, "12 34", "y"), (203, None, "x"), (204, "", None)]
    rows = [(i, t, l, "s", len(t or ""), f"own {i}", "own", i) for i, t, l in rows]
    return rows, labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_filters_keep_clean_documents_as_they_are(stages):
    before, told, clean = (by_id(df) for df in stages[:3])
    assert set(told) == set(before) - {202, 203, 204}
    toxic = {i for i in range(160) if i % 8 == 3}
    assert len(toxic & set(clean)) <= 1
    assert len(set(told) - toxic - set(clean)) <= 2
    assert all(clean[i] == before[i] for i in clean)


def test_short_clean_documents_of_many_languages_stay(spark):
    rng = random.Random(5)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 12)) for _ in range(40)]
    rows = [
        (i, " ".join("".join(rng.choices(alphabets[i % 40], k=5)) for _ in range(30)), f"l{i % 40}") for i in range(400)
    ]
    rows += [(1000 + i, word, None) for i, word in enumerate(["Avec.", "a", "Hm!", "ok ok", "字"])] + [(2000, "12", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in rows} - {2000}


def test_lines_and_groups_by_brute_force(stages):
    before, after, kept = (by_id(df) for df in stages[2:5])
    ids = sorted(before)
    expected = dict(zip(ids, brute_lines([before[i].text for i in ids]), strict=True))
    assert {i: r.text for i, r in after.items()} == {i: t for i, t in expected.items() if t.strip()}
    assert all(r.n_chars == len(r.text) and r.score == f"own {i}" for i, r in after.items())
    assert not {200, 201} & set(after)  # copies of 4 lose all their lines
    prints = {i: brute_fingerprint(r.text) for i, r in after.items()}
    root = {i: i for i in prints}
    for _ in prints:
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    assert {i: r for i, r in kept.items()} == {i: after[i] for i in after if root[i] == i}


def test_one_row_stays_of_each_group_whatever_its_ids(spark):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join(str(rng.random()) for _ in range(40)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (3, c), (5, c), (5, d), (5, e), (None, e), (7, None)]
    table = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id long, nth int")
    kept = corpus_pipeline.near_dedup(spark, table, "")
    assert kept.columns == table.columns
    expected = [(None, a), (None, b), (3, c), (5, d), (5, e), (7, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, expected))


def test_packing_holds_all_that_was_kept(stages):
    kept, pieces = by_id(stages[4]), stages[5].collect()
    plain = tokenizer(WORD_BPE)
    sizes = {i: len(plain.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in kept.items()}
    found = dict.fromkeys(sizes, 0)
    for piece in pieces:
        found[piece.doc_id] += piece.length
    assert found == sizes
    least = -(-sum(sizes.values()) // 2048)
    assert least <= len({p.sequence_id for p in pieces}) <= least + 1  # no short pieces to fill with


def test_columns_and_empty_tables(spark, stages, tmp_path):
    assert all(df.columns == stages[0].columns for df in stages[1:5])
    stages[0].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
