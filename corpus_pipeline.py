"""The corpus pipeline: documents in, packed training sequences out.

Each stage reads what the one before wrote, as Parquet in the shared scratch, and
applies one operator of oreflow.llm to all of it.  All but the last return the
columns of documents, whatever further columns there are and whatever their names.
Empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.llm import langid, linededup, packing, simhash, toxicity
from oreflow.llm.common import bucket_of, prepare, staged

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: No SQL: three stages are learned models or fingerprints.  Tests hold the pipeline
#: against a version of it that goes document by document.
ORACLE_SQL: str | None = None


def _own_names(docs: DataFrame, *needed: str) -> DataFrame:
    """docs with all columns but the needed ones out of the way of an operator's names."""
    return docs.toDF(*(n if n in needed else f"column_{i}" for i, n in enumerate(docs.columns)))


def _kept(docs: DataFrame, judged: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    plain = _own_names(docs, "text")
    return judged(plain).where(keep).select(*plain.columns).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: not ``und``, which has no letter.

    The score plays no part: it falls with brevity and with the number of languages.
    """
    prepare(spark)
    learned = langid.prototypes(docs.where(bucket_of(F.col("doc_id"), langid.FOLDS) != langid.HELD_OUT))
    told = F.col("lang_pred") != langid.UNKNOWN
    return _kept(docs, lambda plain: langid.predict(plain, learned), told)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    taught = bucket_of(F.col("doc_id"), toxicity.FOLDS) != toxicity.HELD_OUT
    model = toxicity.train(docs, labels.where(taught))
    return _kept(docs, lambda plain: toxicity.score(plain, model), F.col("predicted") == 0)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated lines; those of which no word is left go.

    n_chars, where there is such a column, is that of the text as it is now.
    """
    prepare(spark)
    plain = _own_names(docs, "doc_id", "text")
    found = linededup.dedup_lines(plain)
    left = found.where((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\n\t\r", "   ")) != ""))
    if "n_chars" in docs.columns:
        counted = plain.columns[docs.columns.index("n_chars")]
        now = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn(counted, F.when(F.col("n_removed") > 0, now).otherwise(F.col(counted)))
    return left.select(*plain.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the row with the smallest doc_id; null doc_ids come last.

    Rows are told by doc_id and text: of rows that repeat a doc_id each group keeps its own.
    """
    prepare(spark)
    first = simhash.survivors(docs.select("doc_id", "text")).toDF("first_a", "first_b")
    plain = _own_names(docs, "doc_id", "text")
    a, b = simhash.text_hashes()
    stays = plain.join(first, (a == F.col("first_a")) & (b == F.col("first_b")), "left_semi")
    # rows that repeat both doc_id and text
    one = Window.partitionBy(a, b).orderBy("doc_id")
    stays = stays.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return stays.select(*plain.columns).toDF(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    prepare(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxic_out),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
