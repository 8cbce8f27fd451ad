"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import (
    balltree,
    bytebpe,
    histpack,
    hnsw,
    langid,
    linededup,
    merkle,
    packing,
    seekable,
    simhash,
    spelling,
    toxicity,
    warc,
)
from oreflow.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL for the queries that SQL can express on whole tables; tests hold the others
#: against brute force.
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame], sql: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    if sql is not None:
        ORACLES[function.__name__] = sql
    return run


def with_sql(sql: str):
    return lambda function: query(function, sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.withColumn("length", F.col("length").cast("long"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = seekable.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@with_sql(
    """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT doc_id, place,
         list_distinct(list_filter(
           string_split(translate(lower(line), chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '),
           lambda w: w <> '')) AS words
  FROM lines
), spread AS (
  SELECT doc_id, place, len(words) AS n, unnest(words) AS word FROM worded
), gone AS (
  SELECT DISTINCT doc_id, place FROM (
    SELECT y.doc_id, y.place
    FROM spread x JOIN spread y ON x.word = y.word
     AND (x.doc_id < y.doc_id OR (x.doc_id = y.doc_id AND x.place < y.place))
    GROUP BY x.doc_id, x.place, y.doc_id, y.place
    HAVING 9 * count(*) >= 4 * (any_value(x.n) + any_value(y.n)))
)
SELECT d.doc_id, CAST(coalesce(c.n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(c.n_removed, 0) AS INTEGER) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL) AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.place = g.place
  GROUP BY l.doc_id) c ON d.doc_id = c.doc_id
"""
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


@with_sql(
    """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
)
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.nearest(table(spark, sf_dir, "embeddings"), every=50)


#: crc32 in SQL: its table as one list.
CRC_TABLE_SQL = """crc AS (
  SELECT list(v ORDER BY i) AS entries FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) AS v
    FROM range(256) AS r(i)))"""


def crc_sql(codes: str) -> str:
    """The unsigned crc32 of a list of bytes, next to ``crc``."""
    step = "lambda c, b: xor(c >> 8, entries[CAST((xor(c, b) & 255) + 1 AS BIGINT)])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), {step}))"


ITEMS_SQL = " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    for c in ("doc_id", "source", "lang", "n_chars")
)
DECIMAL_BYTES_SQL = (
    "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(unicode(d) AS BIGINT))"
)


@with_sql(
    f"""
WITH RECURSIVE {CRC_TABLE_SQL}, docs AS (
  SELECT doc_id, lang, sha256({ITEMS_SQL} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN {crc_sql(DECIMAL_BYTES_SQL)} % 3 = 0 THEN
           sha256({ITEMS_SQL} || coalesce(strlen(text) || ':' || translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM documents, crc
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM docs
), nodes(lang, level, pos, digest, n) AS (
  SELECT lang, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), crown(level, pos, digest, n) AS (
  SELECT 0, pos, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM crown WHERE n > 1 GROUP BY level, pos // 8
), runs AS (
  SELECT lang, level, pos // 8 AS run, list(digest ORDER BY pos) AS digests
  FROM nodes WHERE n > 1 GROUP BY ALL
), crown_runs AS (
  SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM crown WHERE n > 1 GROUP BY ALL
), entries AS (
  SELECT l.lang, l.pos, r.level AS ord, r.digests, (l.pos >> (3 * r.level)) & 7 AS place
  FROM leaves l JOIN runs r ON r.lang IS NOT DISTINCT FROM l.lang AND r.run = l.pos >> (3 * r.level + 3)
  UNION ALL
  SELECT l.lang, l.pos, 100 + r.level, r.digests, (s.pos >> (3 * r.level)) & 7
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN crown_runs r ON r.run = s.pos >> (3 * r.level + 3)
), sides AS (
  SELECT lang, pos, ord, array_to_string(digests[1:place], '') AS before,
         array_to_string(digests[place + 2:], '') AS behind
  FROM entries
), paths AS (
  SELECT lang, pos, string_agg(before || behind, '' ORDER BY ord) AS siblings,
         list(before || '|' || behind ORDER BY ord) AS steps
  FROM sides GROUP BY lang, pos
), folded AS (
  SELECT l.doc_id, l.lang, l.leaf, coalesce(p.siblings, '') AS siblings,
         list_reduce(list_prepend(coalesce(l.tampered, l.leaf), coalesce(p.steps, [])),
                     lambda d, e: sha256(split_part(e, '|', 1) || d || split_part(e, '|', 2))) AS folded_root
  FROM leaves l LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
)
SELECT f.doc_id, f.leaf, s.digest AS subroot, c.digest AS root, sha256(f.siblings) AS proof_sha256,
       f.folded_root, f.folded_root = c.digest AS verified
FROM folded f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
JOIN crown c ON c.n = 1
"""
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


WORD_BYTES_SQL = (
    "flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), "
    "lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] "
    "ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))"
)


@with_sql(
    f"""
WITH RECURSIVE {CRC_TABLE_SQL}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc_sql(WORD_BYTES_SQL)} AS h FROM runs, crc WHERE length(run) >= 5
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) ||
                                        substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (
  SELECT word, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM words)
), near AS (
  SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.pos = y.pos AND x.word <> y.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
  SELECT * FROM (
    SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near,
           row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS nth
    FROM near JOIN words w ON w.word = b) WHERE nth = 1
), judged AS (
  SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near,
         CASE WHEN t.n >= 2 * w.n THEN t.b END AS form, CASE WHEN t.n >= 2 * w.n THEN t.n END AS form_n
  FROM words w LEFT JOIN best t ON t.a = w.word
), chains(word, pos, depth) AS (
  SELECT word, word, 0 FROM words
  UNION ALL
  SELECT c.word, j.form, c.depth + 1 FROM chains c JOIN judged j ON j.word = c.pos WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, r.root, j.n, j.n_near, j.form_n
FROM judged j JOIN (SELECT word, arg_max(pos, depth) AS root FROM chains GROUP BY word) r ON r.word = j.word
"""
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = histpack.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.withColumn("length", F.col("length").cast("long"))
