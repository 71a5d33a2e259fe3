"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stockweave.llm import (
    divergence,
    langid,
    linededup,
    mixing,
    neardup,
    packing,
    pseudolm,
    quality,
    substrings,
    tokenfiles,
    topk,
    triejoin,
    vectorcodes,
)
from stockweave.llm.common import table, vocabulary
from stockweave.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query
def op1_sum_of_squares_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json")).drop("row")


@query
def op6_suffix_repetition(spark, sf_dir):
    return quality.rules(table(spark, sf_dir, "documents"))


@query
def op7_line_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


# Lines with a word are numbered; a window is known by its three lines, joined.
_SQL["op7_line_windows"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS nr
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT a.doc_id, a.pos AS first_at, c.pos AS last_at,
         a.line || chr(10) || b.line || chr(10) || c.line AS content
  FROM filled a
  JOIN filled b ON b.doc_id = a.doc_id AND b.nr = a.nr + 1
  JOIN filled c ON c.doc_id = a.doc_id AND c.nr = a.nr + 2
), later AS (
  SELECT doc_id, first_at, last_at FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first_at) AS place
    FROM windows
  ) WHERE place > 1
), gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM lines l
  JOIN later w ON w.doc_id = l.doc_id AND l.pos BETWEEN w.first_at AND w.last_at
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
  GROUP BY l.doc_id
), counts AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(c.n, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id)
"""


@query
def op9_segment_topk(spark, sf_dir):
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


_SQL["op9_segment_topk"] = r"""
WITH whole AS (
  SELECT row_number() OVER () AS nr, vec_id,
         [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.nr, q.vec_id AS query_id, c.nr AS row, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.nr <> c.nr AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY nr ORDER BY score DESC, vec_id NULLS LAST, row) AS place
  FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


@query
def op2_dictionary_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tokenfiles.token_table(docs, vocabulary("word_bpe_49k.json"), end_id=1)


@query
def op3_rank_order_language(spark, sf_dir):
    fold = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4
    held_out = F.coalesce(fold == 2, F.lit(False))
    return langid.identify(table(spark, sf_dir, "documents"), held_out)


@query
def op4_raked_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs).drop("row")


_SQL["op4_raked_mixture"] = mixing.sql()


@query
def op5_weighted_minhash(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


@query
def op8_masked_likelihood(spark, sf_dir):
    return pseudolm.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query
def op10_induced_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return divergence.audit(docs)


_SQL["op11_source_divergence"] = divergence.SQL


@query
def op12_prefix_trie_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return triejoin.link_components(docs).drop("copies")


_SQL["op12_prefix_trie_join"] = triejoin.SQL


@query
def op13_norm_of_sum_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vectorcodes.code_table(vectors)


_SQL["op13_norm_of_sum_codes"] = vectorcodes.sql()


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
