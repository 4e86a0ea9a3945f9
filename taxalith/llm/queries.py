"""The queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from taxalith.llm import jaccard, licenses, lines, lm, media, mixing, packing, quality, topk, toxicity
from taxalith.llm.common import table


def op1_lines(spark, sf_dir):
    return lines.document_lines(spark, sf_dir)


def op2_toxicity(spark, sf_dir):
    return toxicity.toxic_documents(spark, sf_dir)


def op3_matroska(spark, sf_dir):
    return media.document_media(table(spark, sf_dir, "documents"))


def op4_packing(spark, sf_dir):
    return packing.pack_documents(spark, sf_dir)


def op5_topk(spark, sf_dir):
    return topk.nearest(spark, sf_dir)


def op6_mixing(spark, sf_dir):
    return mixing.mix_plan(spark, sf_dir)


def op7_lm(spark, sf_dir):
    return lm.score_documents(spark, sf_dir)


def op8_licenses(spark, sf_dir):
    return licenses.document_licenses(spark, sf_dir)


def op9_jaccard(spark, sf_dir):
    return jaccard.joined(spark, sf_dir)


def op10_quality(spark, sf_dir):
    return quality.quality_documents(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (op1_lines, op2_toxicity, op3_matroska, op4_packing, op5_topk, op6_mixing, op7_lm, op8_licenses, op9_jaccard, op10_quality)}


TOPK_SQL = """WITH v AS (
  SELECT vec_id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5"""


JACCARD_SQL = r"""WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS shingle FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), reach(a, b) AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(doc_id, coalesce(min(b), doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN reach ON doc_id = a GROUP BY doc_id"""


def oracle_sql():
    return {"op5_topk": TOPK_SQL, "op9_jaccard": JACCARD_SQL}
