"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from portacube.llm import (decontam, filteraudit, langid, lattice, minhash, mixing, phrases, piecebpe, pii, sharding,
                           tokenfile, urlfilter, warc)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_byte_shards": sharding.op2_byte_shards,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_token_files": tokenfile.op4_token_files,
    "op5_minhash": minhash.op5_minhash,
    "op6_leaks": decontam.op6_leaks,
    "op7_warc": warc.op7_warc,
    "op8_url_templates": urlfilter.op8_url_templates,
    "op9_lattice": lattice.op9_lattice,
    "op10_language_id": langid.op10_language_id,
    "op11_phrases": phrases.op11_phrases,
    "op12_piece_ids": piecebpe.op12_piece_ids,
    "op13_filter_audit": filteraudit.op13_filter_audit,
}

MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || CAST(doc_id AS VARCHAR)) AS draw
  FROM documents),
s AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         [3, 1, 2][((ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
f AS (
  SELECT 0 AS round, NULL::DOUBLE AS level, -1::BIGINT AS clamped
  UNION ALL
  SELECT round + 1, level, clamped FROM (
    SELECT f.round, f.clamped AS previous,
           COUNT(*) FILTER (WHERE coalesce(s.weight * f.level > s.source_size * 2.0, FALSE)) AS clamped,
           ((SELECT SUM(source_size) FROM s) * 1.5
            - coalesce(SUM(s.source_size * 2.0) FILTER (WHERE coalesce(s.weight * f.level > s.source_size * 2.0, FALSE)), 0))
           / SUM(s.weight) FILTER (WHERE NOT coalesce(s.weight * f.level > s.source_size * 2.0, FALSE)) AS level
    FROM f, s GROUP BY f.round, f.clamped) WHERE clamped <> previous),
t AS (
  SELECT source, source_size,
         LEAST(source_size * 2.0, weight * (SELECT arg_max(level, round) FROM f))::DOUBLE AS target FROM s),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source,
         coalesce(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         floor(t.target / greatest(t.source_size, 1)) AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + LEAST(size, GREATEST(0, floor(target) - whole * source_size - before)) AS BIGINT) AS taken,
       source
FROM p
"""

LINKED_SQL = """
r AS (SELECT u AS id, v AS other FROM l UNION SELECT r.id, l.v FROM r JOIN l ON r.other = l.u),
c AS (SELECT id, MIN(other) AS least_id FROM r GROUP BY id)
"""

MINHASH_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                                      ELSE w END) AS shingle
  FROM d),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, COUNT(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS (SELECT p.u, p.v FROM p JOIN n x ON x.doc_id = p.u JOIN n y ON y.doc_id = p.v
      WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
""" + LINKED_SQL + """
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.least_id, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.least_id, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.id = d.doc_id
"""

LATTICE_SQL = """
WITH RECURSIVE x AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda a: a IS NULL OR NOT isfinite(a))) = 0
    AND len(list_filter(embedding, lambda a: a <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM x a JOIN x b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
""" + LINKED_SQL + """
SELECT e.vec_id, (SELECT COUNT(*) FROM l WHERE l.u = e.vec_id)::BIGINT AS n_links,
       least(e.vec_id, coalesce(c.least_id, e.vec_id)) AS component_id, e.vec_id <= coalesce(c.least_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON c.id = e.vec_id
"""

ORACLE = {"op3_source_mix": MIX_SQL, "op5_minhash": MINHASH_SQL, "op7_warc": warc.WARC_SQL,
          "op9_lattice": LATTICE_SQL, "op11_phrases": phrases.PHRASE_SQL, "op13_filter_audit": filteraudit.FILTER_SQL}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
