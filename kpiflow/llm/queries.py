"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.llm import ann, decontam, fingerprints, html, lines, minhash, mixing, periodic, pii, prefix_trie, quality, sharding, tokens
from kpiflow.llm.common import table


def op1_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after redaction and a source note, without counting it twice."""
    docs = table(spark, sf_dir, "documents")
    note = F.concat(F.lit("\n["), F.coalesce("source", F.lit("unknown")), F.lit("]"))
    return tokens.count_edited(tokens.with_redactions(docs, note), F.col("edits")).drop("leaf_tokens")


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op6_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op8_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents")).drop("copies")


def op10_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op11_lookup_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digest(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(prefix_trie.branched(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(table(spark, sf_dir, "documents"), periodic.planted_text(F.col("doc_id"), F.col("text")))


#: op9 recomputed from the contract: water-filled targets, then the prefix of the Pareto order per source.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (CAST('0x' || substr(md5('mix-1|' || coalesce('=' || CAST(doc_id AS VARCHAR), '-')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
m AS (SELECT *, CAST(CASE WHEN size > 0 THEN length(bin(size)) ELSE 1 END AS BIGINT) AS measure FROM d),
s AS (SELECT source, sum(size)::BIGINT AS ss, sum(size * measure)::BIGINT AS mass FROM m GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
l AS (SELECT *, 3 * ss AS cap,
        ((sum(ss) OVER () - coalesce(sum(3 * ss) OVER (ORDER BY 3 * ss / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * ss / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS lev FROM w),
t AS (SELECT source, ss, mass, least(cap::DOUBLE, coalesce((SELECT arg_min(lev, cap / w) FROM l x WHERE x.lev * x.w <= x.cap), 0.0) * w) AS target FROM l),
r AS (SELECT *, CASE WHEN ss > 0 THEN floor(target / ss) ELSE 0 END AS whole FROM t),
k AS (SELECT m.doc_id, m.size, m.u, m.source, r.ss, r.target, r.whole::BIGINT AS whole, r.target - r.whole * r.ss AS rest,
             least(1.0::DOUBLE, CASE WHEN r.mass > 0 THEN (r.target - r.whole * r.ss) / r.mass ELSE 0 END * m.measure) AS p
      FROM m JOIN r ON m.source IS NOT DISTINCT FROM r.source),
z AS (SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / (u * (1 - p) + p * (1 - u)) ELSE 1 END AS z FROM k),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY z, doc_id NULLS FIRST) AS upto FROM z)
SELECT doc_id, size::BIGINT AS size, ss::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN size > 0 AND rest > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


#: op12 recomputed from the contract: nodes as groups of equal prefixes, subtrees by a join on prefixes. crc32 has no
#: DuckDB function: it is taken bit by bit over the decimal digits (an XOR with 0xEDB88320 for each 1 shifted out).
OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role_, md5(length(role_) || ':' || role_ || text_)) AS k,
         md5(length(role_) || ':' || role_ || text_) AS key, len(regexp_extract_all(text_, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role_, coalesce(text, '') AS text_ FROM conversations WHERE conv_id IS NOT NULL)),
crc AS (
  SELECT conv_id, 1 AS step, (4294967295::BIGINT) AS c FROM (SELECT DISTINCT conv_id FROM t)
  UNION ALL
  SELECT conv_id, step + 1,
         list_reduce(list_prepend(xor(c, ascii(substr(conv_id::VARCHAR, step, 1))::BIGINT), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                     lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)
  FROM crc WHERE step <= length(conv_id::VARCHAR)),
h AS (SELECT conv_id, xor(arg_max(c, step), 4294967295) % 4 AS h FROM crc GROUP BY conv_id),
turns AS (
  SELECT h.conv_id, t.k, t.key, t.words FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.k <= h.h
  UNION ALL
  SELECT h.conv_id, t.k + 1000000, t.key, t.words FROM h JOIN t ON t.conv_id = h.conv_id AND t.k > h.h),
seqs AS (SELECT h.conv_id, coalesce(list(turns.key ORDER BY k) FILTER (key IS NOT NULL), []) AS s, coalesce(list(turns.words ORDER BY k) FILTER (key IS NOT NULL), []) AS w
         FROM h LEFT JOIN turns USING (conv_id) GROUP BY h.conv_id),
prefixes AS (SELECT conv_id, d, list_slice(s, 1, d) AS p, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS words, len(s) = d AS ends
             FROM (SELECT conv_id, s, w, unnest(range(len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY p, d),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON nodes.p = kids.p),
below AS (SELECT list_slice(p, 1, a) AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * words) AS saved
          FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_ f JOIN below b ON f.p = b.p LEFT JOIN nodes u ON f.d > 0 AND u.p = list_slice(f.p, 1, f.d - 1)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_edited_token_counts": op1_edited_token_counts,
        "op2_hyperminhash": op2_hyperminhash,
        "op3_block_rules": op3_block_rules,
        "op4_fuzzy_lines": op4_fuzzy_lines,
        "op5_kd_sharding": op5_kd_sharding,
        "op6_vantage_point_search": op6_vantage_point_search,
        "op7_boosted_pii": op7_boosted_pii,
        "op8_factorisation_quality": op8_factorisation_quality,
        "op9_pareto_mixing": op9_pareto_mixing,
        "op10_bm25_decontamination": op10_bm25_decontamination,
        "op11_lookup_sketches": op11_lookup_sketches,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_pareto_mixing": OP9_SQL, "op12_conversation_trie": OP12_SQL}
