"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from visitmart.llm import ann, bpe, decontaminate, fm, interactions, jaccard, maxent, mixing, pii, secrets, sharding, toxicity, zonemaps
from visitmart.llm.shared import importable

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Sets of word runs, all pairs that share one, and everything reachable over links.
SQL["op3_ngram_jaccard"] = f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, chr(31))]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], chr(31)))) END AS s FROM w),
runs AS (SELECT doc_id, len(s) AS n, unnest(s) AS run FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS shared
  FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (an + bn - shared)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id
FROM sets s LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = s.doc_id"""


def _spans_sql(rule: secrets.Rule, number: int) -> str:
    pattern = rule.pattern.replace("'", "''").replace("{16,}+", "{16,}")
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {number} AS place, {rule.least} AS least,
      regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_extract_all(t, '{pattern}', {rule.group}) AS parts,
      regexp_split_to_array(t, '{pattern}') AS gaps FROM d"""


#: The patterns' spans from the texts between matches and the matches themselves.
SQL["op5_secrets"] = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(_spans_sql(r, i) for i, r in enumerate(secrets.RULES))}),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found),
spans AS (SELECT doc_id, kind, place,
  (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0))::BIGINT AS s,
  length(hits[i]) AS n FROM each WHERE length(parts[i]) >= least),
report AS (SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place), '') AS spans
  FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, n_assign, n_access, n_hex, sha256(spans) AS base_sha256, spans FROM report"""

_VECTOR = "list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)"
_FLOOR = "((s - ((s % n) + n) % n) // n)::BIGINT"
_APART = "list_sum(list_transform(list_zip(r.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _round_sql(number: int) -> str:
    """Assignment to the centroids ``c<number>``, and the centroids after it."""
    return f"""a{number} AS MATERIALIZED (
  SELECT row, arg_min(c.k, (d, c.k)) AS k, min(d) AS d FROM (
    SELECT r.row, c.k, {_APART} AS d FROM r, c{number} c) x, LATERAL (SELECT x.k AS k) c GROUP BY row),
c{number + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{number} c LEFT JOIN (
    SELECT k, list({_FLOOR} ORDER BY i) AS v FROM (
      SELECT k, i, sum(r.v[i])::HUGEINT AS s, count(*) AS n FROM a{number} JOIN r USING (row), range(1, 65) t(i) GROUP BY k, i)
    GROUP BY k) m USING (k)),"""


#: Ten rounds over the whole numbers, written out one after the other.
SQL["op11_hilbert_zone_maps"] = f"""WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, {_VECTOR} AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (
    SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM r ORDER BY h, v LIMIT 8)),
{chr(10).join(_round_sql(i) for i in range(11))}
own AS (SELECT k, sum(d)::BIGINT AS cluster_inertia FROM a10 GROUP BY k)
SELECT vec_id, a10.k::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a10) AS inertia,
  sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN r USING (row) JOIN own ON own.k = a10.k JOIN c10 ON c10.k = a10.k"""

#: Failed filters of every document, all orders of the five letters, and sums over both.
SQL["op12_packed_counters"] = """WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, good, toxic, fails, count(*) AS n, len(list_filter(fails, lambda x: x)) AS failed FROM f GROUP BY ALL),
x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT part, filter_order, step, good, toxic, n, failed,
    fails[ascii(filter_order[step]) - 64] AS fails_here,
    len(list_filter(range(1, step), lambda i: fails[ascii(filter_order[i]) - 64])) > 0 AS gone
  FROM m, o, range(1, 6) t(step)),
g AS (SELECT part, filter_order, step::INT AS step,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_here), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails_here), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails_here), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails_here AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (NOT gone AND fails_here AND good = 1), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (NOT gone AND fails_here AND toxic = 1), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM g"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


@query
def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = fm.score(docs, fm.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", fm.held_out(scored.doc_id).alias("held_out"), "score", "predicted")


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip_report(docs, path, public_tokenizers.PATTERN)


@query
def op7_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.pii_report(docs, pii.train(docs))


@query
def op8_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


@query
def op9_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(scored.doc_id).alias("held_out"), "score", "predicted", "windows", "worst_word")


@query
def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op11_hilbert_zone_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonemaps.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_packed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "rate")
