"""One thin query per operator, with production parameters, over its whole table; SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm.bpe import bpe_tokens
from quarry.llm.common import ship_package, table
from quarry.llm.decontaminate import contaminated
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.hard_negatives import mine_hard_negatives
from quarry.llm.language_id import in_held_out, train_language_model, with_language
from quarry.llm.ngram_join import ngram_components
from quarry.llm.secrets import digest_columns, find_secrets, labelled_tokens, train_markov
from quarry.llm.suffix_dedup import remove_repeats
from quarry.llm.token_counts import token_counts
from quarry.llm.toxicity import score_toxicity, toxicity_samples, train_toxicity
from quarry.llm.token_files import id_checksums, read_token_files, write_token_files
from quarry.llm.url_reputation import judge_pages
from quarry.llm.whitening import fit_whitening, identity_error, whiten
from quarry.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, regexp_extract(url, '^(?s:.*?)://((?s:.*))$', 1) AS rest FROM pages),
judged AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
parts AS (
  SELECT *, list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.') AS domain, string_split(host, '.')[-1] AS suffix FROM judged),
hosts AS (
  SELECT p.host, p.domain, p.suffix, count(*) AS n, sum(1.0 - l.quality)::DOUBLE AS bad
  FROM parts p JOIN labels l ON l.doc_id = p.page_id WHERE l.quality IS NOT NULL GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
everything AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS mean FROM suffixes),
s0 AS (SELECT s.*, e.mean AS up FROM suffixes s, everything e),
s1 AS (SELECT 1 / coalesce(CASE WHEN sum(n * (n - 1) * up * (1 - up)) > 0 THEN least(0.5, greatest(0.001,
  sum(pow(bad - n * up, 2) - n * up * (1 - up)) / sum(n * (n - 1) * up * (1 - up)))) ELSE 0.5 END, 0.5) - 1 AS k FROM s0),
s2 AS (SELECT suffix, k * up + bad AS a, k * (1 - up) + n - bad AS b FROM s0, s1),
d0 AS (SELECT d.*, s2.a / (s2.a + s2.b) AS up FROM domains d JOIN s2 USING (suffix)),
d1 AS (SELECT 1 / coalesce(CASE WHEN sum(n * (n - 1) * up * (1 - up)) > 0 THEN least(0.5, greatest(0.001,
  sum(pow(bad - n * up, 2) - n * up * (1 - up)) / sum(n * (n - 1) * up * (1 - up)))) ELSE 0.5 END, 0.5) - 1 AS k FROM d0),
d2 AS (SELECT domain, k * up + bad AS a, k * (1 - up) + n - bad AS b FROM d0, d1),
h0 AS (SELECT h.*, d2.a / (d2.a + d2.b) AS up FROM hosts h JOIN d2 USING (domain)),
h1 AS (SELECT 1 / coalesce(CASE WHEN sum(n * (n - 1) * up * (1 - up)) > 0 THEN least(0.5, greatest(0.001,
  sum(pow(bad - n * up, 2) - n * up * (1 - up)) / sum(n * (n - 1) * up * (1 - up)))) ELSE 0.5 END, 0.5) - 1 AS k FROM h0),
h2 AS (SELECT host, k * up + bad AS a, k * (1 - up) + n - bad AS b FROM h0, h1),
post AS (
  SELECT p.*, coalesce(h2.a, d2.a, s2.a, e.mean) AS a, coalesce(h2.b, d2.b, s2.b, 1 - e.mean) AS b
  FROM parts p CROSS JOIN everything e LEFT JOIN h2 USING (host) LEFT JOIN d2 USING (domain) LEFT JOIN s2 USING (suffix)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    a / (a + b) AS mean, greatest(0, a / (a + b) - 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))) AS low
  FROM post)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict, round(mean, 6) AS bad_rate, round(low, 6) AS bad_low FROM ruled
"""


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op1_url_reputation", OP1_SQL)
def op1(spark, sf_dir):
    """Every page's url. Outcomes: the quality labels, whose doc_id is taken as the page's id (bad = quality 0)."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    out = judge_pages(table(spark, sf_dir, "pages"), labels)
    return out.withColumn("bad_rate", F.round("bad_rate", 6)).withColumn("bad_low", F.round("bad_low", 6))


@query("op2_bpe")
def op2(spark, sf_dir):
    return bpe_tokens(table(spark, sf_dir, "documents"))


@query("op3_secrets")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return digest_columns(find_secrets(docs, train_markov(labelled_tokens(docs))))


@query("op4_language_id")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = with_language(docs.drop("lang"), train_language_model(docs))
    return out.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op5_toxicity")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = score_toxicity(docs, train_toxicity(toxicity_samples(docs, table(spark, sf_dir, "labels"))))
    return out.withColumn("expected_severity", F.round("expected_severity", 6))


@query("op6_ngram_join")
def op6(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op7_token_files")
def op7(spark, sf_dir):
    """Writes the token files to the shared folder, reads them back, and sums up what it read."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return id_checksums(read_token_files(spark, path))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


@query("op9_exact_dedup", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op9(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op10_decontaminate")
def op10(spark, sf_dir):
    """The documents that hold a benchmark passage, with the passage and how much of it."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_whitening")
def op11(spark, sf_dir):
    """All vectors whitened by the eight leading components of all vectors, with the measured distance from the identity."""
    vectors = table(spark, sf_dir, "embeddings")
    model = fit_whitening(vectors)
    return whiten(vectors, model).withColumn("identity_error", F.lit(identity_error(vectors, model)))


@query("op12_suffix_dedup")
def op12(spark, sf_dir):
    """Every document without the bytes of strings of 400 bytes that start at two places or more."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_hard_negatives", OP13_SQL)
def op13(spark, sf_dir):
    """Anchors: identifiers divisible by 50, against all rows; each seventh identifier takes the next label."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", changed.alias("label"))
    return mine_hard_negatives(vectors, lambda i: i % 50 == 0)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
