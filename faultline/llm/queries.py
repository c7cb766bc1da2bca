"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    html_text, impact_search, line_dedup, mixing, neighbours, ngram_join, packing, part_tries, quality_rules, resampling,
    secret_scan, sharding, toxicity,
)
from faultline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes of every document, by epoch."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def _share_out_sql(name: str, source: str, parents: str, level: str, weight: str) -> str:
    part = f"PARTITION BY {parents}" if parents else ""
    order = f"{part} ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), {level}"
    return f"""
{name}1 AS (SELECT *, CAST({weight} AS HUGEINT) AS weight FROM {source}),
{name}2 AS (SELECT *,
    coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER ({part}) - coalesce(sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS heavier,
    sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM {name}1),
{name}3 AS (SELECT *, CAST(cap AS HUGEINT) * heavier <= (parent_budget - used) * weight AS filled FROM {name}2),
{name}4 AS (SELECT *, min(CASE WHEN NOT filled THEN used END) OVER ({part}) AS open_used,
    min(CASE WHEN NOT filled THEN running - weight END) OVER ({part}) AS open_at,
    max(CASE WHEN NOT filled THEN heavier END) OVER ({part}) AS open_all
  FROM {name}3),
{name} AS (SELECT * EXCLUDE (weight, used, heavier, running, filled, open_used, open_at, open_all, parent_budget),
    CAST(CASE WHEN filled THEN cap ELSE (parent_budget - open_used) * (running - open_at) // open_all
      - (parent_budget - open_used) * (running - open_at - weight) // open_all END AS HUGEINT) AS budget
  FROM {name}4)"""


ORACLES["op1_mix_sources"] = r"""
WITH counts AS (
  SELECT doc_id, coalesce(CASE WHEN source = 'src0' THEN 'web' WHEN regexp_matches(source, '^src[1-9]$') THEN 'books'
      WHEN regexp_matches(source, '^src[0-9]+$') THEN 'reference' END, '(none)') AS domain,
    coalesce(lang, '(none)') AS language, coalesce(source, '(none)') AS origin,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
  FROM documents),
leaves AS (
  SELECT domain, language, origin, sum(tokens) AS supply, 2 * sum(tokens) AS cap FROM counts WHERE tokens > 0 GROUP BY ALL),
domain_caps AS (
  SELECT domain, sum(cap) AS cap, (SELECT sum(supply) FROM leaves) * 7 // 10 AS parent_budget FROM leaves GROUP BY ALL),
""" + ",".join(
    [
        _share_out_sql("domains", "domain_caps", "", "domain",
                       "CASE domain WHEN 'web' THEN 3 WHEN 'books' THEN 4 WHEN 'reference' THEN 3 ELSE 1 END"),
        """
language_caps AS (SELECT l.domain, language, sum(l.cap) AS cap, any_value(d.budget) AS parent_budget
  FROM leaves l JOIN domains d USING (domain) GROUP BY ALL)""",
        _share_out_sql("languages", "language_caps", "domain", "language",
                       "CASE language WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END"),
        """
leaf_caps AS (SELECT l.*, b.budget AS parent_budget FROM leaves l JOIN languages b USING (domain, language))""",
        _share_out_sql("budgets", "leaf_caps", "domain, language", "origin", "1"),
        r"""
plan AS (SELECT domain, language, origin, CAST(budget // supply AS INT) AS epochs, budget % supply AS rest FROM budgets),
rows AS (SELECT * FROM counts JOIN plan USING (domain, language, origin) WHERE tokens > 0),
ordered AS (
  SELECT *, rest - coalesce(sum(tokens) OVER (PARTITION BY domain, language, origin
      ORDER BY md5('11|' || epochs || '|' || doc_id), tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS still
  FROM rows)
SELECT doc_id, domain, language, origin, tokens, CAST(epoch AS INT) AS epoch, tokens AS taken
FROM (SELECT *, unnest(range(epochs)) AS epoch FROM rows)
UNION ALL
SELECT doc_id, domain, language, origin, tokens, epochs, CAST(least(tokens, still) AS BIGINT) FROM ordered WHERE still > 0
""",
    ]
)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_pack_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products found for every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log weight, noisy key and verdict of every document."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query
def op7_shard_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shuffled_shards(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the newest policy."""
    return quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))


_MARKED_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
placed AS (SELECT rid, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM texts),
windows AS (
  SELECT rid, i, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3
  FROM placed WINDOW p AS (PARTITION BY rid ORDER BY i)),
counted AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w1, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM counted WHERE n >= 2) GROUP BY rid),
measures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (rid)),
marked AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (2 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
    + 16 * (2 * word_chars < 3 * n_words)::INT + 32 * (word_chars > 30 * n_words)::INT AS BIGINT) AS failed_rules
  FROM measures)
"""

ORACLES["op8_quality_rules"] = _MARKED_SQL + """
SELECT *, 3 AS policy_version, failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept FROM marked
"""


@query
def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the newest policy does: documents that fail it, fail it alone, are kept without it."""
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents")))


ORACLES["quality_rule_ablations"] = _MARKED_SQL + """,
rules AS (SELECT unnest(['few_words', 'repeated_words', 'many_symbols', 'repeated_lines', 'short_words', 'long_words']) AS rule,
  unnest([1, 2, 4, 8, 16, 32]) AS bit)
SELECT rule, CAST(bit AS BIGINT) AS bit, CAST(count(*) FILTER (failed_rules & bit <> 0) AS BIGINT) AS n_failed,
  CAST(count(*) FILTER (failed_rules = bit) AS BIGINT) AS n_failed_alone,
  CAST(count(*) FILTER (failed_rules IN (0, bit)) AS BIGINT) AS n_kept_without
FROM marked CROSS JOIN rules GROUP BY rule, bit
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 3-word shingle sets at 0.9."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


ORACLES["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n_words, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, n_words, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3
  FROM placed WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (
  SELECT DISTINCT doc_id, [w1, w2, w3] AS shingle FROM windows WHERE w3 IS NOT NULL
  UNION SELECT doc_id, words FROM texts WHERE len(words) IN (1, 2)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
counted AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM counted JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least_id, t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
"""


@query
def op10_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components with every link counted: how many other documents each document links with."""
    return ngram_join.ngram_links(table(spark, sf_dir, "documents"))


ORACLES["op10_ngram_jaccard_links"] = ORACLES["op10_ngram_jaccard_join"].rpartition("SELECT t.doc_id")[0] + r"""
SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least_id, t.doc_id) AS component_id,
  CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM texts t LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(DISTINCT b) AS n_links FROM links GROUP BY a) USING (doc_id)
"""


@query
def op11_code_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and errors of every usable vector."""
    coded, books = part_tries.compressed(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _codes_sql(rounds: int) -> str:
    """Lloyd rounds as one block of common table expressions each."""
    nearest = """
distances{r} AS (
  SELECT vec_id, position, entry, sum((p.x - e.x) * (p.x - e.x)) AS distance
  FROM parts p JOIN entries{r} e USING (position, place) GROUP BY ALL),
near{r} AS (
  SELECT vec_id, position, arg_min(entry, distance * 256 + entry) AS entry, min(distance) AS distance
  FROM distances{r} GROUP BY ALL)"""
    moved = """,
moved{r} AS (
  SELECT position, entry, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM near{r} JOIN parts USING (vec_id, position) GROUP BY ALL),
entries{n} AS (
  SELECT position, entry, place, coalesce(m.x, e.x) AS x
  FROM entries{r} e LEFT JOIN moved{r} m USING (position, entry, place))"""
    steps = "".join(nearest.format(r=r) + moved.format(r=r, n=r + 1) + "," for r in range(rounds))
    return steps + nearest.format(r=rounds)


ORACLES["op11_code_tries"] = """
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (
  SELECT vec_id, label, len(embedding) // 4 AS width, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i
  FROM kept),
parts AS (
  SELECT vec_id, label, i // width AS position, i % width AS place, CAST(floor(CAST(v AS DOUBLE) * 1024) AS BIGINT) AS x
  FROM whole),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
entries0 AS (SELECT position, entry, place, x FROM parts JOIN seeds USING (vec_id)),""" + _codes_sql(part_tries.ROUNDS) + """,
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY position) AS code,
    CAST(sum(distance) AS BIGINT) AS error
  FROM near4 JOIN kept USING (vec_id) GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY position, entry, place)) FROM entries4) AS codebooks_sha256
FROM coded
"""


@query
def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return impact_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_impact_search"] = r"""
WITH doc_terms AS (
  SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents)),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
totals AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS length FROM doc_terms),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines that ten documents share."""
    docs = table(spark, sf_dir, "documents")
    cut = line_dedup.without_lines(docs, line_dedup.line_bitmaps(docs))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cut.select("document.doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


ORACLES["op13_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (key)
GROUP BY doc_id
"""
