"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.llm import bpe, divergence, leaks, mixing, near, neighbours, pages, pieces, quality, repeats, shards, turns, vectors
from shiftloom.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op8_bpe_encode_decode")
def bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query("op3_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removed(table(spark, folder, "documents"), length=400)


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, folder, "labels")))


# Components by walking the links of every document: for the small tables the check runs on.
WALK = """walk(a, b) AS (SELECT id, id FROM ids UNION SELECT w.a, l.b FROM walk w JOIN links l ON w.b = l.a),
  parts AS (SELECT a AS id, min(b) AS component_id FROM walk GROUP BY a)"""

NEAR_SQL = f"""WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  sets AS (SELECT doc_id AS id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM split),
  ids AS (SELECT id FROM sets),
  items AS (SELECT id, unnest(s) AS item, len(s) AS n FROM sets),
  links AS (SELECT x.id AS a, y.id AS b FROM items x JOIN items y ON x.item = y.item AND x.id <> y.id
    GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
  {WALK}
  SELECT id AS doc_id, len(s)::BIGINT AS n_shingles, component_id, id = component_id AS kept FROM sets JOIN parts USING (id)"""


@query("op4_minhash_near_dedup", NEAR_SQL)
def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near(table(spark, folder, "documents"), wide=4, percent=80)


VECTORS_SQL = f"""WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
  v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_cosine_similarity(x.e, y.e) >= 0.95),
  {WALK}
  SELECT p.id AS vec_id, count(l.b) AS n_links, component_id, p.id = component_id AS kept
  FROM parts p LEFT JOIN links l ON l.a = p.id GROUP BY ALL"""


@query("op9_embedding_near_dedup", VECTORS_SQL)
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"), least=0.95)


@query("op7_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shards(table(spark, folder, "documents"), n=8)


@query("op2_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


#: Shares of the tokens that each domain shall have in the mix, and the mix's size.
TARGETS = {"plain": 0.88, "toxic": 0.1, "low": 0.02}
SIZE = 1.5


def domains(labels: DataFrame) -> DataFrame:
    """The labelled table: doc_id and domain."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", kind.when(F.col("quality") == 1, "plain").alias("domain"))


@query("op10_soft_membership_mixing")
def soft_membership_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mixed(docs, domains(table(spark, folder, "labels")), TARGETS, SIZE)


@query("op5_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.counted(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query("op6_approximate_nearest_neighbours")
def approximate_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), every=100, k=10)


DIVERGENCE_SQL = """WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
  words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
  held AS (SELECT r, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
  kept AS (SELECT lang, term FROM held GROUP BY ALL HAVING count(*) >= 10),
  v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
  groups AS (SELECT DISTINCT lang, source FROM docs),
  counts AS (SELECT lang, source, term, sum(n) AS n FROM held JOIN kept USING (lang, term) GROUP BY ALL),
  totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
  p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
      1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)::HUGEINT) // (total + 2 * v)::HUGEINT AS p
    FROM totals JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
  q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v))::HUGEINT AS q
    FROM counts JOIN v USING (lang) GROUP BY lang, term),
  summed AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
  SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


@query("op13_source_divergence_audit", DIVERGENCE_SQL)
def source_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audited(table(spark, folder, "documents"))


@query("op11_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return leaks.digests(leaks.scanned(docs, leaks.fit(docs)))


@query("op12_conversation_structure_repair")
def conversation_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turns.digests(turns.repaired(turns.damaged(table(spark, folder, "conversations"))))
