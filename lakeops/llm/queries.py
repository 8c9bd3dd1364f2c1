"""Every operator on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import mixing
from lakeops.llm.arrow_shards import read_documents, write_shards
from lakeops.llm.bayes_pairs import near_components
from lakeops.llm.bpe import encoded_and_decoded, ids_digest
from lakeops.llm.centroids import clustered
from lakeops.llm.chosen_path import linked
from lakeops.llm.conversations import damaged
from lakeops.llm.conversations import judged as repaired_conversations
from lakeops.llm.digest_index import DigestIndex, judged
from lakeops.llm.html_extract import extracted
from lakeops.llm.langid import held_out, identified, learned
from lakeops.llm.registry import ORACLES, QUERIES, query
from lakeops.llm.sentence_spans import deduplicated
from lakeops.llm.surrogates import replaced
from lakeops.llm.topk import top_k
from lakeops.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query("op1_tag_path_ratios", "pages")
def op1(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    return extracted(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: For tests; a key of one's own comes from a secret store.
KEY = "not a secret"


@query("op2_keyed_surrogates", "documents")
def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document with surrogates for personal data and secrets."""
    return replaced(docs.select("doc_id", "text"), KEY)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""


@query("op3_three_phase_top_k", "embeddings", OP3_SQL)
def op3(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The ten nearest of all vectors for those whose number is divisible by 100."""
    return top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


@query("op4_chosen_path_join", "documents")
def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document with its near-duplicate class, the class of its word five-grams, and its links."""
    return linked(docs).drop("__row", "__class")


@query("op5_bpe_encode_decode", "documents")
def op5(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    both = encoded_and_decoded(docs.select("doc_id", "text"), BYTE_BPE)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op6_sentence_span_dedup", "documents")
def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """What is left of every document, and how many sentences it had and lost."""
    return deduplicated(docs.select("doc_id", "text"), ends=True)


@query("op7_arrow_sequences", "documents")
def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document as it is read back from the shards that were written."""
    folder = scratch_path(spark, "shards")
    write_shards(docs, folder, BYTE_BPE, end=0)
    return read_documents(spark, folder)


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h, length(coalesce(text, '')) AS n
  FROM documents),
g AS (SELECT h, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""


@query("op8_digest_index_dedup", "documents", OP8_SQL)
def op8(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document against a new index, as its first batch."""
    index = DigestIndex(spark, scratch_path(spark, "index"))
    return judged(docs, index, "documents").drop("__row")


@query("op9_language_mixtures", "documents")
def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    found = identified(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages", "shares")


#: What a label makes of a document, and the share of the tokens that each domain is to have.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' WHEN quality = 1 THEN 'good' END"
TARGETS = {"good": 0.90, "poor": 0.09, "toxic": 0.01}


@query("op10_soft_mixing", "documents labels")
def op10(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Domain probabilities, rate and copies of every document, the good documents' tokens staying as they are."""
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    rates = mixing.mixed_rates(docs, model, TARGETS, keep="good")
    keys = docs.select("doc_id", F.monotonically_increasing_id().alias("row"))
    shown = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return keys.join(rates, "row").select("doc_id", F.col("tokens").alias("n_tokens"), *shown, "rate", "copies")


@query("op11_auction_repair", "conversations")
def op11(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after it was damaged."""
    return repaired_conversations(damaged(conversations)).withColumnRenamed("conv", "conv_id")


def _op12_sql(rounds: int = 3, k: int = 16) -> str:
    squared = "CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    parts = [
        f"""v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), e) - 1 AS cluster, e
  FROM v ORDER BY cluster LIMIT {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (
  SELECT row, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, arg_min(cluster, ({squared}, cluster)) AS cluster,
    min({squared}) AS distance
  FROM v, c{r} AS c GROUP BY row)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (
  SELECT cluster, list(m ORDER BY pos) AS e
  FROM (
    SELECT cluster, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (
      SELECT cluster, pos, sum(x) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM a{r}) GROUP BY cluster, pos))
  GROUP BY cluster),
c{r + 1} AS (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{r} AS c LEFT JOIN m{r} AS m USING (cluster))"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c USING (cluster)
"""


@query("op12_vantage_tree_clusters", "embeddings", _op12_sql())
def op12(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Cluster, distance and inertias of every vector after three rounds."""
    return clustered(vectors)


@query("op13_bayes_near_dedup", "documents")
def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_components(docs)
