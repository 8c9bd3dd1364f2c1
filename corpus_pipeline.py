"""From raw documents to encoded training text, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import langid, mixing
from lakeops.llm.bpe import encoded_and_decoded, ids_digest
from lakeops.llm.chosen_path import one_of_each
from lakeops.llm.digest_index import DigestIndex, first_copies
from lakeops.llm.queries import BYTE_BPE, DOMAIN, TARGETS
from lakeops.session import apply_profile, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which learned languages, all together, explain a part that counts."""
    return langid.accepted(docs, langid.learned(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, against an index that is new for each run."""
    return first_copies(docs, DigestIndex(spark, scratch_path(spark, "index")), "documents")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets want them, good ones at least once; rates near 1 keep a document once."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mixing.learned(docs, labels, F.expr(DOMAIN))
    return mixing.mixed(docs, model, TARGETS, keep="good", steady=0.1, spare="good")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them and of the text they decode to."""
    both = encoded_and_decoded(docs.select("doc_id", "text", "lang", "source"), BYTE_BPE)
    return both.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]
# Neither the language model, the join nor the encoding can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again for the next."""
    apply_profile(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
