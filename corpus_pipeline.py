"""From raw documents to packed training sequences, in five stages.

Every stage takes what the one before has kept. The first four return the columns of
``documents``: toxic documents go, one document of each group of near copies stays,
secrets are masked, and rows are put into the order of a weighted mix of sources. The
last one returns the pieces of the packed sequences, numbered in the order of the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odoscan.llm.common import stage
from odoscan.llm.mixing import mix
from odoscan.llm.order_minhash import drop_near_copies
from odoscan.llm.packing import pack
from odoscan.llm.queries import table, vocabulary
from odoscan.llm.secrets import letter_pairs, redact_secrets
from odoscan.llm.toxicity import score_texts, threshold_of, train


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, so that stages' own columns meet no name of theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under the threshold of their language."""
    model = train(docs, table(spark, sf_dir, "labels"))
    # Names of the stage's own, so that the score meets no column of that name; texts travel once.
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    scored = score_texts(docs.toDF(*own.values()), model, own["text"])
    kept = scored.filter(F.col("score") < threshold_of(model, F.col(own["lang"])))
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and their lengths brought up to date."""
    masked = redact_secrets(docs, vocabulary("byte_bpe_50k.tiktoken"), pairs=letter_pairs(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: written files follow it."""
    marked = docs.select(whole_row(docs), "doc_id", "source", F.xxhash64("text").alias("_text"))
    placed = mix(marked, ["doc_id", "_text"])
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = placed.repartitionByRange(parts, "_slot", "_place").sortWithinPartitions("_slot", "_place")
    return ordered.select("_whole.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences, with their ids; sequences follow the mix.

    Files read again have no order, and the stages pass on the columns of documents only,
    so the same mix is worked out again from the few columns that decide it.
    """
    marked = docs.select("doc_id", "text", "source", F.xxhash64("text").alias("_text"))

    def arrange(rows: DataFrame) -> tuple[DataFrame, list[str]]:
        return mix(rows, ["doc_id", "_text"]), ["_slot", "_place"]

    return pack(marked, vocabulary("word_bpe_49k.json"), order=["source", "_text"], arrange=arrange)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the stages; tests compare the operators with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
