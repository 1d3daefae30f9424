"""A corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents that it keeps or makes.

``docs`` has the columns of the table ``documents``; all stages but the last return the same columns, the last one
the places of all pieces in packed sequences. Every stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import fold, read
from cohortline.llm.language import UNKNOWN, learn_languages, predict_languages
from cohortline.llm.mixing import mixed_documents
from cohortline.llm.pattern_packing import place_pieces, token_pieces
from cohortline.llm.quality import keep_good
from cohortline.llm.simhash import keep_one
from cohortline.sources.storage import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without letters and those unlike the texts of every language; ``lang`` becomes the predicted one."""
    rows = docs.select(*COLUMNS)
    model = learn_languages(rows, fold("doc_id", 5) != 0)
    kept = predict_languages(rows, model, reject=True).where(F.col("lang_pred") != UNKNOWN)
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts that fail the base rule or whose votes make good quality improbable."""
    return keep_good(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within two bits (three-word shingles) the smallest id stays."""
    return keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and pass of the mix, with the words drawn in it."""
    mixed = mixed_documents(docs.select(*COLUMNS))
    return mixed.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of at most 1024 tokens."""
    pieces = token_pieces(docs.select(*COLUMNS))
    placed = place_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", identify_language),
    ("quality rules", judge_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot state kernels, expectation-maximisation and components; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline-")
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return made
        made.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
