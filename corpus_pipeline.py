"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm import anchors, decontaminate, jaccard, language, packing
from shopgauge.llm.common import held_out, ship
from shopgauge.sources.shared import work_folder
from shopgauge.sources.tables import load

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in some language; those without a letter go."""
    ship(spark)
    model = language.learn(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)))
    return language.identify(docs.select(COLUMNS), model).where(F.col("lang_pred") != language.UNKNOWN).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles the one with the smallest id, once. Rows without an id are not linked."""
    ship(spark)
    groups = jaccard.link(docs)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    once = docs.where("doc_id is not null").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(docs.where("doc_id is null")).select(COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word runs of earlier ones, other text as it is; a document that has no words left goes."""
    ship(spark)
    left = anchors.strip(docs, anchors.repeats(docs), spacing=True).where("n_words > n_removed")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship(spark)
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark")).select(COLUMNS)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048, each with its token ids."""
    ship(spark)
    return packing.packed(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_substrings", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", in_sequences),
]
#: Languages come from a fitted model and token ids from a vocabulary file, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        folder = work_folder(spark)
        found.write.parquet(folder)
        docs = spark.read.schema(found.schema).parquet(folder)
    return docs
