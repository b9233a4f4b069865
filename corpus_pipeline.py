"""From documents to packed sequences: each stage applies one operator to what the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtrace.llm import line_dedup, minhash, mixing, packing, quality_rules, storage


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.judged(docs, keep=tuple(docs.columns), passing=True)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.without_repeated_lines(docs, least_exact=1))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    return packing.pack(pieces, 4096)


STAGES = [("quality rules", quality), ("line dedup", lines), ("minhash near-dedup", near_duplicates), ("mixing", mix), ("best-fit packing", pack)]

#: Shingle hashes, tokenizers and packing have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back before the next stage.

    A row for each piece of each use of a document that is left, as ``packing.pack`` gives it. Null, empty and otherwise failing texts go in the first
    stage; repeated rows lose their repeated lines and, as one document, all but one of them; null languages count as the empty one, null
    sources are one source, and null ids are kept. Columns of any other name pass through all stages but the last. An empty table, or one whose rows
    are all rejected, gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, _ = storage.written(docs, name.replace(" ", "-"))
    return docs
