"""A corpus pipeline from five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what one
writes as Parquet is what the next one reads.  The filtering stages keep the
rows they accept with all their columns; the last stage returns the packed
pieces.  An empty table passes through every stage.

Null texts count as empty and fail the first stage; a row with a null
``doc_id`` is kept like any other; of repeated rows one stays from the second
stage on; columns beyond those of ``documents`` pass through all stages but the
last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import exact, jaccard, packing, pii, quality
from starloom.llm.frames import documents
from starloom.session import remove_table, scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the full policy go."""
    return quality.accept(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least doc_id stays."""
    return jaccard.drop_near_copies(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Valid personal numbers and dates become pseudonyms of the same format."""
    return pii.pseudonymise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left, in sequences of 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("private_data", private_data),
    ("packing", packed),
]

#: Tokenizing and the similarity classes are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote on the way, and the table it read, is removed once it is done."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if last is not None:
            remove_table(spark, last)
        docs, last = spark.read.schema(out.schema).parquet(path), path
    return docs
