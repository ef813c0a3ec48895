"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again for the next one. All stages but the last return the
columns of documents; each works on all that its predecessor kept:

1. language ID: documents of no known language go;
2. exact de-duplication: one document of each group of equal texts stays;
3. near de-duplication: the first document of each group of near copies stays;
4. substring de-duplication: a repeated passage stays in its first document and is
   cut out of the others, a document without a word left goes;
5. best-fit packing: the pieces of what is left, placed in sequences.

Defined cases. Rows are told apart by id and text: an id that repeats with other
texts names documents of their own, and of rows that repeat both the exact stage
keeps one. Null and empty texts and texts without a letter have no language and go in
the first stage; a null id is a document like any other until the near stages,
which leave it as it is. Very long texts are read whole, ties go to the smallest id,
other columns (whatever their names) are carried along until packing, and an empty
table gives an empty result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siglake.llm import exact_dedup, langid, near_dedup, packing, substring
from siglake.llm.common import documents, on_workers
from siglake.session import shared_path

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return langid.drop_unknown(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return near_dedup.drop_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return substring.cut_passages(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: The language model and the passage search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; each stage's output is a table in the shared folder."""
    docs = documents(spark, sf_dir)
    base = shared_path(spark, "llm", f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
