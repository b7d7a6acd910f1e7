"""A corpus cleaned and mixed in stages, each of them one operator.

Each stage reads the whole table that the stage before it wrote and all but the
last return the columns of ``documents``:

1. toxicity: documents with a score of 0.3 or more go;
2. near duplicates: of documents whose SimHash fingerprints of three-word shingles link
   at three bits or fewer, chains included, the one with the least id stays;
3. private data: found spans are replaced by their kind;
4. mixing: each document is emitted as often as its source's target asks for;
5. pieces: ids of each text, and whether decoding gives it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import saved, table
from strata.llm.mixing import mix
from strata.llm.pieces import encode_documents
from strata.llm.private import redact_private
from strata.llm.simhash import keep_one
from strata.llm.toxicity import THRESHOLD, keep_clean

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters that the text has now."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"), THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs).select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(redact_private(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("private data", private_data),
    ("mixing", mixing),
    ("pieces", pieces),
]

#: Classifiers, fingerprints and encoding can't be stated in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
