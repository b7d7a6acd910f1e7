"""The queries that apply each operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.quality import quality_filter

    return quality_filter(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.language import identify_languages

    return identify_languages(table(spark, sf_dir, "documents"))


def op4_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.private import find_private

    return find_private(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import plan_mix

    plan = plan_mix(table(spark, sf_dir, "documents"))
    return plan.withColumn("taken", F.col("copies") * F.col("size"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.simhash import near_groups

    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.warc import archive_and_read

    return archive_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pieces import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_bytepairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.bytepairs import digests, encode_documents

    return digests(encode_documents(table(spark, sf_dir, "documents")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.merkle import manifest

    return manifest(table(spark, sf_dir, "documents"))


def op13_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.prefixtrie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_fingerprints,
        op3_language,
        op4_private,
        op5_mixing,
        op6_toxicity,
        op7_simhash,
        op8_warc,
        op9_pieces,
        op10_repeats,
        op11_bytepairs,
        op12_merkle,
        op13_prefixtrie,
    )
}
