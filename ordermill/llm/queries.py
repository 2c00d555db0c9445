"""The dealt operators as named queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.llm import (
    bestfit, conversations, decontamination, language, oracles, packing, pii, planes, simhash,
    substring, suffixarray, suffixtree, topk, toxicity,
)
from ordermill.llm.common import table, vocabulary

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its repeated lines and sentences removed."""
    return substring.remove_repeats(table(spark, folder, "documents"))


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, packed by source shares."""
    return packing.pack(table(spark, folder, "documents"), *vocabulary())


@query
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a suffix tree learnt from six in seven of them."""
    return suffixtree.score(table(spark, folder, "documents"))


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents by their nearest labelled examples."""
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.drop("text_hash")


@query
def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten largest integer inner products of every hundredth vector."""
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents."""
    return language.identify(table(spark, folder, "documents"))


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the 200-byte strings that occur again."""
    found = suffixarray.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.find(table(spark, folder, "documents"))


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items held by documents."""
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


@query
def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, packed into as few sequences as best-two-fit takes."""
    return bestfit.pack(table(spark, folder, "documents"), *vocabulary())


@query
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all vectors and how tight they are."""
    vectors = planes.quantised(table(spark, folder, "embeddings"))
    return planes.with_quality(*planes.cluster(vectors))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of all damaged conversations and their cheapest repair."""
    rows = table(spark, folder, "conversations")
    return conversations.repair(conversations.damaged(rows), ids=rows)
