"""The queries op1 to op13, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimbrook.llm import align, codes, language_model, licenses, mixing, packing, pii, quality, secrets, simhash, toxicity, vectors
from claimbrook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = function
        return function

    return register


@query("op8_pii")
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, folder, "documents")))


@query("op9_secrets")
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, folder, "documents")))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, folder, "documents")))


@query("op10_vector_dups")
def op10_vector_dups(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query("op2_neighbours")
def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(table(spark, folder, "embeddings"))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false) held_out", "score", "cast(score >= 0.7 as int) predicted"
    )


@query("op3_language_model")
def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(table(spark, folder, "documents"))


@query("op7_licenses")
def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, folder, "documents"))
    return found.selectExpr("doc_id", "cast(size(licenses) as long) n_licenses", "array_join(licenses, ',') licenses")


@query("op13_vector_codes")
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.digest(table(spark, folder, "embeddings"))


SQL["op13_vector_codes"] = codes.SQL


@query("op12_quality")
def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false) held_out", "score", "cast(score >= 0.5 as int) predicted"
    )


@query("op11_alignment")
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(table(spark, folder, "documents"))
