"""Documents to packed training sequences, in five stages.

Toxic documents go; one document of each group of near duplicates (five-word shingles
alike by 0.8) stays; personal data is
replaced by the kind of what stood there; sources are mixed to their target weights, by
dropping documents and repeating others; what is left is tokenised and packed. Each stage's
rows are written as Parquet and read again. Null and empty texts are documents like others
until the mix, which takes nothing from a document without words; repeated rows are near
duplicates of each other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.llm import mixing, overlap, packing, pii, toxicity
from claimbrook.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return overlap.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; one taken in part appears whole."""
    copies = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("__id")).agg(F.ceil(F.avg(copies)).cast("int").alias("__copies"))
    return (
        docs.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")))
        .where("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(docs.columns)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Trained scores, hashes of word sequences and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return stage(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
