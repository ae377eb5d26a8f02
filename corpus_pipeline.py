"""From raw documents to token ids: five stages over Parquet tables.

Each stage takes ``(spark, docs, folder)``; all but the last return the columns of ``documents``. ``folder`` holds the
tables that a stage learns from. Rows with null ids, null texts or repeated ids pass through every stage as the
operators define it; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import session
from tidewell.llm import bpe, mixing, neardup, suffix, toxicity

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    return toxicity.score(rows, model, "_text").where("predicted = 0").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates by five-word shingles."""
    return neardup.one_of_each(docs, words=5)


def _readable(kept: Column) -> Column:
    """Bytes as text; what a cut has left of a character goes too."""

    @F.arrow_udf("string")
    def text(parts: pa.Array) -> pa.Array:
        return pa.array([x.as_py().decode("utf-8", "ignore") for x in parts], pa.string())

    return text(kept)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without their repeated passages; ``n_chars`` follows the text."""
    marked = docs.withColumn("_missing", F.col("text").isNull())
    cut = suffix.without_repeats(marked, [c for c in marked.columns if c != "text"])
    cut = cut.select("_row.*", F.when(~F.col("_row._missing"), _readable(F.col("kept"))).alias("text"))
    columns = {c: F.col(c) for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select(*columns.values())


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, with the digest of the bytes they decode to."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path(VOCABULARY))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"], decoded="decoded")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

# Learned scores and byte-pair merges are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The result of the last stage; each earlier one is written and read again in the shared folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = session.scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
