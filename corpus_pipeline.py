"""A training corpus from the documents: five stages, each over all that the one before it kept.

All but the last return the columns of documents. A stage's rules for nulls, empty texts, repeated rows and empty
tables are those of its operator; rows that a filter cannot judge (null or empty texts) stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, toxicity
from threadloom.llm.queries import PATTERN, RANKS, TOXIC
from threadloom.llm.work import Workspace

NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches TOXIC go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "score"
    while score in docs.columns:
        score += "_"
    return toxicity.score(docs, model, out=score).where(F.col(score) < TOXIC).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id."""
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT, width=NEAR_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    both = byte_bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), RANKS, PATTERN)
    return both.select("doc_id", "lang", "source", "tokens", F.size("tokens").cast("bigint").alias("n_tokens"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("tokens", tokenize)]

#: No SQL: scores, registers and merges are not expressible; tests/llm holds it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark)  # the last stage reads the table of the one before
    for n, (_, stage) in enumerate(STAGES[:-1]):
        docs = work.keep(stage(spark, docs, sf_dir), f"stage_{n}")
        if n:
            work.forget(f"stage_{n - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
