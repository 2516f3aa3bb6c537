"""A corpus made ready for training: stages that each take what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from taxaloom.llm.common import table, unused
from taxaloom.llm.queries import VOCABULARY
from taxaloom.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject; it is fitted on the labels of ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of runs of 50 words or more; n_chars as the text is then."""
    (deleted,) = unused(docs, "lines_deleted")
    cleaned = line_dedup.dedup_lines(docs, counter=deleted)
    n_chars = F.when(F.col(deleted) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of SimHash near-duplicates: three-word shingles, three differing bits at most."""
    return simhash.keep_one(docs, words=3, differing=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): packed tokens of each document, and what they decode to."""
    return bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", to_tokens),
]

#: No SQL: a fitted model, similarity search and tokens; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
