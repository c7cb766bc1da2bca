"""The corpus pipeline: rules, near duplicates, secrets, mixture and packing, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet and reads it back as the next stage's documents.  All stages but the last return the
columns of ``documents``.  SQL cannot express the near-duplicate stage's components over the rows
the rules keep together with the redaction and the packing program, so there is no SQL.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from faultline.llm.common import stored, table

ORACLE_SQL = None

# Near copies share 0.8 of their five-word shingles; op10's own 3 words and 0.9 bind op10 only.
NEAR_WIDTH = 5
NEAR_THRESHOLD = Fraction(80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy rejects go; a document's own columns stay, whatever their names."""
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), "text")
    judged = quality_rules.apply_policy(quality_rules.with_ledger(carried))
    return judged.filter("kept").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram join stays, the one with the smallest id."""
    firsts = ngram_join.first_of_each_component(docs, width=NEAR_WIDTH, threshold=NEAR_THRESHOLD)
    return firsts.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mask."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mixture, once per use, the last of a leaf cut to its budget."""
    return mixing.mixed_documents(docs)


def packing_layout(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of the mixture."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secrets),
    ("mixing", mixture),
    ("packing", packing_layout),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
