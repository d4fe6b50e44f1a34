"""A corpus pipeline of five stages over the documents table.

Every stage gets what the one before kept, as written Parquet, and decides on
all of it.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civgraph.llm import decontaminate, jaccard, mixing, quality, simple8b
from civgraph.llm.common import forget, shared_folder, steady_reads, stored, table
from civgraph.llm.queries import word_tokenizer


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    steady_reads(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): one document of each group stays."""
    steady_reads(spark)
    return jaccard.one_of_each_group(docs, 5, 80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id output: writes the mix as token ids and reads the files back."""
    return simple8b.token_digest(docs, f"{shared_folder(spark)}/tokens", word_tokenizer())


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mix),
    ("token output", tokenize),
]

#: The classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), False
    for name, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if written:  # the next stage reads what this one kept
            forget(docs)
        docs, written = kept, True
    return STAGES[-1][1](spark, docs, sf_dir)
