"""A corpus prepared for training in five stages.

Each stage takes the documents its predecessor kept and returns documents with the same
columns; the last returns the packed pieces. Between two stages the documents are
written to the shared folder and read again, so no stage repeats the work of another.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityscope.llm import line_dedup, ngram_join, packing, quality_rules, toxicity
from parityscope.llm.arrow_columns import quoted
from parityscope.llm.shared import written

#: A document with a higher score than this is left out.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, learned from those with a label, takes for harmless."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = "toxicity_score"
    while name in docs.columns:
        name += "_"
    return toxicity.with_scores(docs, model, name=name).filter(F.col(name) < TOXIC).select(*map(quoted, docs.columns))


def keep_usual(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_rules.accepted(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template an earlier document has shown."""
    left = line_dedup.drop_recurring_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*map(quoted, docs.columns))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.first_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in token windows."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 49_408, 2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_usual),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_first_copies),
    ("packing", pack),
]

#: The stages learn, estimate and encode, which SQL can't express; tests compare each with
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
