"""The corpus pipeline: toxicity, quality, exact copies, near copies, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return whole rows of documents that
stay, with their columns; the last returns the packed pieces. ``run`` writes each result as Parquet into the shared
folder and reads it again for the next stage, so a lost executor costs a part of one stage.

Defined cases: a null text counts as empty in every stage; ids that labels do not name teach nothing; an empty table goes
through all stages empty. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.llm import exact_dedup, near_dedup, packing, quality, toxicity
from circlet.llm.common import keep_scored, materialize, table
from circlet.llm.queries import vocabulary

LIMIT = 0.5  # of both classifiers, as in their queries
SIMILAR = 80  # percent of common shingles that make near copies


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the limit."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return keep_scored(docs, model.score, F.col("score") < LIMIT)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the limit."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return keep_scored(docs, lambda rows: quality.score(rows, model), F.col("score") >= LIMIT)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (similarity 0.8 or more), linked directly or over others, the document with the smallest id."""
    return near_dedup.drop_near_copies(docs, similar=SIMILAR)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("packing", pack),
]

ORACLE_SQL = None  # trained models, links over components and a tokenizer are beyond SQL; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
