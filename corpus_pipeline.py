"""A training corpus from raw documents: five stages, each a table of its own.

Toxic documents go, documents that the quality rules reject go, one document of
each near-duplicate group stays, the sources are mixed to their target weights,
and what is left is encoded to pieces.  ``run`` writes every stage as Parquet
under the cluster's shared folder and gives it to the next one, so a lost
executor costs a stage's lost tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm import compression_rules, jaccard_join, sentencepiece, toxicity
from kpiforge.llm.queries import LEXICON_ROWS, PIECE_MODEL, fold_of, mixed
from kpiforge.llm.labelled import labelled_texts
from kpiforge.llm.storage import table, visible, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a lexicon learned from the labels (but fold 2 of 4) scores 0.3 or more."""
    visible(spark)
    lex = toxicity.learn(labelled_texts(docs, table(spark, sf_dir, "labels"), "toxic", fold_of("doc_id", 4) != 2, LEXICON_ROWS))
    return toxicity.drop_toxic(docs, lex)


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the compression bands reject."""
    visible(spark)
    return compression_rules.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of the n-gram Jaccard join."""
    visible(spark)
    return jaccard_join.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes; one that several epochs take comes several times."""
    visible(spark)
    return mixed(docs).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and their number for every document that comes in."""
    visible(spark)
    codec = sentencepiece.Codec(spark, sentencepiece.load(PIECE_MODEL))
    rows = docs.select("doc_id", "lang", "source", codec.encode(F.col("text")).alias("ids"))
    return rows.withColumn("n_ids", F.size("ids"))


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", of_good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed_sources),
    ("SentencePiece encoding", encoded),
]

# the lexicon is learned, zstandard and the segmentation are no SQL functions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the ``documents`` at ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
