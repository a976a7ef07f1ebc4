"""A training-corpus pipeline: from documents to encoded text, each stage one operator of ``membervane.llm``.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a frame that is written and read
again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membervane.llm import language, linealign, mixing, pieces, simhash
from membervane.llm.common import read, staged
from membervane.llm.queries import PIECE_MODEL
from membervane.session import tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose language is known less surely than this is no prose in any of the languages.
LEAST_SCORE = 0.2
#: Any character but the white space that lines are stripped of.
NOT_BLANK = r"(?U)[^\s\x1C-\x1F]"
#: Near duplicates are those of the operator: shingles of three words, 64 bits, at most three of them different.
SHINGLE, RADIUS = 3, 3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without a letter and null texts go."""
    found = language.identify(docs.select(*COLUMNS))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier one holds; those of which nothing is left go."""
    kept = linealign.dedup_blocks(docs.select(*COLUMNS))
    kept = kept.where((F.col("lines_removed") == 0) | F.col("text").rlike(NOT_BLANK))
    return kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows without an id stay. Rows that share an id stay together, each different text of theirs once.
    """
    docs = docs.select(*COLUMNS)
    found = simhash.near_duplicates(docs, SHINGLE, RADIUS)
    first = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(staged(first, "first-documents"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(*COLUMNS).unionByName(docs.where(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 times)."""
    mixed = mixing.mix(docs.select(*COLUMNS), weights=(5, 2, 1), most=3, carry=True)
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*COLUMNS)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text, and the text that they spell."""
    done = pieces.encode_and_decode(docs.select(*COLUMNS), PIECE_MODEL)
    return done.select("doc_id", "lang", "source", "ids", (F.length("ids") / 2).cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("language", identify_language),
    ("line-dedup", dedup_lines),
    ("near-dedup", dedup_near),
    ("mix", mix_sources),
    ("encode", encode_text),
]

#: SQL cannot follow a trained classifier, an alignment, fingerprints or an encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
