"""A training corpus from raw documents, stage by stage.

Each stage works on all that the one before kept; all but the last return the columns of
``documents``. A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import written
from eventmart.llm.language_id import accepted, language_id
from eventmart.llm.line_dedup import line_dedup, near_copies
from eventmart.llm.mixing import mix
from eventmart.llm.ngram_join import one_of_each
from eventmart.llm.pieces import encode
from eventmart.llm.queries import PIECE_MODEL


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those it rejects, and texts without letters (null and empty ones too), go.

    Repeated rows and null ids are rows like others. An empty table stays empty.
    """
    found = language_id(docs).select("lang_pred", "score", F.struct(*docs.columns).alias("row"))
    return accepted(found).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more texts share; ``n_chars`` follows the text.

    Copies and near copies of one text count as one, or each of their lines would be shared
    and nothing of a text with ten copies would be left for the next stage to keep. Null text becomes
    empty; repeated rows are copies. An empty table stays empty.
    """
    cut = line_dedup(docs, units=near_copies(docs)).withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id; null ids come last.

    Empty texts are copies of one another. An empty table stays empty.
    """
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for.

    Null is a source of its own; documents of a source without words go. An empty table stays empty.
    """
    return mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the pieces of their text, and whether these give the text back.

    Null and empty texts have no piece; null text comes back as it is. An empty table stays empty.
    """
    coded = encode(docs, PIECE_MODEL, round_trip="round_trip")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("ngram_join", keep_one_of_each),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Language, near copies and pieces are beyond SQL; tests/llm holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
