"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every result but the last
as Parquet and reads it back as the next stage's docs. All but the last return the columns of
documents. Language, line and component rules work on all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import copies, decontaminate, language, lines, pieces
from estrato.llm.common import crc_fold, ensure_importable, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents that it rejects go; a missing lang is filled in.

    NULL texts, texts without letters and texts unlike every learned language are rejected. With no
    lang to learn from, all are.
    """
    ensure_importable(spark)
    model = language.fit(docs, F.coalesce(crc_fold("doc_id", 4), F.lit(0)) != 2)
    found = language.with_language(_documents(docs), model)
    return _documents(found.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of runs of lines are deleted; documents with no line left go."""
    ensure_importable(spark)
    found = lines.without_later_copies(_documents(docs))
    kept = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return _documents(kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup, and on 5-word shingles: of each group the document with the smallest doc_id stays.

    Links of either rule make groups. Documents without doc_id come last; of different texts under one id,
    or without one, the smallest hash stays. Equal rows collapse to one; of rows equal in id and text the
    smallest in the other columns stays. Texts without words are one group. No documents give none; long
    texts are whole sets.
    """
    ensure_importable(spark)
    return copies.one_of_each(_documents(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    return decontaminate.clean_documents(_documents(docs), table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """SentencePiece encoding: ids of every whole text, and whether they decode to it again."""
    ensure_importable(spark)
    found = pieces.encoded_texts(_documents(docs), model_path)
    return found.select("doc_id", "lang", "source", "n_chars", "n_pieces", "piece_ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language ID", identified),
    ("line dedup", without_repeated_lines),
    ("near-dedup", one_per_group),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", encoded),
]

ORACLE_SQL = None  # fingerprints, centroids and pieces are beyond SQL; tests hold a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
