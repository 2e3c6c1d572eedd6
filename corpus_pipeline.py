"""Clean and pack a corpus: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir); its result is written and read again as
the docs of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from planledger.llm.line_templates import dedup_lines
from planledger.llm.minmax import near_duplicates
from planledger.llm.packing import pack_documents
from planledger.llm.quality import fit, held_out, score_quality
from planledger.llm.secret_scan import redact_secrets
from planledger.llm.storage import importable, saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it now is."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half go. Learns from the labels of documents not held out."""
    importable(spark)
    own = docs.select(*COLUMNS)
    model = fit(own, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=~held_out())
    return score_quality(own, model).filter("score >= 0.5").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from all documents but the first; a document goes with its last line."""
    importable(spark)
    found = dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.col("text"), F.lit(" \n\t\r")) == "")
    return _documents(found.filter(~emptied))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays. Rows of one
    id on different texts go or stay each by its own text."""
    importable(spark)
    own = docs.select(*COLUMNS)
    found = near_duplicates(own, text_hash=True).filter(~F.col("kept"))
    gone = found.select(F.col("doc").alias("doc_id"), "text_hash").distinct()
    return own.withColumn("text_hash", F.xxhash64("text")).join(gone, ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write a placeholder over every secret; no document goes."""
    importable(spark)
    return _documents(redact_secrets(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut documents into pieces and place them into sequences of 4096 ids."""
    importable(spark)
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs.select("doc_id", "text"), path)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("packing", pack),
]
#: Tokenizing and the classifier are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
