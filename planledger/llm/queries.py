"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from planledger.llm.alignment import align_tokenizers
from planledger.llm.balance import shard_documents
from planledger.llm.exact_topk import exact_top_k
from planledger.llm.infilling import INFILLING_SQL, fill_in_middle, frame_texts
from planledger.llm.line_templates import LINE_DEDUP_SQL, dedup_lines
from planledger.llm.minmax import near_duplicates
from planledger.llm.packing import pack_documents
from planledger.llm.preferences import PREFERENCES_SQL, format_preferences, mismatched_replies
from planledger.llm.quality import fit, held_out, score_quality
from planledger.llm.secret_scan import scan_secrets
from planledger.llm.sentencepieces import decode_ids, encode_text, load_pieces
from planledger.llm.storage import importable, saved
from planledger.llm.vantage import nearest
from planledger.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode it again, and compare."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = load_pieces(_tokenizer("piece_bpe_32k.model"))
    both = decode_ids(encode_text(docs, pieces), pieces)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, n=3, percent=85)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, _table(spark, sf_dir, "labels"), usable=~held_out())
    return score_quality(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, _tokenizer("word_bpe_49k.json"), keep_ids=False)


def exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


BASE_KINDS = ("assign", "access", "hex")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs)
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint) as n_{kind}") for kind in BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = mismatched_replies(_table(spark, sf_dir, "conversations"))
    spans = lambda name: F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(name)
    return format_preferences(turns).select(
        "pair_id", "n_prompt_turns",
        *[F.md5(name).alias(f"{name}_md5") for name in ("prompt", "chosen", "rejected")],
        spans("chosen_spans"), spans("rejected_spans"),
    )


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_pages(_table(spark, sf_dir, "pages"), keep_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents")).drop("text_hash")


def infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(saved(frame_texts(docs), "frames"), keep_output=False)


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"), keep_groups=False)


QUERIES = {
    "op1_sentencepiece": sentencepiece,
    "op2_line_dedup": line_dedup,
    "op3_near_dedup": near_dedup,
    "op4_packing": packing,
    "op5_exact_topk": exact_search,
    "op6_vantage_points": vantage_search,
    "op7_quality": quality,
    "op8_secret_scan": secret_scan,
    "op9_preferences": preferences,
    "op10_warc": warc,
    "op11_karmarkar_karp": sharding,
    "op12_fill_in_middle": infilling,
    "op13_cross_alignment": alignment,
}
#: Queries that SQL can express on whole tables.
ORACLES = {
    "op2_line_dedup": LINE_DEDUP_SQL,
    "op9_preferences": PREFERENCES_SQL,
    "op12_fill_in_middle": INFILLING_SQL,
}
