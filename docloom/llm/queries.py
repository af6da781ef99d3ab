"""The registered queries of the training-data operators, at production parameters."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import htmltext, langid, licenses, mixing, mixing_sql, neardup, oracles, pieces_codec, repeats, simhash, telephony, token_counts
from .store import materialize

#: A folder to take tokenizer files from instead of the installed package's.
TOKENIZERS = os.environ.get("DOCLOOM_TOKENIZERS")


def tokenizer(name: str) -> str:
    """The path of a public tokenizer's file; the files are never copied into this repository."""
    return f"{TOKENIZERS}/{name}" if TOKENIZERS else str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints, and for every 50th id the number of other documents within the Hamming radius."""
    prints = materialize(simhash.fingerprints(_table(spark, sf_dir, "documents")), "fingerprints")
    out = simhash.search(prints, F.col("doc_id") % 50 == 0)
    return out.select("doc_id", "n_chars", "edited_sha256", simhash._hex("lo", "hi").alias("fingerprint"), simhash._hex("edited_lo", "edited_hi").alias("edited_fingerprint"), "near_edited", "near_next", "n_within")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of each of its lines."""
    return token_counts.count(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's pieces, and the digest of the text decoded from them."""
    return pieces_codec.encode_decode(_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), keep=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as telephony audio, read back and described; pcm16k is the stored PCM at 16 kHz."""
    outputs = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm16k")
    return telephony.store(_table(spark, sf_dir, "documents"), keep=["doc_id"], outputs=outputs)


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose two-word shingle sets have a similarity of 0.8 or more."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates of every document."""
    return licenses.scan(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the license scan that SQL can express: places of the phrases."""
    return licenses.scan(_table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes that an earlier document has, and how much went."""
    out = repeats.remove_repeats(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled rows outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    out = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.withColumn("held_out", langid.held_out())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(_table(spark, sf_dir, "pages"), htmltext.train_default(), keep=["page_id", "url"])


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_token_counts, op3_pieces, op4_telephony, op5_neardup, op6_licenses, op7_repeats, op8_language, op9_mixing, op10_html, license_phrases)}
ORACLES = {"op5_neardup": oracles.OP5, "license_phrases": oracles.LICENSE_PHRASES, "op7_repeats": oracles.OP7, "op9_mixing": mixing_sql.OP9}
