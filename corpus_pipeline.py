"""A corpus pipeline: language, near copies, repeated passages, source mix, pieces.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import langid, mixing, neardup, pieces_codec, queries, repeats
from docloom.llm.store import materialize, release, small

#: Ids up to which the documents that stay are picked by a broadcast; beyond it by a shuffle.
PICKED = 500_000


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ..., which no operator's outputs are named like, and the new name of each column."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the operator doesn't accept go: those without a letter, with most letters in scripts of no learned language,
    or long ones hardly any word of which speaks for the language it is labelled with. Mixed-language documents stay."""
    model = langid.train(docs.where(~langid.held_out()))
    apart, names = _apart(docs)
    out = langid.predict(apart, model, text_col=names["text"], keep=apart.columns, with_accepted=True).where("accepted")
    return out.select(*[F.col(new).alias(c) for c, new in names.items()])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the least id, of rows with one id the one with the least digest.

    Rows with one id and different texts are documents of their own; of rows equal in id and text the least one stays.
    """
    named = docs.where("doc_id IS NOT NULL")
    key = "doc_id"
    if named.groupBy("doc_id").count().where("count > 1").limit(1).count():
        key = "__key"
        row = F.struct(*[c for c in docs.columns if c != "doc_id"])
        once = named.groupBy("doc_id", F.sha2("text", 256).alias("__digest")).agg(F.min(row).alias("__row")).orderBy("doc_id", "__digest")
        named = materialize(once.select(F.monotonically_increasing_id().alias(key), "doc_id", "__row.*"), "rows")
    found = neardup.near_duplicates(named, id_col=key)
    kept = materialize(found.where("kept").select(F.col("doc_id").alias("__kept")), "kept")
    out = named.join(small(kept, PICKED), named[key] == F.col("__kept"), "left_semi").select(*docs.columns)
    return out.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; documents of which nothing is left go."""
    apart, names = _apart(docs)
    out = repeats.remove_repeats(apart, id_col=names["doc_id"], text_col=names["text"], keep=[c for c in apart.columns if c != names["text"]])
    out = out.where("kept_text <> '' OR n_removed = 0")
    made = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[made.get(c, F.col(new)).alias(c) for c, new in names.items()])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, their number, and a digest of the text decoded from them."""
    keep = [c for c in docs.columns if c != "text"]
    return pieces_codec.encode_decode(docs, queries.tokenizer("piece_bpe_32k.model"), keep=keep, outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [("language", language), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("source_mix", source_mix), ("encoded", encoded)]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        release(before)
    return docs
