"""One query per operator, each over its whole table with production parameters."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm import fillmiddle, langid, quality, sentencepiece, tokenfile, toxicity, whitening
from lakevault.llm.common import stage
from lakevault.llm.decontam import leaks
from lakevault.llm.jaccard import similar_groups
from lakevault.llm.neighbours import nearest
from lakevault.llm.sharding import shard
from lakevault.llm.suffix import remove_repeats
from lakevault.llm.tokencount import token_counts
from lakevault.session import run_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of every text and the text decoded from them."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece.encode(_table(spark, folder, "documents"), model)
    return sentencepiece.decode(encoded, model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    docs = _table(spark, folder, "documents")
    model = langid.train(docs.where(_remainder(4) != 2))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return langid.label_languages(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles are similar by 0.8 or more."""
    return similar_groups(_table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text, learned from the labelled rows that are not held out."""
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(_remainder(3) != 1).select("doc_id", "quality")
    model = quality.train(docs, labels)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return quality.score_quality(rows, model).select("doc_id", "held_out", "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text without strings of 100 bytes that start earlier, too."""
    found = remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes; equal texts stay together where sizes allow it."""
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, folder, "documents").select(
        "doc_id", F.octet_length(text).cast("long").alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")
    )
    placed = shard(rows, F.col("bytes") + 16, [F.col("text_hash"), F.col("doc_id")], group=1)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of what a token folder, written from all texts, holds when it is read back."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")  # fewer than 65,536 identifiers
    encoded = stage(tokenfile.tokenize(_table(spark, folder, "documents"), vocabulary, width=2, count=True), "tokens")
    path = run_folder(spark, "llm-token-file")
    tokenfile.write_tokens(encoded, path, width=2)
    return tokenfile.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth id."""
    vectors = stage(_table(spark, folder, "embeddings").select("vec_id", "embedding"), "vectors")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than 1,024 tokens."""
    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold, as they are or with other numbers, names and units."""
    return leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every text with its middle moved to the end, and of the text rebuilt from that."""
    cut = fillmiddle.transform(_table(spark, folder, "documents"))
    text = fillmiddle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector on the four strongest components of all different vectors, made to have variance 1."""
    points = stage(whitening.rounded(_table(spark, folder, "embeddings")).select("vec_id", "x"), "rounded")
    return whitening.whiten(points, whitening.fit(points)).withColumn("deviation", F.col("deviation").cast("long"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from the labelled rows that are not held out."""
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(_remainder(5) != 0).select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return toxicity.score_toxicity(rows, model).select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_token_file": op7_token_file,
    "op8_neighbours": op8_neighbours,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_fill_middle": op11_fill_middle,
    "op12_whitening": op12_whitening,
    "op13_toxicity": op13_toxicity,
}

# SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op11_fill_middle": """
        with hashed as (
            select doc_id, coalesce(text, '') as whole, sha256('1:' || cast(doc_id as varchar)) as digest from documents
        ), cut as (
            select doc_id, whole, regexp_extract_all(whole, '[A-Za-z]+|[^A-Za-z]') as units,
                   cast('0x' || substr(digest, 1, 8) as bigint) as h1, cast('0x' || substr(digest, 9, 8) as bigint) as h2,
                   cast('0x' || substr(digest, 17, 8) as bigint) as h3, cast('0x' || substr(digest, 25, 8) as bigint) as h4
            from hashed
        ), placed as (
            select *, cast(len(units) as bigint) as n,
                   least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as first_end,
                   greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as second_end,
                   case when whole = '' or contains(whole, '<P>') or contains(whole, '<S>') or contains(whole, '<M>') or h3 % 100 >= 90
                        then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
            from cut
        ), parts as (
            select *, array_to_string(units[1:first_end], '') as prefix, array_to_string(units[first_end + 1:second_end], '') as middle,
                   array_to_string(units[second_end + 1:n], '') as suffix
            from placed
        )
        select doc_id, n, form,
               case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
               case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
               sha256(case form when 'plain' then whole when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(whole) as restored_sha256
        from parts
    """,
}
