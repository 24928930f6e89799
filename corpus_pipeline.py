"""From raw documents to encoded training text: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns documents with the columns doc_id, text, lang, source and
n_chars; the last one returns their SentencePiece encoding. ``run`` applies them to the documents of a folder and
writes each stage's rows as Parquet before the next one reads them.

Stages tell rows apart by their place in the table, so ids may be null or repeated. Intermediate tables of a stage are
deleted when the next one begins, as far as that does not read them itself: write a stage's rows before you go on.
"""
from __future__ import annotations

import gc
from functools import wraps

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm import langid, sentencepiece
from lakevault.llm.common import stage, staged_paths
from lakevault.llm.decontam import leaks
from lakevault.llm.jaccard import similar_groups
from lakevault.llm.suffix import remove_repeats
from lakevault.session import remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Below this share of a text's letters no language is its main one; from the second on it is beyond doubt.
MAIN_LANGUAGE, SURE_LANGUAGE = 1 / 3, 1 / 2

# Tables that earlier stages have left, by Spark application.
_left: dict[str, list[str]] = {}


def releasing(step):
    """Run a stage after what earlier ones left behind is deleted: staged tables, and shuffle files that no frame holds."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = _left.setdefault(spark.sparkContext.applicationId, [])
        read = docs.inputFiles() if left else []
        for path in [path for path in left if not any(path in file for file in read)]:
            remove(spark, path)
            left.remove(path)
        # Spark drops shuffle files and broadcast models whose frames the collectors have found.
        gc.collect()
        spark._jvm.System.gc()
        with staged_paths() as paths:
            found = step(spark, docs, sf_dir)
        left += paths
        return found

    return run_step


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number of their own for each row, ``row``: its file's and its place in the file.

    The place in a Parquet file is the same whenever and by whichever task the file is read. Frames that are no plain
    table are written first.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = stage(docs.select(COLUMNS), "numbered")
    placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    files = sorted(row["file"] for row in placed.select("file").distinct().collect())  # names of files, no rows
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "number long, file string")
    return placed.join(F.broadcast(numbers), "file").select(*COLUMNS, (F.col("number") * (1 << 40) + F.col("place")).alias("row"))


@releasing
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those without a main language; lang becomes the language found.

    A language with half of the letters or more replaces any other lang; one with less only fills in a missing lang.
    Documents without a language of their own are judged by what the others teach. If there are none with a
    language, nothing can be judged and all documents stay.
    """
    model = langid.train(docs)
    if model is None:
        return docs.select(COLUMNS)
    found = langid.label_languages(docs.select(COLUMNS), model)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MAIN_LANGUAGE))
    sure = F.when(F.col("score") >= SURE_LANGUAGE, F.col("lang_pred"))
    return kept.withColumn("lang", F.coalesce(sure, "lang", "lang_pred")).select(COLUMNS)


@releasing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents keep that with the smallest id (null last, then the first in the table).

    Rows are compared one by one, whatever their ids: a row that repeats an id with another text stays, and a copy
    without an id goes. Rows without words are like no other and stay.
    """
    rows = numbered(docs)
    groups = similar_groups(rows.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.where("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    placed = stage(groups, "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = placed.groupBy("component_id").agg(F.min_by("row", order).alias("kept"))
    dropped = placed.join(first, "component_id").where("row != kept").select("row")
    return rows.join(dropped, "row", "left_anti").select(COLUMNS)


@releasing
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of 100 bytes and more that occur earlier, too; a document of which no word is left goes.

    What a cut leaves of a character is dropped with it; so are documents that had no words before.
    """
    found = remove_repeats(docs.select(COLUMNS))
    whole = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
    rows = found.withColumn("text", F.when(F.col("n_removed") > 0, whole).otherwise(F.col("text")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.where(F.length(F.trim("text")) > 0).select(COLUMNS)


@releasing
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, as it is or with other numbers, names and units; with or without an id."""
    rows = numbered(docs)
    found = leaks(rows.select(F.col("row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti").select(COLUMNS)


@releasing
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers of every text, with its language and source, and whether decoding them gives the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    kept = docs.select(COLUMNS)
    return sentencepiece.encode_checked(kept, model).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# SQL can express neither the random field nor the trie; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
