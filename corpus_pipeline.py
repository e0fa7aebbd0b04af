"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.language import UNKNOWN, predicted, train
from sluice.llm.mixing import mixed
from sluice.llm.names import spare
from sluice.llm.packing import pack
from sluice.llm.paragraphs import without_repeats
from sluice.llm.passages import repeats
from sluice.llm.simhash import simhash_near_dedup
from sluice.session import discard, scratch_path, small_batches
from sluice.sources.files import read_files

# Documents go whose language is unknown or whose best score is lower than this.
MIN_SCORE = 0.2

# SQL cannot train, hash or pack; the stages are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter go, too.

    Where no document has a label, all with a letter stay.
    """
    model = train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    small_batches(spark)
    lang = spare(docs, "judged")
    judged = docs.withColumn(lang, predicted(F.col("text"), model))
    return judged.where((F.col(f"{lang}.lang_pred") != UNKNOWN) & (F.col(f"{lang}.score") >= MIN_SCORE)).drop(lang)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, and the least text hash among several.

    Rows of one id with different texts are different documents. Rows of one id and text are one,
    also where the id is null; the row that stays is the least by a hash of its other columns. Ids
    come before null.
    """
    key, kept, row = (spare(docs, n) for n in ("key", "kept", "row"))
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")))
    found = simhash_near_dedup(keyed, key)
    first = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(kept)).distinct()
    others = [F.col(f"`{c}`") for c, kind in docs.dtypes if c != "text" and "map<" not in kind and kind != "variant"]
    numbered = keyed.withColumn(row, F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*others)))).where(F.col(row) == 1)
    return numbered.join(first, F.col(key) == F.col(kept), "left_semi").drop(key, row)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each repeated passage only where it comes first."""
    return without_repeats(docs, repeats(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per copy of a document or of a part of it."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id), ("simhash_near_dedup", simhash), ("substring_dedup", substrings),
    ("mixing", mixing), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next.

    What a stage has written is removed when the next one is written; the last one's result stays.
    """
    docs, before = read_files(spark, f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs
