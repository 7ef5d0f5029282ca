"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last returns the packing of what is left:

- language ID: documents whose language cannot be told (no text, no letters) go;
- n-gram Jaccard join: of each group of near duplicates the smallest doc_id stays;
- substring dedup: repeated lines and sentences go from all but their first document;
  documents of which nothing is left go;
- best-fit packing: sequences of at most 2048 tokens.

``run`` writes every stage's rows as Parquet in the shared folder and reads them
again for the next. Before the first, rows without doc_id get a negative one made of their
text, and of rows that share doc_id and text one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm import langid, line_dedup, ngram_join, packing
from farelens.llm.common import read, stored


def one_of_each(docs: DataFrame) -> DataFrame:
    """Every (doc_id, text) once. Only ids and digests are counted; texts move only for the
    ids that have some text repeatedly."""
    columns = docs.columns
    own = -F.shiftrightunsigned(F.xxhash64("text"), 1) - 1
    keyed = docs.withColumn("doc_id", F.coalesce("doc_id", own)).select(*columns)
    repeated = stored(keyed.groupBy("doc_id", F.xxhash64("text").alias("digest")).count()
                      .filter("count > 1").select("doc_id").distinct(), "pipeline-repeated")
    once = keyed.join(repeated, "doc_id", "left_anti").select(*columns)
    again = keyed.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*columns)
    return once.unionByName(again)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every row whose text has a language, rows that share doc_id and text once."""
    return langid.with_language(one_of_each(docs), into=None)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every row whose doc_id is its component's smallest."""
    groups = ngram_join.near_duplicates(docs, words=5, percent=75)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; n_chars follows."""
    cut = line_dedup.deduplicate(docs, passage_words=50).withColumn(
        "n_chars", F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return cut.filter("size(removed) = 0 OR trim(text) <> ''").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    return packing.packed_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Tokenisation and packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
