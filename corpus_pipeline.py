"""Corpus pipeline: five operators of ``harborline.llm`` over ``documents``.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns, whatever those are; the last returns token ids. An empty
table goes through all of them. ``run`` keeps it all in one
Spark application, each stage written once to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import bpe, langid, line_dedup, mixing, simhash
from harborline.llm.common import settle, table
from harborline.llm.queries import ranks_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter (``und``) go, null and empty texts among them."""
    return langid.identify(docs).where(F.col("lang_pred") != langid.UNKNOWN).select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that 10 documents or more share.

    No document goes: one of nothing but such lines stays with an empty text.
    Repeated rows stay as often as they came.
    """
    kept = line_dedup.drop_common_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal or, by five-word shingles, 0.8 similar.

    SimHash fingerprints are linked through BK-trees first and every class of
    them is held against the exact similarity; a search between the classes
    finds what no radius can link, as a text in which one word in nine has
    changed (see ``simhash.similar_texts`` and the README).
    Empty texts are equal; rows that are the same in id and text are one.
    """
    return simhash.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document that it takes twice is there twice, one without a word is not taken."""
    mixed = mixing.mix_sources(docs)
    times = (F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    return mixed.where("taken > 0").select("doc", F.explode(F.array_repeat(F.lit(0), times))).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded_sha256) of each document of the mix, the digest of what the ids decode to."""
    coded = bpe.round_trip(docs, ranks_path())
    return coded.select(
        F.col("id").alias("doc_id"), F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
            F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("near-dedup by shingle similarity", near_duplicates),
    ("mixing sources", mix),
    ("BPE tokens", tokens),
]

#: A network, BK-trees and merges of ranks aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
