"""A training corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varstrata.llm.bpe import bpe_encode
from varstrata.llm.linededup import line_dedup
from varstrata.llm.minhash import near_duplicates
from varstrata.llm.mixing import in_order, mix
from varstrata.llm.queries import held_out, table
from varstrata.llm.toxicity import toxicity_model, toxicity_scores
from varstrata.plans.runtime import written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL can't express the learned scores, the schedule or the encoding: stages are tested one by one against brute force
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, as they were. The model learns from labelled documents of this stage's input."""
    model = toxicity_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), train=~held_out())
    return toxicity_scores(docs.select(COLUMNS), model).filter("score < 0.5").drop("score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line chunks that stand in an earlier one; n_chars follows the text.

    Documents that lose every chunk go: exact repeats, and also those whose chunks stand in several different earlier documents, though no single
    one equals them. Their content stays there. Documents that were empty or null before stay.
    """
    clean = line_dedup(docs.select(COLUMNS))
    emptied = (F.col("cleaning.removed_chunks") > 0) & (F.col("cleaning.removed_chunks") == F.col("cleaning.n_chunks"))
    length = F.when(F.col("cleaning.removed_chunks") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.filter(~emptied).withColumn("n_chars", length).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; rows of one id are one document and stay or go together."""
    found = near_duplicates(docs.select("doc_id", "text"))
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.select(COLUMNS).hint("merge").join(gone, "doc_id", "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mixture of the sources: files in name order, and rows in file order, follow the target weights.

    Spark reads files by size, so the last stage computes the places again and gives them out.

    Weights are the sources' sizes to the power 0.7, so that the largest source does not crowd out the others early on.
    """
    return in_order(mix(docs.select(COLUMNS))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded_sha256, slot, at): the packed ids of each document, a hash of what they decode to, and its place in the mixture.

    Files are read in order of size, not of name, so the place is computed again: ``mix`` gives the same for the same rows. Ordered by (slot, at), rows
    are the mixture; written files hold it in name order. Slots are counted without the texts, so that codes are made once and go straight to their files.
    """
    mixed = mix(docs.select("doc_id", "source", "text"))
    coded = bpe_encode(mixed.select("doc_id", "source", "text", "place"), VOCABULARY, decoded=True)
    placed = coded.select("doc_id", "source", "n_tokens", "ids", F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"), "place")
    return in_order(placed, keep_place=True, places=mixed).select("doc_id", "source", "n_tokens", "ids", "decoded_sha256", "place.slot", "place.at")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
