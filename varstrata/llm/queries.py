"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varstrata.llm.bpe import bpe_encode
from varstrata.llm.linechunks import chunk_dedup
from varstrata.llm.merkle import folded, leaf, merkle_manifest, siblings_digest
from varstrata.llm.minhash import near_duplicates
from varstrata.llm.mixing import mix
from varstrata.llm.oracle import EMBEDDING_NEAR_DEDUP, EXACT_TOP_K, MERKLE_MANIFEST, NEAR_DEDUP, PREFIX_TRIE, SUFFIX_DEDUP
from varstrata.llm.pii import KINDS, find_pii, pii_model
from varstrata.llm.quantised import embedding_near_duplicates
from varstrata.llm.secrets import secret_model, secret_scan
from varstrata.llm.suffix import suffix_dedup
from varstrata.llm.tokenfile import read_tokens, write_tokens
from varstrata.llm.topk import top_k
from varstrata.llm.toxicity import toxicity_model, toxicity_scores
from varstrata.llm.trie import prefix_trie

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunk_dedup(docs).select(
        "doc_id", "cleaning.n_lines", "cleaning.n_chunks", "cleaning.removed_chunks", "cleaning.removed_lines",
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("kept_sha256"),
    )


@query
def op8_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", "place.*")


@query
def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs, VOCABULARY, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


@query
def op10_minmax_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_embedding_near_dedup(spark, sf_dir):
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query
def op9_exact_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def held_out(id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"), train=~held_out())
    scored = toxicity_scores(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op3_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan(docs, secret_model(docs))
    return found.select("doc_id", "start", "end", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


@query
def op2_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def _joined(spans: str) -> Column:
    """kind:start:end of each span, with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, pii_model(docs)).select("doc_id", "base", "spans")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(F.encode(_joined("base"), "utf-8"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


@query
def op12_token_files(spark, sf_dir):
    path = write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen, leaf("doc_id", "source", "lang", "n_chars", F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered")
    proofs = merkle_manifest(docs, carry=[tampered])
    told = proofs.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


LLM_ORACLE.update(
    op2_suffix_dedup=SUFFIX_DEDUP, op7_embedding_near_dedup=EMBEDDING_NEAR_DEDUP, op9_exact_top_k=EXACT_TOP_K,
    op10_minmax_near_dedup=NEAR_DEDUP, op11_prefix_trie=PREFIX_TRIE, op13_merkle_manifest=MERKLE_MANIFEST,
)
