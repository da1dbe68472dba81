"""The corpus queries, one per operator over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from caresieve.llm import bpe, exact_dedup, language_id, line_dedup, mixing, pii, quality, sharding, simhash, spelling, toxicity, vector_codes, vector_dedup
from caresieve.llm.common import documents, embeddings, sha256_hex
from caresieve.llm.oracles import ORACLE  # noqa: F401

RANKS = "byte_bpe_50k.tiktoken"


def op1_quality_rules(spark, sf):
    """Counts, failed rules and verdict of every document."""
    return quality.quality_rules(documents(spark, sf))


def op2_byte_bpe(spark, sf):
    """Every document encoded and decoded again, as digests."""
    return bpe.encode(documents(spark, sf), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=False)


def op3_line_dedup(spark, sf):
    """Every document without the lines of earlier ones, as a digest."""
    out = line_dedup.line_dedup(documents(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("text")).alias("kept_sha256"))


def op4_exact_dedup(spark, sf):
    """Every document with the row of its equals that stays."""
    return exact_dedup.exact_dedup(documents(spark, sf)).drop("bucket", "chain")


def op5_sharding(spark, sf):
    """Every document with its shard and place."""
    return sharding.interleave(documents(spark, sf)).drop("share", "rank", "source")


def op6_pii(spark, sf):
    """Every document's personal data: counts and places."""
    found = pii.find(documents(spark, sf))

    def line(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(name, test):
        return F.size(F.filter("spans", test)).cast("long").alias(name)

    def of(kind):
        return lambda x: x["base"] & (x["kind"] == kind)

    base = [count(f"n_{k}", of(k)) for k in pii.BASE_KINDS]
    digest = sha256_hex(line(F.filter("spans", lambda x: x["base"]))).alias("base_sha256")
    more = [count("n_added", lambda x: ~x["base"]), count("n_spans", lambda x: F.lit(True))]
    return found.select("doc_id", *base, digest, line(F.col("spans")).alias("spans"), *more)


def op7_source_mixing(spark, sf):
    """The mixture of all documents, shuffled."""
    return mixing.mix(documents(spark, sf)).select("doc_id", "source", "copy_no", "n_copies", F.round("mix_key", 9).alias("mix_key"), "text")


def op8_simhash(spark, sf):
    """Every document with its fingerprint and component."""
    return simhash.near_dedup(documents(spark, sf)).drop("kept")


def op9_toxicity(spark, sf):
    """Every document with its expected severity, learned from the labelled ones."""
    docs = documents(spark, sf)
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return toxicity.score(docs, model)


def op10_language_id(spark, sf):
    """Every document with its predicted language, learned from those that aren't held out."""
    out = language_id.language_id(documents(spark, sf))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("languages").alias("n_languages"))


def op11_vector_dedup(spark, sf):
    """Every vector with its links, its component and whether it stays."""
    return vector_dedup.near_dedup(embeddings(spark, sf))


def op12_vector_codes(spark, sf):
    """Every vector's code and error, with the codebooks' digest."""
    return vector_codes.compress(embeddings(spark, sf))


def op13_spelling_variants(spark, sf):
    """Every word of the texts with its near words' count, form and root."""
    return spelling.variants(documents(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_byte_bpe, op3_line_dedup, op4_exact_dedup, op5_sharding, op6_pii, op7_source_mixing, op8_simhash, op9_toxicity, op10_language_id, op11_vector_dedup, op12_vector_codes, op13_spelling_variants)
}
