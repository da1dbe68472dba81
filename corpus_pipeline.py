"""Corpus pipeline: the stages in order, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresieve.llm import bpe, language_id, line_dedup, mixing, simhash
from caresieve.llm.common import cut, documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes when the share of its main language times how sure it is falls under this:
#: a letter or two, or a mixture without a main language.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language can be told; `lang` becomes the predicted one.

    Learns from the labelled rows that aren't held out. Documents without a letter
    (null and empty text too) or with a score under LEAST_SCORE are rejected; of equal
    shares the language that sorts first is taken; repeated rows are judged alike.
    Where no label is there to learn from, all lettered documents pass as they are.
    Whole texts of any length are read; an empty table gives no rows; further columns
    are left out.
    """
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    if not model.languages:
        return language_id.lettered(docs.select(*COLUMNS))
    marked = language_id.annotate(docs.select(*COLUMNS), model)
    told = marked.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return told.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one holds; n_chars follows the text.

    Null text becomes empty. Rows of one id are one document, so repeated rows keep
    the same lines; rows without an id lose nothing. Texts and lines may be of any
    length; an empty table gives no rows; further columns are left out.
    """
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of the smallest id, a null id being the last.

    Rows are told apart by a number of their own, so groups without any id and
    repeated rows of an id are cut to one row too. Of several rows of the smallest
    id the text of the least hash stays. Null, empty and wordless texts are one group.
    Whole texts of any length count; an empty table gives no rows; further columns are
    left out.
    """
    rows = cut(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()))  # the numbers are used twice
    found = simhash.near_dedup(rows, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("hash"), "__row")
    best = found.join(rows.select("__row", rank.alias("rank")), "__row").groupBy("component_id").agg(F.min("rank").alias("rank"))
    return rows.join(best.select(F.col("rank.__row").alias("__row")), "__row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's rate draws them, in a global random order.

    A null source is one of its own; rows of one id, a null id included, are drawn
    alike; texts, null, empty or very long, are carried as they are. An empty table
    gives no rows; further columns are left out.
    """
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids and the digests of ids and of the bytes decoded from them.

    Null and empty text have no ids; very long ones are cut where no token spans;
    repeated rows give repeated rows; an empty table gives none.
    """
    return bpe.encode(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenise),
]

#: Language identification, SimHash and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are cut from their lineage in the shared folder."""
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
