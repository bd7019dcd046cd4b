"""The corpus pipeline: ``documents`` through five stages, each a written table.

Every stage works on all that its predecessor kept and returns the columns of
``documents``; the last returns packed pieces.  Rows without a doc_id pass the
near-duplicate stage, which names documents by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, near_dup, packing, pii, queries, toxicity
from ledgerlens.llm.common import stored, table

#: Shares of the tokens by domain.  The expected clean tokens stay as they are and no
#: rate exceeds 1, so the stage thins the other domains and repeats nothing.
MIX_WEIGHTS = {"clean": 0.97, "low": 0.02, "toxic": 0.01}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id.  Of rows that
    repeat an id the least stays, by its text and then its other columns."""
    kept = near_dup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi")
    # texts are compared for the ids that need it only, which are few or none
    many = stored(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    rank = F.struct("text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    least = named.join(many, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(rank).alias("least"))
    least = least.select("doc_id", "least.*").select(docs.columns)
    return named.join(many, "doc_id", "left_anti").unionByName(least).unionByName(docs.where("doc_id IS NULL"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kinds; n_chars follows.  Null texts and ids stay as
    they are; every row is masked by itself."""
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay at their fitted rates: by a draw from the id, or from the text of a row
    without one.  Columns that are named as the operator's own are kept aside."""
    labels = queries.labelled_domains(table(spark, sf_dir, "labels"))
    aside = {c: f"_kept_{c}" for c in docs.columns if c in ("tokens", "posterior", "rate", "copies", "_text", "_draw")}
    rows = docs.withColumnsRenamed(aside)
    rated = mixing.mix(rows, labels, MIX_WEIGHTS, anchor="clean", max_rate=1.0, carry=rows.columns)
    kept = rated.where("copies > 0").select(rows.columns)
    return kept.withColumnsRenamed({new: old for old, new in aside.items()})


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 ids along the space-filling curve.  A null text is empty; rows that
    repeat an id are documents of their own."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The stages are a trained network, set similarity and a fitted mixture: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
