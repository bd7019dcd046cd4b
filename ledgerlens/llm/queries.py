"""The registered queries of the corpus operators: ``opN_<name>``.

Each applies its operator with production parameters to the whole of its table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerlens.llm import (
    ann, collocations, decontamination, html_text, mixing, near_dup, packing, pii, quality, secrets, token_counts,
    toxicity, whitening,
)
from ledgerlens.llm.common import table

#: Shares of the tokens by domain of the labelled table.
MIX_WEIGHTS = {"clean": 0.90, "low": 0.08, "toxic": 0.02}


def labelled_domains(labels):
    """(doc_id, domain) of the labels: toxic before low quality before clean."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))


def op1_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_source_mixing(spark, sf_dir):
    labels = labelled_domains(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), labels, MIX_WEIGHTS)


def op3_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op4_nearest_neighbours(spark, sf_dir):
    return ann.PermutationIndex(table(spark, sf_dir, "embeddings")).search(F.col("vec_id") % 50 == 0, k=5)


def op5_curve_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))


def op10_personal_data(spark, sf_dir):
    return pii.scan(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_benchmark_decontamination(spark, sf_dir):
    found = decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op13_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_source_mixing, op3_minhash_near_dedup, op4_nearest_neighbours, op5_curve_packing,
    op6_toxicity, op7_secret_scan, op8_html_text, op9_token_counts, op10_personal_data, op11_embedding_whitening,
    op12_benchmark_decontamination, op13_phrase_collocations)}

#: SQL states two of these; tests/llm holds the others against brute force.
ORACLE_SQL: dict[str, str] = {
    "op12_benchmark_decontamination": decontamination.ORACLE_SQL,
    "op13_phrase_collocations": collocations.ORACLE_SQL,
}
