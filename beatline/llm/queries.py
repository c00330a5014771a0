"""The queries of the corpus operators, by the driver's names.

Each runs its operator with production parameters over its whole tables."""

from __future__ import annotations

from beatline.llm import (centroids, chat, decontaminate, jaccard, lexical, licenses, ngram_model, packing, quality, secrets,
                          substring_dedup, token_counts, warc)
from beatline.llm.common import table
from beatline.llm.oracle import ORACLE  # noqa: F401


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_scans(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations")
    # Roles are for learning only: the decoder recovers them from the texts.
    return chat.format_chats(chats, chat.fit(chats), trust_roles=False)


def op8_license_scans(spark, sf_dir):
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_token_counts(spark, sf_dir):
    from public_tokenizers import path

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))


def op11_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scoring(spark, sf_dir):
    return ngram_model.score(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_substring_dedup, op3_quality_rules, op4_decontamination, op5_secret_scans, op6_jaccard_join,
    op7_chat_formatting, op8_license_scans, op9_warc, op10_token_counts,
    op11_centroid_clustering, op12_lexical_search, op13_lm_scoring)}
