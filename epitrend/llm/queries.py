"""Registered queries of the training-data operators."""

from __future__ import annotations

import corpus_pipeline
from epitrend.llm import (chat, embeddings, fingerprints, hilbert, minhash, negatives, oracle, quality, secrets,
                          substring, suffixes, whitening)
from epitrend.llm.bpe import encode_digests
from epitrend.llm.common import table
from epitrend.llm.packing import pack_documents


def op1_fingerprints(spark, d):
    return fingerprints.compare_edited(table(spark, d, "documents"))


def op2_secrets(spark, d):
    docs = table(spark, d, "documents")
    return secrets.scan(docs, secrets.train_from_documents(docs))


def op3_chat(spark, d):
    return chat.render(table(spark, d, "conversations"))


def op4_packing(spark, d):
    return pack_documents(table(spark, d, "documents"))


def op5_substring_dedup(spark, d):
    return substring.measure(table(spark, d, "documents"))


def op6_minhash(spark, d):
    return minhash.near_duplicates(table(spark, d, "documents"))


def op7_embeddings(spark, d):
    return embeddings.near_duplicates(table(spark, d, "embeddings"))


def op8_quality(spark, d):
    docs = table(spark, d, "documents")
    return quality.score(docs, quality.train(docs, table(spark, d, "labels")))


def op9_bpe(spark, d):
    return encode_digests(table(spark, d, "documents"))


def op10_suffixes(spark, d):
    return suffixes.remove_repeated(table(spark, d, "documents"))


def op11_whitening(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"))


def op12_hilbert(spark, d):
    return hilbert.search(table(spark, d, "embeddings"))


def op13_negatives(spark, d):
    return negatives.mine(table(spark, d, "embeddings"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_secrets": op2_secrets,
    "op3_chat": op3_chat,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_minhash": op6_minhash,
    "op7_embeddings": op7_embeddings,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_suffixes": op10_suffixes,
    "op11_whitening": op11_whitening,
    "op12_hilbert": op12_hilbert,
    "op13_negatives": op13_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op3_chat": chat.RENDER_SQL,
    "op6_minhash": oracle.NEAR_DUPLICATES,
    "op7_embeddings": oracle.EMBEDDINGS,
    "op10_suffixes": oracle.REPEATED_STRINGS,
    # Exact search: up to 2,049 distinct vectors (sf0.1 has 2,000) every window
    # holds the whole table; above, recall is measured instead.
    "op12_hilbert": oracle.NEIGHBOURS,
    "op13_negatives": oracle.HARD_NEGATIVES,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
