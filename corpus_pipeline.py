"""Corpus pipeline: documents to token ids, one operator per stage.

Every stage gets what the one before kept, written as Parquet and read again, and its decisions take effect.
"""

from __future__ import annotations

from segment_hours.llm import exact_dedup, language_id, minhash_dedup, mixing, sentencepiece_codec
from segment_hours.llm.common import table
from segment_hours.session import scratch_path


def recognised(spark, docs, sf_dir):
    """Documents whose language the classifier recognises; those it rejects go."""
    return language_id.keep_identified(docs)


def without_copies(spark, docs, sf_dir):
    """One row of each group of equal texts: the one with the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash_dedup.drop_near_copies(docs)


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them, weighted by the labels of quality."""
    return mixing.repeat_to_mix(docs, table(spark, sf_dir, "labels"))


def encoded(spark, docs, sf_dir):
    """Token ids of every document."""
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("language_id", recognised),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

# Classifier, hashed sampling and tokens are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Token ids (doc_id, n_tokens, ids, round_trip) of the documents that all stages kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
