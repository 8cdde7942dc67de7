"""Exact duplicates by composable polynomial fingerprints, confirmed chunk by chunk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.common import SPACE, documents, fresh, stage

# Characters of a chunk, and the two prime moduli and bases of the polynomials.
CHUNK = 1 << 16
MODULI = (2147483629, 2147483587)
BASES = (911382323, 972663749)
_LINE = 1024

_HASHED = "rid long, doc_id long, sha string, idx int, n_bytes long, h1 long, s1 long, h2 long, s2 long"


def polynomial(data, base, modulus):
    """(hash, base ** length) of some bytes: ``sum((byte + 1) * base ** (bytes that follow))`` modulo the prime."""
    n = len(data)
    lines = -(-n // _LINE)
    padded = np.zeros(lines * _LINE, np.uint64)
    padded[lines * _LINE - n :] = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    within = padded.reshape(lines, _LINE) @ _falling(base, modulus, _LINE)
    value = 0
    jump = pow(base, _LINE, modulus)
    for part in within % np.uint64(modulus):
        value = (value * jump + int(part)) % modulus
    return value, pow(base, n, modulus)


_TABLES = {}


def _falling(base, modulus, n):
    if (base, modulus) not in _TABLES:
        powers = [pow(base, n - 1 - i, modulus) for i in range(n)]
        _TABLES[base, modulus] = np.array(powers, np.uint64)
    return _TABLES[base, modulus]


def combine(left, right, modulus):
    """Fingerprint of a concatenation from the (hash, shift) of its parts."""
    return (left[0] * right[1] + right[0]) % modulus, left[1] * right[1] % modulus


def _hash_chunks(moduli):
    def run(batches):
        for batch in batches:
            chunks = [c or b"" for c in batch.column("chunk").to_pylist()]
            columns = [batch.column(c) for c in ("rid", "doc_id", "sha", "idx")]
            columns.append(pa.array([len(c) for c in chunks], pa.int64()))
            for base, modulus in zip(BASES, moduli, strict=True):
                pairs = [polynomial(c, base, modulus) for c in chunks]
                columns += [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "sha", "idx", "n_bytes", "h1", "s1", "h2", "s2"])

    return run


def _chunks(rows):
    """Adds (idx, chunk): the normalised text ``norm`` in pieces; an empty text has one empty piece."""
    last = F.greatest(F.ceil(F.length("norm") / F.lit(CHUNK)), F.lit(1)).cast("int") - 1
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(i.alias("idx"), F.col("norm").substr(i * F.lit(CHUNK) + 1, F.lit(CHUNK)).alias("chunk")),
    )
    return rows.withColumn("piece", F.explode(pieces)).drop("norm").select("*", "piece.*").drop("piece")


def _folded(n, modulus):
    def step(total, part):
        return (total * part[f"s{n}"] + part[f"h{n}"]) % F.lit(modulus)

    return F.aggregate("parts", F.lit(0).cast("long"), step).alias(f"h{n}")


def fingerprints(docs, moduli=MODULI):
    """(rid, doc_id, sha, n_rows, n_bytes, h1, h2) per distinct row: chunk hashes folded in order.

    Chunks of a document are hashed wherever they lie; only their (hash, shift) pairs meet.
    """
    rows = documents(docs).select("rid", "doc_id", F.regexp_replace("text", SPACE, " ").alias("norm"))
    rows = rows.select("rid", "doc_id", F.sha2("norm", 256).alias("sha"), "norm")
    chunks = _chunks(rows).withColumn("chunk", F.col("chunk").cast("binary"))
    hashed = chunks.mapInArrow(_hash_chunks(moduli), _HASHED)
    part = F.struct("idx", "n_bytes", "h1", "s1", "h2", "s2")
    merged = hashed.groupBy("rid", "doc_id", "sha").agg(
        F.sort_array(F.collect_set(part)).alias("parts"), F.sum((F.col("idx") == 0).cast("long")).alias("n_rows")
    )
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda t, p: t + p["n_bytes"])
    return merged.select(
        "rid", "doc_id", "sha", "n_rows", size.alias("n_bytes"), _folded(1, moduli[0]), _folded(2, moduli[1])
    )


def exact_groups(docs, moduli=MODULI):
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` became one space. Documents
    with one fingerprint are compared chunk by chunk: a chunk position of a group passes when its least
    and greatest chunk are the same text (both combine before the shuffle, so a group of any size costs
    one row per task). Groups that fail are split by the hash of their texts.

    Null text counts as empty, and empty texts form one group. A repeated row counts each time; all rows
    with the least doc_id of a group are kept. Null ids rank last and are kept only if the group has no
    other id. Other columns are ignored; an empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, moduli), "fingerprints")
    key = ["n_bytes", "h1", "h2"]
    groups = prints.groupBy(*key).agg(F.count("*").alias("n"))
    members = prints.join(groups.where("n > 1").select(*key), key).select("rid", *key)
    texts = documents(docs).select("rid", F.regexp_replace("text", SPACE, " ").alias("norm"))
    chunks = _chunks(texts.join(members, "rid").select(*key, "norm"))
    differing = (
        chunks.groupBy(*key, "idx")
        .agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
        .where("low <> high")
        .select(*key, F.lit(True).alias("differs"))
        .distinct()
    )
    marked = prints.join(differing, key, "left")
    marked = stage(
        marked.select("doc_id", "sha", "n_rows", *key, F.when(F.col("differs"), F.col("sha")).otherwise("").alias("part")),
        "compared",
    )
    key.append("part")
    kept = marked.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
    out = marked.join(kept, key).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs):
    """The rows of ``docs`` that stay, once each, with all their columns.

    A row stays if its doc_id is the least of its group; of rows repeated whole or under one id, one.
    """
    kept = exact_groups(docs).where("kept").select("keep_id", "text_sha256").distinct()
    sha, seen = fresh(docs, "_sha"), fresh(docs, "_id")
    kept = kept.select(F.col("keep_id").alias(seen), F.col("text_sha256").alias(sha))
    norm = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), SPACE, " ")
    rows = docs.withColumn(sha, F.sha2(norm, 256))
    rows = rows.join(kept.withColumnRenamed(sha, sha + "k"), (rows[sha] == F.col(sha + "k")) & rows["doc_id"].eqNullSafe(F.col(seen)), "left_semi")
    return rows.dropDuplicates(["doc_id", sha]).select(*docs.columns)
