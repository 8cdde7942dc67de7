"""Helpers of the text operators: tables, row keys, stages, and word hashes of text blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text a worker handles at once; a longer text forms a block of its own.
BLOCK_BYTES = 4 << 20


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stage(df, name):
    """Writes ``df`` to the shared folder and reads it back: lost executors re-read files."""
    return cut_lineage(df, name)


def documents(docs):
    """(rid, doc_id, text): only the needed columns, null text empty.

    ``rid`` names a row by its content, so repeated rows share one and get the same result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def fresh(df, name):
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fmix(x):
    """Scrambles an array of 64-bit integers (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base, n):
    """1, base, base**2, ... (n values, modulo 2**64)."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_blocks(batches, column="text"):
    """Arrow batches cut so that each part holds about ``BLOCK_BYTES`` of text."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
            yield batch.slice(first, last - first)
            first = last


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block of UTF-8 texts, as 64-bit hashes.

    ``hashes``: of all words; ``first``: index of each text's first word (one more entry than texts).
    Words hash alike exactly if their bytes are equal, up to collisions of a 64-bit hash.
    """

    def __init__(self, texts, lower=False):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        letters = np.arange(256, dtype=np.uint64)
        if lower:
            letters[65:91] += np.uint64(32)
        space = np.zeros(256, bool)
        space[[32, 9, 10, 11, 12, 13]] = True
        gap = space[data]
        word = ~gap
        starts = np.flatnonzero(word & np.concatenate(([True], gap[:-1])))
        ends = np.flatnonzero(gap & np.concatenate(([False], word[:-1])))
        if len(starts):
            longest = int((ends - starts).max())
            within = np.arange(len(data), dtype=np.int64)
            opened = np.zeros(len(data), np.int64)
            opened[starts] = starts
            within -= np.maximum.accumulate(opened)
            within[gap] = 0
            values = fmix(letters + np.uint64(0x9E3779B97F4A7C15))[data]
            values *= powers(0x9FB21C651E98DF25, longest)[within]
            values[gap] = 0
            sums = np.add.reduceat(values, starts)
            self.hashes = fmix(sums + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        else:
            self.hashes = np.zeros(0, np.uint64)
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        self.first = np.searchsorted(starts, offsets)

    def __len__(self):
        return len(self.hashes)


def texts_of(batch, column="text"):
    return [t or b"" for t in batch.column(column).to_pylist()]


def signed(x):
    return np.asarray(x, np.uint64).view(np.int64)
