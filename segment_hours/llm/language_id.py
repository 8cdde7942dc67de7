"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.llm.common import fmix, text_blocks

UNKNOWN = "und"
# Hash buckets of the n-grams of 1 to 3 characters.
BUCKETS = 1 << 14
# Documented bound of the fit: at most so many labelled texts, chosen by hash, train the model.
SAMPLE = 4_000
# Pipeline: a document whose best language has less than this is rejected.
LEAST_SCORE = 0.5
_PIECE = 1 << 20


def held_out(doc_id):
    """True where crc32(doc_id as text) modulo 3 is 1; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def ngram_counts(text, buckets=BUCKETS):
    """Counts of the hashed n-grams of the whole lower-cased text; None if it has no letter.

    Runs of characters that are not letters count as one space.
    """
    total = None
    tail = np.zeros(0, np.uint32)
    for first in range(0, max(len(text), 1), _PIECE):
        codes = _codes(text[first : first + _PIECE])
        letter = codes != 32
        if total is None:
            if not letter.any():
                continue
            total = np.zeros(buckets, np.int64)
            tail = np.array([32], np.uint32)
        whole = np.concatenate((tail, codes))
        keep = np.ones(len(whole), bool)
        keep[1:] = (whole[1:] != 32) | (whole[:-1] != 32)
        keep[: len(tail)] = True
        whole = whole[keep].astype(np.uint64)
        for n in (1, 2, 3):
            begin = max(0, len(tail) - n + 1)
            own = whole[begin:]
            if len(own) < n:
                continue
            mixed = np.full(len(own) - n + 1, n, np.uint64)
            for i in range(n):
                mixed = mixed * np.uint64(0x100000001B3) + own[i : len(own) - n + 1 + i]
            total += np.bincount((fmix(mixed) >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
        tail = whole[-2:].astype(np.uint32)
    return total


_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])


def _codes(text):
    """Lower-case code points with everything but letters as a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).copy()
    high = codes >= 0x10000
    codes[~_LETTER[np.minimum(codes, 0xFFFF)] & ~high] = 32
    for i in np.flatnonzero(high):
        if not chr(int(codes[i])).isalpha():
            codes[i] = 32
    return codes


def _features(counts, idf):
    """Unit vector of (1 + log count) * idf."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((values * values).sum())
    return at, values / norm if norm else values


def _document_counts(batches):
    """(bucket, n): documents in which each bucket occurs, one set of rows per task."""
    seen = np.zeros(BUCKETS + 1, np.int64)
    for part in text_blocks(batches):
        for text in part.column("text").to_pylist():
            counts = ngram_counts(text or "")
            if counts is not None:
                seen[:-1] += counts > 0
                seen[-1] += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["bucket", "n"])


def ftrl(rows, labels, classes, buckets, epochs=4, alpha=0.5, beta=1.0, l1=0.05, l2=0.05, seed=5):
    """Weights (buckets + 1, classes) by follow-the-regularised-leader; the last row is the bias.

    The elastic net acts in the closed form of each weight: below ``l1`` it is exactly zero.
    """
    z = np.zeros((buckets + 1, classes))
    n = np.zeros((buckets + 1, classes))

    def weights(at):
        zs, ns = z[at], n[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        w[np.abs(zs) <= l1] = 0
        return w

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            at, values = np.append(at, buckets), np.append(values, 1.0)
            w = weights(at)
            p = softmax(values @ w)
            p[labels[i]] -= 1
            g = values[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(buckets + 1))


def softmax(scores):
    scores = np.exp(scores - scores.max(-1, keepdims=True))
    return scores / scores.sum(-1, keepdims=True)


def temperature(scores, labels):
    """The divisor of the scores with the least log loss on texts that did not train the weights.

    Labels are smoothed by one text in all, so that separable languages do not call for certainty.
    """
    if not len(labels) or scores.shape[1] < 2:
        return 1.0
    tried = np.geomspace(0.02, 20, 121)
    wanted = np.full(scores.shape, 1 / (len(labels) + 1) / (scores.shape[1] - 1))
    wanted[np.arange(len(labels)), labels] = 1 - 1 / (len(labels) + 1)
    loss = [-(wanted * np.log(softmax(scores / t) + 1e-300)).sum(1).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def _fitter(idf, classes):
    def run(batches):
        rows, labels, held = [], [], []
        for batch in batches:
            for text, lang, r in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "r")), strict=True):
                counts = ngram_counts(text or "")
                if counts is not None:
                    rows.append(_features(counts, idf))
                    labels.append(classes.index(lang))
                    held.append(r % 5 == 0)
        if not rows:
            return
        labels, held = np.array(labels), np.array(held)
        train = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
        w = ftrl([rows[i] for i in train], labels[train], len(classes), BUCKETS)
        check = np.flatnonzero(held)
        scores = np.array([rows[i][1] @ w[rows[i][0]] + w[-1] for i in check]).reshape(-1, len(classes))
        w = (w / temperature(scores, labels[check])).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])

    return run


class Model:
    """Languages, inverse document frequencies and calibrated weights: a few MB, whatever the corpus."""

    def __init__(self, classes, idf, weights):
        self.classes, self.idf, self.weights = classes, idf, weights

    def predict(self, text):
        """(language, probability); ``und`` and 0 for a text without letters."""
        counts = ngram_counts(text or "") if self.classes else None
        if counts is None:
            return UNKNOWN, 0.0
        at, values = _features(counts, self.idf)
        p = softmax(values @ self.weights[at] + self.weights[-1])
        best = int(np.argmax(p))
        return self.classes[best], float(p[best])


def sample_of(known, each):
    """(lang, r, text): of every language the ``each`` different texts with the smallest hashes ``r``, each once.

    The hashes are made different before any limit, so copies neither fill the sample nor shrink it.
    """
    order = Window.partitionBy("lang").orderBy("r")
    hashes = known.select("lang", "r").distinct()
    # The limit by rank holds before the shuffle, too: a task hands on ``each`` hashes of a language at most.
    chosen = hashes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each).drop("rank")
    return known.join(chosen, ["lang", "r"], "left_semi").groupBy("lang", "r").agg(F.min("text").alias("text"))


def fit(docs, sample=SAMPLE):
    """Model from the rows of ``docs`` with a language: document frequencies over all, weights from ``sample`` of them.

    The sample holds the different texts with the smallest hashes, evenly per language as far as they reach. The rows are read
    three times, however many languages there are. The languages are collected: a fixed small set of labels.
    """
    known = docs.where("lang is not null").select(
        F.col("text"), F.col("lang"), F.pmod(F.xxhash64("text"), F.lit(1 << 40)).alias("r")
    )
    counts = known.select("text").mapInArrow(_document_counts, "bucket int, n long")
    counts = counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows at most
    classes = sorted(r["lang"] for r in known.select("lang").distinct().collect())  # one row per language
    if not classes:
        return Model([], None, None)
    seen = np.zeros(BUCKETS + 1)
    for r in counts:
        seen[r["bucket"]] = r["n"]
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    rows = sample_of(known, -(-sample // len(classes)))
    # At most ``sample`` texts and a row more a language, in an order that does not depend on the partitions.
    found = rows.repartition(1).sortWithinPartitions("lang", "r").mapInArrow(_fitter(idf, classes), "weights binary").collect()  # one row
    if not found:
        return Model([], None, None)
    weights = np.frombuffer(found[0]["weights"], np.float32).reshape(BUCKETS + 1, len(classes))
    return Model(classes, idf, weights)


def _predictor(shared):
    def run(batches):
        model = shared.value
        for part in text_blocks(batches):
            answers = [model.predict(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rid"),
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array([a[0] for a in answers], pa.string()),
                    pa.array([a[1] for a in answers], pa.float64()),
                ],
                ["rid", "doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs, model=None):
    """(rid, doc_id, held_out, lang_pred, score) per document.

    Without a model one is fitted on the documents that are not held out and have a language. Null text and text
    without letters give ``und`` with score 0, and so does everything if there is nothing to learn from.
    Repeated rows get equal answers. Long texts are read whole, in pieces. An empty table gives an empty result.
    """
    if model is None:
        model = fit(docs.where(~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return rows.mapInArrow(_predictor(shared), "rid long, doc_id long, held_out boolean, lang_pred string, score double")


def _keeper(shared, least):
    def run(batches):
        model = shared.value
        for part in text_blocks(batches):
            answers = [model.predict(t) for t in part.column("text").to_pylist()]
            yield part.filter(pa.array([a[0] != UNKNOWN and a[1] >= least for a in answers], pa.bool_()))

    return run


def keep_identified(docs, least=LEAST_SCORE):
    """The rows of ``docs`` whose language is recognised with at least ``least``, with all their columns.

    Rows are dropped where they lie: nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out(F.col("doc_id")))))
    return docs.mapInArrow(_keeper(shared, least), docs.schema)
