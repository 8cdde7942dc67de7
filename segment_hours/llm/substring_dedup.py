"""Removal of repeated passages by suffix automata of reference shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.common import Words, documents, fmix, powers, signed, stage, text_blocks, texts_of

# Words of a window, and words of the anchors in it.
WINDOW = 50
ANCHOR = 8
# Different runs behind one anchor up to which it is looked up as it is; with more it is refined to whole windows.
RUNS_PER_ANCHOR = 200
# Rows of which a task remembers that it has met them.
REMEMBERED = 1_000_000
# Words of a shard of reference runs: the size of an automaton.
SHARD_WORDS = 100_000

_RUN = "anchor long, run long, rid long, doc_id long, start int, n int"
_BASE = 0xD1342543DE82EF95


def _hash_range(prefix, inverse, first, last):
    """Hash of the words first to last, wherever they lie: prefix sums moved back to the origin."""
    return fmix((prefix[last] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))


def _prefix(hashes):
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(_BASE, n)[:n], dtype=np.uint64, out=sums[1:])
    return sums, powers(pow(_BASE, -1, 1 << 64), n + 1)


def runs_of(words, window=WINDOW, anchor=ANCHOR):
    """Runs of windows of a block: (text, anchor hash, run hash, first window, windows); windows count from the text's start.

    The anchor of a window is its sub-sequence of ``anchor`` words with the least hash, the leftmost of equals. Equal
    windows have equal anchors, so only runs with one anchor can share a window.
    """
    h = words.hashes
    n = len(h)
    none = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)]
    if n < window:
        return none
    grams = np.zeros(n - anchor + 1, np.uint64)
    for i in range(anchor):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[i : n - anchor + 1 + i]
    grams = fmix(grams)
    # Hash above, position below: the least value is the leftmost least anchor. 2**28 words fit in a block.
    low = (grams >> np.uint64(28) << np.uint64(28)) | np.arange(len(grams), dtype=np.uint64)
    width, span = 1, window - anchor + 1
    while width * 2 <= span:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    at = (low & np.uint64((1 << 28) - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = owner[: len(at)] == owner[window - 1 :]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none
    at = at[starts]
    fresh = np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = starts[fresh]
    count = np.diff(np.append(np.flatnonzero(fresh), len(starts)))
    prefix, inverse = _prefix(h)
    run = _hash_range(prefix, inverse, first, first + count + window - 1)
    run = fmix(run + (at[fresh] - first).astype(np.uint64))
    text = owner[first]
    return text, first - words.first[text], grams[at[fresh]], run, count


def _runs(window):
    """Runs of the texts; of repeated rows that a task meets only the first counts, as the others have the same runs."""

    def run(batches):
        seen = set()
        for part in text_blocks(batches):
            rids = part.column("rid").to_pylist()
            new = [i for i, r in enumerate(rids) if r not in seen and not seen.add(r)]
            if len(new) < len(rids):
                part = part.take(pa.array(new, pa.int64()))
            if len(seen) > REMEMBERED:
                seen.clear()
            text, first, anchor, runs, count = runs_of(Words(texts_of(part)), window)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(anchor)),
                    pa.array(signed(runs)),
                    part.column("rid").take(rows),
                    part.column("doc_id").take(rows),
                    pa.array(first, pa.int32()),
                    pa.array(count, pa.int32()),
                ],
                ["anchor", "run", "rid", "doc_id", "start", "n"],
            )

    return run


def _cut_runs(window):
    """Word hashes of the wanted runs of each document; runs of refined anchors as one row per window."""

    def run(batches):
        for part in text_blocks(batches):
            words = Words(texts_of(part))
            rows = []
            for d, wanted in enumerate(part.column("wanted").to_pylist()):
                own = words.hashes[words.first[d] : words.first[d + 1]]
                for w in wanted:
                    text = own[w["start"] : w["start"] + w["n"] + window - 1]
                    if not w["refine"]:
                        rows.append((w["anchor"], w["run"], w["least"], w["anchor"], 0, text))
                        continue
                    prefix, inverse = _prefix(text)
                    at = np.arange(w["n"])
                    keys = signed(_hash_range(prefix, inverse, at, at + window))
                    rows += [(w["anchor"], w["run"], w["least"], int(k), i, text[i : i + window]) for i, k in zip(at.tolist(), keys, strict=True)]
            for first in range(0, len(rows), 20_000):
                some = rows[first : first + 20_000]
                columns = [pa.array([r[i] for r in some], pa.int32() if i == 4 else pa.int64()) for i in range(5)]
                columns.append(pa.array([signed(r[5]) for r in some], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "run", "least", "key", "skip", "words"])

    return run


class Automaton:
    """Suffix automaton of many word sequences. ``least``: least document in which the strings of a state occur."""

    def __init__(self):
        self.next, self.link, self.length, self.least = [{}], [-1], [0], [None]

    def _state(self, following, link, length):
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.link) - 1

    def _split(self, p, symbol, q):
        """The state of the string of p and symbol, apart from the longer strings of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, words, document):
        """Adds a sequence that occurs in ``document``."""
        nexts, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for symbol in words:
            q = nexts[last].get(symbol)
            if q is not None:
                last = self._split(last, symbol, q)
            else:
                new = self._state({}, 0, length[last] + 1)
                p = last
                while p >= 0 and symbol not in nexts[p]:
                    nexts[p][symbol] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, symbol, nexts[p][symbol])
                last = new
            if least[last] is None or document < least[last]:
                least[last] = document

    def finish(self):
        """Hands the least documents down to the suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            to = self.link[state]
            if self.least[to] is None or self.least[state] < self.least[to]:
                self.least[to] = self.least[state]

    def windows(self, words, width):
        """Least document of each window of ``width`` words: matching statistics, cut back to the window; None where
        the match is shorter."""
        nexts, link, length, least = self.next, self.link, self.length, self.least
        state, matched, out = 0, 0, []
        for i, symbol in enumerate(words, 1):
            while state and symbol not in nexts[state]:
                state = link[state]
                matched = length[state]
            to = nexts[state].get(symbol)
            if to is not None:
                state, matched = to, matched + 1
            if matched >= width:
                while length[link[state]] >= width:
                    state = link[state]
                matched = min(matched, length[state])
            if i >= width:
                out.append(least[state] if matched >= width else None)
        return out


def _match(window):
    """Builds the automaton of a shard and streams the shard's runs through it."""

    def run(table):
        columns = [table.column(c).to_pylist() for c in ("anchor", "run", "least", "skip", "words")]
        automaton = Automaton()
        for _, _, least, _, words in zip(*columns, strict=True):
            automaton.add(words, least)
        automaton.finish()
        out = []
        for anchor, run_hash, _, skip, words in zip(*columns, strict=True):
            found = automaton.windows(words, window)
            first = 0
            for i in range(1, len(found) + 1):
                if i == len(found) or found[i] != found[first]:
                    out.append((anchor, run_hash, skip + first, skip + i, found[first]))
                    first = i
        names = ("anchor", "run", "first", "last", "least")
        return pa.table({n: pa.array([r[i] for r in out], pa.int32() if i in (2, 3) else pa.int64()) for i, n in enumerate(names)})

    return run


def repeated_spans(docs, window=WINDOW, runs_per_anchor=RUNS_PER_ANCHOR, shard_words=SHARD_WORDS):
    """(rid, spans): word ranges [first, last) of each document that windows of earlier documents cover.

    Every window has an anchor, and neighbouring windows with one anchor form a run. Only anchors that occur in two
    documents matter. Each different run behind them is a reference once, under its least document, which brings
    copies together before anything is compared. A run that is alone behind its anchor can only match
    itself. The others form shards of bounded size by anchor; a task builds the suffix automaton of its shard and streams the shard's
    runs through it, and the state of each window tells the least document that has it. An anchor with
    very many different runs is refined to whole windows, equal ones of which come together first, so no shard
    outgrows a task.
    """
    rows = documents(docs).where("doc_id is not null")
    runs = rows.select("rid", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_runs(window), _RUN)
    runs = stage(runs, "runs")
    distinct = runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.max("n").alias("n"))
    distinct = stage(distinct, "distinct-runs")
    anchors = distinct.groupBy("anchor").agg(F.min("least").alias("low"), F.max("most").alias("high"), F.count("*").alias("runs"))
    shared = distinct.join(anchors.where("low <> high").select("anchor", "runs"), "anchor")
    shared = stage(shared, "shared-runs")
    alone = shared.where("runs = 1").select("anchor", "run", F.lit(0).alias("first"), F.col("n").alias("last"), "least")

    many = shared.where("runs > 1").select("anchor", "run", "least", "n", (F.col("runs") > runs_per_anchor).alias("refine"))
    place = runs.drop("n").join(many, ["anchor", "run"]).where("doc_id = least").groupBy("anchor", "run", "least", "refine", "n")
    place = place.agg(F.min(F.struct("rid", "start")).alias("p")).select("p.rid", F.struct("anchor", "run", "least", "refine", "n", "p.start").alias("w"))
    wanted = place.groupBy("rid").agg(F.collect_set("w").alias("wanted"))  # bounded by the words of a document
    # A repeated row is a reference once.
    texts = rows.select("rid", F.col("text").cast("binary").alias("text")).join(wanted.select("rid"), "rid", "left_semi")
    texts = texts.groupBy("rid").agg(F.any_value("text").alias("text"))
    cut = texts.join(wanted, "rid").mapInArrow(_cut_runs(window), "anchor long, run long, least long, key long, skip int, words array<long>")
    cut = stage(cut, "references")
    # Equal windows of refined anchors are one reference, under their least document. A run matches itself;
    # windows that an earlier document has as well come on top.
    whole = F.col("key") != F.col("anchor")
    single = cut.where(whole).groupBy("key").agg(F.min("least").alias("least"), F.count("*").alias("runs")).where("runs > 1")
    later = cut.where(whole).select("anchor", "run", "key", "skip", F.col("least").alias("own"))
    later = later.join(single, (later["key"] == single["key"]) & (F.col("own") > F.col("least")))
    itself = many.where("refine")
    refined = later.select("anchor", "run", F.col("skip").alias("first"), (F.col("skip") + 1).alias("last"), "least").unionByName(
        itself.select("anchor", "run", F.lit(0).alias("first"), F.col("n").alias("last"), "least")
    )

    plain = cut.where(~whole)
    total = plain.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    shards = int(total // shard_words) + 1
    sharded = plain.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    matched = sharded.groupBy("shard").applyInArrow(_match(window), "anchor long, run long, first int, last int, least long")
    found = stage(alone.unionByName(matched).unionByName(refined), "matches")
    marked = runs.join(found, ["anchor", "run"]).where("least < doc_id")
    span = F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last") + (window - 1)).alias("last"))
    return marked.groupBy("rid").agg(F.collect_set(span).alias("spans"))  # bounded by the words of a document


def _kept(batches):
    for part in text_blocks(batches):
        totals, removed, hashes = [], [], []
        for text, spans in zip(texts_of(part), part.column("spans").to_pylist(), strict=True):
            words = text.split()
            kept = words
            if spans:
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, [s["first"] for s in spans], 1)
                np.add.at(cover, [s["last"] for s in spans], -1)
                kept = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0)]
            totals.append(len(words))
            removed.append(len(words) - len(kept))
            hashes.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def remove_repeats(docs, window=WINDOW, **options):
    """(doc_id, n_words, n_removed, kept_sha256) per document: words covered by windows that also start in an earlier document.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Earlier means a smaller doc_id; windows are judged on the input.

    Null, empty and short texts lose nothing. Documents without an id are neither cut nor a reference. Rows with one id
    are one document in that they do not cut each other. Repeated rows get equal results. Long texts are read whole.
    Other columns are ignored. An empty table gives an empty result.
    """
    spans = stage(repeated_spans(docs, window, **options), "repeats")
    rows = documents(docs).select("rid", "doc_id", F.col("text").cast("binary").alias("text"))
    joined = rows.join(spans, "rid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
