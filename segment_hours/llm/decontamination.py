"""Removal of benchmark passages: phrases searched in FM-indexes of shards of the training text."""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.byte_words import DIGITS, LETTERS, byte_table, word_lists
from segment_hours.llm.common import stage, text_blocks, texts_of
from segment_hours.llm.fm_index import FMIndex
from segment_hours.llm.sharing import share, shared

# Words of a window.
WINDOW = 10
# Words of a shard of training text, the size of an index; shards overlap by a window.
SHARD_WORDS = 1 << 19
# Phrases and their bytes that are sent to the executors at once; more go in further passes.
BLOCK_PHRASES = 200_000
BLOCK_BYTES = 16 << 20

_TABLE = byte_table(LETTERS + DIGITS)
# Fixed value of the contract: words after lower-casing.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # with capitals, as in the text itself
_FOUND = "spans array<struct<first:long,last:long>>, items array<string>"


def _phrases(window):
    """(phrase, k, item) of every window of an item; an item with fewer words is one window."""

    def run(batches):
        for part in text_blocks(batches):
            names, phrases = [], []
            for text, item in zip(texts_of(part), part.column("item").to_pylist(), strict=True):
                words = [w for some in word_lists(text, _TABLE) for w in some]
                found = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else ()
                phrases += found
                names += [item] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(names, pa.string())], ["phrase", "item"])

    return run


def phrases_of(benchmark, window=WINDOW):
    """(phrase, item): distinct windows of the items, words joined by a space."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.where("text is not null").mapInArrow(_phrases(window), "phrase binary, item string").distinct()


class Phrases:
    """A block of phrases as numbers: words count from 1, rows of ``symbols`` are phrases."""

    def __init__(self, rows):
        texts = sorted({phrase for phrase, _ in rows})
        self.items = sorted({item for _, item in rows if item is not None})
        split = [t.split() for t in texts]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for s in split for w in s}), 1)}
        self.lengths = np.array([len(s) for s in split], np.int64)
        self.symbols = np.zeros((len(texts), max(map(len, split), default=1)), np.int32)
        for i, s in enumerate(split):
            self.symbols[i, : len(s)] = [self.vocabulary[w] for w in s]
        at, name = {t: i for i, t in enumerate(texts)}, {t: i for i, t in enumerate(self.items)}
        owners = sorted((at[p], name[i]) for p, i in rows if i is not None)
        self.owner_first = np.searchsorted([p for p, _ in owners], np.arange(len(texts) + 1))
        self.owners = np.array([i for _, i in owners], np.int64)

    def owned(self, phrases):
        """Items of some phrases."""
        return {self.items[i] for p in phrases for i in self.owners[self.owner_first[p] : self.owner_first[p + 1]]}

    def occurrences(self, words, shard_words):
        """(phrase, first word) of every occurrence in ``words`` (numbers, 0 for others), one index a shard."""
        if not len(self.lengths):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.concatenate(([False], words > 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        starts, ends = edges[::2], edges[1::2]
        # Words outside the phrases part the text. Runs too short for any phrase are left out.
        long = ends - starts >= self.lengths.min()
        starts, sizes = starts[long], (ends - starts)[long]
        place = np.cumsum(sizes + 1) - sizes - 1
        total = int((sizes + 1).sum())
        text, where = np.zeros(total, np.int64), np.zeros(total, np.int64)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(place, sizes) + inside
        where[at] = np.repeat(starts, sizes) + inside
        text[at] = words[where[at]]
        phrases, positions = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        overlap = int(self.lengths.max()) - 1
        for first in range(0, total, shard_words):
            shard = text[max(0, first - overlap) : first + shard_words]
            # Only symbols of the shard get a place in its index.
            used, numbers = np.unique(np.append(shard, 0), return_inverse=True)
            place = np.zeros(len(self.vocabulary) + 1, np.int64)
            place[used] = np.arange(len(used))
            wanted = place[self.symbols]
            full = np.count_nonzero(wanted, axis=1) == self.lengths
            chosen = np.flatnonzero(full)
            index = FMIndex(numbers[:-1], len(used))
            phrase, position = index.locate(*index.search(wanted[chosen], self.lengths[chosen]))
            phrases.append(chosen[phrase])
            positions.append(where[position + max(0, first - overlap)])
        return np.concatenate(phrases), np.concatenate(positions)


def _merged(first, last):
    """Ranges as few as possible that cover the same words."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > last[:-1]))
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def _search(block, shard_words, with_text):
    def run(batches):
        phrases = shared(block)
        number = phrases.vocabulary.get
        for part in text_blocks(batches):
            pieces, sizes = [], []
            for text in texts_of(part):
                size = 0
                for words in word_lists(text, _TABLE):
                    pieces.append(np.fromiter(map(number, words, repeat(0)), np.int32, len(words)))
                    size += len(words)
                pieces.append(np.zeros(1, np.int32))  # no phrase crosses two texts
                sizes.append(size)
            sizes = np.array(sizes, np.int64)
            ends = np.cumsum(sizes + 1)
            phrase, first = phrases.occurrences(np.concatenate(pieces), shard_words)
            text = np.searchsorted(ends, first, "right")
            order = np.argsort(text, kind="stable")
            phrase, first, text = phrase[order], first[order], text[order]
            last = first + phrases.lengths[phrase]
            spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
            for rows in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1) if len(text) else ():
                d = text[rows[0]]
                start = ends[d] - sizes[d] - 1
                a = np.concatenate(([s["first"] for s in spans[d]], first[rows] - start)).astype(np.int64)
                b = np.concatenate(([s["last"] for s in spans[d]], last[rows] - start)).astype(np.int64)
                spans[d] = [{"first": x, "last": y} for x, y in zip(*(v.tolist() for v in _merged(a, b)), strict=True)]
                items[d] = sorted({*items[d], *phrases.owned(np.unique(phrase[rows]))})
            columns = {"doc_id": part.column("doc_id"), "n_words": pa.array(sizes)}
            columns |= {"spans": pa.array(spans, part.schema.field("spans").type), "items": pa.array(items, pa.list_(pa.string()))}
            if with_text:
                columns["text"] = part.column("text")
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _blocks(spark, phrases):
    """Phrases in broadcast blocks of bounded size, by hash: a phrase of very many items may be in several."""
    size = phrases.agg(F.count("*"), F.sum(F.length("phrase") + F.length(F.coalesce("item", F.lit(""))))).first()
    blocks = max(1, -(-size[0] // BLOCK_PHRASES), -(-(size[1] or 0) // BLOCK_BYTES))
    for i in range(blocks):
        rows = phrases.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == i).collect() if size[0] else []
        yield i == blocks - 1, share(spark, Phrases([(bytes(r[0]), r[1]) for r in rows]))


def find_passages(docs, benchmark, window=WINDOW, shard_words=SHARD_WORDS, with_text=False):
    """(doc_id, n_words, spans, items[, text]): word ranges [first, last) of each document inside a benchmark passage, and the items.

    Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. A passage is ``window`` consecutive words of an
    item; an item with fewer words is one passage as a whole. Every worker indexes shards of its documents (an FM-index
    of the word numbers) and searches all phrases backward; occurrences are located by sampled positions and
    merged. Texts are read whole and cut into shards that overlap by a window. The phrases are sent in blocks of bounded size; with
    more than one block the documents are written as a stage between the passes.

    Null and empty texts have no words. An item without words has no passage; one without id marks words but is not listed.
    Equal items are all listed, repeated rows once. Repeated documents get equal rows, also those without an id. Other columns are
    ignored. An empty benchmark marks nothing, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    phrases = stage(phrases_of(benchmark, window), "phrases")
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    rows = rows.withColumns({"spans": F.expr("cast(array() as array<struct<first:long,last:long>>)"), "items": F.expr("cast(array() as array<string>)")})
    key = docs.schema["doc_id"].dataType.simpleString()
    for is_last, block in _blocks(spark, phrases):
        keep = with_text or not is_last
        rows = rows.mapInArrow(_search(block, shard_words, keep), f"doc_id {key}, n_words long, {_FOUND}" + ", text binary" * keep)
        if not is_last:
            rows = stage(rows.drop("n_words"), "searched")
    return rows.withColumn("text", F.col("text").cast("string")) if with_text else rows


def _without(text, spans):
    if text is None or not spans:
        return text
    words = [m.span() for m in _WORD.finditer(text)]
    at, kept = 0, []
    for s in spans:
        kept.append(text[at : words[s["first"]][0]])
        at = words[s["last"] - 1][1]
    return "".join([*kept, text[at:]])


def _cut(batches):
    for part in batches:
        rows = zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True)
        clean = pa.array([_without(text, spans) for text, spans in rows], pa.string())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), clean, part.column("n_words"), part.column("n_hit")], ["doc_id", "text", "n_words", "n_hit"])


def n_hit(spans="spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def remove_passages(docs, benchmark, **options):
    """(doc_id, text, n_words, n_hit): the texts without the words of benchmark passages and what lies between these.

    A null text stays null. See :func:`find_passages` for the other cases.
    """
    found = find_passages(docs, benchmark, with_text=True, **options).withColumn("n_hit", n_hit())
    key = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_cut, f"doc_id {key}, text string, n_words long, n_hit long")


def digest(found):
    """Counts and digests of :func:`find_passages`."""
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
