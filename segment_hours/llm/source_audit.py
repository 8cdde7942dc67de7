"""Divergence of sources from their language: exact counts by a second pass over minimal perfect hashes."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.llm.byte_words import LETTERS, byte_table, word_lists
from segment_hours.llm.common import stage, texts_of
from segment_hours.llm.perfect_hash import PerfectHash, hashes_of
from segment_hours.llm.sharing import share, shared

# Documents of a language in which a kept term occurs at least.
LEAST_DOCUMENTS = 10
# Terms reported for each group.
TOP = 10
# Keys of a shard of the perfect hash, and bytes of the shards that are sent to the executors at once.
SHARD_KEYS = 50_000
BLOCK_BYTES = 32 << 20
# Entries that a task holds before it hands them on: of its word tables, and of its dense arrays.
HELD_TERMS = 1_000_000
HELD_SLOTS = 8_000_000
# Terms of a block of the comparison of sources.
PAIR_TERMS = 1024

_TABLE = byte_table(LETTERS)


def _text(column):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _documents(docs):
    return docs.select(_text("lang").alias("lang"), _text("source").alias("source"), _text("text").cast("binary").alias("text"))


def _document_counts(batches):
    """(lang, term, n): documents of a part that hold a term, summed as far as memory allows."""

    def rows(held):
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                ["lang", "term", "n"],
            )

    held = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
            counts = held.setdefault(lang, Counter())
            pieces = [set(words) for words in word_lists(text, _TABLE)]
            counts.update(pieces[0].union(*pieces[1:]))
        if sum(map(len, held.values())) > HELD_TERMS:
            yield from rows(held)
            held = {}
    yield from rows(held)


def frequent_terms(docs, least=LEAST_DOCUMENTS):
    """(lang, term): terms in at least ``least`` documents of a language, exactly counted."""
    counts = _documents(docs).select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def _with_part(batches):
    for batch in batches:
        terms, parts = texts_of(batch, "term"), batch.column("parts").to_numpy()
        part = (hashes_of(terms) % parts.astype(np.uint64)).astype(np.int64) if terms else parts
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(part)], ["lang", "term", "part"])


def _build(table):
    """The perfect hash of a shard, as its keys in the order of their numbers."""
    index = PerfectHash(sorted(texts_of(table.combine_chunks(), "term")))
    keys = index.keys.tolist()
    columns = {
        "lang": table.column("lang")[:1].combine_chunks(),
        "part": table.column("part")[:1].combine_chunks(),
        "n": pa.array([len(keys)], pa.int64()),
        "bytes": pa.array([sum(map(len, keys)) + 16 * len(keys)], pa.int64()),
        "keys": pa.array([keys], pa.list_(pa.binary())),
    }
    return pa.table(columns)


def term_shards(terms, shard_keys=SHARD_KEYS):
    """(lang, part, n, bytes, keys, first): perfect hashes of the terms of each language, in shards by hash; ``first`` is the slot of
    a shard's first key, so that a language fills the slots from 0 on."""
    parts = terms.groupBy("lang").agg(F.ceil(F.count("*") / shard_keys).cast("long").alias("parts"))
    named = terms.join(parts, "lang").mapInArrow(_with_part, "lang string, term binary, part long")
    shards = named.groupBy("lang", "part").applyInArrow(_build, "lang string, part long, n long, bytes long, keys array<binary>")
    shards = stage(shards, "shards")
    # One row a shard and no keys: the window holds a language's shards only.
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("lang", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return shards.join(places, ["lang", "part"])


class Block:
    """Some shards as a worker holds them: by language, with a dense numbering over the shards of the block."""

    def __init__(self, rows):
        self.langs = {}
        for lang, part, keys, first in sorted(rows, key=lambda r: (r[0], r[1])):
            index = PerfectHash([bytes(k) for k in keys])
            held = self.langs.setdefault(lang, {"parts": {}, "size": 0, "slots": []})
            held["parts"][part] = (index, held["size"])
            held["size"] += len(keys)
            held["slots"].append(np.arange(first, first + len(keys)))
        for held in self.langs.values():
            held["slots"] = np.concatenate(held["slots"])

    def dense(self, lang, parts, words):
        """(index of the word, place) of the words that are keys of the block."""
        held = self.langs[lang]
        hashes = hashes_of(words)
        part = (hashes % np.uint64(parts)).astype(np.int64)
        rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p in np.unique(part).tolist():
            if p in held["parts"]:
                index, start = held["parts"][p]
                own = np.flatnonzero(part == p)
                number = index.lookup([words[i] for i in own.tolist()], hashes[own])
                rows.append(own[number >= 0])
                places.append(number[number >= 0] + start)
        return np.concatenate(rows), np.concatenate(places)


def _count(block, parts):
    """(lang, source, slot, n): occurrences, added to one dense array a group."""

    def run(batches):
        held, dense, slots = {}, {}, 0
        known = shared(block)

        def rows():
            for (lang, source), array in dense.items():
                at = np.flatnonzero(array)
                for first in range(0, len(at), 50_000):
                    some = at[first : first + 50_000]
                    names = [pa.array([v] * len(some), pa.string()) for v in (lang, source)]
                    numbers = [pa.array(known.langs[lang]["slots"][some]), pa.array(array[some])]
                    yield pa.RecordBatch.from_arrays([*names, *numbers], ["lang", "source", "slot", "n"])

        def settle():
            nonlocal slots
            for (lang, source), counts in held.items():
                words = list(counts)
                if (lang, source) not in dense:
                    size = known.langs[lang]["size"]
                    if slots and slots + size > HELD_SLOTS:
                        yield from rows()
                        dense.clear()
                        slots = 0
                    dense[lang, source] = np.zeros(size, np.int64)
                    slots += size
                at, places = known.dense(lang, parts[lang], words)
                dense[lang, source][places] += np.fromiter(counts.values(), np.int64, len(counts))[at]
            held.clear()

        for batch in batches:
            columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts_of(batch))
            for lang, source, text in zip(*columns, strict=True):
                if lang in known.langs:
                    counts = held.setdefault((lang, source), Counter())
                    for words in word_lists(text, _TABLE):
                        counts.update(words)
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from settle()
        yield from settle()
        yield from rows()

    return run


def group_counts(docs, shards):
    """(lang, source, slot, n): occurrences of each kept term, pre-aggregated by tasks in dense arrays.

    The shards are sent in blocks of bounded size; each block reads the documents once more.
    """
    spark = docs.sparkSession
    total = shards.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows, found = _documents(docs), None
    for i in range(blocks):
        own = shards.where(F.pmod(F.xxhash64("lang", "part"), F.lit(blocks)) == i)
        own = own.join(shards.groupBy("lang").agg(F.count("*").alias("parts")), "lang").select("lang", "part", "keys", "first", "parts").collect()
        block, parts = share(spark, Block([tuple(r)[:4] for r in own])), {r["lang"]: r["parts"] for r in own}
        counts = rows.mapInArrow(_count(block, parts), "lang string, source string, slot long, n long")
        counts = stage(counts.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n")), "counts")
        found = counts if found is None else found.unionByName(counts)
    return found


def _share(n, total, terms):
    """1 + floor(10**9 * (n + 2) / (total + 2 * terms)), exactly; null without terms."""
    wide = "decimal(20,0)"
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (n.cast(wide) + F.lit(2).cast("decimal(1,0)"))
    bottom = F.nullif(total.cast(wide) + F.lit(2).cast("decimal(1,0)") * terms.cast(wide), F.lit(0).cast(wide))
    return F.call_function("div", top, bottom) + 1


def _difference(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(table):
    """(lang, source, item, value): differences of all sources of a language over one block of terms, one source at a time."""
    rows = table.combine_chunks()
    sources, index = np.unique(np.array(rows.column("source").to_pylist(), object), return_inverse=True)
    slots = rows.column("slot").to_numpy(zero_copy_only=False)
    p = rows.column("p").to_numpy(zero_copy_only=False).astype(np.int64)
    base = slots < 0
    width = int(rows.column("width")[0].as_py())
    shares = np.zeros((len(sources), width), np.int64)
    shares[index[base]] = p[base, None]
    shares[index[~base], slots[~base] % PAIR_TERMS] = p[~base]
    values = []
    for i in range(len(sources)):
        gap = shares - shares[i]
        value = (gap * gap // np.maximum(shares + shares[i], 1)).sum(1)
        values.append(np.delete(value, i))
    n = len(sources)
    names = pa.array(sources.tolist(), pa.string())
    others = np.concatenate([np.delete(np.arange(n), i) for i in range(n)])
    columns = {
        "lang": pa.array([rows.column("lang")[0].as_py()] * (n * (n - 1)), pa.string()),
        "source": names.take(pa.array(np.repeat(np.arange(n), n - 1))),
        "item": names.take(pa.array(others)),
        "value": pa.array(np.concatenate(values).astype(np.int64)),
    }
    return pa.table(columns)


def divergence(docs, least=LEAST_DOCUMENTS, top=TOP, shard_keys=SHARD_KEYS):
    """(lang, source, part, item, value, rank): how far the sources of a language lie from each other, and the terms that set each apart.

    Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; a language keeps those in at least ``least`` of its
    documents. The first pass counts documents exactly. The kept terms go into minimal perfect hashes in shards
    (words stored), which are broadcast; the second pass adds occurrences to dense slots of each group (lang, source).
    With p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), the difference of p and q is floor((p - q)**2 / (p + q)).
    Part ``pair``: all other sources by the sum of differences over all kept terms; part ``term``: the ``top`` terms
    of the group above their share in the language. Ranks by value, then by item. All arithmetic is in whole numbers.

    Null text, lang and source count as ''. Every row is a document, repeated ones too. A language without kept terms has pairs of
    value 0. A language of one source has no pairs. Other columns are ignored. An empty table gives an empty result.
    """
    terms = stage(frequent_terms(docs, least), "terms")
    shards = term_shards(terms, shard_keys)
    counts = group_counts(docs, shards)
    kept = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = _documents(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms")])
    groups = stage(groups, "groups")

    whole = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    named = shards.select("lang", "first", F.posexplode("keys").alias("i", "key"))
    named = named.select("lang", (F.col("first") + F.col("i")).alias("slot"), F.col("key").cast("string").alias("item"))
    share = _share(F.col("n"), F.col("total"), F.col("terms"))
    whole = whole.join(langs, "lang").join(named, ["lang", "slot"]).select("lang", "slot", "item", share.alias("q"))
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "slot", share.alias("p"))
    order = Window.partitionBy("lang", "source")
    ranked = shares.join(whole, ["lang", "slot"]).where("p > q")
    ranked = ranked.select("lang", "source", F.lit("term").alias("part"), "item", _difference(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(order.orderBy(F.desc("value"), "item")).alias("rank")
    ranked = ranked.select("*", rank).where(F.col("rank") <= top)

    last = F.greatest(F.floor((F.col("terms") - 1) / PAIR_TERMS), F.lit(0))
    base = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    zero = F.coalesce(_share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0))
    width = F.least(F.col("terms") - F.col("block") * PAIR_TERMS, F.lit(PAIR_TERMS).cast("long"))
    base = base.select("lang", "block", "source", F.lit(-1).cast("long").alias("slot"), zero.alias("p"), width.alias("width"))
    held = F.floor(F.col("slot") / PAIR_TERMS).alias("block")
    cells = shares.select("lang", held, "source", "slot", "p", F.lit(None).cast("long").alias("width"))
    cells = base.unionByName(cells).withColumn("width", F.max("width").over(Window.partitionBy("lang", "block")))
    pairs = cells.groupBy("lang", "block").applyInArrow(_pairs, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.select("*", F.row_number().over(order.orderBy(F.desc("value"), "item")).alias("rank"))
    return pairs.unionByName(ranked)
