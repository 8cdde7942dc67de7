"""Near duplicates by an inverted join on MinHash coordinates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.common import Words, documents, fmix, fresh, signed, stage, text_blocks, texts_of
from segment_hours.llm.components import components
from segment_hours.session import spread

# Coordinates of a signature, and how many two documents must share. At a similarity of 0.8 a pair shares 38 on
# average; less than 24 has a probability of about 2e-6.
COORDINATES = 48
MATCHES = 24
SHINGLE = 5
THRESHOLD = 80
# Rows of a part of a list or family, and shingles of a part of a family: what one task compares at once.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20

_SIGNED = "rid long, doc_id long, n_shingles long, s1 long, s2 long, sig array<int>, low binary"


def shingle_sets(texts, width):
    """Per text the sorted distinct hashes of its shingles of ``width`` words; of fewer words, all as one."""
    words = Words(texts, lower=True)
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        own = words.hashes[first:last]
        if not len(own):
            yield own
            continue
        n = min(width, len(own))
        mixed = np.full(len(own) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = fmix(mixed * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - n + 1 + i])
        yield np.unique(mixed)


def _seeds(k):
    return fmix(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def _signer(width, k):
    seeds = _seeds(k)

    def run(batches):
        for part in text_blocks(batches):
            sets = list(shingle_sets(texts_of(part), width))
            sizes = np.array([len(s) for s in sets], np.int64)
            filled = np.flatnonzero(sizes)
            sig = np.zeros((len(sets), k), np.int32)
            s1, s2 = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            if len(filled):
                flat = np.concatenate([sets[i] for i in filled])
                at = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
                s1[filled] = signed(np.add.reduceat(flat, at))
                s2[filled] = signed(np.add.reduceat(fmix(flat ^ seeds[0]), at))
                for c in range(k):
                    x = flat * seeds[c]
                    x ^= x >> np.uint64(32)
                    x *= seeds[k + c]
                    sig[filled, c] = (np.minimum.reduceat(x, at) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rid"),
                    part.column("doc_id"),
                    pa.array(sizes),
                    pa.array(s1),
                    pa.array(s2),
                    pa.ListArray.from_arrays(np.arange(0, sig.size + 1, k, dtype=np.int32), pa.array(sig.reshape(-1))),
                    pa.array([row.tobytes() for row in sig.astype(np.uint8)], pa.binary()),
                ],
                ["rid", "doc_id", "n_shingles", "s1", "s2", "sig", "low"],
            )

    return run


def _posted(classes, k, least):
    """Postings (key, cid, low): every class under the coordinates of its prefix that another class shares.

    Two classes that share ``least`` of ``k`` coordinates share one of their first ``k - least + 1`` in any common
    order; the order is by rarity, so long lists are skipped. Coordinates that nobody else has come first and need no
    posting.
    """
    at = F.posexplode("sig").alias("c", "value")
    coordinates = classes.select("cid", at).select("cid", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("value")).alias("key"))
    shared = coordinates.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = coordinates.join(shared, "key").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
    prefix = F.slice("keys", 1, F.size("keys") - (least - 1))
    own = own.where(F.size("keys") >= least).join(classes.select("cid", "low"), "cid")
    return own.select("cid", "low", F.explode(prefix).alias("p")).select("p.key", "cid", "low")


def _cells(batches):
    """Tables of whole cells, in the order of the rows, and the index of each cell's first row (and the end)."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        cell = rows.column("cell").to_numpy()
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        rest = rows.slice(first[-1])
        if len(first) > 1:
            yield rows.slice(0, first[-1]), first
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _forest(roots, sides, match):
    """Pairs of positions that connect what ``match`` connects, at most one less than there are positions.

    ``match(i, others)`` tells which of ``others`` are alike to ``i``. Positions with one root are connected already and
    not compared, nor are those of one side, if sides are given.
    """
    part = np.unique(roots, return_inverse=True)[1]
    pairs = []
    for i in range(len(part) - 1):
        open_ = part[i + 1 :] != part[i]
        if sides is not None:
            open_ &= sides[i + 1 :] != sides[i]
        others = np.flatnonzero(open_) + i + 1
        if not len(others):
            continue
        hits = others[match(i, others)]
        if len(hits):
            joined, at = np.unique(part[hits], return_index=True)
            pairs += [(i, j) for j in hits[at]]
            part[np.isin(part, joined)] = part[i]
    return pairs


def _edges(cid, pairs):
    pairs = np.asarray(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(cid[pairs[:, 0]]), pa.array(cid[pairs[:, 1]])], ["a", "b"])


def _low(rows, k):
    return np.frombuffer(b"".join(rows.column("low").to_pylist()), np.uint8).reshape(-1, k)


def _colliding(k, least, across):
    """Counts collisions of the signatures in a cell of a list; pairs (a, b) that connect those with ``least``.

    Only the low byte of a coordinate is compared, which can add a candidate but not lose one.
    """

    def run(batches):
        for rows, first in _cells(batches):
            cid, root = rows.column("cid").to_numpy(), rows.column("root").to_numpy()
            side = rows.column("side").to_numpy() if across else None
            low, ends = _low(rows, k), np.append(first[first < len(cid)], len(cid))
            sizes = np.diff(ends)
            twos = ends[:-1][sizes == 2]
            if across:
                twos = twos[side[twos] != side[twos + 1]]
            twos = twos[(low[twos] == low[twos + 1]).sum(1) >= least]
            pairs = list(zip(twos, twos + 1, strict=True))
            for at in np.flatnonzero(sizes > 2):
                own = slice(ends[at], ends[at + 1])
                mine = low[own]
                found = _forest(root[own], side[own] if across else None, lambda i, o, m=mine: (m[o] == m[i]).sum(1) >= least)
                pairs += [(ends[at] + i, ends[at] + j) for i, j in found]
            yield _edges(cid, pairs)

    return run


def _alike(k, least, width, threshold, across):
    """Pairs (a, b) that connect the texts of a cell whose full sets reach the threshold:
    100 * intersection >= threshold * union. Only pairs with ``least`` collisions are looked at."""

    def run(batches):
        for rows, first in _cells(batches):
            ends = np.append(first[first < rows.num_rows], rows.num_rows)
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                yield _edges(*_alike_in(rows.slice(start, end - start), k, least, width, threshold, across))

    return run


def _alike_in(rows, k, least, width, threshold, across):
    cid, low = rows.column("cid").to_numpy(), _low(rows, k)
    sets = []
    for batch in rows.combine_chunks().to_batches():
        for part in text_blocks([batch]):
            sets += shingle_sets(texts_of(part), width)
    sizes = np.array([len(s) for s in sets], np.int64)
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    mark = np.zeros(int(sizes.sum()), bool)

    def match(i, others):
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        good = (100 * small >= threshold * large) & ((low[others] == low[i]).sum(1) >= least)
        at = np.flatnonzero(good)
        mark[ids[i]] = True
        both = np.array([np.count_nonzero(mark[ids[j]]) for j in others[at]], np.int64)
        mark[ids[i]] = False
        good[at] = 100 * both >= threshold * (sizes[others[at]] + sizes[i] - both)
        return good

    return cid, _forest(rows.column("root").to_numpy(), rows.column("side").to_numpy() if across else None, match)


def _dealt(rows, cell, side):
    """``rows`` dealt into cells that come whole and in order within a partition."""
    return spread(rows.withColumn("cell", cell).withColumn("side", side), "cell").sortWithinPartitions("cell")


def _across(rows, root):
    """Rows (g, parts, cid, ...) of the groups that still have several roots, once for every pair of their parts."""
    rows = rows.join(root.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = rows.groupBy("g").agg(F.min("root").alias("low_root"), F.max("root").alias("high_root")).where("low_root <> high_root")
    rows = rows.join(mixed.select("g"), "g")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part")
    return _dealt(rows, F.xxhash64("g", F.least("part", "other"), F.greatest("part", "other")), F.col("part"))


def _families(posted, k, least, block):
    """(node, root): classes connected by pairs with ``least`` collisions."""
    large = posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = stage(large.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "large_lists")
    # Another cut of every list, so that the parts of one meet in the parts of others.
    lists = posted.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    lists = lists.withColumn("part", F.pmod(F.xxhash64("cid", "key"), F.col("parts")).cast("int"))
    lists = lists.select(F.col("key").alias("g"), "parts", "part", "cid", "low")
    cells = _dealt(lists.withColumn("root", F.col("cid")), F.xxhash64("g", "part"), F.lit(0))
    links = stage(cells.mapInArrow(_colliding(k, least, False), "a long, b long").distinct(), "collisions")
    labels = components(links, "families")
    rest = _across(lists.where("parts > 1"), labels).mapInArrow(_colliding(k, least, True), "a long, b long")
    rest = stage(rest.distinct(), "collisions")
    return labels if rest.isEmpty() else components(links.union(rest), "families")


def near_groups(docs, width=SHINGLE, threshold=THRESHOLD, k=COORDINATES, least=MATCHES, block=BLOCK, block_shingles=BLOCK_SHINGLES):
    """(rid, doc_id, n_shingles, component_id): components of documents whose shingle sets are alike.

    Documents with one set form a class, so copies cost nothing further. Classes are posted under coordinates of their
    signatures. Collisions are counted inside the lists; what shares ``least`` of them forms families. The texts
    of a family meet once, and links are confirmed on their full sets. In both steps a task gives only the links that
    connect its rows, so groups do not unfold into pairs. Lists over ``block`` rows and families over ``block`` rows or
    ``block_shingles`` are cut into parts; where parts are not connected, every two of them are compared. So each pair that
    shares ``least`` coordinates is compared or already connected.

    Null text, empty text and text without words have an empty set and are linked with nothing. Repeated rows have equal
    sets. Null ids take part; a component of null ids only has a null id. Other columns are ignored.
    An empty table gives an empty result.
    """
    rows = documents(docs)
    signed_rows = rows.select("rid", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_signer(width, k), _SIGNED)
    signed_rows = signed_rows.withColumn("cid", F.xxhash64("n_shingles", "s1", "s2"))
    signed_rows = stage(signed_rows, "signatures")
    filled = signed_rows.where("n_shingles > 0")
    first = filled.groupBy("cid").agg(F.min("rid").alias("rid"))
    classes = filled.join(first, ["cid", "rid"]).dropDuplicates(["cid"]).select("cid", "rid", "n_shingles", "sig", "low")
    classes = stage(classes, "classes")
    families = _families(stage(_posted(classes, k, least), "postings"), k, least, block)

    members = families.withColumnRenamed("node", "cid").withColumnRenamed("root", "g")
    members = members.join(classes.select("cid", "rid", "n_shingles", "low"), "cid")
    parts = F.ceil(F.greatest(F.count("*") / block, F.sum("n_shingles") / block_shingles)).cast("int")
    large = stage(members.groupBy("g").agg(parts.alias("parts")).where("parts > 1"), "large_families")
    members = members.join(large, "g", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    members = members.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")).drop("n_shingles")
    members = members.withColumn("root", F.col("cid"))
    # A repeated row enters a family once.
    texts = rows.select("rid", F.col("text").cast("binary").alias("text")).join(members.select("rid"), "rid", "left_semi")
    texts = texts.groupBy("rid").agg(F.any_value("text").alias("text"))
    # The first member of a family is in all of its parts.
    everywhere = F.when(F.col("cid") == F.col("g"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    cells = texts.join(members.withColumn("part", F.explode(everywhere)), "rid")
    cells = _dealt(cells, F.xxhash64("g", "part"), F.lit(0))
    links = stage(cells.mapInArrow(_alike(k, least, width, threshold, False), "a long, b long"), "links")
    groups = components(links, "near")
    rest = texts.join(members.where("parts > 1"), "rid").drop("root")
    rest = _across(rest, groups).mapInArrow(_alike(k, least, width, threshold, True), "a long, b long")
    rest = stage(rest, "links")
    if not rest.isEmpty():
        groups = components(links.union(rest), "near")

    joined = signed_rows.join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cid")).select("rid", "doc_id", "n_shingles", "root")
    filled = joined.where("n_shingles > 0")
    names = filled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = joined.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return filled.join(names, "root").drop("root").unionByName(alone.drop("root"))


def drop_near_copies(docs, **options):
    """The rows of ``docs`` that stay, with all their columns: one document of each group, empty ones all.

    The document with the least id stays; of repeated rows (equal id and text) one. Without an id a group of null ids
    only keeps one row of each text. An empty table gives an empty result.
    """
    groups = near_groups(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rid, copies, empty = fresh(docs, "_rid"), fresh(docs, "_copies"), fresh(docs, "_empty")
    kept = groups.groupBy(F.col("rid").alias(rid)).agg(F.count("*").alias(copies), F.min(F.col("n_shingles") == 0).alias(empty))
    kept = stage(kept, "kept")
    rows = docs.withColumn(rid, F.xxhash64("doc_id", "text"))
    repeated = (F.col(copies) > 1) & ~F.col(empty)
    once = rows.join(kept.where(~repeated), rid, "left_semi").select(*docs.columns)
    again = kept.where(repeated).select(rid)
    if again.isEmpty():
        return once
    return once.unionByName(rows.join(again, rid, "left_semi").dropDuplicates([rid]).select(*docs.columns))
