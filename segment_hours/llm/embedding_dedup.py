"""Near-duplicate vectors by lattice hashing: random projections decoded to E8 lattice points."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.llm.common import fmix, signed, stage
from segment_hours.llm.components import components

THRESHOLD = 0.93
# A pair at cosine 0.93 meets in a table with probability 0.87 (home or a probed cell), so six tables miss 4 pairs in a million.
TABLES = 6
PROBES = 4
SCALE = 1.5
# Vectors of a block: a cell with more is compared block by block.
BASE_BLOCK = 1_000
VISITOR_BLOCK = 2_000


def _nearest_d8(x):
    """Nearest points of D8: whole coordinates with an even sum."""
    r = np.round(x)
    error = x - r
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    worst = np.abs(error[odd]).argmax(1)
    r[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return r


def nearest_e8(x):
    """Nearest points of E8: those of D8 and of D8 moved by one half in every coordinate."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def _neighbours():
    """The 240 shortest lattice vectors: steps to the neighbouring cells."""
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = a, b
            steps.append(step)
    steps += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(steps)


def _unit(vectors):
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Lattice:
    """Cells of unit vectors of one dimension. A cell's key is linear in its point, so steps add to keys."""

    def __init__(self, dimension, tables=TABLES, probes=PROBES, scale=SCALE):
        self.probes = probes
        self.matrices = np.random.default_rng(8 * dimension + 1).normal(size=(tables, dimension, 8)) * scale / np.sqrt(8)
        self.factors = fmix(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.steps = _neighbours()
        self.step_keys = self._keys(self.steps)

    def _keys(self, points):
        return ((points * 2).astype(np.int64).view(np.uint64) * self.factors).sum(1, dtype=np.uint64)

    def cells(self, units, table, probes=True):
        """(home keys, probed keys per vector)."""
        x = units @ self.matrices[table]
        home = nearest_e8(x)
        keys = self._keys(home)
        if not probes:
            return keys, None
        gain = (x - home) @ self.steps.T
        near = np.argsort(-gain, 1, kind="stable")[:, : self.probes]
        return keys, keys[:, None] + self.step_keys[near]

    def first_meeting(self, units, pairs, table, visiting, ids):
        """Which pairs (i, j) of rows of ``units`` are to count in this place: they meet in no earlier table, and of two
        vectors that probe each other's cell the one with the smaller id is the visitor."""
        counts = np.ones(len(pairs), bool)
        rows, at = np.unique(pairs, return_inverse=True)
        a, b = at.reshape(pairs.shape).T
        for t in range(table + 1):
            home, probed = self.cells(units[rows], t)
            back = (probed[b] == home[a][:, None]).any(1)
            if t == table:
                counts &= ~visiting | ~back | (ids[rows[a]] < ids[rows[b]])
            else:
                counts &= (home[a] != home[b]) & ~back & ~(probed[a] == home[b][:, None]).any(1)
        return counts


def _keys_of(options):
    def run(batches):
        lattices = {}
        for batch in batches:
            cids = batch.column("cid").to_numpy()
            labels = batch.column("label_key").to_numpy()
            vectors = batch.column("vector").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                lattice = lattices.setdefault(d, Lattice(int(d), **options))
                units = _unit([vectors[i] for i in rows])
                for t in range(len(lattice.matrices)):
                    home, probed = lattice.cells(units, t)
                    every = np.concatenate((home[:, None], probed), 1)
                    salt = fmix(labels[rows].astype(np.int64).view(np.uint64) + np.uint64(t * 1_000_003 + int(d)))
                    keys = fmix(every ^ salt[:, None])
                    n = every.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(keys.reshape(-1))),
                            pa.array(np.full(len(rows) * n, t, np.int32)),
                            pa.array(np.tile(np.arange(n) == 0, len(rows))),
                            pa.array(np.repeat(cids[rows], n)),
                        ],
                        ["key", "t", "home", "cid"],
                    )

    return run


def _roots(n, pairs):
    """Least row that each of ``n`` rows reaches over the pairs."""
    root = np.arange(n)
    while len(pairs):
        before = root.copy()
        least = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        np.minimum.at(root, pairs[:, 0], least)
        np.minimum.at(root, pairs[:, 1], least)
        root = root[root]
        if (root == before).all():
            break
    return root


def _compare(threshold, options):
    lattices = {}  # a task makes one a dimension, for all of its cells

    def run(table):
        t, part = table.column("t")[0].as_py(), table.column("part")[0].as_py()
        base, home = table.column("base").to_numpy(), table.column("home").to_numpy()
        ids, weights = table.column("cid").to_numpy(), table.column("n").to_numpy()
        vectors = table.column("vector").to_pylist()
        units = _unit(vectors)
        size = len(vectors[0])
        lattice = lattices.get(size) or lattices.setdefault(size, Lattice(size, **options))
        own, visitors = np.flatnonzero(base), np.flatnonzero(~base)
        kept = [np.zeros((0, 2), np.int64)]
        for rows in (own if part == 0 else own[:0], visitors):
            for first in range(0, len(rows), 200):
                i, j = np.nonzero(units[rows[first : first + 200]] @ units[own].T >= threshold)
                pairs = np.stack((rows[first + i], own[j]), 1)
                if rows is not visitors:
                    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
                if len(pairs):
                    kept.append(pairs[lattice.first_meeting(units, pairs, t, ~home[pairs[:, 0]], ids)])
        pairs = np.concatenate(kept)
        links = np.bincount(pairs[:, 0], weights[pairs[:, 1]], len(ids)) + np.bincount(pairs[:, 1], weights[pairs[:, 0]], len(ids))
        root = _roots(len(ids), pairs)
        rows = np.unique(pairs)
        columns = (ids[rows], links[rows].astype(np.int64), ids[root[rows]])
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("cid", "links", "root"), columns, strict=True)})

    return run


def _classes(vectors):
    """(vec_id, cid): ``cid`` names label and vector, null where the vector links with nothing."""
    element = vectors.schema["embedding"].dataType.elementType
    vector = F.col("embedding").cast(T.ArrayType(T.DoubleType() if isinstance(element, T.DoubleType) else T.FloatType()))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector"), F.coalesce(usable, F.lit(False)).alias("ok"))
    return rows.withColumn("cid", F.when(F.col("ok"), F.xxhash64("label", "vector")))


def near_vectors(vectors, threshold=THRESHOLD, tables=TABLES, probes=PROBES, scale=SCALE):
    """(vec_id, n_links, component_id, kept): vectors of one label linked by a cosine of at least ``threshold``.

    Equal vectors form a class with a weight, so copies are compared once. In each table a vector is projected to eight
    dimensions and decoded to its E8 lattice point; it is at home in that cell and visits the ``probes``
    neighbouring cells that it lies nearest to. Vectors at home are compared with each other and with visitors, in double
    precision. A pair counts in the first table where it meets, so link counts are exact for the pairs that
    meet, and no list of pairs is made. A cell with many vectors is cut into blocks of bounded size.

    Null, empty and zero vectors, vectors with a null or non-finite component, and vectors without a label have no links
    and are components of their own. Vectors of different lengths never meet. Repeated rows are copies of each other.
    Other columns are ignored. An empty table gives an empty result.
    """
    options = {"tables": tables, "probes": probes, "scale": scale}
    rows = stage(_classes(vectors), "vectors")
    usable = rows.where("cid is not null")
    classes = usable.groupBy("cid").agg(F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
    classes = stage(classes.withColumn("label_key", F.xxhash64("label")).drop("label"), "classes")
    keys = classes.select("cid", "label_key", "vector").mapInArrow(_keys_of(options), "key long, t int, home boolean, cid long")
    keys = stage(keys, "cells")
    sizes = keys.groupBy("key").agg(F.count_if("home").alias("at_home"), F.count_if(~F.col("home")).alias("visiting"))
    sizes = sizes.where("at_home > 0 and at_home + visiting > 1")
    blocks = F.ceil(F.col("at_home") / BASE_BLOCK).cast("int")
    visitors = F.col("visiting") + F.when(F.col("blocks") > 1, F.col("at_home")).otherwise(0)
    sizes = sizes.withColumn("blocks", blocks).withColumn("parts", F.greatest(F.ceil(visitors / VISITOR_BLOCK), F.lit(1)).cast("int"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("parts")).cast("int")
    as_base = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.col("own").alias("block"), p.alias("part"), F.lit(True).alias("base")))
    later = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: ~F.col("home") | (b > F.col("own")))
    as_visitor = F.transform(later, lambda b: F.struct(b.alias("block"), F.col("own_part").alias("part"), F.lit(False).alias("base")))
    places = keys.join(sizes, "key").withColumns({"own": own, "own_part": part})
    places = places.withColumn("place", F.explode(F.when(F.col("home"), F.concat(as_base, as_visitor)).otherwise(as_visitor)))
    places = places.select("key", "t", "home", "cid", "place.*").join(classes.select("cid", "n", "vector"), "cid")
    met = places.groupBy("key", "block", "part").applyInArrow(_compare(threshold, options), "cid long, links long, root long")
    met = stage(met, "links")
    links = met.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(met.select("cid", "root"), "vector-groups").withColumnRenamed("node", "cid")
    named = classes.select("cid", "n").join(links, "cid", "left").join(groups, "cid", "left")
    named = named.select("cid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root"))
    joined = usable.select("vec_id", "cid").join(named, "cid")
    least = joined.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = joined.join(least, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where("cid is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
