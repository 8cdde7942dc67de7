"""Vectors as product codes: nearest codebook entries found in a tree of split points with distance ranges."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.llm.common import fresh, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Split points of a node, and entries of a leaf at most.
SPLITS = 8
LEAF = 4
# Components below this are held in 64 bits: squared distances of a part then fit, too. Others are Python integers.
SMALL = 1 << 26
# Share by which a distance in floating point may be off, far above its rounding error.
SLACK = 1e-12
_LIMB = 1 << 32


class Gnat:
    """Tree over the rows of ``points`` (integers): split points with the range of distances to each child's points."""

    def __init__(self, points, index=None):
        self.points = points
        self.index = np.arange(len(points)) if index is None else index
        self.children = None
        if len(self.index) <= max(LEAF, 2):
            return
        own = points[self.index]
        chosen, gap = [0], self._squares(own, own[0])
        while len(chosen) < min(SPLITS, len(own)):
            gap[chosen] = -1
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, self._squares(own, own[chosen[-1]]))
        squares = np.stack([self._squares(own, own[c]) for c in chosen])
        home = squares.argmin(0)
        distance = np.sqrt(squares.astype(np.float64))
        self.splits = self.index[chosen]
        rest = np.ones(len(own), bool)
        rest[chosen] = False
        members = [np.flatnonzero(rest & (home == j)) for j in range(len(chosen))]
        self.low = np.array([[d[m].min() if len(m) else np.inf for m in members] for d in distance]) * (1 - SLACK)
        self.high = np.array([[d[m].max() if len(m) else -np.inf for m in members] for d in distance]) * (1 + SLACK)
        self.children = [Gnat(points, self.index[m]) if len(m) else None for m in members]

    @staticmethod
    def _squares(points, centre):
        gap = points - centre
        return (gap * gap).sum(-1)

    def _visit(self, queries, entry, best, found):
        """Squared distance to one entry; ties go to the lower index, by integers only."""
        squares = self._squares(queries, self.points[entry])
        better = (squares < best) | ((squares == best) & (entry < found))
        best[better], found[better] = squares[better], entry
        return squares

    def search(self, queries, best, found):
        """Improves ``best`` (squared distances) and ``found`` (entries) of each query by the points below."""
        if self.children is None:
            for entry in self.index.tolist():
                self._visit(queries, entry, best, found)
            return
        open_ = np.tile(np.isfinite(self.low[0]), (len(queries), 1))
        for i, entry in enumerate(self.splits.tolist()):
            distance = np.sqrt(self._visit(queries, entry, best, found).astype(np.float64))
            radius = np.sqrt(best.astype(np.float64))
            reach = ((distance + radius) * (1 + SLACK))[:, None]
            near = (distance * (1 - SLACK) - radius * (1 + SLACK))[:, None]
            # Only what lies strictly outside goes: an entry at the same distance may have a lower index.
            open_ &= (self.low[i] <= reach) & (self.high[i] >= near)
        for j, child in enumerate(self.children):
            rows = np.flatnonzero(open_[:, j])
            if child is not None and len(rows):
                own_best, own_found = best[rows], found[rows]
                child.search(queries[rows], own_best, own_found)
                best[rows], found[rows] = own_best, own_found


class Codebooks:
    """Entries of all parts, with one tree a part: ``entries`` is a list of parts of entries of components."""

    def __init__(self, entries):
        self.entries = entries
        self.small = all(abs(c) < SMALL for part in entries for e in part for c in e)
        self.trees = [Gnat(np.array(part, np.int64)) for part in entries] if self.small else None

    def assign(self, rows):
        """(codes, squared distances) of vectors by part. Integers of any size are compared exactly."""
        n, parts = len(rows), len(self.entries)
        codes = np.zeros((n, parts), np.int64)
        if rows.dtype != object and self.small:
            errors = np.zeros((n, parts), np.int64)
            for p, queries in enumerate(np.split(rows, parts, 1)):
                best = np.full(n, np.iinfo(np.int64).max)
                found = np.full(n, len(self.entries[p]))
                self.trees[p].search(queries, best, found)
                codes[:, p], errors[:, p] = found, best
            return codes, errors
        errors = np.zeros((n, parts), object)
        for i, row in enumerate(rows.tolist()):
            width = len(row) // parts
            for p, part in enumerate(self.entries):
                own = row[p * width : (p + 1) * width]
                best = min((sum((a - b) ** 2 for a, b in zip(own, e, strict=True)), k) for k, e in enumerate(part))
                errors[i, p], codes[i, p] = best
        return codes, errors

    def digest(self):
        text = ",".join(str(c) for part in self.entries for e in part for c in e)
        return hashlib.sha256(text.encode()).hexdigest()


def _integer(x):
    return int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)


def _kept(batch, size):
    """(rows kept, integers): vectors of ``size`` finite components; small and large ones apart, so at most two pairs."""
    vectors = batch.column("vector")
    lengths = pa.compute.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    values = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    whole = np.isfinite(values).all(1)  # a null is not a number here
    rows, values = rows[whole], values[whole]
    small = (np.abs(values) < SMALL // SCALE).all(1)
    out = [(rows[small], np.floor(values[small] * SCALE).astype(np.int64))]
    if not small.all():
        large = [[_integer(x) for x in row] for row in values[~small].tolist()]
        out.append((rows[~small], np.array(large, object).reshape(-1, size)))
    return out


def _limbs(value):
    """A whole number as signed digits to base 2**32, lowest first: long sums of digits then stay exact."""
    sign, value = (-1 if value < 0 else 1), abs(value)
    digits = []
    while value:
        digits.append(sign * (value % _LIMB))
        value //= _LIMB
    return digits or [0]


def _sums(books, size):
    """(part, entry, place, limb, value): sums of the components of a task's vectors by entry; place -1 counts them."""

    def run(batches):
        parts, width = len(books.entries), size // len(books.entries)
        most = max(map(len, books.entries))
        counts = np.zeros((parts, most), np.int64)
        sums = np.zeros((parts, most, width), object)
        for batch in batches:
            for _, rows in _kept(batch, size):
                codes, _ = books.assign(rows)
                for p, own in enumerate(np.split(rows, parts, 1)):
                    part = np.zeros((most, width), own.dtype)
                    np.add.at(part, codes[:, p], own)
                    sums[p] += part
                    counts[p] += np.bincount(codes[:, p], minlength=most)
        found = []
        for p, e in np.argwhere(counts).tolist():
            found.append((p, e, -1, 0, int(counts[p, e])))
            found += [(p, e, k, i, d) for k in range(width) for i, d in enumerate(_limbs(int(sums[p, e, k])))]
        columns = list(zip(*found, strict=True)) or [()] * 5
        types = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "entry", "place", "limb", "value"])

    return run


def _trained(books, rows):
    """Entries replaced by the floored mean of their vectors; those without vectors stay."""
    totals = {}
    for r in rows:
        key = (r["part"], r["entry"], r["place"])
        totals[key] = totals.get(key, 0) + int(r["value"]) * _LIMB ** r["limb"]
    return Codebooks(
        [
            [
                [totals[p, e, k] // totals[p, e, -1] for k in range(len(entry))] if (p, e, -1) in totals else entry
                for e, entry in enumerate(part)
            ]
            for p, part in enumerate(books.entries)
        ]
    )


def _code(books, size, schema):
    def run(batches):
        for batch in batches:
            for at, rows in _kept(batch, size):
                codes, errors = books.assign(rows)
                text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                total = [e if e < 1 << 63 else None for e in errors.sum(1).tolist()]
                take = pa.array(at)
                columns = [batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(text, pa.string()), pa.array(total, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema)

    return run


def _usable(vectors, parts):
    element = vectors.schema["embedding"].dataType.elementType
    vector = F.col("embedding").cast(T.ArrayType(T.FloatType() if isinstance(element, T.FloatType) else T.DoubleType()))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", "label", vector.alias("vector"))
    return rows, rows.where((F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite)


def encode_vectors(vectors, parts=PARTS, entries=ENTRIES, rounds=ROUNDS):
    """(vec_id, label, code, error) of every vector and the codebooks: product codes of ``floor(256 * x)``.

    Each of ``parts`` equal parts of a vector gets the nearest entry of its codebook, by squared distance, ties to the lower index. The
    codebooks start as the vectors of the ``entries`` smallest ids and are trained in ``rounds`` passes over all vectors:
    tasks send sums of their parts, as whole numbers. The nearest entry is found in a tree: the distance to a split
    point excludes every child whose range of distances lies strictly outside; what remains is compared in integers.

    Vectors that are null, or hold a null or non-finite component, are dropped, as are those whose length is not that of
    the first vector (smallest id, of a length that ``parts`` divides). With fewer vectors than entries the codebooks are shorter.
    Rows without an id get a code but start no entry. Repeated rows count as often as they are there. Components of any size are
    exact; an error beyond 64 bits is null. Other columns are ignored. An empty table gives an empty result.
    """
    rows, usable = _usable(vectors, parts)
    first = usable.where("vec_id is not null").orderBy("vec_id", "vector").limit(entries).collect()
    names = ["vec_id", "label", "code", "error"]
    schema = T.StructType([*rows.drop("vector").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema), Codebooks([[] for _ in range(parts)])
    size = len(first[0]["vector"])
    start = [[_integer(x) for x in r["vector"]] for r in first if len(r["vector"]) == size]
    width = size // parts
    books = Codebooks([[v[p * width : (p + 1) * width] for v in start] for p in range(parts)])
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(books, size), "part int, entry int, place int, limb int, value long")
        books = _trained(books, sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect())
    return rows.mapInArrow(_code(books, size, names), schema), books


def codes_with_errors(vectors, **options):
    """(vec_id, code, error, label_error, codebooks_sha256): :func:`encode_vectors` with the error summed over equal labels.

    Null labels are one label; a label with an error beyond 64 bits has none.
    """
    coded, books = encode_vectors(vectors, **options)
    coded = stage(coded, "codes")
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(F.count("*") == F.count("error"), wide.try_cast("long"))
    sums = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", fresh(coded, "of"))
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
