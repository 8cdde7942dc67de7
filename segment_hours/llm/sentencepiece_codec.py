"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.common import text_blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
# Characters indexed at once, units remembered between indexes, and the length from which a unit is merged on its own.
INDEX_CHARS = 600_000
REMEMBERED = 800_000
LONG_UNIT = 96

# Fixed values of the model format: piece types and the penalty of an unknown character.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)
_UNIGRAM, _BPE = 1, 2
_UNKNOWN_PENALTY = 10.0
_UNKNOWN_SURFACE = " ⁇ "


class Vocabulary:
    """Pieces of a model file, in the form that the tasks need (a few MB, fixed by the file)."""

    def __init__(self, pieces, scores, kinds, bpe, dummy_prefix=True, squeeze=False, byte_fallback=True):
        self.pieces, self.kinds, self.bpe = pieces, kinds, bpe
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.scores = np.array(scores, np.float32)
        self.unknown = kinds.index(_UNKNOWN)
        self.bytes = [0] * 256 if byte_fallback else None
        self.surface = []
        for i, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == _BYTE:
                value = int(piece[1:-1], 16)
                self.surface.append(bytes([value]))
                if byte_fallback:
                    self.bytes[value] = i
            elif kind == _CONTROL:
                self.surface.append(b"")
            else:
                self.surface.append(_UNKNOWN_SURFACE.encode() if kind == _UNKNOWN else piece.replace(SPACE_MARK, " ").encode())
        usable = [i for i, k in enumerate(kinds) if k == _NORMAL]
        usable.sort(key=lambda i: pieces[i])
        self.sorted = np.array(usable, np.int32)
        self.longest = max(len(pieces[i]) for i in usable)
        self.alphabet = np.array(sorted({ord(c) for i in usable for c in pieces[i]}), np.uint32)
        self.lengths = np.array([len(p) for p in pieces], np.int32)
        padded = np.zeros((len(usable), self.longest), np.int32)
        for row, i in enumerate(usable):
            padded[row, : len(pieces[i])] = self.letters(pieces[i])
        self.padded = padded
        # Rank of a piece among merges: higher scores first.
        self.rank = np.empty(len(pieces), np.int64)
        self.rank[np.argsort(-self.scores, kind="stable")] = np.arange(len(pieces))
        known = "".join(chr(c) for c in self.alphabet if chr(c) != SPACE_MARK)
        inner = any(SPACE_MARK in pieces[i].lstrip(SPACE_MARK) for i in usable)
        # No piece reaches over an unknown character, nor (usually) over the start of a word.
        mark = SPACE_MARK if SPACE_MARK in "".join(pieces[i] for i in usable) else ""
        inside = re.escape(known) if known else SPACE_MARK
        self.unit = re.compile(f"[{inside}{mark}]+|." if inner else f"{SPACE_MARK}*[{inside}]+|{SPACE_MARK}+|.", re.DOTALL)
        # Merges of equal score and unequal pieces keep their order by position only.
        if bpe and len(np.unique(self.scores[usable])) != len(usable):
            _, self.rank = np.unique(-self.scores, return_inverse=True)

    def letters(self, text):
        """Positions of the characters in the alphabet, from 1; 0 for others."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, codes)
        found = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes
        return np.where(found, at + 1, 0).astype(np.int32)

    def normalised(self, text):
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE_MARK if self.dummy_prefix else "") + text.replace(" ", SPACE_MARK)

    def character(self, c):
        """Ids of a character that is no piece."""
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]


def load(path=MODEL):
    """Vocabulary of a model file (unigram or BPE, identity normalisation, no user-defined pieces)."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trainer, rules = model.trainer_spec, model.normalizer_spec
    kinds = [p.type for p in model.pieces]
    if rules.precompiled_charsmap or _USER in kinds or _UNUSED in kinds or trainer.treat_whitespace_as_suffix:
        raise ValueError("normalisation tables, user-defined pieces and suffix marks are not supported")
    if trainer.model_type not in (_UNIGRAM, _BPE):
        raise ValueError("only unigram and BPE models are supported")
    return Vocabulary(
        [p.piece for p in model.pieces],
        [p.score for p in model.pieces],
        kinds,
        trainer.model_type == _BPE,
        rules.add_dummy_prefix,
        rules.remove_extra_whitespaces,
        trainer.byte_fallback,
    )


def suffix_array(letters, depth):
    """Positions sorted by the ``depth`` letters that follow, by doubling from four letters."""
    n = len(letters)
    key = np.zeros(n, np.int64)
    for i in range(4):
        key <<= 16
        key[: n - i] += letters[i:]
    order = np.argsort(key)
    width = 4
    while True:
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], (ranked[1:] != ranked[:-1]).astype(np.int64)))) + 1
        if width >= depth or rank[order[-1]] == n:
            return order
        key = rank << 32
        key[: n - width] += rank[width:]
        order = np.argsort(key)
        width *= 2


def occurrences(letters, order, padded, lengths):
    """(piece row, first, last): ranges of the suffix array that start with each piece, by binary search letter by letter."""
    rows = np.arange(len(padded))
    first, last = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
    n = len(letters)
    done = []
    for depth in range(padded.shape[1]):
        wanted = padded[rows, depth]
        bounds = []
        for limit in (wanted, wanted + 1):
            low, high = first.copy(), last.copy()
            while (low < high).any():
                middle = (low + high) >> 1
                at = order[np.minimum(middle, n - 1)] + depth
                value = np.where(at < n, letters[np.minimum(at, n - 1)], 0)
                less = (value < limit) & (low < high)
                low = np.where(less, middle + 1, low)
                high = np.where(less, high, np.minimum(high, middle))
            bounds.append(low)
        first, last = bounds
        ended = (lengths[rows] == depth + 1) & (first < last)
        done.append((rows[ended], first[ended], last[ended]))
        alive = (first < last) & (lengths[rows] > depth + 1)
        rows, first, last = rows[alive], first[alive], last[alive]
        if not len(rows):
            break
    return [np.concatenate(parts) for parts in zip(*done, strict=True)]


def edges(letters, vocabulary):
    """Matrix [position, length] of piece ids, -1 where no piece of that length starts: edges sorted by position."""
    table = np.full((len(letters) + 1, vocabulary.longest + 1), -1, np.int32)
    if len(letters):
        order = suffix_array(letters, vocabulary.longest)
        ids = vocabulary.sorted
        rows, first, last = occurrences(letters, order, vocabulary.padded, vocabulary.lengths[ids])
        counts = last - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        piece = np.repeat(ids[rows], counts)
        table[order[at], vocabulary.lengths[piece]] = piece
    return table


def _merge_all(table, starts, sizes, vocabulary):
    """Symbols (unit, start, length) after byte-pair merges: in every round each unit merges its best, leftmost edge."""
    unit = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
    start = (np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)).astype(np.int32)
    length = np.ones(len(start), np.int32)
    none = np.int32(2**31 - 1)
    rank = np.append(vocabulary.rank, none).astype(np.int32)  # of piece -1: none
    finished = []
    while len(unit):
        both = length[:-1] + length[1:]
        same = unit[:-1] == unit[1:]
        both[~same | (both > vocabulary.longest)] = 0  # no piece has length 0
        order = np.append(rank[table[start[:-1], both]], none)
        heads = np.concatenate(([0], np.flatnonzero(~same) + 1))
        counts = np.diff(np.append(heads, len(unit)))
        best = np.minimum.reduceat(order, heads)
        active = np.repeat(best < none, counts)
        finished.append((unit[~active], start[~active], length[~active]))
        # The first symbol of each unit that has the best rank takes in the next one.
        hit = np.flatnonzero((order == np.repeat(best, counts)) & active)
        hit = hit[np.concatenate(([True], unit[hit[1:]] != unit[hit[:-1]]))] if len(hit) else hit
        length[hit] += length[hit + 1]
        keep = active
        keep[hit + 1] = False
        unit, start, length = unit[keep], start[keep], length[keep]
    return [np.concatenate(parts) for parts in zip(*finished, strict=True)] if finished else [unit, start, length]


def _merge_long(table, begin, size, vocabulary):
    """The same merges for one long unit, with a queue of edges by rank and position."""
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    length = [1] * size
    queue = []

    def offer(i):
        j = after[i]
        if j < size and length[i] + length[j] <= vocabulary.longest:
            piece = table[begin + i, length[i] + length[j]]
            if piece >= 0:
                heapq.heappush(queue, (int(vocabulary.rank[piece]), i, length[i], length[j]))

    for i in range(size):
        offer(i)
    while queue:
        _, i, own, other = heapq.heappop(queue)
        j = after[i]
        if length[i] != own or j >= size or length[j] != other:
            continue
        length[i] += other
        length[j] = 0
        after[i] = after[j]
        if after[j] < size:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    at = [i for i in range(size) if length[i]]
    return [begin + i for i in at], [length[i] for i in at]


def _shortest_all(table, starts, sizes, vocabulary):
    """Symbols of the best segmentation under unigram scores: edges relax in the order of their positions."""
    n = int(starts[-1] + sizes[-1]) if len(starts) else 0
    best = np.full(n + 1, -np.inf, np.float32)
    came = np.zeros(n + 1, np.int64)
    usable = vocabulary.scores[vocabulary.sorted]
    unknown = np.float32((usable.min() if len(usable) else 0) - _UNKNOWN_PENALTY)
    # A unit ends where the next one starts, so ends are kept apart by one separator.
    best[starts] = 0
    for j in range(int(sizes.max()) if len(sizes) else 0):
        at = starts[sizes > j] + j
        room = sizes[sizes > j] - j
        for width in range(1, vocabulary.longest + 1):
            piece = table[at, width]
            ok = (piece >= 0) & (room >= width)
            gain = np.where(ok, vocabulary.scores[piece], unknown)
            if width == 1:
                ok = np.ones(len(at), bool)
            total = best[at] + gain
            better = ok & (total > best[at + np.minimum(width, room)])
            best[at[better] + width] = total[better]
            came[at[better] + width] = width
    unit, position, length = [], [], []
    for u, (s, size) in enumerate(zip(starts, sizes, strict=True)):
        end, own = int(s + size), []
        while end > s:
            own.append((end - int(came[end]), int(came[end])))
            end -= int(came[end])
        for p, w in reversed(own):
            unit.append(u)
            position.append(p)
            length.append(w)
    return np.array(unit, np.int64), np.array(position, np.int64), np.array(length, np.int64)


def segment(units, vocabulary):
    """Token ids of distinct units (strings): one suffix array over all of them."""
    text = "\0".join(units) + "\0"
    letters = vocabulary.letters(text)
    table = edges(letters, vocabulary)
    sizes = np.array([len(u) for u in units], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
    if vocabulary.bpe:
        short = np.flatnonzero(sizes <= LONG_UNIT)
        unit, start, length = _merge_all(table, starts[short], sizes[short], vocabulary)
        unit = short[unit]
        for u in np.flatnonzero(sizes > LONG_UNIT):
            more, widths = _merge_long(table, int(starts[u]), int(sizes[u]), vocabulary)
            unit = np.append(unit, np.full(len(more), u))
            start, length = np.append(start, more), np.append(length, widths)
    else:
        unit, start, length = _shortest_all(table, starts, sizes, vocabulary)
    order = np.argsort(start, kind="stable")
    unit, start, length = unit[order], start[order], length[order]
    ids = table[start, length]
    missing = np.flatnonzero(ids < 0)
    counts = np.bincount(unit, minlength=len(units))
    if len(missing):
        parts = [[i] for i in ids.tolist()]
        for m in missing:
            parts[m] = vocabulary.character(text[start[m] : start[m] + 1])
        sizes_of = np.array([len(p) for p in parts], np.int64)
        counts = np.bincount(unit, weights=sizes_of, minlength=len(units)).astype(np.int64)
        ids = np.array([i for p in parts for i in p], np.int32)
    return ids.astype(np.int32), counts


class Encoder:
    """Encodes texts; units met before are looked up, new ones are indexed together."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self):
        self.known = {}
        self.ids = [np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64)]
        self.total = 0

    def encode(self, texts):
        """(ids of all texts one after the other, number of ids per text)."""
        if len(self.known) > REMEMBERED:
            self._forget()
        units = [self.vocabulary.unit.findall(self.vocabulary.normalised(t)) for t in texts]
        known = self.known
        new = list(set(chain.from_iterable(units)).difference(known))
        first = 0
        while first < len(new):
            last, chars = first, 0
            while last < len(new) and (last == first or chars + len(new[last]) < INDEX_CHARS):
                chars += len(new[last]) + 1
                last += 1
            ids, counts = segment(new[first:last], self.vocabulary)
            self.known.update(zip(new[first:last], range(len(known), len(known) + last - first), strict=True))
            self.ids.append(ids)
            self.ends.append(self.total + np.cumsum(counts))
            self.total += len(ids)
            first = last
        self.ids, self.ends = [np.concatenate(self.ids)], [np.concatenate(self.ends)]
        ids, ends = self.ids[0], self.ends[0]
        rows = np.fromiter(map(known.__getitem__, chain.from_iterable(units)), np.int64, sum(map(len, units)))
        counts = ends[rows + 1] - ends[rows]
        upto = np.concatenate(([0], np.cumsum(counts)))
        at = np.repeat(ends[rows] - upto[:-1], counts) + np.arange(upto[-1])
        out = ids[at]
        per_text = upto[np.cumsum([0, *map(len, units)])]
        if self.vocabulary.bytes is None:
            return self._merge_unknown(out, per_text)
        return out, np.diff(per_text)

    def _merge_unknown(self, ids, ends):
        """Neighbouring unknown characters of a text are one token."""
        own = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        unknown = ids == self.vocabulary.unknown
        again = np.zeros(len(ids), bool)
        again[1:] = unknown[1:] & unknown[:-1] & (own[1:] == own[:-1])
        return ids[~again], np.bincount(own[~again], minlength=len(ends) - 1)


def decode(ids, vocabulary):
    """Text of token ids: pieces and bytes one after the other, marks as spaces, without the leading one that encoding adds."""
    data = b"".join([vocabulary.surface[i] for i in ids])
    if vocabulary.dummy_prefix and data[:1] == b" ":
        data = data[1:]
    return data.decode("utf-8", "replace")


def _codec(shared):
    def run(batches):
        vocabulary = shared.value
        # The broadcast value lives as long as the worker: later tasks know the units of earlier ones.
        encoder = vocabulary.__dict__.setdefault("encoder", Encoder(vocabulary))
        for part in text_blocks(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids, counts = encoder.encode(texts)
            ends = np.concatenate(([0], np.cumsum(counts)))
            back = [decode(ids[a:b].tolist(), vocabulary) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            plain = [(re.sub(" +", " ", t).strip(" ") if vocabulary.squeeze else t).replace(SPACE_MARK, " ") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([a == b for a, b in zip(back, plain, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids", "round_trip"],
            )

    return run


def encode_documents(docs, vocabulary=None):
    """(doc_id, n_tokens, ids, round_trip) per document: token ids of the whole text, and whether they decode to it.

    Texts are cut into units that no piece crosses. The distinct new units of a batch are laid end to end and
    indexed by a suffix array; every piece is found in it by binary search; its occurrences are the edges between
    positions, and the edges are relaxed: by score and position for BPE models, by best path for unigram models.
    Ids are those of the public encoder of the format.

    Null text counts as empty and has no ids. Characters that are no piece become bytes, or the unknown id where the
    model has no bytes. A text that holds the mark U+2581 itself decodes with a space in its place. Repeated rows give equal
    rows. Long texts and long words are encoded whole. Only the vocabulary is broadcast, whose size the model file fixes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_codec(shared), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
