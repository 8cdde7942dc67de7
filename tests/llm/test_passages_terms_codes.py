"""Benchmark passages, source divergence and vector codes against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from segment_hours.llm import decontamination, source_audit, vector_codes
from segment_hours.llm.byte_words import LETTERS, byte_table, word_lists
from segment_hours.llm.fm_index import FMIndex, suffix_array
from segment_hours.llm.perfect_hash import PerfectHash

DOCS = "doc_id long, text string, lang string, source string, spans int, items string, n int, term string, slot int"
CLASH = (1, "x", 2, "y", 3)


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- index and hash ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "symbols"), [(1, 2), (2, 2), (60, 3), (900, 4), (900, 1), (700, 300)])
def test_fm_index_finds_every_occurrence(n, symbols):
    rng = np.random.default_rng(n + symbols)
    text = rng.integers(0, symbols, n) if symbols > 1 else np.ones(n, np.int64)
    symbols = max(symbols, 2)
    text[n // 2 : n // 2 * 2] = text[: n // 2]  # long repeats
    plain = text.tolist()
    assert suffix_array(text, symbols).tolist() == sorted(range(n), key=lambda i: plain[i:])
    cut = [plain[i : i + k] for i in range(0, n, 7) for k in (1, 3, 6)]
    phrases = [p for p in [*cut, [symbols - 1] * 5] if p and 0 not in p]
    if not phrases:
        return
    lengths = np.array([len(p) for p in phrases])
    rows = np.array([p + [0] * (6 - len(p)) for p in phrases])
    index = FMIndex(text, symbols)
    got = sorted(zip(*(x.tolist() for x in index.locate(*index.search(rows, lengths))), strict=True))
    assert got == sorted((k, i) for k, p in enumerate(phrases) for i in range(n) if plain[i : i + len(p)] == p)


def test_perfect_hash_numbers_keys_and_nothing_else():
    keys = [f"k{i}é".encode() for i in range(3_000)]
    index = PerfectHash(keys)
    assert sorted(index.lookup(keys).tolist()) == list(range(3_000))
    assert (index.lookup([f"z{i}".encode() for i in range(3_000)]) == -1).all()
    assert PerfectHash([]).lookup([b"a"]).tolist() == [-1]


def test_perfect_hash_lists_keys_that_share_all_bits(monkeypatch):
    monkeypatch.setattr("segment_hours.llm.perfect_hash.LEVELS", 1)
    keys = [f"k{i}".encode() for i in range(500)]
    index = PerfectHash(keys)
    assert index.rest and sorted(index.lookup([*keys, b"other"]).tolist()) == list(range(-1, 500))


def test_words_of_a_long_text_come_in_pieces():
    text = ("aB" * 30 + " ñ1x-é " + "q" * 500 + "\x00\x7f") * 40
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))
    pieces = list(word_lists(text.encode(), byte_table(LETTERS), size=100))
    assert len(pieces) > 20 and [w.decode() for p in pieces for w in p] == want


# --- benchmark passages -----------------------------------------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _plain_hits(docs, items, window=10):
    owners = defaultdict(set)
    for item, text in items:
        w = _WORD.findall(_lower(text))
        if w:
            for i in range(max(1, len(w) - window + 1)):
                owners[tuple(w[i : i + window])].add(item)
    sizes = sorted({len(k) for k in owners})
    out = Counter()
    for doc, text in docs:
        w = _WORD.findall(_lower(text))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in owners:
                    hit.update(range(i, i + k))
                    found |= owners[tuple(w[i : i + k])]
        ids = sorted(str(x) for x in found if x is not None)
        out[doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(5)
    words = [f"W{i}é" if i % 3 else f"w{i}" for i in range(40)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    first, second = some(25), some(12)
    items = [(10, " ".join(first)), (9, "-".join(second)), (100, " ".join(first)), (9, "-".join(second))]
    items += [(3, "one TWO three"), (4, None), (5, " .,; "), (None, "only without id"), (6, " ".join(some(400))), (7, "ab " * 30)]
    docs = [(1, None), (2, ""), (3, "one, two; THREE"), (4, "one two"), (5, " ".join(some(50) + first[3:14] + some(20) + first))]
    docs += [(6, " ".join(second).upper()), (7, " ".join(second[:9])), (8, "x only. without id y"), (9, "AB ab " * 40), (10, "x" * 60_000 + " one two three")]
    docs += [(11, " ".join(some(9_000) + second + some(5) + second[:10])), (None, "one two three"), (5, docs[4][1]), (None, "one two three")]
    docs += [(20 + i, " ".join(some(30) + first)) for i in range(30)]
    return docs, items


def _frames(spark, passages):
    docs, items = passages
    rows = [(d, t, "en", "s", *CLASH) for d, t in docs]
    bench = [(i, t, 1, "p") for i, t in items]
    return spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(bench, "item_id long, text string, doc_id int, phrase string")


def _counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("shard", "phrases"), [(1 << 19, 200_000), (50, 200_000), (200, 60)])
def test_passages_like_brute_force(spark, passages, monkeypatch, shard, phrases):
    monkeypatch.setattr(decontamination, "BLOCK_PHRASES", phrases)
    docs, bench = _frames(spark, passages)
    found = decontamination.find_passages(docs, bench, shard_words=shard)
    assert _counted(decontamination.digest(found)) == _plain_hits(*passages)


def test_passages_of_an_item_in_several_blocks(spark, monkeypatch):
    """Copies of one passage: no block holds more of it than its share."""
    monkeypatch.setattr(decontamination, "BLOCK_PHRASES", 50)
    items = [(i, "one two three") for i in range(300)]
    docs = [(1, "one two three four"), (2, "two three")]
    d, b = _frames(spark, (docs, items))
    assert _counted(decontamination.digest(decontamination.find_passages(d, b))) == _plain_hits(docs, items)


def test_passages_of_empty_tables(spark, passages):
    docs, bench = _frames(spark, passages)
    assert decontamination.find_passages(docs.limit(0), bench).count() == 0
    rows = decontamination.digest(decontamination.find_passages(docs, bench.limit(0)))
    assert _counted(rows) == _plain_hits(passages[0], [])


def test_passages_are_cut_from_the_text(spark):
    docs = [(1, "Keep, one TWO  three! keep\n2 one two three"), (2, None), (3, "nothing here"), (4, "One-two-three")]
    d, b = _frames(spark, (docs, [(1, "one two three")]))
    got = {r.doc_id: (r.text, r.n_words, r.n_hit) for r in decontamination.remove_passages(d, b).collect()}
    assert got == {1: ("Keep, ! keep\n2 ", 9, 6), 2: (None, 0, 0), 3: ("nothing here", 2, 0), 4: ("", 3, 3)}


# --- source divergence ------------------------------------------------------------------------------------------


def _plain_divergence(docs, least, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))) for text, lang, source in docs]
    df, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in rows:
        df[lang].update(set(words))
        groups[lang, source].update(words)
    out = Counter()
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in df[lang].items() if n >= least]
        own = {s: c for (x, s), c in groups.items() if x == lang}

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(-gap(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                for i, (value, item) in enumerate(found, 1):
                    out[lang, s, part, item, -value, i] += 1
    return out


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("ä", "B", "c", "ß1", "z") for b in ("", "a", "É", "no")]
    docs = [(None, None, None), ("", "en", "a"), ("12 34", "xx", "b"), (None, "xx", "c"), ("lone word", "yy", "b")]
    for i in range(160):
        lang, source = ("en", None, "fr")[i % 3], ("a", "b", "c", None, "é")[rng.randrange(5) if i % 2 else 0]
        docs.append((" ".join(rng.choices(words, range(1, 21), k=rng.randrange(0, 40))), lang, source))
    return docs + [docs[-1]] * 15


@pytest.mark.parametrize(("least", "shard_keys", "small"), [(10, 50_000, False), (3, 4, True)])
def test_divergence_like_brute_force(spark, spoken, monkeypatch, least, shard_keys, small):
    if small:  # many shards, blocks, flushes and blocks of terms
        monkeypatch.setattr(source_audit, "BLOCK_BYTES", 120)
        monkeypatch.setattr(source_audit, "HELD_TERMS", 10)
        monkeypatch.setattr(source_audit, "HELD_SLOTS", 10)
        monkeypatch.setattr(source_audit, "PAIR_TERMS", 3)
    rows = [(i, t, lang, s, *CLASH) for i, (t, lang, s) in enumerate(spoken)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert _counted(source_audit.divergence(docs, least=least, shard_keys=shard_keys)) == _plain_divergence(spoken, least, 10)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert source_audit.divergence(docs).count() == 0
    none = [("a b", "en", "x"), ("c", "en", "y"), (None, "fr", "x")]
    rows = [(i, t, lang, s, *CLASH) for i, (t, lang, s) in enumerate(none)]
    assert _counted(source_audit.divergence(spark.createDataFrame(rows, DOCS))) == _plain_divergence(none, 10, 10)


def test_shares_of_huge_counts_are_exact(spark):
    big = 6 * 10**18
    row = spark.createDataFrame([(big, big, 7)], "n long, total long, v long")
    got = row.select(source_audit._share(*(row[c] for c in ("n", "total", "v")))).first()[0]
    assert got == 1 + 10**9 * (big + 2) // (big + 14)


# --- vector codes -----------------------------------------------------------------------------------------------


def _plain_codes(rows, parts, entries, rounds):
    size = next((len(v) for i, v, _ in sorted(((i, v, 0) for i, v, _ in rows if i is not None and v), key=lambda r: r[0]) if len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)), None)
    if size is None:
        return Counter()
    kept = [(i, [int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256) for x in v], label) for i, v, label in rows
            if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    width = size // parts
    start = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v in start] for p in range(parts)]

    def assign():
        found = []
        for _, v, _ in kept:
            own = [v[p * width : (p + 1) * width] for p in range(parts)]
            found.append([min((sum((a - b) ** 2 for a, b in zip(o, e, strict=True)), k) for k, e in enumerate(book)) for o, book in zip(own, books, strict=True)])
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    totals = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        totals[label] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    narrow = lambda e: e if e < 2**63 else None
    out = Counter()
    for (i, _, label), f, e in zip(kept, found, errors, strict=True):
        whole = all(x < 2**63 for (_, _, other), x in zip(kept, errors, strict=True) if other == label)
        out[i, "".join(f"{k:02x}" for _, k in f), narrow(e), narrow(totals[label]) if whole else None, digest] += 1
    return out


VECTORS = "vec_id long, embedding array<double>, label int, code string, vector int, error string, of int, codebooks_sha256 int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, "e", 2, 3) for i, v, label in rows], VECTORS).repartition(3)


def _grid(seed, n, width, spread):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-spread, spread) / 256 + rng.choice((0, 0.001)) for _ in range(width)], rng.choice((None, 0, 1, 2))) for i in range(n)]


@pytest.mark.parametrize(("spread", "entries"), [(2, 64), (30, 64), (400, 9), (400, 200)])
def test_codes_like_brute_force(spark, spread, entries):
    """A narrow spread makes most distances ties and most entries equal."""
    rows = _grid(spread, 250, 32, spread)
    rows += [rows[3], rows[3], (None, rows[4][1], 1), (None, rows[5][1], None)]
    inf, nan = float("inf"), float("nan")
    rows += [(-1, None, 1), (-2, [], 1), (-3, [1.0] * 31 + [None], 1), (-4, [nan] * 32, 1), (-5, [inf] * 32, 0), (900, [1.0] * 16, 0), (901, [1.0] * 31, 0)]
    got = vector_codes.codes_with_errors(_vectors(spark, rows), entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert _counted(got) == _plain_codes(rows, 16, entries, 2)


def test_codes_of_huge_components_are_exact(spark):
    rows = _grid(1, 40, 16, 50)
    rows += [(50 + i, [(-1) ** i * 10.0 ** (i * 10 + k) for k in range(16)], i % 3) for i in range(8)]
    rows.append((60, [1.7e308] * 16, 5))
    for entries in (8, 64):  # without and with huge entries in the codebooks
        got = vector_codes.codes_with_errors(_vectors(spark, rows), entries=entries)
        assert _counted(got) == _plain_codes(rows, 16, entries, 2)


def test_codes_of_small_tables(spark):
    assert vector_codes.codes_with_errors(_vectors(spark, [])).count() == 0
    assert vector_codes.codes_with_errors(_vectors(spark, [(1, None, 1), (None, [1.0] * 16, 1)])).count() == 0
    rows = _grid(2, 3, 16, 9)
    assert _counted(vector_codes.codes_with_errors(_vectors(spark, rows))) == _plain_codes(rows, 16, 64, 2)


def test_tree_leaves_out_most_entries():
    rng = np.random.default_rng(4)
    points = (rng.normal(0, 1, (64, 4)) * 256).astype(np.int64)
    queries = (rng.normal(0, 1, (2_000, 4)) * 256).astype(np.int64)
    tree, seen = vector_codes.Gnat(points), 0
    visit = vector_codes.Gnat._visit

    def counted(self, rows, *rest):
        nonlocal seen
        seen += len(rows)
        return visit(self, rows, *rest)

    vector_codes.Gnat._visit = counted
    try:
        best, found = np.full(2_000, np.iinfo(np.int64).max), np.full(2_000, 64)
        tree.search(queries, best, found)
    finally:
        vector_codes.Gnat._visit = visit
    squares = ((queries[:, None] - points) ** 2).sum(2)
    assert (found == squares.argmin(1)).all() and (best == squares.min(1)).all()
    assert seen < 0.8 * 64 * 2_000


# --- reference SQL over the given tables ------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_benchmark_decontamination", "op12_source_divergence", "op13_vector_codes"])
def test_queries_match_reference_sql(spark, name):
    from compare import SF, difference, duck

    from segment_hours.llm.queries import ORACLES, QUERIES

    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None
