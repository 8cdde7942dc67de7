"""Repeated rows, null ids and clashing names: every operator gives what it gives for single rows, at about their cost."""

from __future__ import annotations

import math
import random

import plain
import pytest
from pyspark.sql import functions as F

from segment_hours.llm import embedding_dedup, language_id, minhash_dedup, mixing, pii, secret_scan, sentencepiece_codec, sharding, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, rid long, key string, n int, spans int, w int"
CLASH = (7, "k", 1, 2, 3)
COPIES = 1_000


def _text(seed, n, words=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage = _text(1, 70)
    base = [(10, passage + " " + _text(2, 200)), (20, _text(3, 100) + " " + passage), (30, _text(3, 100) + " " + passage + " " + _text(9, 4)), (40, None), (50, ""), (60, "one")]
    return base + [(20, base[1][1])] * COPIES + [(40, None)] * 3


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Repeated rows, and rows without an id."""
    every = rows + [(None, rows[0][1])] * 2 + [(None, None)]
    return spark.createDataFrame([(i, t, "en", "s", *CLASH) for i, t in every], SCHEMA).repartition(3)


def _named(df):
    """Rows by id, each id once; copies must agree."""
    found = {}
    for r in df.where("doc_id is not null").collect():
        assert found.setdefault(r["doc_id"], tuple(r)) == tuple(r)
    return {i: r[1:] for i, r in found.items()}


def test_substring_dedup_of_copies(docs, rows):
    once = list(dict(rows).items())
    got = substring_dedup.remove_repeats(docs)
    assert got.count() == docs.count()
    assert _named(got) == plain.op1(once)
    spans = substring_dedup.repeated_spans(docs)
    assert spans.select(F.max(F.size("spans"))).first()[0] < 100  # not one a copy
    null = got.where("doc_id is null and n_words > 0").collect()
    assert len(null) == 2 and all(r["n_removed"] == 0 for r in null)


def test_minhash_dedup_of_copies(docs, rows):
    want = plain.op6(list(dict(rows).items()))
    got = minhash_dedup.near_groups(docs, width=2).where("doc_id is not null").select("doc_id", "n_shingles", "component_id").distinct().collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["doc_id"] == r["component_id"]) for r in got} == want
    kept = minhash_dedup.drop_near_copies(docs.where("doc_id is not null"), width=2)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    stay = [i for i, (n, _, k) in want.items() if k and n]
    assert sorted(i for i in ids if i not in (40, 50)) == sorted(stay)  # one row each
    assert ids.count(40) == 4 and ids.count(50) == 1  # nothing is alike to an empty text


def test_secrets_of_copies(spark, docs, tmp_path):
    text = "pa\u017f\u017fword = abcdefghijklmnop to\u212aen = abcdefghijklmnop passWORD: 0123456789abcdef0 "
    many = spark.createDataFrame([(1, text, "en", "s", *CLASH)] * COPIES + [(2, text, "en", "s", *CLASH), (None, text, "en", "s", *CLASH)], SCHEMA).repartition(4)
    ledger = f"{tmp_path}/ledger"
    found = secret_scan.digest(secret_scan.scan(many.unionByName(docs), ledger))
    assert secret_scan.read_ledger(spark, ledger).groupBy("blob").count().where("count > 1").isEmpty()
    assert found.count() == COPIES + 2 + docs.count()
    got = {tuple(r)[1:5] for r in found.where("doc_id in (1, 2) or (doc_id is null and n_hex > 0)").collect()}
    assert got == {plain.op10(text)} and plain.op10(text)[0] == 1  # letters are ASCII: neither the long s nor the Kelvin sign
    before = secret_scan.read_ledger(spark, ledger).count()
    secret_scan.scan_new(many.unionByName(docs), ledger)  # nothing new
    assert secret_scan.read_ledger(spark, ledger).count() == before


def test_language_sample_counts_different_texts(spark):
    texts = [(f"text number {i} of english words", "en") for i in range(600)] + [("the same words again", "en")] * 20_000
    texts += [("nur ein deutscher Satz", "de"), (None, "de"), (None, "de")]
    known = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    known = known.withColumn("r", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    kept = language_id.sample_of(known, 2_000).groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("text").alias("d")).collect()
    assert {r["lang"]: (r["n"], r["d"]) for r in kept} == {"en": (601, 601), "de": (2, 1)}
    few = language_id.sample_of(known, 50).where("lang = 'en'")
    assert few.count() == 50 and few.agg(F.max("r")).first()[0] <= sorted(r["r"] for r in known.where("lang = 'en'").select("r").distinct().collect())[49]


def test_language_of_copies_and_clashing_names(spark, docs):
    langs = [(i, f"{t} {i}", lang, "s", *CLASH) for i, (t, lang) in enumerate([("the and of with", "en"), ("der die das und", "de")] * 40)]
    many = spark.createDataFrame(langs + [langs[0]] * COPIES, SCHEMA).unionByName(docs.where("text is null"))
    got = language_id.identify(many)
    assert got.count() == many.count() and got.where("doc_id is null").select("lang_pred").first()[0] == "und"
    named = {r["doc_id"]: r["lang_pred"] for r in got.where("score > 0").collect()}
    assert {named[i] for i in range(0, 80, 2)} == {"en"} and {named[i] for i in range(1, 80, 2)} == {"de"}
    assert language_id.keep_identified(many).columns == many.columns


def _plain_mix(rows, seed_keys):
    """Documents taken, from the keys: whole epochs, then by key until the budget, the one on the border if half of it fits."""
    taken = {}
    sizes, targets = {}, {}
    for _, source, size, _, target in rows:
        sizes[source] = sizes.get(source, 0) + size
        targets[source] = target
    for source, total in sizes.items():
        epochs = int(targets[source] // total) if total else 0
        budget, before = targets[source] - epochs * total, 0
        own = sorted((seed_keys[d], d, size) for d, s, size, _, _ in rows if s == source)
        for _, d, size in own:
            extra = before + size / 2 <= budget
            taken[d] = min(epochs + extra, 3) * size
            before += size
    return taken


@pytest.mark.parametrize("slice_rows", [50_000, 7])
def test_selection_of_the_mix(spark, slice_rows):
    rng = random.Random(1)
    rows = [(i, _text(i, rng.randrange(1, 40)), "en", ("a", "b", None, "d")[min(3, int(rng.expovariate(1)))], *CLASH) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 300, 3)] + [(None, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, rows_per_slice=slice_rows).collect()
    u = docs.select("doc_id", ((F.pmod(F.xxhash64(F.xxhash64("doc_id", "text", "source"), F.lit(20)), F.lit(1 << 52)) + 0.5) / float(1 << 52)).alias("u"))
    quality = {i: (2.0 if i % 2 else 0.5) for i in range(0, 300, 3)}
    keys = {r["doc_id"]: -math.log(r["u"]) / quality.get(r["doc_id"], 1.0) for r in u.collect()}
    want = _plain_mix([(r["doc_id"], r["source"], r["size"], r["source_size"], r["target"]) for r in got], keys)
    assert {r["doc_id"]: r["taken"] for r in got} == want
    assert mixing.mix(docs.limit(0), labels).count() == 0


def test_slices_of_the_mix_are_even(spark, monkeypatch):
    """Weights of 0.5 and 2 give slices of one size, as weight 1 does."""
    docs = spark.range(40_000).selectExpr("id as doc_id", "'a b c' as text", "'s' as source")
    labels = docs.selectExpr("doc_id", "if(doc_id % 4 = 0, 1, 0) as quality")
    seen, floor = [], mixing.F.floor

    def kept(column):
        seen.append(column)
        return floor(column)

    monkeypatch.setattr(mixing.F, "floor", kept)
    found = mixing.mix(docs, labels, rows_per_slice=400)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.undo()
    assert "EXP" in text and seen
    keyed = docs.join(labels, "doc_id").withColumn("w", F.when(F.col("quality") == 1, 2.0).otherwise(0.5))
    u = (F.pmod(F.xxhash64(F.xxhash64("doc_id", "text", "source"), F.lit(20)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = keyed.select((-F.log(u) / F.col("w")).alias("key")).selectExpr("key", "10000 as n_2", "0 as n_1", "30000 as n_0", "40000 as n_rows")
    slices = keyed.groupBy(floor(seen[0])).count().select("count").collect()
    sizes = sorted(r[0] for r in slices)
    assert len(sizes) == 100 and sizes[-1] <= 2 * sizes[50]


def test_shards_tokens_and_pii_of_copies(docs):
    shards = sharding.balanced_shards(docs)
    assert shards.count() == docs.count() and shards.select("slot", "shard").distinct().count() == docs.count()
    tokens = sentencepiece_codec.encode_documents(docs)
    assert tokens.count() == docs.count() and tokens.where("doc_id = 20").drop("doc_id").distinct().count() == 1
    found = pii.find(docs)
    assert found.count() == docs.count() and found.where("doc_id = 20").distinct().count() == 1


def test_bytes_of_shards_are_balanced(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, "x" * rng.randrange(0, 300), "en", "s", *CLASH) for i in range(4_000)], SCHEMA)
    sizes = [r["b"] for r in sharding.balanced_shards(docs).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 2 * 301


def test_vectors_of_copies_and_other_lengths(spark):
    rng = random.Random(6)
    v = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(4)]
    rows = [(1, v[0], 1), (2, [x * 1.001 for x in v[0]], 1), (3, v[1], 1), (4, v[0][:8], 1), (None, v[2], 1)] + [(5, v[3], 2)] * 300
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid int, vector string").repartition(3)
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (None, 0, None), (5, 299, 5)}
