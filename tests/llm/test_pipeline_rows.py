"""The whole pipeline over planted rows, each stage against a plain version on its own input; reference SQL of op1, op6, op9."""

from __future__ import annotations

import random
from collections import Counter

import plain
import pytest
from compare import SF, difference, duck
from pyspark.sql import functions as F

from segment_hours.llm import language_id, mixing, sentencepiece_codec


def _varied(text, seed, every):
    """``text`` with each ``every``-th word replaced."""
    words = text.split()
    rng = random.Random(seed)
    return " ".join(f"neu{rng.randrange(10**6)}" if i % every == every - 1 else w for i, w in enumerate(words))


def _planted(given):
    """Rows to add to ``given``: copies, near copies, texts below the threshold, no text, no letters, no language, no source."""
    long = [r for r in given if r["text"] and 200 < len(r["text"].split()) < 2_000 and r["lang"] and r["source"]][:8]
    rows = []
    for i, r in enumerate(long):
        spaced = r["text"].replace(" ", " \t", 3)
        own = [r["text"], spaced, _varied(r["text"], i, 150), _varied(r["text"], i, 7)]
        rows += [(100_000 + 10 * i + k, t, r["lang"], r["source"], len(t)) for k, t in enumerate(own)]
    text = long[0]["text"]
    rows += [(200_000, None, "en", "web", 0), (200_001, "", "en", "web", 0), (200_002, "123 456 !?", "en", "web", 10), (200_003, text, None, None, 0)]
    rows += [(200_004, text + " and", None, None, 0)] * 2
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("planted"))
    given = spark.read.parquet(f"{SF}/documents.parquet")
    assert given.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = spark.createDataFrame(_planted(given.collect()), given.schema)
    given.union(rows).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def stages(spark, tables):
    """What went into each stage and what came out."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tables}/{name}"
        stage(spark, docs, tables).write.parquet(path)
        out = spark.read.parquet(path)
        steps[name] = (docs, out)
        docs = out
    return steps


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_language_stage_keeps_what_is_identified(stages):
    docs, out = stages["language_id"]
    answers = {(r["doc_id"]): r for r in language_id.identify(docs).collect()}
    good = {d for d, r in answers.items() if r["lang_pred"] != "und" and r["score"] >= language_id.LEAST_SCORE}
    assert _rows(out) == Counter({r: n for r, n in _rows(docs).items() if r[0] in good})
    gone = set(answers) - good
    assert {200_000, 200_001, 200_002} <= gone and 200_003 in good
    # Clean prose stays: what goes has hardly any words.
    assert all(len((r["text"] or "").split()) < 30 for r in docs.collect() if r["doc_id"] in gone)


def test_exact_stage_keeps_the_first_of_equal_texts(stages):
    docs, out = stages["exact_dedup"]
    want = plain.op3([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, w in want.items() if w[2])
    assert set(_rows(out)) <= set(_rows(docs))


def test_near_stage_keeps_one_document_of_each_group(stages):
    docs, out = stages["near_dedup"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {}
    for d, text in texts.items():
        words = plain.W.findall(plain.low(text or ""))
        sets[d] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in sets:
        for e in sets:
            both = len(sets[d] & sets[e]) if d < e else 0
            if both and 100 * both >= 80 * (len(sets[d]) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d in sets if find(d) == d)
    planted = {100_000 + 10 * i + k for i in range(8) for k in (2, 3)} & set(texts)
    assert planted and all(find(d) != d for d in planted if d % 10 == 2) and all(find(d) == d for d in planted if d % 10 == 3)


def test_mixing_stage_repeats_documents_as_the_mix_takes_them(stages, spark, tables):
    docs, out = stages["mixing"]
    taken = mixing.mix(docs, spark.read.parquet(f"{tables}/labels.parquet")).collect()
    times = {r["doc_id"]: 1 if r["size"] == 0 else r["taken"] // r["size"] for r in taken}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({d: n for d, n in times.items() if n})
    assert set(_rows(out)) <= set(_rows(docs)) and max(times.values()) <= 3
    for source in {r["source"] for r in taken}:
        own = [r for r in taken if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1


def test_token_stage_equals_the_public_encoder(stages, spark, tables):
    import corpus_pipeline

    sentencepiece = pytest.importorskip("sentencepiece")
    public = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    docs, out = stages["sentencepiece"]
    want = Counter((r["doc_id"], tuple(public.encode(r["text"] or ""))) for r in docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in out.collect()) == want
    ran = corpus_pipeline.run(spark, tables)
    digest = [F.xxhash64("doc_id", "ids").alias("h")]
    assert _rows(ran.select(*digest)) == _rows(out.select(*digest))


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op6_minhash_dedup", "op9_embedding_dedup"])
def test_queries_match_reference_sql(spark, name):
    from segment_hours.llm.queries import ORACLES, QUERIES

    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_reference_sql_of_vectors_sees_links(spark, tmp_path):
    """The given vectors have no links; these have: near vectors, copies, other labels, zero, null and non-finite ones."""
    from segment_hours.llm.queries import ORACLES, QUERIES

    rng = random.Random(4)
    rows = []
    for i in range(60):
        base = [rng.gauss(0, 1) for _ in range(64)]
        for k in range(rng.choice((1, 2, 5))):
            near = [x + rng.gauss(0, 0.02 * k) for x in base]
            rows.append((len(rows), near, 1 if k == 4 else i % 3))
    nan = [float("nan")] * 64
    rows += [(900, [0.0] * 64, 1), (901, None, 1), (902, nan, 1), (903, rows[0][1], None), (904, rows[0][1], rows[0][2]), (905, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.coalesce(1).write.parquet(str(tmp_path / "parts"))
    file = next((tmp_path / "parts").glob("*.parquet"))
    (tmp_path / "embeddings.parquet").write_bytes(file.read_bytes())
    made = QUERIES["op9_embedding_dedup"](spark, str(tmp_path))
    assert made.where("n_links > 0").count() > 40
    assert difference(made, duck(tmp_path), ORACLES["op9_embedding_dedup"]) is None
