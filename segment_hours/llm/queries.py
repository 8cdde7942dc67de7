"""Queries of the numbered operators over the given tables, and reference SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from segment_hours.llm import (
    decontamination,
    embedding_dedup,
    exact_dedup,
    language_id,
    minhash_dedup,
    mixing,
    pii,
    secret_scan,
    sentencepiece_codec,
    sharding,
    source_audit,
    substring_dedup,
    vector_codes,
)
from segment_hours.llm.common import table
from segment_hours.session import scratch_path


def op1_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents"))


def op2_pii(spark, sf):
    return pii.find(table(spark, sf, "documents"))


def op3_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


def op4_sentencepiece(spark, sf):
    return sentencepiece_codec.encode_documents(table(spark, sf, "documents"))


def op5_language_id(spark, sf):
    return language_id.identify(table(spark, sf, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op6_minhash_dedup(spark, sf):
    rows = minhash_dedup.near_groups(table(spark, sf, "documents"), width=2)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op7_mixing(spark, sf):
    rows = mixing.mix(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op8_sharding(spark, sf):
    return sharding.balanced_shards(table(spark, sf, "documents"))


def op9_embedding_dedup(spark, sf):
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


def op10_secret_scan(spark, sf):
    """Two releases of the rules over one ledger: the second scans each blob only for the rules that the first did not have."""
    docs, ledger = table(spark, sf, "documents"), scratch_path(spark, "ledger")
    secret_scan.scan_new(docs, ledger, secret_scan.BASE)
    return secret_scan.digest(secret_scan.scan(docs, ledger))


def op11_benchmark_decontamination(spark, sf):
    found = decontamination.find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return decontamination.digest(found)


def op12_source_divergence(spark, sf):
    return source_audit.divergence(table(spark, sf, "documents"))


def op13_vector_codes(spark, sf):
    return vector_codes.codes_with_errors(table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_pii,
        op3_exact_dedup,
        op4_sentencepiece,
        op5_language_id,
        op6_minhash_dedup,
        op7_mixing,
        op8_sharding,
        op9_embedding_dedup,
        op10_secret_scan,
        op11_benchmark_decontamination,
        op12_source_divergence,
        op13_vector_codes,
    )
}



def _vector_codes_sql(parts=16, entries=64, rounds=2):
    """SQL of the product codes: nearest entries by comparing each part with all entries of its codebook."""
    steps = [
        """v AS (SELECT vec_id, label, len(embedding) // 16 AS width, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS c
              FROM embeddings WHERE embedding IS NOT NULL AND list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding))""",
        f"""c AS (SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS place, c[i] AS x
              FROM (SELECT vec_id, width, c, unnest(range(1, {parts} * width + 1)) AS i FROM v))""",
        f"""b0 AS (SELECT part, entry, place, x AS e FROM c JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
              FROM v QUALIFY entry < {entries}) USING (vec_id))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS (SELECT vec_id, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
              FROM (SELECT vec_id, part, entry, sum((x - e) * (x - e))::BIGINT AS d FROM c JOIN b{i} USING (part, place) GROUP BY ALL)
              GROUP BY vec_id, part)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM c JOIN a{i} USING (vec_id, part) GROUP BY ALL),
              b{i + 1} AS (SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, e) AS e
              FROM b{i} LEFT JOIN m{i} USING (part, entry, place))"""
            )
    return f"""WITH {", ".join(steps)},
        r AS (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
              FROM a{rounds} GROUP BY vec_id),
        k AS (SELECT sha256(string_agg(e::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM r JOIN v USING (vec_id) CROSS JOIN k"""


ORACLES = {
    # Fixed values of the contract: words without white space.
    "op1_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             g AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS pos,
                          unnest(list_transform(range(1, len(w) - 48), lambda x: array_to_string(w[x : x + 49], ' '))) AS phrase
                   FROM d WHERE len(w) >= 50),
             f AS (SELECT phrase, min(doc_id) AS least FROM g GROUP BY phrase),
             c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM g JOIN f USING (phrase) WHERE least < doc_id),
             t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
             k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM t ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    # Fixed values of the contract: words without white space, shingles of two, 80 in 100.
    "op6_minhash_dedup": r"""
        WITH RECURSIVE
             d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w
                          ELSE list_transform(range(1, len(w)), lambda x: w[x] || ' ' || w[x + 1]) END)) AS own FROM d),
             c AS (SELECT own, min(doc_id) AS class, len(own) AS n FROM s WHERE len(own) > 0 GROUP BY own),
             e AS (SELECT class, n, unnest(own) AS shingle FROM c),
             l AS (SELECT a.class AS a, b.class AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.class < b.class
                   AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
                   GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
             m AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             r AS (SELECT class AS a, class AS b FROM c UNION SELECT r.a, m.b FROM r JOIN m ON r.b = m.a),
             g AS (SELECT a AS class, min(b) AS least FROM r GROUP BY a)
        SELECT s.doc_id, len(s.own)::BIGINT AS n_shingles, coalesce(least, s.doc_id) AS component_id, coalesce(least, s.doc_id) = s.doc_id AS kept
        FROM s LEFT JOIN c ON s.own = c.own LEFT JOIN g USING (class)""",
    # Fixed values of the contract: cosine 0.93 within a label.
    "op9_embedding_dedup": """
        WITH RECURSIVE
             v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(list_filter(embedding, lambda c: isfinite(c))) = len(embedding)
                     AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
             m AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                   ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
             n AS (SELECT a AS vec_id, count(*) AS n_links FROM m GROUP BY a),
             r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, m.b FROM r JOIN m ON r.b = m.a),
             g AS (SELECT a AS vec_id, min(b) AS least FROM r GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN g USING (vec_id)""",
    # Fixed values of the contract: runs of white space.
    "op3_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY t)""",
    # Fixed values of the contract: words of letters and digits.
    "op11_benchmark_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             i AS (SELECT item_id, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                          lambda x: array_to_string(w[x : x + least(len(w), 10) - 1], ' '))) AS phrase FROM b WHERE len(w) > 0),
             p AS (SELECT DISTINCT phrase, k FROM i),
             g AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS pos,
                          unnest(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x : x + k - 1], ' '))) AS phrase
                   FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k),
             h AS (SELECT doc_id, pos, k, phrase FROM g JOIN p USING (phrase, k)),
             c AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS word FROM h) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h JOIN i USING (phrase, k)) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    # Fixed values of the contract: words of letters.
    "op12_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
             o AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
             k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
             v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
             g AS (SELECT DISTINCT lang, source FROM d),
             n AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
             s AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source),
             p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
                          1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(total, 0)::HUGEINT + 2 * v) AS p
                   FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN n USING (lang, source, term)),
             q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
                   FROM n JOIN v USING (lang) GROUP BY lang, term, v),
             pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                              coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y USING (lang, term)
                                        WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
                       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
             terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
                       FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
             ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
                        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_vector_codes": _vector_codes_sql(),
}
