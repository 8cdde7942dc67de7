"""Incremental secret scan: a ledger of contents already scanned, joined back to every path."""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import functions as F

from segment_hours.llm.common import text_blocks


class Rule(NamedTuple):
    """``pattern`` finds a span; its group ``group`` must have ``least`` characters, or the match is dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self):
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    # The same spans as [0-9a-f]+ of 16 characters or more: runs are maximal.
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge_token", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + MORE

# Blobs of which a task remembers that it has scanned them.
REMEMBERED = 500_000

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_FOUND = "blob binary, rules array<string>, spans array<struct<kind: string, start: int, end: int>>"
_LEDGER = f"{_FOUND}, run string"


def spans_of(text, rules):
    """Spans (kind, start, end) in code points; per rule leftmost and not overlapping, failing matches dropped."""
    found = []
    for rule, pattern in rules:
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((rule.kind, m.start(), m.end()))
    return found


def _scanner(rules):
    compiled = {r.key: (r, re.compile(r.pattern)) for r in rules}

    def run(batches):
        met = set()
        for batch in batches:
            for part in text_blocks([batch]):
                # Of repeated rows that a task meets the first is scanned.
                blobs = part.column("blob").to_pylist()
                new = [i for i, b in enumerate(blobs) if b not in met and not met.add(b)]
                if len(new) < len(blobs):
                    part = part.take(pa.array(new, pa.int64()))
                if len(met) > REMEMBERED:
                    met.clear()
                texts, todo = part.column("text").to_pylist(), part.column("todo").to_pylist()
                spans = [spans_of(t, [compiled[k] for k in keys]) for t, keys in zip(texts, todo, strict=True)]
                rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in own] for own in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), pa.array(todo, pa.list_(pa.string())), pa.array(rows, pa.list_(_SPAN))],
                    ["blob", "rules", "spans"],
                )

    return run


def versions(docs):
    """(rid, doc_id, blob): the path of every stored version and the SHA-256 of its content (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.xxhash64("doc_id", "text").alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("blob"),
    )


def read_ledger(spark, path):
    """The ledger (blob, rules, spans, run): one row per scan of a blob. An absent folder is an empty ledger."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
        return spark.read.schema(_LEDGER).parquet(path)
    return spark.createDataFrame([], _LEDGER)


def scan_new(docs, ledger, rules=RULES):
    """Scans every blob for the rule versions it has not seen and appends the findings to the ``ledger`` folder.

    Returns the name of the run, which its ledger rows carry.
    """
    spark, run = docs.sparkSession, uuid.uuid4().hex
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    # One stored version stands for all with the same content.
    blobs = versions(docs).groupBy("blob").agg(F.min("rid").alias("rid"))
    every = F.array(*[F.lit(r.key) for r in rules])
    todo = F.array_except(every, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    unseen = blobs.join(seen, "blob", "left").select("rid", "blob", todo.alias("todo")).where(F.size("todo") > 0)
    text = F.coalesce(F.col("text"), F.lit(""))
    contents = docs.select(F.xxhash64("doc_id", "text").alias("rid"), text.alias("text"))
    found = contents.join(unseen, "rid").mapInArrow(_scanner(rules), _FOUND)
    found = found.dropDuplicates(["blob"])  # of repeated rows in several tasks
    found.withColumn("run", F.lit(run)).write.mode("append").parquet(ledger)
    return run


def findings(docs, ledger, rules=RULES, run=None):
    """(rid, doc_id, spans, n_known) of every stored version: the ledger's spans of the current rule versions.

    ``n_known`` counts the rule versions for which the blob was not scanned by ``run``, as an earlier one had done it.
    """
    spark = docs.sparkSession
    current = F.array(*[F.lit(r.key) for r in rules])
    valid = F.array_intersect("rules", current)
    kinds = F.transform(valid, lambda k: F.substring_index(k, "@", 1))
    rows = read_ledger(spark, ledger).select(
        "blob",
        F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans"),
        F.when(~F.col("run").eqNullSafe(F.lit(run)), valid).alias("known"),
    )
    # Two runs that overlapped may have scanned a blob twice; equal spans and rules count once.
    rows = rows.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.size(F.array_distinct(F.flatten(F.collect_list("known")))).cast("long").alias("n_known"),
    )
    return versions(docs).join(rows, "blob").drop("blob")


def scan(docs, ledger, rules=RULES):
    """Findings of all documents after an incremental scan; see ``findings``.

    Content, not paths, is scanned: equal texts cost one scan, and a later run with the same ledger scans only
    blobs it has not met, or rules with a new version. Base spans are those of the three base patterns, leftmost and
    not overlapping per kind; further rules add spans. Null text is empty and has no spans. Repeated rows each get
    their row. An empty table gives an empty result.
    """
    run = scan_new(docs, ledger, rules)
    return findings(docs, ledger, rules, run)


def listed(spans, order):
    """kind:start:end of an array of spans, by start, then in the order of kinds, joined by commas."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(order) for x in (k, i)])
    keyed = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"].alias("kind")))
    )
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(found, base=BASE, rules=RULES):
    """Counts of the base kinds, the hash of their spans, all spans as text, and the rules the last run could skip."""
    kinds = [r.kind for r in base]
    own = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [count_kind("spans", k).alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(own, kinds), 256).alias("base_sha256"),
        listed(F.col("spans"), [r.kind for r in rules]).alias("spans"),
        "n_known",
    )
