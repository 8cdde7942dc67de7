"""Personal data: fixed patterns, and bootstrapped contextual extraction of identifiers around them.

All steps are built-in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.llm.common import stage

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Each is written so that a run of characters is tried once, which finds the same leftmost matches:
# possessive repeats where nothing can be given back, and no start inside a run (but where the last match ended).
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PATTERNS = dict(zip(KINDS, (_EMAIL, _IP, _CARD, _PHONE), strict=True))

# Values that stand where an identifier may stand: base matches, and numbers or words that look like one (four digits,
# or an at sign between characters). As above, each repeat is of one character class or possessive.
_IN = r"\p{L}\p{N}@._%+/-"
_NUMBERS = rf"(?<![{_IN}])(?=\(?(?:[\x20().-]*+[0-9]){{4}})\(?[0-9][\x20().0-9-]*[0-9](?![\p{{L}}@_%+/])"
_WORDLIKE = rf"(?<![{_IN}])(?=(?:[\p{{L}}@._%+/-]*+[0-9]){{4}}|[\p{{L}}\p{{N}}._%+/-]++@[\p{{L}}\p{{N}}])[{_IN}]*[\p{{L}}\p{{N}}]"
_LONG_CARD = r"(?=(?:[0-9][\x20-]?){12})" + _CARD
_CANDIDATE = f"{_EMAIL}|{_PHONE}|{_IP}|{_LONG_CARD}|{_NUMBERS}|{_WORDLIKE}"
# What an unseen identifier must look like.
_SHAPE = r"(?:[0-9][^0-9]*){4}|[^@]@[^@]"
# So many words next to a value are its lexical patterns; the first words of a text, with the space in front.
CONTEXT = 3
_FIRST_WORDS = rf"^\s*+(?:\S++\s++){{0,{CONTEXT - 1}}}\S++"

# Marks set around matches; where a text holds them itself, another character stands for them.
_OPEN, _CLOSE, _OTHER = "\ue000", "\ue002", "\ufffd"

ROUNDS = 3
# A pattern must have so many different seed identifiers of its kind, and this mean score over all values next to it.
LEAST_SEEDS = 5
LEAST_SCORE = 0.8


def _cut(text, pattern, marks):
    """The text cut before each match: entries after the first start with the marked match."""
    clean = F.translate(text, _OPEN + _CLOSE, _OTHER * 2)
    return F.split(F.regexp_replace(clean, F.lit(pattern), F.lit(marks)), _OPEN, -1)


def _first_words(text):
    return F.regexp_extract(text, _FIRST_WORDS, 0)


def _last_words(text):
    """Read from the end, so that a long text is not searched."""
    return F.reverse(_first_words(F.reverse(text)))


def _parts(parts, kind, words=False):
    """(kind, i, whole, value, tail, rest) per entry: ``whole`` characters of the text, the match in front of them.

    With ``words`` also the last words of the entry and the first ones behind the match.
    """

    def one(p, i):
        none = F.lit(None).cast("string")
        rest = F.when(i > 0, _first_words(F.substring_index(p, _CLOSE, -1)))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            (F.length(p) - (i > 0).cast("int")).alias("whole"),
            F.when(i > 0, F.substring_index(p, _CLOSE, 1)).alias("value"),
            (F.translate(_last_words(p), _CLOSE, "") if words else none).alias("tail"),
            (rest if words else none).alias("rest"),
        )

    return F.transform(parts, one)


def _valid(kind, value):
    """The checks of the base kinds: byte-sized parts, Luhn digits, and how many digits."""
    byte = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = F.regexp_replace(value, "[^0-9]", "")
    card = F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return (
        F.when(kind == "ip", value.rlike(rf"^(?:{byte}\.){{3}}{byte}$"))
        .when(kind == "card", card)
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(True)
    )


def matches(docs):
    """Two stages: rows (uid, doc_id) of all documents, and (uid, kind, start, end, value, before, after) of all valid
    base matches and of all candidates (kind ``candidate``) with up to three words on each side. Offsets are code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    cuts = {f"c_{k}": _cut(F.col("text"), f"({p})", f"{_OPEN}$1{_CLOSE}") for k, p in _PATTERNS.items()}
    cuts["c_candidate"] = _cut(F.col("text"), f"({_CANDIDATE})", f"{_OPEN}$1{_CLOSE}")
    cut = rows.select("uid", "doc_id", *[c.alias(n) for n, c in cuts.items()])
    empty = F.array().cast("array<struct<kind: string, i: int, whole: int, value: string, tail: string, rest: string>>")
    parts = [F.when(F.size(f"c_{k}") > 1, _parts(F.col(f"c_{k}"), k)).otherwise(empty) for k in KINDS]
    parts.append(F.when(F.size("c_candidate") > 1, _parts(F.col("c_candidate"), "candidate", words=True)).otherwise(empty))
    found = stage(cut.select("uid", "doc_id", F.concat(*parts).alias("parts")), "matches")
    each = found.select("uid", F.explode("parts").alias("p")).select("uid", "p.*")
    along = Window.partitionBy("uid", "kind").orderBy("i")
    placed = each.withColumn("start", F.sum("whole").over(along.rowsBetween(Window.unboundedPreceding, -1)).cast("int"))
    # Every entry but the first holds a word, so as many entries as words hold all of them; a space stands for words left out.
    behind = F.col("whole") - F.coalesce(F.length("value"), F.lit(0))
    placed = placed.withColumns(
        {
            "tail": F.when(F.length("tail") < F.col("whole"), F.concat(F.lit(" "), "tail")).otherwise(F.col("tail")),
            "rest": F.when(F.length("rest") < behind, F.concat("rest", F.lit(" "))).otherwise(F.col("rest")),
        }
    )
    near = range(1, CONTEXT + 1)
    earlier = [F.coalesce(F.lag("tail", k).over(along), F.lit("")) for k in reversed(near)]
    later = [F.coalesce(F.lead(c, k).over(along), F.lit("")) for k in near for c in ("value", "rest")]
    placed = placed.withColumns({"before": F.concat(*earlier), "after": F.concat("rest", *later)})
    placed = placed.where("i > 0").where(_valid(F.col("kind"), F.col("value")))
    before, after = _last_words(F.col("before")), _first_words(F.col("after"))
    spans = placed.select(
        "uid", "kind", "start", (F.col("start") + F.length("value")).alias("end"), "value", before.alias("before"), after.alias("after")
    )
    return found.select("uid", "doc_id"), stage(spans, "spans")


def _patterns(before, after):
    """The last one, two and three words in front of a value and the first ones behind it, in lower case, with a mark of the side."""

    def words(text):
        clean = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
        return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))

    def some(text, side, cut):
        parts = words(text)
        return [F.when(F.size(parts) >= k, F.concat(F.lit(side), F.array_join(cut(parts, k), " "))) for k in range(1, CONTEXT + 1)]

    front = some(before, "<", lambda w, k: F.slice(w, F.size(w) - k + 1, k))
    return F.array_compact(F.array(*front, *some(after, ">", lambda w, k: F.slice(w, 1, k))))


def mentions(spans):
    """(uid, start, end, value, kind, patterns): candidates; ``kind`` is that of a base match at the same place, if any.

    Values that only overlap a base match are left out: they are neither seeds nor unseen.
    """
    patterns = _patterns(F.col("before"), F.col("after"))
    candidates = spans.where("kind = 'candidate'").select("uid", "start", "end", F.lower("value").alias("value"), patterns.alias("patterns"))
    base = spans.where("kind <> 'candidate'").select("uid", F.col("kind").alias("base"), F.col("start").alias("s"), F.col("end").alias("e"))
    # Both sides in one order of places: the furthest end so far and the nearest start after tell overlaps, with no join.
    places = candidates.select("uid", "start", "end", "value", "patterns", F.lit(None).cast("string").alias("base")).unionByName(
        base.select("uid", F.col("s").alias("start"), F.col("e").alias("end"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("array<string>").alias("patterns"), "base")
    )
    # At one start base matches come first.
    order = [F.col("start"), F.col("base").isNull(), F.col("end")]
    before = Window.partitionBy("uid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("uid").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    is_base = F.col("base").isNotNull()
    last_start = F.last(F.when(is_base, F.col("start")), ignorenulls=True).over(before)
    last_kind = F.last("base", ignorenulls=True).over(before)
    furthest = F.max(F.when(is_base, F.col("end"))).over(before)
    nearest = F.first(F.when(is_base, F.col("start")), ignorenulls=True).over(after)
    seen = places.withColumns({"ls": last_start, "lk": last_kind, "fe": furthest, "ns": nearest}).where("base is null")
    seed = F.col("ls") == F.col("start")
    free = (F.coalesce(F.col("fe"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("ns"), F.col("end")) >= F.col("end"))
    seen = seen.where(F.coalesce(seed, F.lit(False)) | free)
    return seen.select("uid", "start", "end", "value", F.when(seed, F.col("lk")).alias("kind"), "patterns")


def bootstrap(seen, rounds=ROUNDS, least_seeds=LEAST_SEEDS, least_score=LEAST_SCORE):
    """(value, kind, score): values that high-confidence patterns take for identifiers of a kind.

    The graph joins every pattern with the distinct values next to it, over all documents. Values seen as a base match
    score 1 for that kind and are seeds, as are, from the next round on, values that reached the least score. In each round a pattern's score is the mean score of its values, patterns with enough
    seeds and score are kept, and a value that looks like an identifier scores ``1 - product(1 - score)`` over its kept patterns.
    """
    graph = seen.select(F.explode("patterns").alias("pattern"), "value", "kind").groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    graph = stage(graph, "graph")
    seeds = seen.where("kind is not null").groupBy("value", "kind").agg(F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    sizes = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    scored = seeds
    found = None
    for _ in range(rounds):
        weights = graph.select("pattern", "value").join(scored, "value").groupBy("pattern", F.col("kind")).agg(
            F.sum("score").alias("total"), F.sum("seed").alias("seeds")
        )
        kept = weights.where(F.col("seeds") >= least_seeds).join(sizes, "pattern")
        kept = kept.withColumn("p", F.col("total") / F.col("n")).where(F.col("p") >= least_score).select("pattern", "kind", "p")
        open_values = graph.where(F.col("kind").isNull() & F.col("value").rlike(_SHAPE)).select("pattern", "value")
        reached = open_values.join(kept, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))))).alias("score")
        )
        found = stage(reached.join(seeds.select("value").distinct(), "value", "left_anti"), "found")
        scored = seeds.unionByName(found.withColumn("seed", (F.col("score") >= least_score).cast("int")))
    return found.where(F.col("score") >= least_score)


def _listed(spans):
    """kind:start:end by start, then kind as listed, joined by commas; spans of other kinds rank behind."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")), F.lit(9)).cast("int")
    entry = F.struct("start", rank.alias("rank"), "end", "kind")
    picked = F.sort_array(F.collect_list(F.when(spans, entry)))
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs, **options):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per document.

    The base matches of the four patterns seed the method; values that it finds beyond them by the words around are added to ``spans``
    with the kind of their patterns. They never touch a base match and do not change the counts or the hash.

    Null text and empty text have no spans. Whole texts are read, and each match is one row, so a long text full of
    matches is sorted, not held. Repeated rows each get their row; null ids are kept.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows, spans = matches(docs)
    seen = stage(mentions(spans), "mentions")
    found = bootstrap(seen, **options)
    best = found.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    added = seen.where("kind is null").select("uid", "start", "end", "value").join(best, "value")
    base = spans.where("kind <> 'candidate'").select("uid", "kind", "start", "end", F.lit(True).alias("base"))
    every = base.unionByName(added.select("uid", "kind", "start", "end", F.lit(False).alias("base")).distinct())
    counts = [F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS]
    own = every.groupBy("uid").agg(*counts, _listed(F.col("base")).alias("own"), _listed(F.lit(True)).alias("spans"))
    zeros = {f"n_{k}": F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("long")) for k in KINDS}
    out = rows.join(own, "uid", "left").withColumns(zeros)
    return out.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(F.coalesce("own", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
