"""Fixed-width fields, identifiers and coercions, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from segment_hours.config import SEGMENT_MILES


def fixed(col, start, length):
    """Fixed-width field at a 1-based position, not stripped."""
    return F.substring(col, start, length)


# Fixed pattern: 1-5 digits that, padded to four, have an hour below 24 and a rest below 60.
_HHMM = "^(?:[0-9]|[0-5][0-9]|[0-9][0-5][0-9]|(?:[01][0-9]|2[0-3])0?[0-5][0-9])$"


def hhmm(col):
    """Four-digit time of a digit text (leading zeros may be missing), or null."""
    raw = F.trim(col)
    hour = F.substring(F.lpad(raw, 4, "0"), 1, 2)
    minute = F.lpad(F.right(raw, F.lit(2)), 2, "0")
    return F.when(raw.rlike(_HHMM), F.when(F.length(raw) == 4, raw).otherwise(F.concat(hour, minute)))


def hhmm_minutes(col):
    """Minutes since midnight of an HHMM value, also when leading zeros were lost."""
    value = F.trim(col.cast("string")).try_cast("int")
    return F.floor(value / 100).cast("int") * 60 + value % 100


def minutes_hhmm(minutes):
    """HHMM text of minutes since midnight."""
    hours = F.lpad(F.floor(minutes / 60).cast("string"), 2, "0")
    return F.concat(hours, F.lpad((minutes % 60).cast("string"), 2, "0"))


def split_prefix_int(col, sep=":"):
    """Integer before the first separator, null where it is not a number."""
    return F.split_part(col, F.lit(sep), F.lit(1)).try_cast("bigint")


def segment_id(line, start, size=SEGMENT_MILES):
    """Line code and start mile floored to its bucket; a null start counts as mile 0."""
    mile = F.coalesce(start.cast("double"), F.lit(0.0)).cast("bigint")
    bucket = (F.floor(mile / size) * size).cast("bigint")
    return F.concat(line, F.lit("_"), bucket.cast("string"))


def blank_to_null(col):
    return F.when(F.trim(col) != "", col)


def number_or_null(col):
    return F.trim(col.cast("string")).try_cast("double")


def rotate_mask(mask):
    """Day mask moved one day later (the last day becomes the first)."""
    return F.concat(F.right(mask, F.lit(1)), F.left(mask, F.length(mask) - 1))


# Fixed pattern: season and business period in the name of a period archive.
PERIOD_NAME = r"(?i)(\d{4}(?:[-_ ]?\d{2})?|\d{2}[-_ ]\d{2})[-_ ]*P(\d{2})\.zip$"


def parse_period_name(name):
    """Struct (season, period) of an archive name; both null where the name does not match."""
    season = F.regexp_replace(F.regexp_extract(name, PERIOD_NAME, 1), "[-_ ]", "")
    season = F.when(F.length(season) < 6, F.concat(F.lit("20"), season)).otherwise(season)
    period = F.concat(F.lit("P"), F.regexp_extract(name, PERIOD_NAME, 2))
    hit = name.rlike(PERIOD_NAME)
    return F.struct(F.when(hit, season).alias("season"), F.when(hit, period).alias("period"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ALPHABET = "0123456789" + _LETTERS


def fixed_code(number, width):
    """Code of exactly ``width`` characters, another one for every number from 0.

    Digits with leading zeros as far as they reach; from 10**width on a letter, then letters and digits. A number beyond
    the last code is an error.
    """
    base, plain = len(_ALPHABET), 10**width
    wide = number.cast("bigint") - plain + len("0123456789") * base ** (width - 1)
    # one expression for all places: written out, they make a method too long to be compiled
    powers = F.array(*[F.lit(base**i).cast("bigint") for i in reversed(range(width))])
    signs = F.transform(powers, lambda p: F.substring(F.lit(_ALPHABET), (F.floor(wide / p) % base + 1).cast("int"), F.lit(1)))
    beyond = F.raise_error(F.concat(number.cast("string"), F.lit(f" has no code of {width} characters")))
    return (
        F.when(number.between(0, plain - 1), F.lpad(number.cast("string"), width, "0"))
        .when(number.isNotNull() & ((number < 0) | (wide >= base**width)), beyond)
        .otherwise(F.array_join(signs, ""))
    )


def code_number(code, width):
    """The number that :func:`fixed_code` turned into ``code``."""
    base = len(_ALPHABET)
    signs = [(F.instr(F.lit(_ALPHABET), F.substring(code, i + 1, 1)) - 1).cast("bigint") * base ** (width - 1 - i) for i in range(width)]
    wide = sum(signs[1:], signs[0]) - len("0123456789") * base ** (width - 1) + 10**width
    return F.when(code.rlike("^[0-9]+$"), code.cast("bigint")).otherwise(wide)
