"""Words of UTF-8 texts by a table of bytes: capitals A-Z become small, bytes outside the table are gaps."""

from __future__ import annotations

# Bytes that are split at once; a longer text is split piece by piece, at gaps.
PIECE_BYTES = 4 << 20

LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
DIGITS = bytes(range(0x30, 0x3A))


def byte_table(kept):
    """Translation of bytes: those of ``kept`` stay, A-Z are lower-cased, all others become spaces."""
    table = bytearray(b" " * 256)
    for b in kept:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


def word_lists(text, table, size=PIECE_BYTES):
    """Lists of the words of ``text``, in order; a text of more than ``size`` bytes gives several."""
    plain = text.translate(table)
    first = 0
    while len(plain) - first > size:
        last = plain.find(b" ", first + size)
        if last < 0:
            break
        yield plain[first:last].split()
        first = last
    yield plain[first:].split() if first else plain.split()
