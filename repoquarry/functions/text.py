"""Whitespace, characters, word and piece patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes behind Python's str.strip / \s, and behind Unicode White_Space.
# Spelled out, so Java's ASCII-only \s and the slower (?U) flag are not needed.
PYTHON_SPACE = r"\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNICODE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Word alternatives in order of preference: identifier, number, operator, any symbol.
WORD_PATTERN = "|".join(
    [
        r"[A-Za-z_][A-Za-z0-9_]*",
        r"\p{Nd}+(?:\.\p{Nd}+)?",
        r"==|!=|<=|>=|->|=>|::|&&|\|\|",
        rf"[^{PYTHON_SPACE}]",
    ]
)

# Fixed value: the published GPT-2 pre-tokenization pattern.
PIECE_PATTERN = "|".join(
    [
        r"'s|'t|'re|'ve|'m|'ll|'d",
        r" ?\p{L}+",
        r" ?\p{N}+",
        rf" ?[^{UNICODE_SPACE}\p{{L}}\p{{N}}]+",
        rf"[{UNICODE_SPACE}]+(?![^{UNICODE_SPACE}])",
        rf"[{UNICODE_SPACE}]+",
    ]
)


# The same characters as PYTHON_SPACE, one by one; all lie below U+3001.
_SPACE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(c: Column) -> Column:
    """Trim by character set: no regular expression is run per row."""
    return F.btrim(c, F.lit(_SPACE_CHARACTERS))


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{PYTHON_SPACE}]")


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD_PATTERN), F.lit(0))


def text_pieces(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(PIECE_PATTERN), F.lit(0))


def _byte_alphabet() -> list[str]:
    """Byte -> printable character: bytes printable in Latin-1 stay, the others move above U+0100."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]


BYTE_ALPHABET = _byte_alphabet()
_MOVED = [b for b in range(256) if BYTE_ALPHABET[b] != chr(b)]


def byte_level(c: Column) -> Column:
    """UTF-8 bytes of a string, one printable character per byte (a space becomes U+0120)."""
    one_char_per_byte = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    return F.translate(
        one_char_per_byte, "".join(map(chr, _MOVED)), "".join(BYTE_ALPHABET[b] for b in _MOVED)
    )


def to_byte_level(text: str) -> str:
    """The same mapping for a Python string."""
    return "".join(BYTE_ALPHABET[b] for b in text.encode("utf-8"))


def characters(c: Column) -> Column:
    """Code points of a string; splitting '' gives one empty element, which is dropped."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def character_set(c: Column) -> Column:
    return F.array_distinct(characters(F.lower(c)))


def character_overlap(a: Column, b: Column) -> Column:
    """Shared characters (case ignored) relative to the smaller set, 0 if either is empty."""
    sa, sb = character_set(a), character_set(b)
    smaller = F.least(F.size(sa), F.size(sb))
    return F.when(smaller == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(sa, sb)).cast("double") / smaller
    )


def display_token(c: Column) -> Column:
    """Line breaks and tabs written out for a report."""
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c
