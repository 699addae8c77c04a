"""Text cleaning: whitespace, hashes, prefixes and the searchable article text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's Unicode `\s` matches (Java's `\s` knows only ASCII).
SPACE_CLASS = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
    r"\x{205F}\x{3000}]"
)

SPACES = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
              0x2029, 0x202F, 0x205F, 0x3000])
)


def normalize_whitespace(text: Column) -> Column:
    """Runs of Unicode whitespace become one space; none is left at either end."""
    return F.trim(F.regexp_replace(text, SPACE_CLASS + "+", " "))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends only."""
    return F.btrim(text, F.lit(SPACES))


def hash_text(text: Column) -> Column:
    return F.sha2(text, 256)


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def article_text(*parts: Column) -> Column:
    """Non-empty parts joined by a space; `concat_ws` leaves NULLs out."""
    return strip(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))
