"""Text cleaning, digests and term extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space, spelt so that Java and RE2 agree on it.
WHITESPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+"
NOT_WHITESPACE = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
# The same characters one by one, for trimming without a pattern.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# A word character is a letter, a number or an underscore; marks end a token.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def clean_text(text: Column) -> Column:
    """Null to empty, every run of white space to one space, both ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " "))


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends; null stays null."""
    return F.trim(text, F.lit(SPACES))


def has_text(text: Column) -> Column:
    """True when cleaning would leave something; stops at the first such character."""
    return F.coalesce(text.rlike(NOT_WHITESPACE), F.lit(False))


def is_blank(text: Column) -> Column:
    return ~has_text(text)


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def seeded_hash(seed: int, value: Column) -> Column:
    """Hex hash that orders rows pseudo-randomly, the same way on every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``low`` to ``high`` words, each joined by one space.

    Longer n-grams pair the ones before with the word that follows, element by element, so
    the word array is read once per length and never once per n-gram.
    """
    if low < 1 or high < low:
        raise ValueError("n-gram bounds must satisfy 1 <= low <= high")
    grams, parts = words, []
    for n in range(1, high + 1):
        if n > 1:
            length = F.greatest(F.size(words) - (n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, 1, length), F.slice(words, n, length),
                lambda head, word: F.concat(head, F.lit(" "), word),
            )
        if n >= low:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)
