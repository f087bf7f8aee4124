"""Hyphens, words, bands and cleaning of historical text, as native columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SOFT = "¬"
#: Letters of old prints and their plain forms (fixed).
PLAIN = {"ſ": "s", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "ß": "ss", "ë": "e", "ï": "i", "ü": "u"}


def ends_with_hyphen(c: Column) -> Column:
    return c.rlike(rf"[{SOFT}-]\s*$")


def strip_trailing_hyphen(c: Column) -> Column:
    """One mark and the spaces at the end."""
    return F.when(ends_with_hyphen(c), F.regexp_replace(c, rf"[{SOFT}-]\s*$", "")).otherwise(c)


def joins_words(before: Column, after: Column) -> Column:
    return before.rlike(r"\p{L}$") & after.rlike(r"^\p{L}")


def remove_soft_hyphens(c: Column) -> Column:
    return F.translate(c, SOFT, "")


def without_soft_hyphens(texts: Column) -> Column:
    """The same for each of an array of texts."""
    return F.transform(texts, remove_soft_hyphens)


def drop_carried_word(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*\S+\s*", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != ""))


def letters(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{L}"))


def sendable(c: Column) -> Column:
    """A line worth a service's time: three letters at least."""
    return F.coalesce(letters(c) >= 3, F.lit(False))


def band(score: Column, bands: Sequence[tuple[float, str]]) -> Column:
    """The label of the highest floor that the score reaches, else null."""
    out = F.lit(None).cast("string")
    for floor, label in sorted(bands):
        out = F.when(score >= floor, F.lit(label)).otherwise(out)
    return out


def outgrown_by(before: Column, after: Column) -> Column:
    """A reading of so many words that has too many for its line."""
    return after > before * 1.5 + 2


def outgrown(before: Column, after: Column) -> Column:
    return outgrown_by(word_count(before), word_count(after))


def cleaned(c: Column) -> Column:
    """Old spelling made plain for language rules: bars go, words broken at a hyphen
    are joined, long s and ligatures replaced, u after u before a letter is v, a
    word's first i before a vowel is j, and blanks are single."""
    c = F.translate(c, "|¦", "")
    c = F.regexp_replace(c, rf"(\p{{L}})[{SOFT}-]\s*\n\s*(\p{{L}})", "$1$2")
    c = F.translate(c, SOFT, "")
    for old, new in PLAIN.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, r"(\p{L})uu(\p{L})", "$1uv$2")
    c = F.regexp_replace(c, r"(^|[^\p{L}])i([aeiou])", "$1j$2")
    c = F.regexp_replace(c, r"(^|[^\p{L}])I([aeiou])", "$1J$2")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def tokens(c: Column) -> Column:
    """Words and single signs, in order."""
    return F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+|[^\s\p{L}\p{N}])"), 1)


def digest_shape(message: Column, document: Column) -> Column:
    """A warning without its document and with N for each number."""
    bare = F.when(message.startswith(F.concat(document, F.lit(": "))), F.substring(message, F.length(document) + 3, F.length(message))).otherwise(message)
    return F.regexp_replace(bare, r"\d+", "N")


def counted(count: Column, total: Column) -> Column:
    """'count of total'; a count without a sound denominator is an error."""
    sound = total.isNotNull() & (count >= 0) & (count <= total)
    return F.when(sound, F.format_string("%d of %d", count, total)).otherwise(F.raise_error(F.lit("a count needs a denominator that isn't smaller")))
