"""Text cleaning and tokenising as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning rules must delete exactly these characters and ranges.
PUNCTUATION = "@#!?+&*[]-%.:/();$=><|{}^'`_"
_PUNCTUATION = "[" + "".join(f"\\x{ord(c):02x}" for c in PUNCTUATION) + "]+"
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
)
STRICT_EMOJI_RANGES = EMOJI_RANGES[:5]
SCORE_LABELS = {1: "negative", 2: "negative", 3: "negative", 4: "positive", 5: "positive"}

# Unicode white space plus the four separators U+001C..U+001F.
_SPACE = r"\s\x1c-\x1f"
_LETTERS = r"[\p{L}\p{N}_]{2,}"


def _class_of(ranges) -> str:
    """A run of characters in the ranges. Most characters lie outside the span of them all, which is tested first."""
    def chars(lo: int, hi: int) -> str:
        return f"\\x{{{lo:X}}}-\\x{{{hi:X}}}"
    span = chars(min(lo for lo, _ in ranges), max(hi for _, hi in ranges))
    return f"[{span}&&[" + "".join(chars(*r) for r in ranges) + "]]+"


def strip_markup(text: Column) -> Column:
    """Lower-case, then drop URLs, tags and punctuation, in that order."""
    out = F.lower(text)
    out = F.regexp_replace(out, F.lit(f"(?U)http[^{_SPACE}]+"), F.lit(""))
    # (?d): only \n ends a line, so a tag may span the other line separators.
    out = F.regexp_replace(out, F.lit("(?d)<.*?>"), F.lit(""))
    return F.regexp_replace(out, F.lit(_PUNCTUATION), F.lit(""))  # half the time of translate()


def collapse_space(text: Column) -> Column:
    """Single spaces between words, none at the ends."""
    return F.trim(F.regexp_replace(text, F.lit(f"(?U)[{_SPACE}]+"), F.lit(" ")))


def words(text: Column) -> Column:
    """White-space separated words; none for an empty text."""
    return F.filter(F.split(collapse_space(text), " "), lambda w: w != "")


def drop_emoji(text: Column, strict: bool = False) -> Column:
    """Delete emoji. The default ranges also cover CJK; ``strict`` keeps CJK."""
    ranges = STRICT_EMOJI_RANGES if strict else EMOJI_RANGES
    return F.regexp_replace(text, F.lit(_class_of(ranges)), F.lit(""))


def clean_text(text: Column, strict_emoji: bool = False) -> Column:
    """Full cleaning without lemmatisation."""
    return drop_emoji(collapse_space(strip_markup(text)), strict_emoji)


def terms(text: Column) -> Column:
    """Vectoriser tokens: runs of two or more letters, digits or underscores, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(_LETTERS), 0)


def sentiment_label(score: Column) -> Column:
    """'negative' for scores 1-3, 'positive' for 4-5, null otherwise."""
    out = None
    for value, label in SCORE_LABELS.items():
        out = (F if out is None else out).when(score == value, F.lit(label))
    return out
