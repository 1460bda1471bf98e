"""Masking and keyword matching."""

from pyspark.sql import functions as F

# The masking rule keeps three leading and four trailing word characters.
PHONE_PATTERN = r"(\w{3})\w*(\w{4})"
PHONE_MASK = "$1****$2"

# One word is a run of letters and digits; each Han character is a word of its own.
_WORD = r"(\p{IsHan}|[\p{L}\p{M}\p{N}_&&[^\p{IsHan}]]+)"


def mask_phone(phone):
    return F.regexp_replace(phone, PHONE_PATTERN, PHONE_MASK)


def words(text):
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(1)))


def match_score(text, keyword):
    """How many distinct words of ``keyword`` occur in ``text``; NULL or an empty keyword matches nothing."""
    return F.coalesce(F.size(F.array_intersect(words(text), words(F.lit(keyword)))), F.lit(0))
