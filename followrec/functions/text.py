"""Message text expressions: cleaning, link description, tokens.

The cleaning is five chained ``regexp_replace`` calls plus ``lower``; all stay
inside whole-stage codegen. Order matters (a URL loses its punctuation only
after it was replaced by 'http').
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cleaning patterns (Java regex), applied in this order.
# 1 mention: '@' followed by letters, digits or underscore (Unicode-aware)
# 2 URL: 'http' or 'https', '://', up to the next Unicode white space
# 3 ASCII punctuation !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
# 4 anything outside ASCII
# 5 runs of digits
MENTION_PATTERN = r"@[\p{L}\p{N}_]+"
URL_PATTERN = r"(?U)https?://\S+"
URL_REPLACEMENT = "http"
PUNCT_PATTERN = r"\p{Punct}"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"
DIGITS_PATTERN = r"\d+"

# Word separators of the tokenizer (after cleaning only these remain).
TOKEN_SPLIT_PATTERN = r"[ \t\n]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text) -> Column:
    s = _c(text)
    s = F.regexp_replace(s, MENTION_PATTERN, "")
    s = F.regexp_replace(s, URL_PATTERN, URL_REPLACEMENT)
    s = F.regexp_replace(s, PUNCT_PATTERN, "")
    s = F.regexp_replace(s, NON_ASCII_PATTERN, "")
    s = F.regexp_replace(s, DIGITS_PATTERN, "")
    return F.lower(s)


def first_link_description(links) -> Column:
    """Description of the first link; '' when links are missing, empty or null.

    ``get`` (not ``links[0]``) so an empty array yields null under ANSI mode.
    """
    return F.coalesce(F.get(_c(links), 0).getField("description"), F.lit(""))


def tokens(text) -> Column:
    """Words of a cleaned text, in order, empty strings dropped."""
    return F.filter(F.split(_c(text), TOKEN_SPLIT_PATTERN), lambda w: F.length(w) > 0)
