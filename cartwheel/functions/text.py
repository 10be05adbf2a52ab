"""Column-level text helpers (JVM built-ins only, no Python row UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters, lower-cased.
TOKEN_PATTERN = r"\p{L}+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text, min_len: int = 1) -> Column:
    """Segment a text column into an array of lower-case letter runs; tokens
    shorter than ``min_len`` characters are dropped."""
    arr = F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)
    if min_len > 1:
        arr = F.filter(arr, lambda t: F.length(t) >= min_len)
    return arr


def segment(text, sep: str = " ", min_len: int = 1) -> Column:
    """Segmented text joined by ``sep`` (the reference uses ' ' and '/')."""
    return F.array_join(tokens(text, min_len), sep)


def split_words(line, sep: str = " ") -> Column:
    """``split(s, ' ')`` exactly as the warehouse does (empty strings kept)."""
    return F.split(_c(line), sep)
