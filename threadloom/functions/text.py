"""Text scalars: whitespace map, Unicode strip, pre-token count, length code.

All are compositions of Spark built-ins so they stay inside whole-stage
codegen; none of them moves data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Whitespace map: no-break space, line feed and tab become a space; carriage
# return is deleted.
WS_MAP_FROM = "\u00a0\n\t\r"
WS_MAP_TO = "   "
# Characters Python's str.strip() removes (str.isspace() is true for these).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# GPT-2 style pre-token pattern (contractions, letter runs, digit runs,
# other-symbol runs, whitespace), used to count tokens without a vocabulary.
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Length codes by token count: <=15 -> 1, <=50 -> 2, <=256 -> 3, else '-'.
LENGTH_BOUNDS = (15, 50, 256)
LENGTH_CODES = ("1", "2", "3", "-")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_ws(text) -> Column:
    """Map U+00A0, LF, TAB to a space and delete CR (``translate``)."""
    return F.translate(_c(text), WS_MAP_FROM, WS_MAP_TO)


def strip_ws(text) -> Column:
    """Strip every character Python's ``str.strip`` strips, both ends."""
    return F.btrim(_c(text), F.lit(PY_WHITESPACE))


def clean_text(text) -> Column:
    """C1 then C2, the treatment every dialogue text gets."""
    return strip_ws(normalize_ws(text))


def token_count(text) -> Column:
    """number of pre-tokens of the whitespace-mapped text.

    Counting on the C1-mapped copy keeps the count independent of raw line
    breaks that the first question of a topic may still hold.
    """
    return F.size(F.regexp_extract_all(normalize_ws(text), F.lit(PRETOKEN_PATTERN), 0))


def length_code(n_tokens, bounds=LENGTH_BOUNDS) -> Column:
    """bucket a token count into the length code ``1 2 3 -``."""
    n = _c(n_tokens)
    b1, b2, b3 = bounds
    return (F.when(n <= b1, LENGTH_CODES[0]).when(n <= b2, LENGTH_CODES[1])
            .when(n <= b3, LENGTH_CODES[2]).otherwise(LENGTH_CODES[3]))


def hash_bucket_hex(text) -> Column:
    """First hex digit of md5, a 16-way bucket usable in both engines."""
    return F.substring(F.md5(_c(text).cast("string")), 1, 1)
