"""Column expressions for text: word capitalisation, tokens, file-name keys.

All are built-in Spark expressions with no Python in the data path. Higher-order
functions (``transform``, ``filter``) are evaluated row by row in the JVM,
outside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which the warehouse dialect starts a new word
# in INITCAP (whitespace plus this punctuation).
INITCAP_DELIMITERS = " \t\n\r\f\v!?@\"^#$&~_,.:;+-*%/|\\[](){}<>="

# File-name key patterns of the transcript convention.
SYMBOL_PATTERN = r"SYM[0-9]{3}"
FISCAL_PERIOD_PATTERN = r"20[0-9]{2}Q[1-4]"

# Default tokeniser: runs of letters or digits of the lower-cased text.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def initcap_words(c: Column | str, delimiters: str = INITCAP_DELIMITERS) -> Column:
    """Upper-case the first letter of every word and lower-case the rest.

    A word starts at the beginning of the string or after any delimiter
    character, so ``mary-jane o'neil`` -> ``Mary-Jane O'neil`` (Spark's own
    ``initcap`` splits on spaces only). Values of ASCII letters, digits, spaces and
    apostrophes go through that built-in; only the others are taken apart.
    """
    col = F.col(c) if isinstance(c, str) else c
    chars = F.split(col, "")
    delims = F.array(*[F.lit(ch) for ch in delimiters])
    # element_at is 1-based: for the 0-based index i it returns the previous char
    fixed = F.transform(chars, lambda ch, i: F.when(
        (i == 0) | F.array_contains(delims, F.element_at(chars, i)), F.upper(ch)).otherwise(F.lower(ch)))
    return (F.when(col.isNull(), F.lit(None).cast("string"))
             .when(~col.rlike("[^A-Za-z0-9 ']"), F.initcap(col))
             .otherwise(F.array_join(fixed, "")))


def tokens(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """Array of lower-cased word tokens of a text column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(pattern), 0)


def regex_key(c: Column | str, pattern: str) -> Column:
    """First match of ``pattern`` or NULL when there is none."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_substr(col, F.lit(pattern))
