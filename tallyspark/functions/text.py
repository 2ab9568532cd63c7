"""String cleaning expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The customer-name cleaning patterns, in the order they apply.
# They must keep these meanings for results to agree with the reference.
#   1. a non-letter run between a letter and a lowercase letter is dropped
#   2. everything but ASCII letters, whitespace, apostrophe and hyphen is dropped
#   3. non-letters at either end are dropped
#   4. whitespace runs become one space, then the value is trimmed
NAME_RUN_INSIDE_WORD = r"(?<=[a-zA-Z])[^a-zA-Z]+(?=[a-z])"
NAME_NOT_ALLOWED = r"[^a-zA-Z\s'\-]"
NAME_EDGE_NOISE = r"^[^a-zA-Z]+|[^a-zA-Z]+$"
WHITESPACE_RUN = r"\s+"
# Opt-in Unicode variant: any letter counts, so accented names survive.
_UNICODE_PATTERNS = (
    r"(?<=\p{L})[^\p{L}]+(?=\p{Ll})",
    r"[^\p{L}\s'\-]",
    r"^[^\p{L}]+|[^\p{L}]+$",
    WHITESPACE_RUN,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column, chars: str | None = None) -> Column:
    """``trim``: removes spaces only (tabs and newlines stay) unless ``chars``."""
    return F.trim(_col(c)) if chars is None else F.trim(_col(c), F.lit(chars))


def clean_person_name(c: str | Column, unicode: bool = False,
                      protect: Sequence[str] = ()) -> Column:
    """Four regex passes that rejoin split words and drop digits and symbols.

    NULL stays NULL and '' stays ''. With ``unicode=True`` non-ASCII letters
    are kept (the default drops them, as the reference does). ``protect``
    lists lowercase words (particles such as "van", "der") that step 1 must
    not glue onto the word before them."""
    inside, not_allowed, edges, spaces = (
        _UNICODE_PATTERNS if unicode
        else (NAME_RUN_INSIDE_WORD, NAME_NOT_ALLOWED, NAME_EDGE_NOISE, WHITESPACE_RUN)
    )
    if protect:
        words = "|".join(re.escape(w) for w in protect)
        inside += rf"(?!(?:{words})\b)"
    value = F.regexp_replace(_col(c), inside, "")
    value = F.regexp_replace(value, not_allowed, "")
    value = F.regexp_replace(value, edges, "")
    return F.trim(F.regexp_replace(value, spaces, " "))


def join_lines(c: str | Column, separator: str = ", ") -> Column:
    """Turn embedded line feeds into a separator (multi-line address → one line)."""
    return F.replace(_col(c), F.lit("\n"), F.lit(separator))
