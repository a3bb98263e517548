"""Scalar column functions for text repair (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regular expressions of the malformed-value audits.
UNSIGNED_FLOAT = r"([0-9]*[.])?[0-9]+"
SIGNED_FLOAT = r"[+-]?([0-9]*[.])?[0-9]+"
MULTI_SIGNED_FLOAT = r"[+-]*([0-9]*[.])?[0-9]+"
DIGITS = r"[0-9]+"
DURATION = r"(\d+) Years and (\d+) Months"

# pandas' default missing-value tokens of read_csv.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_char(c, ch: str = "_") -> Column:
    """Remove every occurrence of ``ch`` (pandas ``str.replace``)."""
    return F.replace(_c(c), F.lit(ch), F.lit(""))


def fullmatch(c, pattern: str) -> Column:
    """Whole-string regex match; NULL stays NULL. ``\\z`` anchors at the
    very end (``$`` would also match before a trailing newline)."""
    return _c(c).rlike(rf"^(?:{pattern})\z")


def placeholder_to_null(c, *placeholders: str) -> Column:
    """A placeholder string becomes NULL."""
    c = _c(c)
    return F.when(c.isin(*placeholders), F.lit(None).cast("string")).otherwise(c)


def to_number(c, dtype: str = "double", strip: str | None = "_") -> Column:
    """Strip a character and cast; a value that does not parse is NULL
    (``try_cast``; an ANSI cast would fail the job)."""
    c = _c(c)
    if strip:
        c = strip_char(c, strip)
    return c.try_cast(dtype)


def extract_months(c, pattern: str = DURATION) -> Column:
    """S5 + B3: 'Y Years and M Months' -> Y*12+M; no match -> NULL."""
    c = _c(c)
    y = F.regexp_extract(c, pattern, 1)
    m = F.regexp_extract(c, pattern, 2)
    return (F.nullif(y, F.lit("")).try_cast("int") * 12 + F.nullif(m, F.lit("")).try_cast("int"))


def split_list(c, sep: str = ", ") -> Column:
    """Split a list string (NULL stays NULL)."""
    return F.split(_c(c), sep, -1)


def list_len(c, sep: str = ", ") -> Column:
    """Number of items (NULL for NULL)."""
    return F.size(split_list(c, sep))


def lstrip_set(c, chars: str) -> Column:
    """Strip any of ``chars`` from the left (a set, as ``str.lstrip``)."""
    return F.ltrim(_c(c), F.lit(chars))


def map_values(c, mapping: dict, dtype: str | None = None) -> Column:
    """Dictionary lookup; unmapped values give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    out = F.try_element_at(F.create_map(*pairs), _c(c))
    return out.cast(dtype) if dtype else out


# Month names in calendar order (the credit data uses January..August, 1..8).
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]
MONTH_NUMBER = {m: i + 1 for i, m in enumerate(MONTHS)}

# The Yes/No/NM flag and its inverse.
YES_NO = {"Yes": 1, "No": 0}
YES_NO_BACK = {1: "Yes", 0: "No"}
