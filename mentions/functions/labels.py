"""Label helpers as Column expressions (SF-08 … SF-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display renames applied after capitalising a category name,
# the word pattern of camel-case names (a word, then an optional hyphen) and
# the default key labels.
CATEGORY_RENAMES = {"Auto": "Automotive", "Hr": "HR"}
CAMEL_WORD = r"([A-Z][a-z]*|[0-9]+)(-?)"
DEFAULT_CONCEPT_LABEL = "Concept"
DEFAULT_ENTITY_LABEL = "Entity"


def capitalize(c: Column) -> Column:
    """Python's ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def category_label(c: Column) -> Column:
    """SF-10: capitalised category name with the fixed display renames."""
    cap = capitalize(c)
    out = cap
    for src, dst in CATEGORY_RENAMES.items():
        out = F.when(cap == src, F.lit(dst)).otherwise(out)
    return out


def type_label(c: Column, default: str = DEFAULT_CONCEPT_LABEL) -> Column:
    """SF-08: ``feature_subjective`` -> ``FeatureSubjective``; ``''``/NULL -> ``default``.

    Each ``_``-separated part is capitalised (first letter upper, rest
    lower) and the parts are joined.
    """
    parts = F.split(c, "_")
    joined = F.array_join(F.transform(parts, lambda p: capitalize(p)), "")
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(joined)


def split_camel_case(c: Column) -> Column:
    """SF-09: ``Two-WaySolenoidValve`` -> ``Two-Way Solenoid Valve``.

    Words are an upper-case letter followed by lower-case letters, or a run
    of digits, each optionally followed by ``-``; a space follows every word
    longer than one character that does not end in ``-``. Other characters
    are dropped.
    """
    words = F.regexp_extract_all(c, F.lit(CAMEL_WORD), 0)
    spaced = F.transform(
        words, lambda w: F.when(w.endswith("-") | (F.length(w) <= 1), w).otherwise(F.concat(w, F.lit(" "))))
    return F.trim(F.array_join(spaced, ""))
