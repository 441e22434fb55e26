"""Text keys built from native string functions only, so they stay in generated code."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that Python also strips. The flag
# form is measurably faster here than the same set spelled out as ranges.
SPACE = r"(?U)[\s\x1c-\x1f]+"


@lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """Every single character whose decomposition is one base character plus marks."""
    source, target = [], []
    for point in range(0xC0, min(sys.maxunicode, 0xFFFF) + 1):
        char = chr(point)
        parts = unicodedata.normalize("NFD", char)
        if parts == char:
            continue
        base = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def strip_accents(text: Column) -> Column:
    """Drop accents; plain ASCII values skip the translation."""
    source, target = _accent_pairs()
    folded = F.regexp_replace(F.translate(text, source, target), r"\p{Mn}", "")
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def header_normalize(header: Column) -> Column:
    return F.lower(squeeze(F.coalesce(header, F.lit(""))))


def region_key(region: Column) -> Column:
    """Comparison key for a region name: no case, accents, capital-district suffix,
    punctuation or blanks."""
    text = strip_accents(F.lower(F.coalesce(region, F.lit(""))))
    for token in ("d.c.", "dc", ",", "."):
        text = F.replace(text, F.lit(token), F.lit(""))
    return F.regexp_replace(text, SPACE, "")


def name_clean(name: Column) -> Column:
    """Display name without commas, doubled blanks or trailing hyphens; null becomes ''."""
    text = squeeze(F.replace(F.coalesce(name, F.lit("")), F.lit(","), F.lit("")))
    return F.trim(F.regexp_replace(text, "-+$", ""))


def match_fold(name: Column) -> Column:
    """Name key for list matching: no case or accents, hyphens read as blanks."""
    text = strip_accents(F.lower(F.coalesce(name, F.lit(""))))
    return squeeze(F.replace(text, F.lit("-"), F.lit(" ")))


def fold_literal(text: str) -> str:
    """Driver-side twin of :func:`match_fold` for short constant lists."""
    parts = unicodedata.normalize("NFD", text.lower())
    bare = "".join(c for c in parts if unicodedata.category(c) != "Mn")
    return " ".join(bare.replace("-", " ").split())
