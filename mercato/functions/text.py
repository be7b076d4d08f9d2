"""Review text expressions: concatenation, cleaning, keyword scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_

# fixed values: the letters the review cleaner keeps (besides whitespace)
KEPT_LETTERS = "a-záàâãäéèêëíìîïóòôõöúùûüçñ"

# fixed values: accent folding applied before tokenising (accented -> plain)
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def review_text(title, message) -> Column:
    """Title + ' ' + message, trimmed; a missing title counts as ''."""
    return F.trim(F.concat(F.coalesce(col_(title), F.lit("")), F.lit(" "), col_(message)))


def clean_text(c) -> Column:
    """Lower-case, every char outside the kept letters/whitespace -> space,
    collapse whitespace runs, trim.

    Equivalently -- and in one regex pass -- every run of characters that are not
    kept letters becomes one space, then the ends are trimmed: whitespace and
    removed characters both end up as single separating spaces."""
    return F.trim(F.regexp_replace(F.lower(col_(c)), f"[^{KEPT_LETTERS}]+", " "))


def fold_accents(c) -> Column:
    return F.translate(col_(c), ACCENTED, PLAIN)
