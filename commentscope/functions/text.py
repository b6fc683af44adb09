"""Text cleaning and tokens, all as built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DIGITS, LETTERS

# Whitespace of Java's \s except the plain space, which always separates tokens.
INNER_WHITESPACE = r"\t\n\x0B\f\r"


def clean_text(text: Column, *, keep_digits: bool = True) -> Column:
    """Lower case, with one space for every character outside the kept alphabet and whitespace."""
    kept = LETTERS + (DIGITS if keep_digits else "")
    return F.regexp_replace(F.lower(text), rf"[^{kept}\s]", " ")


def tokens(
    text: Column,
    *,
    min_length: int = 1,
    keep_digits: bool = True,
    join_lines: bool = False,
) -> Column:
    """Non-empty tokens of the cleaned text that have at least `min_length` characters.

    A token is a longest run of kept characters, so one matching pass replaces cleaning,
    splitting and filtering. With `join_lines`, only the plain space and dropped characters
    separate: words on both sides of a line break or tab stay one token.
    """
    kept = LETTERS + (DIGITS if keep_digits else "") + (INNER_WHITESPACE if join_lines else "")
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{kept}]{{{min_length},}}"), F.lit(0))
