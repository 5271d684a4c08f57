"""Text cleansing and casts with defaults."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: characters that end a word, besides white space
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def capitalise_words(col: Column) -> Column:
    """Upper-case the first letter of each word; punctuation ends a word too."""
    escaped = "".join("\\" + ch for ch in WORD_BREAKS)
    pieces = F.split(col, f"(?<=[\\s{escaped}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 2**31 - 1)))),
        "",
    )


def clean_upper(name: str) -> Column:
    return F.trim(F.upper(F.col(name)))


def clean_lower(name: str) -> Column:
    return F.trim(F.lower(F.col(name)))


def clean_words(name: str) -> Column:
    return F.trim(capitalise_words(F.col(name)))


def safe_cast(col: Column, target: str, default: Any = None) -> Column:
    """Cast, or the default where the value does not convert."""
    tried = col.try_cast(target)
    return tried if default is None else F.coalesce(tried, F.lit(default).cast(target))
