"""Hash keys, hash diffs and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config


def canonical(name: str, dtype: T.DataType) -> Column:
    """One text form per value, independent of engine rendering rules."""
    col = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.cast("decimal(18,4)").cast("string")
    return col.cast("string")


def _digest(df: DataFrame, columns: Sequence[str], null_token: str) -> Column:
    parts = [F.coalesce(canonical(c, df.schema[c].dataType), F.lit(null_token)) for c in columns]
    return F.sha2(F.concat_ws(config.KEY_SEPARATOR, *parts), config.HASH_BITS)


def hash_key(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of the business key parts; NULL counts as the empty string."""
    return _digest(df, columns, config.KEY_NULL_TOKEN)


def hash_diff(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of descriptive columns; NULL differs from the empty string."""
    return _digest(df, columns, config.DIFF_NULL_TOKEN)


def surrogate_key(df: DataFrame, *columns: str, null_token: str = config.KEY_NULL_TOKEN) -> Column:
    """Dimension and fact keys; same digest with a sentinel of its own choice."""
    return _digest(df, columns, null_token)


def packed(digest: Column) -> Column:
    """A digest as its bytes: half of its hex text, which does not compress, in what is exchanged. Equality and order are those of the text."""
    return F.unhex(digest)


def unpacked(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_id(*columns: Column) -> Column:
    """Replayable replacement for a random row id."""
    parts = [F.coalesce(c.cast("string"), F.lit(config.DIFF_NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(config.KEY_SEPARATOR, *parts), config.HASH_BITS)


def has_key(*columns: str) -> Column:
    """True when every key part is present and not blank."""
    test = F.lit(True)
    for name in columns:
        text = F.col(name).cast("string")
        test = test & text.isNotNull() & (F.trim(text) != "")
    return test
