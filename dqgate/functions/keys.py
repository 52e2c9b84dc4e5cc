"""Keys for grouping and joining: small in a shuffle, safe against hot values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqgate.functions.columns import quoted

_DIGEST_BYTES = 32


def compact_key(df: DataFrame, column: str) -> Column:
    """The column as a grouping key of at most 32 bytes where it is text.

    Short texts are kept as they are. Longer ones are replaced by their SHA-256
    digest, so that grouping whole documents shuffles 32 bytes per row. Kept
    texts are shorter than a digest, so the two kinds cannot meet.
    """
    col = quoted(column)
    if isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)):
        return F.when(
            F.octet_length(col) < _DIGEST_BYTES, col.cast("binary")
        ).otherwise(F.unhex(F.sha2(col.cast("binary"), 256)))
    return col
