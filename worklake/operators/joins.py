"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A hinted side is shipped whole to every executor: at most this many bytes of text form.
BROADCAST_BYTES = 8 << 20
_ROW_BYTES = 64


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows, at their text length plus a fixed cost each, stay within ``max_bytes``.

    Looked up at each call (the folder may have grown since) and reads at most
    as many rows as the bound can hold.
    """
    most = max_bytes // _ROW_BYTES
    size = df.limit(most + 1).select((F.length(F.to_json(F.struct(*df.columns))) + _ROW_BYTES).alias("b")).agg(
        F.sum("b").alias("b")).first()["b"]
    return (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df`` is small, else leave the join to the optimizer.

    Above the bound the join is a shuffle (sort-merge) join, which
    AQE may still convert at run time or split when a key is skewed.
    Callers project the side to the few columns the join needs first.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df
