"""Keyed upserts from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dqgate.functions.columns import quoted
from dqgate.sinks.layers import path_exists, touch, upsert


def newest(rows: DataFrame, primary_keys: Sequence[str], order_by: str) -> DataFrame:
    """The row of each key with the greatest `order_by`; of several, any one of the least text.

    Rows are brought down to one per key and task before they are shuffled. Rows without a whole key
    are all kept.
    """
    keys = [quoted(k) for k in primary_keys]
    whole = F.lit(True)
    for key in keys:
        whole = whole & key.isNotNull()
    row = F.struct(*[quoted(c) for c in rows.columns])
    order = F.struct(quoted(order_by).isNotNull(), quoted(order_by), F.xxhash64(row))
    kept = rows.where(whole).groupBy(*[k.alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, order).alias("_row"))
    return kept.select("_row.*").unionByName(rows.where(~whole))


def upsert_batch(rows: DataFrame, batch_id: int, location: str, checkpoint: str, primary_keys: Sequence[str], order_by: str) -> bool:
    """Merge one batch, unless it is known to have been merged; says whether it was.

    The number of a merged batch is kept beside the stream's checkpoint. A batch that was cut off between
    its merge and that note is merged again, which gives the same table: equal keys take equal
    values. Only rows without a whole key, which never match, would then stand twice.
    """
    note = f"{checkpoint.rstrip('/')}/_merged/{batch_id}"
    if path_exists(rows.sparkSession, note):
        return False
    upsert(rows.sparkSession, newest(rows, primary_keys, order_by), location, primary_keys)
    touch(rows.sparkSession, note)
    return True


def upsert_available(rows: DataFrame, location: str, checkpoint: str, primary_keys: Sequence[str], order_by: str) -> StreamingQuery:
    """Merge everything that has arrived into the table at `location`, then stop.

    `rows` is a stream; of rows with one key in a batch, that with the greatest `order_by` counts.
    A later call takes only what is new, and a batch that is delivered again changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, location, checkpoint, primary_keys, order_by)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
