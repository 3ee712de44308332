"""Keeps a keyed table up to date with a stream of its changed rows: the last change of a key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.operators.relational import keep_first, upserted


def latest(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    return keep_first(changes, keys, [F.desc(order), F.xxhash64(*[F.col(c) for c in changes.columns])])


def keep_table(changes: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that writes the table's state after each batch to path/version=<batch>."""

    def apply(batch: DataFrame, number: int) -> None:
        new, spark = latest(batch, keys, order), batch.sparkSession
        state = upserted(spark.read.parquet(f"{path}/version={number - 1}"), new, keys) if number else new
        state.write.mode("overwrite").parquet(f"{path}/version={number}")

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).start()
