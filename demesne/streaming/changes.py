"""Change files as a stream: every micro-batch is kept in a folder of its own, then the state is replayed.

A micro-batch that is run again overwrites its folder. Changes that come twice in different batches are one
change by their version and row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from demesne.operators.changefeed import replay


def follow(spark: SparkSession, source: str, schema: str, log: str, state: str, checkpoint: str) -> StreamingQuery:
    """Follow a folder of Parquet change files; `log` keeps all changes, `state` the replayed register at the watermark."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        replay(spark.read.parquet(log)).write.mode("overwrite").parquet(state)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
