"""Incremental scoring of a stream of tasks: each micro-batch scores only tasks without a
stored, error-free result (the batch form is operators.joins.reusable)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomseq.operators.joins import reusable


def score_stream(tasks: DataFrame, keys: list[str], store: str, checkpoint: str, scorer: Callable[[DataFrame], DataFrame], schema: str) -> StreamingQuery:
    """Append scores of new tasks to the Parquet table at store. scorer maps tasks to rows
    of schema, which has the keys and a status column. A micro-batch writes
    a folder of its own, which a repetition after a failure overwrites."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{store}/batch={batch_id}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{store}/batch=-1")
        stored = spark.read.schema(schema + ", batch bigint").parquet(store).where(f"batch < {batch_id}")
        scorer(reusable(batch.dropDuplicates(keys), stored, keys)).write.mode("overwrite").parquet(path)

    return tasks.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
