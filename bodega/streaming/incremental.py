"""The incremental load as a stream that stops when it has caught up: the stream checkpoint plays the
part of the control table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    target: str,
    clean: Callable[[DataFrame], DataFrame],
    batch_column: str = "lote",
) -> StreamingQuery:
    """Clean every parquet file under `source` not seen before and add it to `target`.

    A batch is written to its own partition with overwrite, so a batch repeated after a failure
    replaces itself instead of adding its rows twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{target}/{batch_column}={number}")

    return (
        spark.readStream.schema(schema).parquet(source).writeStream
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
