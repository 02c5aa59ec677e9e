"""Files as streams, and the file sink.

Streams start with ``availableNow``: they work off what is there and stop.  Jobs with state take the oldest files first;
``revisions`` and ``change_log`` hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def incoming_files(
    spark: SparkSession, path: str, schema: StructType | str, *, files_per_batch: int = 150, newest_first: bool = False
) -> DataFrame:
    """Parquet files as a stream: each file once, oldest first, a budget of files per batch.

    ``newest_first`` is for jobs without state, where fresh files must not wait behind a backlog.
    """
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("latestFirst", str(newest_first).lower())
        .parquet(path)
    )


def start_ingest(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write the transformed stream to a file sink; its log makes each source file count exactly once."""
    writer = transform(stream).writeStream.format("parquet").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
