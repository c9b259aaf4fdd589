"""Running file streams to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_landed(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100) -> DataFrame:
    """Stream of landed JSON files; ``max_files`` per batch is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has landed to a Parquet table and stop.

    Offsets are committed to the checkpoint after a batch is written, and the file sink's own log
    makes a repeated batch harmless: that replaces acknowledging messages one by one.
    """
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, handle, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand each batch with its id to ``handle``; a repeated id must overwrite its earlier output."""
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def progress(query: StreamingQuery) -> list[tuple[int, int, float]]:
    """(batch_id, rows, rows per second) of the query's latest batches; older ones are forgotten, see CountedTable."""
    return [(p["batchId"], p["numInputRows"], float(p["processedRowsPerSecond"])) for p in query.recentProgress]


class CountedTable:
    """Writes each batch and the number of its rows under the batch's id: every batch ever is counted, and once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.rows_path, self.counts_path = spark, f"{path}/rows", f"{path}/counts"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.rows_path}/batch={batch_id}")
        written = self.spark.read.schema(batch.schema).parquet(f"{self.rows_path}/batch={batch_id}")
        written.agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.counts_path}/batch={batch_id}")

    def counts(self) -> DataFrame:
        """batch, rows."""
        return self.spark.read.parquet(self.counts_path)


def batch_ids(spark: SparkSession, path: str, before: int | None = None) -> list[int]:
    """Ids of the batches (below ``before``) that wrote under ``path``, in order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return []
    ids = [int(name.removeprefix("batch=")) for name in (s.getPath().getName() for s in files.listStatus(hadoop)) if name.startswith("batch=")]
    return sorted(i for i in ids if before is None or i < before)


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written by earlier batches, or None before the first one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if files.exists(hadoop) else None
