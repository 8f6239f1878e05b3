"""Incremental ingestion: files as they come, each handled once."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, schema, files_a_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def processed(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, key: str = "file_id") -> StreamingQuery:
    """Runs ``transform`` over each batch's keys that no earlier batch had, and appends the result; ends when none is left.

    A batch's part lies in a folder of its own (``batch=n``) that a repeated batch puts
    in place anew, so a batch that failed half-way leaves nothing twice. Of repeated
    keys in a batch one row stays. Only the key column of earlier parts is read.
    """

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        new = rows.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(output)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            done = spark.read.schema(f"{key} {dict(rows.dtypes)[key]}, batch long").parquet(output).filter(F.col("batch") != n)
            new = new.join(done.select(key), key, "left_anti")
        transform(new).write.mode("overwrite").parquet(f"{output}/batch={n}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by kind and window; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count(F.lit(1)).alias("n"))
