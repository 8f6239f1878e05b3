"""Tables in the cluster's shared folder, and small inputs dealt over the cores."""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: An input of fewer bytes a core is dealt anew.
SPREAD_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and all runs on one machine."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        told = f"/tmp/lexforge-{os.getuid()}-{spark.sparkContext.applicationId}"
    return told.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it again: later uses don't compute it anew, and a lost executor takes nothing with it.

    The job runs when this is called. Tables stay until ``clear_written`` or the cluster's own retention.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexforge-core/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Deletes every table that ``written`` left; only when no result is still to be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lexforge-core")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small input, which may be one row group, dealt over the cores; a larger one stays as it is split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df
