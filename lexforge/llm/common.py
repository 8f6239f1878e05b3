"""Shared pieces of the operators: tables in the cluster's shared folder, arrow helpers."""

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step of a Python worker handles at a time.
STEP_BYTES = 12 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and all runs on one machine (tests)."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        told = f"/tmp/lexforge-{os.getuid()}-{spark.sparkContext.applicationId}"
    return told.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it again.

    The table takes the place of a checkpoint: it cuts the lineage, it is smaller
    than serialised rows, and a lost executor takes nothing with it. Files stay
    until ``clear_written`` or the end of the cluster's own retention.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexforge/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Deletes every table that ``written`` left; only when no result is still to be read."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lexforge")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_broadcast(small: DataFrame, most_rows: int) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is (shuffle join)."""
    return F.broadcast(small) if small.limit(most_rows + 1).count() <= most_rows else small


#: Rows from which a key is hot, and the most hot keys that are broadcast.
HOT_ROWS, MOST_HOT = 1024, 1 << 20


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row a key and, as ``size``, the rows that have the key.

    Hot keys are few, as each has many rows: they are broadcast after a look at their
    number, so that no key lands in a task as a whole. ``size`` is dropped.
    """
    hot = keyed.filter(F.col(size) > HOT_ROWS)
    n = hot.limit(MOST_HOT + 1).count()
    if not 0 < n <= MOST_HOT:  # beyond the bound, the engine's own handling of skew
        return rows.join(keyed.drop(size), key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.filter(F.col(size) <= HOT_ROWS).drop(size), key)
    return rows.join(F.broadcast(hot.drop(size)), key).unionByName(cold)


def slices(texts: pa.Array, step: int = STEP_BYTES):
    """(begin, end) ranges of rows with about ``step`` bytes of text; a longer text stands alone."""
    n = len(texts)
    if not n:
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < n:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + step, side="right")))
        yield begin, end
        begin = end


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings, with null as the empty text."""
    return pa.compute.fill_null(batch.column(name).cast(pa.string()), "")


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` (``lengths`` in items) as one binary array, without copies."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths * data.itemsize, out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("over 2 GB in one Arrow batch")
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def binary_data(array: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary array without nulls as one numpy array, and the items of each value."""
    if not len(array):
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int32, count=len(array) + 1, offset=array.offset * 4)
    buffer = array.buffers()[2]
    raw = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    item = np.dtype(dtype).itemsize
    return np.frombuffer(raw.tobytes(), dtype), np.diff(offsets).astype(np.int64) // item


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after another, in 32 bits where they fit."""
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    if len(lengths) and lengths.min() == 0:
        some = lengths > 0
        starts, lengths = starts[some], lengths[some]
    if not len(lengths):
        return np.zeros(0, np.int64)
    lasts = starts + lengths - 1
    ends = np.cumsum(lengths)
    # steps of one, but from the last of a range to the next one's start
    out = np.ones(ends[-1], np.int32 if lasts.max() < 1 << 30 else np.int64)
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - lasts[:-1]
    return np.cumsum(out, out=out)
