"""Work discovery and incremental runs: pending files, blocks, manifests, gates."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.sources.shared import written

# Suffixes of artefacts; files with one of them are no input.
OUTPUT_SUFFIXES = ["_names.json", "_names_llm.json", "_ner.json", "_clean.json", "_names_clean.json", "_summary.json"]
SUMMARY_SUFFIXES = ["_names.json", "_names_clean.json", "_summary.json"]
SKIP_LENGTH, SKIP_NOISE = 200, 0.15


def is_input(path: Column, suffixes=tuple(OUTPUT_SUFFIXES)) -> Column:
    out = path.endswith(".json")
    for s in suffixes:
        out = out & ~path.endswith(s)
    return out


def stem(path: Column, suffix: str = ".json") -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), rf"\Q{suffix}\E$", "")


def pending(inputs: DataFrame, outputs: DataFrame, key: str = "stem") -> DataFrame:
    """Input stems without an output."""
    return inputs.select(key).distinct().join(outputs.select(key), key, "left_anti")


def assigned(rows: DataFrame, workers: int, key: str = "stem") -> DataFrame:
    """Adds worker: contiguous slices of ceil(n / workers) in order; the last workers may get none.

    A row's place comes from its range's first place and its number within the range
    (ranges by a sort's own sampling), so no task numbers all rows. The numbered rows
    are written when this is called.
    """
    ranged = written(rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_id", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_id", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    sizes = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    placed = ranged.withColumn("_part", part).join(F.broadcast(sizes), "_part")
    place = F.col("_base") + F.col("_id") - F.col("_first")
    return placed.withColumn("worker", F.floor(place / F.ceil(F.col("_total") / workers)).cast("int")).drop("_id", "_part", "_first", "_base", "_total")


def suspicious(inputs: DataFrame, outputs: DataFrame, key: str = "stem") -> DataFrame:
    """One row: nothing is pending, yet there are fewer outputs than half the inputs."""
    n = pending(inputs, outputs, key).agg(F.count(F.lit(1)).alias("pending"))
    counts = inputs.agg(F.count_distinct(key).alias("inputs")).join(outputs.agg(F.count_distinct(key).alias("outputs"))).join(n)
    return counts.withColumn("warning", (F.col("pending") == 0) & (F.col("outputs") < F.col("inputs") / 2))


def latest(manifest: DataFrame, key: str = "stem", seq: str = "seq") -> DataFrame:
    """The last line of each stem; sums before the shuffle keep one row a task and stem."""
    rest = [c for c in manifest.columns if c not in (key, seq)]
    top = F.max_by(F.struct(*rest), F.col(seq))
    return manifest.filter(F.col(key).isNotNull()).groupBy(key).agg(top.alias("v"), F.max(seq).alias(seq)).select(key, seq, *(F.col("v")[c].alias(c) for c in rest))


def manifest_of(ner: DataFrame, seq: int | None = None) -> DataFrame:
    """Manifest lines of NER outputs, with defaults for what is missing. seq: the run's place among all runs, by which the last line of a stem counts."""
    zero = lambda c, kind="int": F.coalesce(F.col(c).cast(kind), F.lit(0).cast(kind)).alias(c)
    return ner.select(F.col("file_id").alias("stem"), zero("person_spans"), zero("total_spans"), zero("clean_text_length"), F.round(F.coalesce(F.col("noise_score").cast("double"), F.lit(0.0)), 4).alias("noise_score"), *([] if seq is None else [F.lit(seq).cast("long").alias("seq")]))


def top(manifest: DataFrame, least: int = 0, most: int | None = None, by: str = "person_spans", limit: int | None = None) -> DataFrame:
    """Files with spans in a range, most first, ties by stem."""
    rows = manifest.filter(F.col("person_spans") >= least)
    if most is not None:
        rows = rows.filter(F.col("person_spans") <= most)
    rows = rows.orderBy(F.desc(by), "stem")
    return rows if limit is None else rows.limit(limit)


def nothing_to_do(spans: Column, length: Column, noise: Column) -> Column:
    """No spans, and a short or clean text."""
    return (spans == 0) & ((length < SKIP_LENGTH) | (noise < SKIP_NOISE))


def empty_results(gated: DataFrame) -> DataFrame:
    """A row without names for each gated file, to stand beside processed ones."""
    return gated.select("file_id", F.lit(0).alias("total_names"), F.col("total_spans"), F.lit(True).alias("skipped"))
