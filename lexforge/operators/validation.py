"""Stored names against their sources."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import text as X


def issues(names: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Every stored name (file_id, name_index, original_text, start, end) with issue_type, null where it holds.

    missing_offsets, out_of_bounds, then mismatch; a name without a source holds.
    """
    joined = names.join(docs.select("file_id", F.col(text).alias("_t")), "file_id", "left")
    start, end = F.col("start"), F.col("end")
    actual = F.substring(F.col("_t"), start + 1, end - start)
    issue = (
        F.when(start.isNull() | end.isNull(), F.lit("missing_offsets"))
        .when(F.col("_t").isNull(), F.lit(None))
        .when((start < 0) | (end > F.length("_t")) | (start >= end), F.lit("out_of_bounds"))
        .when((X.strip(actual) != X.strip(F.col("original_text"))) & (X.squeezed(actual) != X.squeezed(F.col("original_text"))), F.lit("mismatch"))
    )
    return joined.withColumn("issue_type", issue).drop("_t")


def report(checked: DataFrame) -> DataFrame:
    """files, names, valid and invalid names, files with issues."""
    return checked.agg(
        F.count_distinct("file_id").alias("total_files"), F.count(F.lit(1)).alias("total_names"), F.count_if(F.col("issue_type").isNull()).alias("valid_names"),
        F.count_if(F.col("issue_type").isNotNull()).alias("invalid_names"), F.count_distinct(F.when(F.col("issue_type").isNotNull(), F.col("file_id"))).alias("files_with_issues"),
    )


def by_type(checked: DataFrame) -> DataFrame:
    return checked.filter("issue_type IS NOT NULL").groupBy("issue_type").agg(F.count(F.lit(1)).alias("n"))


def fixed(checked: DataFrame) -> DataFrame:
    """Without names that have an issue, and total_names, of those that stay, counted anew."""
    left = checked.filter("issue_type IS NULL").drop("issue_type")
    n = left.groupBy(F.col("file_id").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    return left.join(n, F.col("file_id").eqNullSafe(F.col("_of"))).withColumn("total_names", F.col("_n")).drop("_of", "_n")


def valid_files(files: DataFrame) -> DataFrame:
    """Whether an output (file_id, source_file, total_names, names array) is whole."""
    ok = F.col("source_file").isNotNull() & F.col("total_names").isNotNull() & F.col("names").isNotNull() & (F.size("names") == F.col("total_names"))
    return files.select("file_id", F.coalesce(ok, F.lit(False)).alias("is_valid"))
