"""Names of documents: cleaning, filtering, one of each, statistics."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions import names as N
from lexforge.functions import text as X


def cleaned(names: DataFrame) -> DataFrame:
    """Names (file_id, name_index, normalized_name, original_text, role, confidence) with clean_name, role and why they go.

    verdict: null (stays), garbage or low_confidence. A form is cleaned and judged once,
    however often it occurs; ``names`` is computed twice, so it should be at hand.
    """
    base = F.coalesce(F.nullif(F.col("normalized_name"), F.lit("")), F.nullif(F.col("original_text"), F.lit("")), F.lit(""))
    rows = names.withColumn("_base", base)
    forms = X.once(rows.select("_base").distinct(), clean_name=N.clean(F.col("_base")))
    rows = rows.join(X.once(forms, _garbage=N.is_garbage(F.col("clean_name"))), "_base")
    rows = rows.withColumn("verdict", F.when(F.col("_garbage"), F.lit("garbage")).when(~N.confident(F.col("confidence")), F.lit("low_confidence"))).drop("_base", "_garbage")
    return rows.withColumns({"was_remapped": N.role(F.col("role")) != F.coalesce("role", F.lit("")), "role": N.role(F.col("role"))})


def one_of_each(names: DataFrame, name: str = "clean_name") -> DataFrame:
    """Of a file's names that differ in case alone, the one of the best role, then the first."""
    w = Window.partitionBy("file_id", F.lower(name)).orderBy(N.priority(F.col("role")), "name_index")
    return names.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def clean_files(names: DataFrame) -> DataFrame:
    """The names that stay."""
    return one_of_each(cleaned(names).filter("verdict IS NULL")).drop("verdict", "was_remapped")


def statistics(names: DataFrame) -> DataFrame:
    """One row over all files: names before and after, and why the others went."""
    rows = cleaned(names)
    before = rows.agg(
        F.count(F.lit(1)).alias("total_names"), F.count_if(F.col("verdict").isNotNull()).alias("garbage_names"), F.count_if(F.col("verdict").isNull() & F.col("was_remapped")).alias("roles_remapped"),
        F.count_if(F.col("verdict").isNull()).alias("_left"),
    )
    after = one_of_each(rows.filter("verdict IS NULL")).agg(F.count(F.lit(1)).alias("kept_names"))
    return before.join(after).withColumn("deduplicated", F.col("_left") - F.col("kept_names")).drop("_left")


def lookup(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Names of files by (priority, name): of the cleaned artefact where there is one, else of the raw one."""
    rest = raw.join(clean.select("file_id").distinct(), "file_id", "left_anti")
    label = F.coalesce(F.nullif(F.col("normalized_name"), F.lit("")), F.col("original_text"))
    both = clean.unionByName(rest, allowMissingColumns=True).withColumn("name", label).filter(F.coalesce("name", F.lit("")) != "")
    rows = one_of_each(both, "name")
    return rows.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(N.priority(F.col("role")).alias("priority"), "name", "role"))).alias("names"))


def uncleaned(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Files with names, but without cleaned ones."""
    return raw.select("file_id").distinct().join(clean.select("file_id"), "file_id", "left_anti")
