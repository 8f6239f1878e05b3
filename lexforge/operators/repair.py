"""Repair of names by a model: batches, prompts, and what a reply decides."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions import names
from lexforge.functions import text as X

# Sizes and budgets of repair batches.
BATCH, PER_NAME, OVERHEAD, MOST_OUTPUT = 80, 15, 50, 1024
REPLY = "array<struct<index:int,name:string>>"


def batched(valid: DataFrame, batch: int = BATCH) -> DataFrame:
    """Names that need repair, with batch_id, index in the batch, and the batch's output budget."""
    size = min(batch, (MOST_OUTPUT - OVERHEAD) // PER_NAME)
    w = Window.partitionBy("file_id").orderBy("start", "end")
    rows = valid.filter("error IS NULL AND needs_repair").withColumn("_n", F.row_number().over(w) - 1)
    rows = rows.withColumns({"batch_id": F.floor(F.col("_n") / size).cast("int"), "index": (F.col("_n") % size).cast("int")}).drop("_n")
    n = F.count(F.lit(1)).over(Window.partitionBy("file_id", "batch_id"))
    return rows.withColumn("output_budget", F.least(F.lit(MOST_OUTPUT), n * PER_NAME + OVERHEAD))


def prompts(valid: DataFrame) -> DataFrame:
    """file_id, batch_id, output_budget, names (JSON of index and text)."""
    return batched(valid).groupBy("file_id", "batch_id").agg(F.max("output_budget").alias("output_budget"), F.to_json(F.array_sort(F.collect_list(F.struct("index", F.col("verified_text").alias("text"))))).alias("names"))


def decided(valid: DataFrame, replies: DataFrame) -> DataFrame:
    """All valid names by start, with normalized_name and was_repaired. replies: file_id, batch_id, reply.

    A name without a reply, or with a blank one, takes its basic normal form; one that
    was sent counts as repaired in either case.
    """
    got = replies.select("file_id", "batch_id", F.posexplode(F.from_json(F.regexp_extract("reply", r"(\[[\s\S]*\])", 1), REPLY)).alias("place", "item"))
    last = Window.partitionBy("file_id", "batch_id", "index").orderBy(F.desc("place"))
    got = got.withColumn("index", F.coalesce("item.index", "place")).withColumn("_n", F.row_number().over(last)).filter("_n = 1").select("file_id", "batch_id", "index", "item.name")
    sent = batched(valid).join(got, ["file_id", "batch_id", "index"], "left")
    basic = names.basic_normal(F.col("verified_text"))
    mended = sent.withColumns({"normalized_name": F.coalesce(F.nullif(X.squeezed(F.col("name")), F.lit("")), basic), "was_repaired": F.lit(True)}).drop("name", "batch_id", "index", "output_budget")
    clean = valid.filter("error IS NULL AND NOT needs_repair").withColumns({"normalized_name": basic, "was_repaired": F.lit(False)})
    return clean.unionByName(mended)
