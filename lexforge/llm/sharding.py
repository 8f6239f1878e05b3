"""Sharding: weighted rendezvous hashing of stable record keys.

Every shard bids for a key with -weight / ln(u), u in (0, 1) from a hash of the key
and the shard's name; the highest bid takes the key, ties go to the earlier shard.
One more shard only adds a bid, so a record either stays or goes to the new shard.
All of it is one projection: no shuffle decides a shard.

Slots (gapless from 0 in every shard) come from two levels: rows are numbered within
(part of the input, shard), and prefix sums over the parts' counts shift them. A
part is as large as a scan task, whatever keys repeat in it.

Defined cases: a null key is a key of its own; a null text has no bytes and the crc
of the empty text; repeated rows each have a slot; equal bids go to the earlier shard;
a text of any length is one row, read whole for its size and crc; an empty table gives
no row; other columns are ignored. Counts of slots are written when the function is called.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import table, written

LAW = "key"


def bid(key: Column, shard: str, weight: float) -> Column:
    """The bid of one shard for the key: a double, higher wins."""
    hashed = F.xxhash64(key, F.lit(shard))
    u = (F.shiftrightunsigned(hashed, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.lit(-float(weight)) / F.log(u)


def rendezvous(key: Column, shards: dict[str, float] | int) -> Column:
    """The position of the key's shard. shards: names with weights over 0, or a count of equal shards 0, 1, ..."""
    named = {str(i): 1.0 for i in range(shards)} if isinstance(shards, int) else shards
    if not named or min(named.values()) <= 0:
        raise ValueError("shards need weights over 0")
    bids = F.array(*(F.struct(bid(key, name, w).alias("bid"), F.lit(-i).alias("back")) for i, (name, w) in enumerate(named.items())))
    return (-F.array_max(bids)["back"]).cast("int")


def shard(docs: DataFrame, shards: dict[str, float] | int = 8, grown: dict[str, float] | int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and, where ``grown`` is given, grown_shard."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    key = F.col("doc_id").cast("long")
    at = F.monotonically_increasing_id()
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        rendezvous(key, shards).alias("shard"),
        *([rendezvous(key, grown).alias("grown_shard")] if grown else []),
        F.shiftright(at, 33).cast("int").alias("part"),
        at.alias("at"),
    )
    rows = written(rows, "shards")  # the numbers of parts and rows hold from here on
    counts = rows.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("part", "shard").orderBy("at")) - 1
    return (
        rows.withColumn("within", within)
        .join(bases, ["part", "shard"])
        .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("base") + F.col("within")).cast("long").alias("slot"), *(["grown_shard"] if grown else []))
    )


def op2_query(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), 8, 9)
