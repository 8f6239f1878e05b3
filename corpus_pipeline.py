"""The corpus pipeline: documents go through these stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept:
rejected by quality rules or toxicity, one document of each near-duplicate class,
secrets masked in the text, and at last the pieces of packed sequences.

Defined cases: null texts fail the quality rules, so none comes further; null and
repeated ids are rows like others, until one row of each class of near-duplicates
stays; texts of any length are read whole; columns of any name go through all stages
but the last; an empty table gives no piece. A stage runs when it is called, and what
it needs of the corpus (counts, labels, links) is of the rows that it gets.
"""

import uuid

from pyspark.sql import functions as F

from lexforge.llm import jaccard, packing, quality, secrets, toxicity
from lexforge.llm.common import shared_dir, table


def quality_stage(spark, docs, sf_dir):
    """Documents that the rules keep, without lines above the limits."""
    return quality.filtered(docs)


def toxicity_stage(spark, docs, sf_dir):
    """Documents that aren't predicted toxic; weights from labelled documents among these."""
    return toxicity.filtered(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark, docs, sf_dir):
    """One document of each near-duplicate class."""
    return jaccard.deduplicated(docs)


def secrets_stage(spark, docs, sf_dir):
    """The documents with secrets masked."""
    return secrets.redacted(docs)


def packing_stage(spark, docs, sf_dir):
    """Pieces in sequences of 2048 ids, with their ids."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: Signatures, learned weights and vocabulary files have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; what lies between is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/lexforge/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        made.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
