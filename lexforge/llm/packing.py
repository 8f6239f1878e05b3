"""Packing: concatenate and cut.

Pass one encodes every document where it lies and keeps, beside the ids, each
document's offset within its partition. Prefix sums over the partitions' totals
(a row a partition) give every partition's global offset. Pass two adds the two and
cuts the one long stream of ids into windows of ``window`` ids. No id is shuffled;
only windows that cross the border of two partitions need a record from each, and
only those are brought together by ``sequences``.

Defined cases: a null text counts as empty (its document is its end id alone); null
or repeated doc_ids are rows like others, and equal texts lie where their rows do; a
text of any length is encoded whole and cut into as many windows as it takes; an empty
table gives no piece; columns other than the two that are named are ignored. Only the last sequence of all is
shorter than ``window``.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, binary_data, bounded_broadcast, slices, text_column, written
from lexforge.llm.tokens import encoder, vocabulary_path, with_end

#: A row a partition of 24 bytes: 24 MB at most are broadcast.
MOST_BROADCAST_PARTITIONS = 1_000_000

ENCODED = "doc_id long, part int, local_start long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, boundary boolean, ids binary"


def encoded(docs: DataFrame, path: str, keeps_space: bool, end_id: int | None) -> DataFrame:
    """doc_id, part (the partition), local_start (ids before it in the partition), doc_tokens, ids (uint16 or uint32)."""

    def run(batches):
        tokens, part, at = encoder(path, keeps_space), TaskContext.get().partitionId(), 0
        narrow = np.uint16 if tokens.library.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            texts = text_column(batch)
            for i, j in slices(texts):
                ids, counts = with_end(*tokens.encode(texts.slice(i, j - i)), end_id)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.full(j - i, part, np.int32)), pa.array(at + ends - counts), pa.array(counts), binary_array(ids.astype(narrow), counts)],
                    ["doc_id", "part", "local_start", "doc_tokens", "ids"],
                )
                at += int(ends[-1])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def offsets_of(parts: DataFrame) -> DataFrame:
    """(part, total) to (part, base, total): the prefix sums of the partitions' totals, and the end of all as ``stream``."""
    w = Window.orderBy("part")
    return parts.select("part", "total", (F.sum("total").over(w) - F.col("total")).alias("base"), F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("stream"))


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = 2048, end_id: int | None = 1, keeps_space: bool = True) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) in sequences of ``window`` ids.

    doc_id, start (ids of the document before the piece), length, doc_tokens,
    sequence_id, offset (in the sequence), boundary (whether the sequence holds
    pieces of several partitions), ids (little-endian uint32).
    """
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")
    rows = written(encoded(docs, path, keeps_space, end_id), "packed-ids")
    parts = written(offsets_of(rows.groupBy("part").agg(F.sum("doc_tokens").alias("total"))), "packed-offsets")

    def cut(batches):
        from lexforge.llm.tokens import encoder as of

        narrow = np.uint16 if of(path, keeps_space).library.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            ids, _ = binary_data(batch.column("ids"), narrow)
            n, base, total, stream = (np.asarray(batch.column(x), dtype=np.int64) for x in ("doc_tokens", "base", "total", "stream"))
            begin = base + np.asarray(batch.column("local_start"), dtype=np.int64)
            first = begin // window
            pieces = np.where(n > 0, (begin + n - 1) // window - first + 1, 0)
            of_doc = np.repeat(np.arange(len(n)), pieces)
            sequence = first[of_doc] + np.arange(len(of_doc)) - (np.cumsum(pieces) - pieces)[of_doc]
            left = np.maximum(sequence * window, begin[of_doc])
            right = np.minimum((sequence + 1) * window, (begin + n)[of_doc])
            boundary = (sequence * window < base[of_doc]) | (np.minimum((sequence + 1) * window, stream[of_doc]) > (base + total)[of_doc])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of_doc)), *(pa.array(x) for x in (left - begin[of_doc], right - left, n[of_doc], sequence, left - sequence * window, boundary)), binary_array(ids.astype(np.uint32), right - left)],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "boundary", "ids"],
            )

    return rows.join(bounded_broadcast(parts, MOST_BROADCAST_PARTITIONS), "part").mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_ids, ids (little-endian uint32) of the pieces of ``pack``; a group holds one window at most."""
    got = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.array_join(F.transform(got, lambda x: F.hex(x["ids"])), "")
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.unhex(hexed).alias("ids"))


def op1_query(spark, sf_dir: str) -> DataFrame:
    from lexforge.llm.common import table

    return digest(pack(table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
