"""Exact top-k search: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights (a term is a dimension). They are packed
into blocks; a block of candidates is turned into postings, term by term. For a few
queries at a time, each of their terms scatters weight times posting into the
queries' rows of a dense score array over the block. A partition selection keeps the
block's k best, and the k best of all blocks seen so far are merged as they come, so
a task returns k rows a query. Scores are 64-bit integers, so sums are exact.

Queries are a stated set. They go against all rows in blocks: candidate blocks stay
where they lie, and batches of queries of a bounded size (``batch_bytes``) are sent to
them, a job a batch. A task keeps the k best of each query over all its blocks, so k
rows a query and task are shuffled, to a last merge.

Defined cases: vectors that are null, or hold a null or non-finite component, and
rows without an id take no part; vectors may differ in length (a missing component
is 0); an empty vector scores 0. Repeated ids are rows like others: a query leaves
out its own row only. Ties go to the smaller id, and among equal ids to the earlier
row. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, binary_data, ragged, table, written

BLOCK_ROWS = 2048
#: Terms and weights of the queries that are sent out together.
BATCH_BYTES = 32 << 20
#: Queries whose scores over a block are in memory together.
TOGETHER = 16

BLOCKS = "block long, ids binary, lengths binary, terms binary, weights binary"
FOUND = "query_id long, query_block long, query_at long, vec_id long, block long, at long, score long"


def sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, terms of each row, terms and integer weights other than 0 of a batch (id, vector) without nulls."""
    ids = np.asarray(batch.column("id"), dtype=np.int64)
    vectors = batch.column("vector")
    offsets = np.asarray(vectors.offsets, dtype=np.int64)
    weights = np.asarray(vectors.flatten(), dtype=np.int64)
    sizes = np.diff(offsets)
    terms = ragged(np.zeros(len(ids), np.int64), sizes)
    some = weights != 0
    rows = np.repeat(np.arange(len(ids)), sizes)[some]
    return ids, np.bincount(rows, minlength=len(ids)), terms[some], weights[some]


def blocks(vectors: DataFrame) -> DataFrame:
    """(id, vector array<long>) packed into rows of up to BLOCK_ROWS sparse vectors."""

    def pack(batches):
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                ids, lengths, terms, weights = sparse(batch.slice(i, BLOCK_ROWS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), *(binary_array(x.astype(np.int64), np.array([len(x)])) for x in (ids, lengths, terms, weights))], ["block", "ids", "lengths", "terms", "weights"]
                )
                at += 1

    return vectors.mapInArrow(pack, BLOCKS)


def unpacked(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, ...]:
    return tuple(binary_data(batch.column(x).slice(row, 1), np.int64)[0] for x in ("ids", "lengths", "terms", "weights"))


class Postings:
    """A candidate block by terms."""

    def __init__(self, ids, lengths, terms, weights):
        self.ids = ids
        order = np.argsort(terms, kind="stable")
        rows = np.repeat(np.arange(len(ids)), lengths)[order]
        names, starts = np.unique(terms[order], return_index=True)
        ends = np.append(starts, len(terms))[1:]
        w = weights[order]
        self.most = int(np.abs(w).max()) if len(w) else 0
        # a term that every vector holds needs no row numbers: its postings are the whole column
        self.lists = {int(t): (None if e - s == len(ids) else rows[s:e], w[s:e]) for t, s, e in zip(names, starts, ends, strict=True)}

    def accumulate(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, scores: np.ndarray) -> None:
        """Adds products, term by term, to the dense scores of a few queries: query ``at[i]`` has ``terms[i]`` with ``weights[i]``."""
        order = np.argsort(terms, kind="stable")
        names, starts = np.unique(terms[order], return_index=True)
        weights = weights.astype(scores.dtype)
        for term, mine in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
            if (got := self.lists.get(term)) is not None:
                rows, w = got[0], got[1].astype(scores.dtype)
                if rows is None and len(mine) == len(scores):
                    scores += weights[mine, None] * w  # a query has a term once, and ``mine`` is in the queries' order
                elif rows is None:
                    scores[at[mine]] += weights[mine, None] * w
                else:
                    scores[at[mine][:, None], rows] += weights[mine, None] * w


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, by score downwards, then id, then position: selection first, order after."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        over, even = np.flatnonzero(scores > limit), np.flatnonzero(scores == limit)
        need = k - len(over)
        if len(even) > need:
            even = even[np.lexsort((even, ids[even]))[:need]]
        at = np.concatenate([over, even])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, ids[at], -scores[at]))]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best of all other rows.

    vectors: id long, vector array<long>, without nulls; is_query: over ``id``. The
    search runs, a job for each batch of queries, when this is called.
    """
    packed = written(blocks(vectors), "vector-blocks")
    # the queries as rows of their own: their place in a candidate block tells them from equal rows
    asked = packed.mapInArrow(_unblocked, "id long, block long, at long, terms array<long>, weights array<long>").filter(is_query)
    asked = written(asked, "queries")
    n, terms = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    n_batches = max(1, -(-(24 * n + 16 * terms) // batch_bytes))
    found = []
    for batch in range(n_batches):
        queries = asked.filter(F.pmod(F.xxhash64("block", "at"), F.lit(n_batches)) == batch).orderBy("id", "block", "at").toArrow() if n else None
        if queries is not None and len(queries):
            found.append(written(packed.mapInArrow(_search(_arrays(queries), k), FOUND), "found"))
    if not found:
        found = [packed.limit(0).mapInArrow(_search(None, k), FOUND)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    w = Window.partitionBy("query_block", "query_at").orderBy(F.desc("score"), "vec_id", "block", "at")
    return every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _arrays(queries: pa.Table) -> dict[str, np.ndarray]:
    """A batch of queries as plain arrays; they go out with the search's function, which Spark broadcasts."""
    table = queries.combine_chunks()
    lists = table.column("terms").combine_chunks()
    out = {c: np.asarray(table.column(c), dtype=np.int64) for c in ("id", "block", "at")}
    out["starts"] = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    return out | {c: np.asarray(pc.list_flatten(table.column(c).combine_chunks()), dtype=np.int64) for c in ("terms", "weights")}


def _unblocked(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            ids, lengths, terms, weights = unpacked(batch, row)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            block = batch.column("block")[row].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids))), pa.ListArray.from_arrays(offsets, pa.array(terms)), pa.ListArray.from_arrays(offsets, pa.array(weights))],
                ["id", "block", "at", "terms", "weights"],
            )


def _search(queries: dict[str, np.ndarray] | None, k: int):
    """A task's search: the k best candidates of each query among the task's blocks; a block is in memory at a time."""

    def run(batches):
        n = 0 if queries is None else len(queries["id"])
        kept = [tuple(np.zeros(0, np.int64) for _ in range(4)) for _ in range(n)]
        for batch in batches:
            for row in range(batch.num_rows if n else 0):
                block = batch.column("block")[row].as_py()
                postings = Postings(*unpacked(batch, row))
                every = np.arange(len(postings.ids))
                for i in range(0, n, TOGETHER):
                    j = min(i + TOGETHER, n)
                    own = slice(queries["starts"][i], queries["starts"][j])
                    # 32 bits where no sum of products can pass them: exact as well, and half the work
                    longest = int(np.diff(queries["starts"][i : j + 1]).max())
                    bound = postings.most * int(np.abs(queries["weights"][own]).max(initial=0)) * longest
                    scores = np.zeros((j - i, len(every)), np.int32 if bound < 1 << 31 else np.int64)
                    of = np.repeat(np.arange(j - i), np.diff(queries["starts"][i : j + 1]))
                    postings.accumulate(of, queries["terms"][own], queries["weights"][own], scores)
                    for q in range(i, j):
                        ids, at, got = postings.ids, every, scores[q - i]
                        if queries["block"][q] == block:
                            other = at != queries["at"][q]
                            ids, at, got = ids[other], at[other], got[other]
                        here = best(got, ids, k)
                        merged = [np.concatenate(x) for x in zip(kept[q], (got[here].astype(np.int64), ids[here], np.full(len(here), block), at[here]), strict=True)]
                        order = np.lexsort((merged[3], merged[2], merged[1], -merged[0]))[:k]
                        kept[q] = tuple(x[order] for x in merged)
        counts = [len(x[0]) for x in kept]
        if sum(counts):
            score, ids, block, at = (np.concatenate(x) for x in zip(*kept, strict=True))
            of = [pa.array(np.repeat(queries[c], counts)) for c in ("id", "block", "at")]
            yield pa.RecordBatch.from_arrays([*of, pa.array(ids), pa.array(block), pa.array(at), pa.array(score)], ["query_id", "query_block", "query_at", "vec_id", "block", "at", "score"])

    return run


def integer_vectors(frame: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, embedding) to (id, vector) with floor(scale * x); rows that can't take part are left out."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return frame.filter(F.col("vec_id").isNotNull() & v.isNotNull() & fine).select(F.col("vec_id").cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x)).alias("vector"))


def op8_query(spark, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) <= 5
"""
