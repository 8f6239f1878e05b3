"""N-gram Jaccard join by MinHash banding.

1. Every text gets the MinHash values of its set of word 5-grams; rows of ``r``
   values are hashed into ``b`` bands. (b, r) is the largest r, within a number of
   hash functions, whose recall at the threshold reaches the target.
2. Equal texts are one class; only class representatives go on.
3. A shuffle on band hashes brings representatives with an equal band together. A
   band's group isn't expanded into pairs: each member is linked to the group's
   least, and connected components of these links hold every pair that shares a band.
4. The n-gram sets of the representatives in components of two or more are made
   from their whole texts, and sent once to their component. A component of up to
   ``BLOCK`` members (or ids) is verified in one task; a larger one is cut into blocks by
   hash, and every two blocks meet in a task, so no task holds more than two blocks.
   All pairs there are verified on the full sets; what leaves the task is a row a
   member (the number of documents linked to it) and a spanning forest of the links.
5. Components of the verified links are the near-duplicate classes.

Rows that leave any step are in proportion to documents, never to pairs; what goes into
the fourth is a document's set once for each block of its component, so a component of
n different texts costs n^2 / BLOCK sets.

Words are runs of characters other than space and \\t to \\r, as they stand. A text of
one to four words has one n-gram: all its words. Defined cases: null or empty texts
have no n-grams and are linked to equal texts only; null or repeated ids are rows
like others (the class id is the least id of its rows, null if all are); an empty
table gives no row; texts of any length are read whole; other columns, of any name, are
ignored. The join runs, but for its last steps, when it is called.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, binary_data, bounded_broadcast, fresh, join_hot, ragged, slices, table, text_column, written

NGRAM, THRESHOLD = 5, 0.8
#: Target recall of a pair just at the threshold, and the most hash functions spent on it.
RECALL, MOST_FUNCTIONS = 0.999, 216
#: Members and n-grams of a block of a large component.
BLOCK, BLOCK_NGRAMS = 512, 4 << 20
#: Rows of 48 bytes that a broadcast of dropped documents may have.
MOST_BROADCAST = 1 << 20

SIGNED = "doc_id long, key string, n_grams long, bands array<long>"
SETS = "component long, i int, j int, mine int, cid long, copies long, grams binary"
VERIFIED = "cid long, other long, links long"


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_FUNCTIONS) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which ``most`` functions give the recall at the threshold."""
    found = (most, 1)
    for r in range(1, most + 1):
        b = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**r)))) if threshold < 1 else 1
        if b * r > most:
            break
        found = (b, r)
    return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def n_grams(texts: pa.Array, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams, text by text in order, and the number of each text's."""
    for space in "\n\t\x0b\x0c\r":
        texts = pc.replace_substring(texts, space, " ")
    lists = pc.split_pattern(texts, " ")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    offsets = offsets - offsets[0]
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in names), np.uint64, count=len(names))
    codes = np.asarray(coded.indices, dtype=np.int64)
    empty = np.array([x == "" for x in names], bool)
    some = ~empty[codes] if len(names) else np.zeros(0, bool)
    words = hashes[codes[some]] if len(names) else np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(some)])[offsets]
    counts = np.diff(ends)
    starts = ends[:-1]
    grams = np.maximum(counts - n + 1, np.minimum(counts, 1))
    at = ragged(starts, grams)
    short = np.repeat(counts < n, grams)
    out = np.zeros(len(at), np.uint64)
    prime = np.uint64(0x9E3779B185EBCA87)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    for k in range(n):
        out *= prime
        out += padded[at + k]
    mixed(out)
    for i in np.flatnonzero(short):  # at most one a text: the n-gram of all its words
        d = int(np.searchsorted(np.cumsum(grams), i, side="right"))
        out[i] = xxhash.xxh3_64_intdigest(words[starts[d] : starts[d] + counts[d]].tobytes(), seed=1)
    return out, grams


def signatures(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands, int64) of texts with n-grams; those without get zeros."""
    out = np.zeros((len(counts), bands), np.int64)
    some = np.flatnonzero(counts > 0)
    if not len(some):
        return out
    factors = np.random.default_rng(20_240_731).integers(1, 1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    starts = (np.cumsum(counts) - counts)[some]
    room = np.empty_like(grams)
    for band in range(bands):
        hashed = np.full(len(some), band + 1, np.uint64)
        for row in range(rows):
            np.multiply(grams, factors[band * rows + row], out=room)
            hashed *= np.uint64(0x9E3779B185EBCA87)
            hashed += mixed(np.minimum.reduceat(room, starts))
        out[some, band] = mixed(hashed).view(np.int64)
    return out


def signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key (md5 of the text), n_grams, bands of every document."""

    def run(batches):
        for batch in batches:
            texts = text_column(batch)
            for i, j in slices(texts, 6 << 20):
                grams, counts = n_grams(texts.slice(i, j - i), n)
                values = signatures(grams, counts, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * bands), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("key").slice(i, j - i), pa.array(counts), lists], ["doc_id", "key", "n_grams", "bands"])

    return keyed(docs).mapInArrow(run, SIGNED)


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("key"), text.alias("text"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the least node of each connected component, for the nodes of edges (a, b).

    Alternates linking larger neighbours, then smaller ones, to a node's least
    neighbour, until each node is linked to its root alone. Every round is written to
    the shared folder; a round is sums of partial minima and an equi-join.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    known = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n"))
        large = join_hot(both.filter("b > a"), least, "a", "n").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a <> b").distinct(), name)
        # now a > b on every edge: the least neighbour takes the node and its other neighbours
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_hot(large, low, "a", "n").select(F.col("b").alias("x"), "m").unionByName(low.select(F.col("a").alias("x"), "m")).filter("x <> m")
        now = written(small.select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _verified(rows: list[tuple], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one task's rows (mine, cid, copies, set): pairs (x, y) of positions with a Jaccard similarity of the threshold."""
    n = len(rows)
    sets = [r[3] for r in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    data = np.concatenate(sets)
    names, codes = np.unique(data, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(names), np.int32)
    block, one_side = np.array([r[0] for r in rows]), rows[0][4]
    left, right = [], []
    for x in range(n - 1):
        # in a task of two blocks, pairs within a block are another task's
        later = np.arange(x + 1, n) if one_side else x + 1 + np.flatnonzero(block[x + 1 :] != block[x])
        later = later[(sizes[later] >= threshold * sizes[x]) & (sizes[x] >= threshold * sizes[later])]
        if not len(later):
            continue
        mine = codes[starts[x] : starts[x] + sizes[x]]
        mark[mine] = 1
        got = mark[codes[ragged(starts[later], sizes[later])]]
        shared = np.add.reduceat(got, np.cumsum(sizes[later]) - sizes[later])
        mark[mine] = 0
        # shared / union >= threshold, without rounding for thresholds of a few decimals
        good = shared * 1000 >= round(threshold * 1000) * (sizes[x] + sizes[later] - shared)
        left.append(np.full(int(good.sum()), x))
        right.append(later[good])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        if (a := find(x)) != (b := find(y)):
            parent[b] = a
            kept.append((x, y))
    return kept


def verify(batches, threshold: float):
    """Sorted rows of tasks (component, i, j) to (cid, null, links) for every member with links and (cid, other, 0) for the forest."""

    def done(rows):
        seen, unique = set(), []
        for r in rows:  # a repeated document may have come twice
            if (r[0], r[1]) not in seen:
                seen.add((r[0], r[1]))
                unique.append(r)
        if len(unique) < 2:
            return
        left, right = _verified(unique, threshold)
        if len(left):
            copies, cid = np.array([r[2] for r in unique], np.int64), np.array([r[1] for r in unique], np.int64)
            links = np.bincount(left, copies[right], minlength=len(unique)) + np.bincount(right, copies[left], minlength=len(unique))
            some = np.flatnonzero(links)
            forest = _forest(len(unique), left, right)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([cid[some], cid[[x for x, _ in forest]]])),
                    pa.array([None] * len(some) + cid[[y for _, y in forest]].tolist(), pa.int64()),
                    pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(forest), np.int64)])),
                ],
                ["cid", "other", "links"],
            )

    key, held = None, []
    for batch in batches:
        data, sizes = binary_data(batch.column("grams"), np.uint64)
        ends = np.cumsum(sizes)
        for row, (c, i, j, mine, cid, copies) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("component", "i", "j", "mine", "cid", "copies")), strict=True)):
            if (c, i, j) != key:
                yield from done(held)
                key, held = (c, i, j), []
            held.append((mine, cid, copies, data[ends[row] - sizes[row] : ends[row]], i == j))
    yield from done(held)


def join(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (the least doc_id of its near-duplicate class), n_links (other documents at the threshold or above), text_key, kept.

    kept: whether the row's text is the one that stands for the class.
    """
    bands, rows = bands_and_rows(threshold, recall)
    sig = written(signed(docs, n, bands, rows), "signatures")
    classes = sig.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.filter("n_grams > 0").select("cid", F.posexplode("bands").alias("band", "value")).select("cid", F.xxhash64("band", "value").alias("bucket"))
    heads = written(members.groupBy("bucket").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "band-heads")
    edges = join_hot(members, heads, "bucket", "size").filter("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    roots = components(edges, "candidates")
    dealt = blocks(roots.join(classes.select(F.col("cid").alias("node"), "key", "rep", "copies", "n_grams"), "node"))

    def make_sets(batches):
        for batch in batches:
            texts = text_column(batch)
            for b, e in slices(texts):
                grams, counts = n_grams(texts.slice(b, e - b), n)
                parts = [np.unique(x) for x in np.split(grams, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).slice(b, e - b) for x in ("component", "mine", "n_blocks", "cid", "copies")), binary_array(np.concatenate(parts), np.array([len(x) for x in parts]))],
                    ["component", "mine", "n_blocks", "cid", "copies", "grams"],
                )

    texts = keyed(docs).withColumnRenamed("doc_id", "_id").withColumnRenamed("key", "_key").join(dealt, (F.col("_key") == F.col("key")) & F.col("_id").eqNullSafe(F.col("rep")))
    sets = texts.select("component", "mine", "n_blocks", "cid", "copies", "text").mapInArrow(make_sets, "component long, mine int, n_blocks int, cid long, copies long, grams binary")
    met = sets.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "component", F.least("mine", "k").cast("int").alias("i"), F.greatest("mine", "k").cast("int").alias("j"), "mine", "cid", "copies", "grams"
    )
    found = met.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(lambda x: verify(x, threshold), VERIFIED)
    found = written(found, "links")
    links = found.filter("other IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    linked = components(found.filter("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")), "classes-joined")
    whole = (
        classes.select("cid", "key", "rep", "copies")
        .join(links, "cid", "left")
        .join(linked.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    whole = written(whole, "near-classes")
    firsts = whole.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), F.col("rep"), F.col("key"))).alias("first"))
    named = whole.join(firsts, "root").select("key", F.col("first.rep").alias("class_id"), (F.col("first.key") == F.col("key")).alias("kept"), (F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    named = written(named, "named-classes")
    return join_hot(sig.select("doc_id", "key"), named, "key", "copies").select("doc_id", "class_id", "n_links", F.col("key").alias("text_key"), "kept")


def blocks(roots: DataFrame) -> DataFrame:
    """Adds to (node, root, n_grams, ...) the component's number of blocks and the node's own, ``mine``."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("n_grams").alias("grams"))
    number: Column = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("grams") / BLOCK_NGRAMS)).cast("int")
    sizes = sizes.select("root", number.alias("n_blocks"))
    return roots.join(sizes, "root").select(F.col("root").alias("component"), F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("mine"), "n_blocks", F.col("node").alias("cid"), "key", "rep", "copies")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate class, the one with the least doc_id.

    The join runs when this is called. What goes (ids and keys of texts) is sent to the
    texts while it is little (MOST_BROADCAST); beyond that both sides are shuffled.
    """
    of, key, gone, mine = (fresh(docs, c) for c in ("copy_of", "copy_key", "copy_gone", "copy_mine"))
    stays = F.col("kept") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    marked = join(docs, **options).groupBy(F.col("doc_id").alias(of), F.col("text_key").alias(key)).agg((~F.bool_or(stays)).alias(gone), F.count(F.lit(1)).alias("rows"))
    marked = written(marked.filter(F.col(gone) | (F.col("rows") > 1)).drop("rows"), "copies")
    marked = bounded_broadcast(marked, MOST_BROADCAST)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn(mine, F.md5(text)).join(marked, (F.col(mine) == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(of)), "left")
    names = [F.col(f"`{c}`") for c in docs.columns]
    once = rows.filter(F.col(gone).isNull()).select(*names)
    # the same id and text in several rows: one of them
    return once.unionByName(rows.filter(~F.col(gone)).dropDuplicates([of, mine]).select(*names))


def op6_query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


OP6_SQL = """
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS i, text, min(doc_id) AS rep, count(*) AS copies FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) GROUP BY text
), w AS (
  SELECT i, list_filter(regexp_split_to_array(text, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words FROM t
), g AS (
  SELECT DISTINCT i, array_to_string(words[k:k + 4], ' ') AS gram
  FROM (SELECT i, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS k FROM w WHERE len(words) > 0)
), n AS (SELECT i, count(*) AS n FROM g GROUP BY i),
shared AS (SELECT a.i AS a, b.i AS b, count(*) AS s FROM g a JOIN g b ON a.gram = b.gram AND a.i <> b.i GROUP BY a.i, b.i),
links AS (
  SELECT a, b FROM shared JOIN n x ON a = x.i JOIN n y ON b = y.i WHERE 1000 * s >= 800 * (x.n + y.n - s)
), reach AS (
  SELECT i AS a, i AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), classes AS (SELECT a AS i, min(rep) AS class_id FROM reach JOIN t ON t.i = reach.b GROUP BY a),
counts AS (SELECT a AS i, sum(copies) AS n FROM links JOIN t ON t.i = links.b GROUP BY a)
SELECT d.doc_id, class_id, CAST(t.copies - 1 + coalesce(counts.n, 0) AS BIGINT) AS n_links
FROM documents d JOIN t ON coalesce(d.text, '') = t.text JOIN classes ON t.i = classes.i LEFT JOIN counts ON t.i = counts.i
"""
