"""Token ids in files, compressed by Re-Pair grammars.

Documents are dealt into ranges of (doc_id, hash of the text), sorted, and encoded
where they come to lie. The ids of a task are cut into shards of whole documents.
For each shard, frequent pairs of neighbouring ids are replaced by nonterminals,
round after round, until no pair is frequent or a round gains little. A pair never crosses the end of a
document, so a document is a slice of the shard's sequence.

A file holds a row a shard: its ``rules`` (pairs of ids, the n-th makes the id
``first + n``), the ``expanded`` length of each rule's result, the ``sequence``,
the documents' ids, numbers of ids and slices. ``ids_between`` decodes any range of a
document without the rest: prefix sums of expanded lengths find the symbols.

Defined cases: a null text counts as empty (its document is its end id alone); null
doc_ids come first, repeated ones next to each other, by the hash of their texts; of
overlapping equal pairs every other one is replaced, from the left; a text of any length
is whole in one shard; an empty table gives no row; other columns are ignored.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, binary_data, bounded_broadcast, ragged, shared_dir, slices, table, text_column
from lexforge.llm.packing import MOST_BROADCAST_PARTITIONS, offsets_of
from lexforge.llm.tokens import encoder, vocabulary_path, with_end

SHARDS = "part int, shard int, local_start long, n_ids long, first int, rules binary, expanded binary, sequence binary, doc_ids array<long>, doc_tokens binary, doc_symbols binary"
DOCUMENTS = "part int, local_start long, doc_id long, n_tokens long, ids binary"

#: Pairs replaced in a round, the least count of a pair, and the least gain that earns another round.
ROUND_PAIRS, LEAST_COUNT, LEAST_GAIN = 4096, 16, 0.02
_HASH_BITS = 20


def compress(ids: np.ndarray, counts: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rules n x 2, expanded lengths, sequence, symbols of each document) of the ids of documents of ``counts`` ids.

    Pairs are counted by a hash; a slot stands for the pair that came last in it, and
    another frequent pair of that slot has its turn in a round of another hash.
    """
    seq = ids.astype(np.uint32)
    last = np.cumsum(counts)[counts > 0] - 1  # where documents end
    rules: list[np.ndarray] = []
    made, slots = first, 1 << _HASH_BITS
    while len(seq) > 1:
        slot = seq[:-1] * np.uint32(0x9E3779B1)
        slot += seq[1:] * np.uint32(0x85EBCA77 + 2 * len(rules))
        slot ^= slot >> np.uint32(15)
        slot *= np.uint32(0xC2B2AE3D)
        slot >>= np.uint32(32 - _HASH_BITS)
        slot = slot.view(np.int32)
        slot[last[:-1]] = slots  # no pair across a document's end
        seen = np.bincount(slot, minlength=slots + 1)
        seen[-1] = 0
        least = LEAST_COUNT
        if np.count_nonzero(seen >= least) > ROUND_PAIRS:
            least = max(least, int(np.partition(seen, len(seen) - ROUND_PAIRS)[len(seen) - ROUND_PAIRS]))
        for limit in dict.fromkeys((least, LEAST_COUNT)):  # slots that reach the higher limit may do so by rare pairs together
            at, name, pairs = _frequent(seq, slot, seen, limit, slots)
            if len(at):
                break
        if not len(at):
            break
        # of overlapping pairs every other one counts, from the left of a run
        run = np.concatenate([[True], np.diff(at) > 1])
        place = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at, name = at[place % 2 == 0], name[place % 2 == 0]
        some = np.zeros(len(pairs), bool)
        some[name] = True
        rules.append(np.stack([pairs[some] >> 31, pairs[some] & ((1 << 31) - 1)], axis=1))
        seq[at] = (made + np.cumsum(some) - 1).astype(np.uint32)[name]
        made += int(some.sum())
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        before = len(seq)
        seq = seq[keep]
        last = last - np.searchsorted(at, last, side="left")  # the second ids before an end, or at it, are gone
        if before - len(seq) < LEAST_GAIN * before:
            break
    all_rules = np.concatenate(rules).astype(np.int32) if rules else np.zeros((0, 2), np.int32)
    symbols = np.zeros(len(counts), np.int64)
    symbols[counts > 0] = np.diff(last, prepend=-1)
    return all_rules, expanded_lengths(all_rules, first), seq.astype(np.int64), symbols


def _frequent(seq: np.ndarray, slot: np.ndarray, seen: np.ndarray, limit: int, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs that occur ``limit`` times, which pair each is, and the pairs."""
    at = np.flatnonzero((seen >= limit)[slot])
    keys, mine = (seq[at].astype(np.int64) << 31) | seq[at + 1], slot[at]
    last = np.full(slots, -1, np.int64)
    last[mine] = keys
    same = keys == last[mine]
    n = np.bincount(mine[same], minlength=slots)
    same &= (n >= limit)[mine]
    if same.any() or not len(at):
        names = np.flatnonzero(n >= limit)
        number = np.zeros(slots, np.int64)
        number[names] = np.arange(len(names))
        return at[same], number[mine[same]], last[names]
    # no slot's last pair is frequent; whether another is, a sort tells
    pairs, which, n = np.unique(keys, return_inverse=True, return_counts=True)
    good = n[which] >= limit
    return at[good], which[good], pairs


def rounds(rules: np.ndarray, first: int):
    """(begin, end) of rules that use only rules before begin."""
    uses = rules.max(axis=1) - first if len(rules) else np.zeros(0, np.int64)
    begin = 0
    while begin < len(rules):
        over = np.flatnonzero(uses[begin:] >= begin)
        end = begin + int(over[0]) if len(over) else len(rules)
        yield begin, end
        begin = end


def expanded_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    lengths = np.zeros(len(rules), np.int64)
    for i, j in rounds(rules, first):
        for x in rules[i:j].T:
            lengths[i:j] += np.where(x >= first, lengths[np.maximum(x - first, 0)], 1)
    return lengths


class Grammar:
    """Decodes sequences of a shard."""

    def __init__(self, rules: np.ndarray, expanded: np.ndarray, first: int):
        self.first, self.lengths = first, np.asarray(expanded, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.zeros(int(self.lengths.sum()), np.uint32)
        for i, j in rounds(rules, first):
            at = self.starts[i:j].copy()
            for x in rules[i:j].T.astype(np.int64):
                made = x >= first
                self.pool[at[~made]] = x[~made]
                n = np.ones(j - i, np.int64)
                n[made] = self.lengths[x[made] - first]
                self.pool[ragged(at[made], n[made])] = self.pool[ragged(self.starts[x[made] - first], n[made])]
                at += n

    def sizes(self, seq: np.ndarray) -> np.ndarray:
        """The expansion length of each symbol."""
        out = np.ones(len(seq), np.int64)
        made = seq >= self.first
        out[made] = self.lengths[seq[made] - self.first]
        return out

    def expand(self, seq: np.ndarray) -> np.ndarray:
        # an id that isn't made by a rule is a piece of length one, behind the rules' own
        pool = np.concatenate([self.pool, seq.astype(np.uint32)])
        made = seq >= self.first
        starts, sizes = np.arange(len(self.pool), len(pool)), np.ones(len(seq), np.int64)
        starts[made], sizes[made] = self.starts[seq[made] - self.first], self.lengths[seq[made] - self.first]
        return pool[ragged(starts, sizes)]

    def between(self, seq: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Ids begin to end (exclusive) of the sequence, expanding only the symbols that reach into the range."""
        ends = np.cumsum(self.sizes(seq))
        i, j = int(np.searchsorted(ends, begin, side="right")), int(np.searchsorted(ends, end, side="left")) + 1
        skipped = int(ends[i - 1]) if i else 0
        return self.expand(seq[i:j])[begin - skipped : end - skipped]


def compressed(docs: DataFrame, vocabulary: str | None = None, end_id: int | None = 1) -> DataFrame:
    """The rows of the file format, shards in ascending doc_id order by (part, shard)."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")

    def run(batches):
        tokens, part, shard, at = encoder(path, False), TaskContext.get().partitionId(), 0, 0
        first = max(tokens.library.get_vocab_size(), (end_id or 0) + 1)
        for batch in batches:
            texts = text_column(batch)
            for i, j in slices(texts):
                ids, counts = with_end(*tokens.encode(texts.slice(i, j - i)), end_id)
                rules, expanded, seq, symbols = compress(ids, counts, first)
                narrow = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
                one = lambda x, t: binary_array(x.astype(t).ravel(), np.array([x.size]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([at], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([first], pa.int32()),
                        one(rules, np.int32), one(expanded, np.int32), one(seq, narrow),
                        pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column("doc_id").slice(i, j - i)), one(counts, np.int64), one(symbols, np.int64),
                    ],
                    ["part", "shard", "local_start", "n_ids", "first", "rules", "expanded", "sequence", "doc_ids", "doc_tokens", "doc_symbols"],
                )
                shard, at = shard + 1, at + len(ids)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    content = F.xxhash64("text")
    return rows.repartitionByRange("doc_id", content).sortWithinPartitions("doc_id", content).mapInArrow(run, SHARDS)


def write(docs: DataFrame, path: str, **options) -> None:
    compressed(docs, **options).write.option("compression", "zstd").parquet(path)


def shard_of(batch: pa.RecordBatch, row: int) -> tuple[Grammar, np.ndarray, np.ndarray, np.ndarray]:
    """The grammar, sequence, doc_tokens and doc_symbols of a row of the file."""
    first = batch.column("first")[row].as_py()
    get = lambda name, t: binary_data(batch.column(name).slice(row, 1), t)[0]
    rules = get("rules", np.int32).reshape(-1, 2)
    narrow = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
    return Grammar(rules, get("expanded", np.int32), first), get("sequence", narrow).astype(np.int64), get("doc_tokens", np.int64), get("doc_symbols", np.int64)


def ids_between(batch: pa.RecordBatch, row: int, doc: int, begin: int, end: int) -> np.ndarray:
    """Ids begin to end (exclusive) of the shard's doc-th document."""
    grammar, seq, tokens, symbols = shard_of(batch, row)
    stop = int(symbols[: doc + 1].sum())
    end = min(end, int(tokens[doc]))
    return grammar.between(seq[stop - int(symbols[doc]) : stop], begin, end) if begin < end else np.zeros(0, np.uint32)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32) of the documents of a file."""

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                grammar, seq, tokens, _ = shard_of(batch, row)
                n = len(tokens)
                begin = batch.column("local_start")[row].as_py() + np.cumsum(tokens) - tokens
                part = pa.array(np.full(n, batch.column("part")[row].as_py(), np.int32))
                ids = grammar.expand(seq)
                yield pa.RecordBatch.from_arrays([part, pa.array(begin), batch.column("doc_ids").slice(row, 1).flatten(), pa.array(tokens), binary_array(ids, tokens)], ["part", "local_start", "doc_id", "n_tokens", "ids"])

    rows = spark.read.schema(SHARDS).parquet(path)
    bases = offsets_of(rows.groupBy("part").agg(F.sum("n_ids").alias("total"))).select("part", "base")
    found = rows.mapInArrow(decode, DOCUMENTS).join(bounded_broadcast(bases, MOST_BROADCAST_PARTITIONS), "part")
    return found.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def op7_query(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/lexforge/token-ids-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
