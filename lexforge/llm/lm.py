"""Language-model scoring: a gated recurrent network with a class-factored softmax.

Texts are tokenised once into blocks (codes into a block's own dictionary, both
compressed), which are written. Words are counted over all training documents: the
blocks' dictionaries are summed by word, and every block gets the counts of its own
words back, so no task or worker ever holds the corpus's vocabulary.

The network's tokens are the most frequent words, the end of a text, and ``RARE``
buckets of all other words by their ending; a rare word's probability is its
bucket's times the word's smoothed share of the bucket. Tokens are sorted by
frequency into classes of ``MEMBERS``: P(token) = P(class | state) P(token | class,
state). The biases start at the logarithms of the counts.

Training runs over all training documents once, in ``ROUNDS`` parts. In a round each
task starts from the same weights and goes through its blocks' part by truncated
backpropagation in numpy (windows of ``WINDOW`` steps over ``LANES`` streams, the state
carried from window to window and cleared at a document's start); the weights are
then averaged by tokens, a chunk of them at a time. Gates use x / (1 + |x|).

Scoring carries the state through whole documents, so a score is the log-likelihood
of the complete text, its end included. A block's documents are scored some at a time,
which bounds memory and changes no score.

Defined cases: a null or empty text is its end alone; null ids train (they have no
remainder); repeated rows are rows like others; of equally frequent words the first in
order is a token; a text of any length is one document, in a block of its own if it is
longer than one, and its state is carried through all of it; an empty table gives no
row; without training documents, every word is rare and unseen. Other columns are
ignored. Counting and training run when ``scored`` is called.
"""

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, binary_data, ragged, slices, table, text_column, written

#: Text of a block; the more, the fewer different (block, word) pairs are counted.
BLOCK_BYTES = 24 << 20
TOKENS, RARE, MEMBERS, HIDDEN = 1024, 32, 32, 16
ROUNDS, LANES, WINDOW, RATE = 3, 256, 16, 0.01
SCORE_LANES, SCORE_WINDOW = 512, 32
#: Targets whose probabilities are computed together; what they need stays in a core's cache.
PLACES = 4096
#: Tokens of a block that are scored together, in whole documents; their arrays are large. Scores don't depend on it.
SCORE_TOKENS = 1 << 20
END = 0
#: Floats of the weights that are averaged together.
CHUNK = 4096
#: Tasks whose weights are summed in one group.
FAN_IN = 64

BLOCKS = "block long, doc_ids array<long>, held binary, lengths binary, codes binary, words binary, trained binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# blocks

#: Bytes as the tokens have them.
FOLD = bytes.maketrans(b"\t\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def planes(codes: np.ndarray) -> np.ndarray:
    """Bytes of int32 codes, all first bytes first: the high ones are nearly all 0 and compress away."""
    return np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).ravel()


def from_planes(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(4, -1).T).view("<i4").ravel()


def squeezed(data: np.ndarray) -> np.ndarray:
    """Bytes, compressed, after their number: rows stay small in the JVM, through shuffles and sorts."""
    return np.concatenate([np.array([len(data)], "<i8").view(np.uint8), np.frombuffer(pa.compress(data, codec="zstd"), np.uint8)])


def unsqueezed(data: np.ndarray) -> np.ndarray:
    size = int(data[:8].view("<i8")[0])
    return np.frombuffer(pa.decompress(pa.py_buffer(data[8:]), size, codec="zstd"), np.uint8) if size else np.zeros(0, np.uint8)


def packed_words(words: pa.Array) -> np.ndarray:
    """Strings (no nulls) as bytes: their number, their lengths in bytes, their bytes; compressed."""
    data, lengths = binary_data(words, np.uint8)
    return squeezed(np.concatenate([np.array([len(words)], "<i8").view(np.uint8), planes(lengths), data]))


def unpacked_words(data: np.ndarray) -> pa.Array:
    data = unsqueezed(data)
    n = int(data[:8].view("<i8")[0])
    offsets = np.concatenate([[0], np.cumsum(from_planes(data[8 : 8 + 4 * n]))]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data[8 + 4 * n :]))


def folded(texts: pa.Array) -> pa.Array:
    """Texts (no nulls) with A-Z in lower case and every white space as a space: bytes become bytes, so places stay."""
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32, count=len(texts) + 1, offset=texts.offset * 4)
    data = texts.buffers()[2]
    data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes().translate(FOLD) if data is not None else b""
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data))


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, words of each text, the different words)."""
    lists = pc.split_pattern(folded(texts), " ")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = np.asarray(coded.indices)
    empty = pc.index(coded.dictionary, "").as_py()
    some = codes != empty
    before = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(some, out=before[1:])
    lengths = np.diff(before[offsets - offsets[0]]).astype(np.int64)
    codes = codes[some]
    if empty >= 0:
        codes -= codes > empty
        return codes, lengths, pa.concat_arrays([coded.dictionary.slice(0, empty), coded.dictionary.slice(empty + 1)])
    return codes, lengths, coded.dictionary


def blocks(docs: DataFrame) -> DataFrame:
    """Documents as rows of BLOCK_BYTES of text: ids, held flags, lengths, codes, the words, and their training counts."""

    def run(batches):
        at = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            column = text_column(batch)
            for i, j in slices(column, BLOCK_BYTES):
                part = column.slice(i, j - i)
                ids.append(batch.column("doc_id").slice(i, j - i))
                held.append(batch.column("held_out").slice(i, j - i))
                texts.append(part)
                size += pc.sum(pc.binary_length(part)).as_py() or 0
                if size >= BLOCK_BYTES // 2:
                    yield made(at, ids, held, texts)
                    at, ids, held, texts, size = at + 1, [], [], [], 0
        if ids:
            yield made(at, ids, held, texts)

    def made(at, ids, held, texts):
        flags = np.asarray(pa.concat_arrays(held).cast(pa.uint8()))
        codes, lengths, words = tokenised(pa.concat_arrays(texts))
        trained = np.bincount(codes[np.repeat(flags == 0, lengths)], minlength=len(words))
        doc_ids = pa.concat_arrays(ids)
        whole = lambda x: binary_array(x, np.array([len(x)]))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays(
            [pa.array([at]), one(doc_ids), whole(flags), whole(lengths), whole(squeezed(planes(codes))), whole(packed_words(words)), whole(trained)], ["block", "doc_ids", "held", "lengths", "codes", "words", "trained"]
        )

    key = F.col("doc_id").cast("long")
    held_out = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return docs.select(key.alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCKS)


class Block:
    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name, t: binary_data(batch.column(name).slice(row, 1), t)[0]
        self.doc_ids = batch.column("doc_ids").slice(row, 1).flatten()
        self.held, self.lengths = get("held", np.uint8), get("lengths", np.int64)
        self.words = unpacked_words(get("words", np.uint8))
        self.codes = from_planes(unsqueezed(get("codes", np.uint8)))

    def coded(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of some documents (true in ``some``) with a code of its own for the end after each text, and the lengths with it."""
        lengths = self.lengths[some]
        return np.insert(self.codes[np.repeat(some, self.lengths)], np.cumsum(lengths), len(self.words)), lengths + 1

    def groups(self):
        """Documents (true) by about SCORE_TOKENS tokens, those of like lengths together; a longer one stands alone."""
        order = np.argsort(-self.lengths, kind="stable")
        ends = np.cumsum(self.lengths[order] + 1)
        i = 0
        while i < len(order):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SCORE_TOKENS, side="right")))
            some = np.zeros(len(order), bool)
            some[order[i:j]] = True
            yield some
            i = j


def spread(codes: np.ndarray, values: np.ndarray, end) -> np.ndarray:
    """Of codes with ends: each one's value, ``end`` at the ends."""
    return np.concatenate([values, np.array([end], values.dtype)])[codes]


# the network


class Vocabulary:
    """Network tokens: END, then words and rare buckets by falling counts."""

    def __init__(self, words: list[tuple[str, int]], buckets: dict[int, tuple[int, int]], ends: int):
        """words: the most frequent with their counts; buckets: (count, different words) of the others; ends: training documents."""
        self.buckets = {b: buckets.get(b, (0, 0)) for b in range(RARE)}
        order = sorted([(n, 1, w) for w, n in words] + [(n, 0, b) for b, (n, _) in self.buckets.items()], key=lambda x: (-x[0], x[1], x[2]))
        self.words = {x: i + 1 for i, (_, kind, x) in enumerate(order) if kind}
        self.rare = np.zeros(RARE, np.int64)
        for i, (_, kind, x) in enumerate(order):
            if not kind:
                self.rare[x] = i + 1
        self.size = len(order) + 1
        self.classes = -(-self.size // MEMBERS)
        self.counts = np.array([ends] + [n for n, *_ in order], float)

    def of(self, words: pa.Array) -> np.ndarray:
        """The network's token of each word."""
        at = pc.index_in(words, value_set=pa.array(list(self.words), pa.string()))
        out = np.array([*self.words.values(), 0], np.int32)[np.asarray(pc.fill_null(at, len(self.words)))]
        rest = np.asarray(pc.is_null(at))
        # few words end differently: each ending is hashed once
        ends = pc.utf8_slice_codeunits(words.filter(pa.array(rest)), -2).dictionary_encode()
        of_ends = np.array([self.rare[zlib.crc32(x.encode()) % RARE] for x in ends.dictionary.to_pylist()], np.int32)
        out[rest] = of_ends[np.asarray(ends.indices)]
        return out

    def share(self, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of each word's smoothed share of its bucket; 0 for words that are tokens themselves."""
        masses = np.zeros(self.size)
        for b, (total, kinds) in self.buckets.items():
            masses[self.rare[b]] = total + 0.1 * (kinds + 1)
        masses = masses[tokens]
        out, at = np.zeros(len(tokens)), masses > 0
        out[at] = np.log10((counts[at] + 0.1) / masses[at])
        return out


def bucket(word):
    """As in Vocabulary.of, for columns."""
    return (F.crc32(F.encode(F.substring(word, -2, 2), "UTF-8")) % RARE).cast("int")


class Weights:
    """Named arrays over one flat vector of float32. Features come first, streams last, so every slice of features is contiguous."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        k, c, h = vocabulary.classes * MEMBERS, vocabulary.classes, HIDDEN
        shapes = {"e": (3 * h, k), "u": (3 * h, h), "wc": (c, h), "bc": (c, 1), "wm": (c, MEMBERS, h), "bm": (c, MEMBERS, 1)}
        total = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(total, np.float32) if flat is None else flat
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n
        if flat is None:
            rng = np.random.default_rng(1)
            for x, scale in ((self.e, 0.3), (self.u, 0.3), (self.wc, 0.05), (self.wm, 0.05)):
                x[...] = rng.normal(0, scale, x.shape)
            mass = np.zeros(k)
            mass[: vocabulary.size] = vocabulary.counts + 0.1
            mass = mass.reshape(c, MEMBERS)
            self.bc[:, 0] = np.log(mass.sum(1) / mass.sum())
            with np.errstate(divide="ignore"):
                self.bm[:, :, 0] = np.maximum(np.log(mass / mass.sum(1, keepdims=True)), -30)


def _soft(x: np.ndarray) -> np.ndarray:
    """1 / (1 + |x|)."""
    out = np.abs(x)
    out += 1
    return np.reciprocal(out, out=out)


def forward(w: Weights, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States after each of the steps (HIDDEN x steps * lanes), and the last. starts: true where a document begins."""
    h, (steps, lanes) = HIDDEN, inputs.shape
    out = np.empty((h, steps * lanes), np.float32)
    fresh = starts.any(axis=1)
    for t in range(steps):
        if fresh[t]:
            state = state * ~starts[t]
        given = np.take(w.e, inputs[t], axis=1)
        z = w.u @ state
        a = given[: 2 * h]
        a += z[: 2 * h]
        da = _soft(a)
        a *= da
        a *= 0.5
        a += 0.5  # the gates
        zn = z[2 * h :]
        b = a[:h] * zn
        b += given[2 * h :]
        db = _soft(b)
        b *= db  # the new state
        change = state - b
        kept = change * a[h:]
        kept += b
        if keep is not None:
            keep.append((state, zn, a, da, change, db))
        out[:, t * lanes : (t + 1) * lanes] = kept
        state = kept
    return out, state

def by_class(targets: np.ndarray, classes: int):
    """(order, bounds): positions sorted by class, and where each class begins."""
    of = (targets // MEMBERS).astype(np.int16)
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(classes + 1))


def logits(w: Weights, states: np.ndarray, targets: np.ndarray):
    """(order, spans, states, goals, sides, safe): positions sorted by class; where each class that occurs lies there; the
    states in that order, over a row of ones for the biases; the targets in that order; logits of classes and of each
    target's class's members, with each goal's place in them; whether no exponential of them can overflow or vanish."""
    n, classes = len(targets), len(w.bc)
    order, bounds = by_class(targets, classes)
    mine = np.ones((HIDDEN + 1, n), np.float32)
    np.take(states, order, axis=1, out=mine[:-1], mode="clip")
    goals = targets[order]
    wc, wm = np.concatenate([w.wc, w.bc], axis=1), np.concatenate([w.wm, w.bm], axis=2)
    reach = max(1.0, float(np.abs(states).max(initial=0))) * max(float(np.abs(x).sum(axis=-1).max()) for x in (wc, wm))
    x = np.empty((MEMBERS, n), np.float32)
    spans = [(c, slice(i, j)) for c, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if i < j]
    for c, at in spans:
        np.matmul(wm[c], mine[:, at], out=x[:, at])
    rows = np.arange(n)
    return order, spans, mine, goals, ((wc @ mine, goals // MEMBERS * n + rows), (x, goals % MEMBERS * n + rows)), reach < 60


def log_probabilities(w: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """ln P of each target, by states (HIDDEN x targets)."""
    out = np.empty(len(targets), np.float32)
    for i in range(0, len(targets), PLACES):
        order, _, _, goals, sides, safe = logits(w, states[:, i : i + PLACES], targets[i : i + PLACES])
        mine = np.zeros(len(goals), np.float32)
        for x, at in sides:
            if not safe:
                x -= x.max(axis=0)
            mine += np.take(x, at)
            mine -= np.log(np.exp(x, out=x).sum(axis=0))
        out[i : i + PLACES][order] = mine
    return out


def gradients(w: Weights, vocabulary: Vocabulary, inputs, starts, targets, state, live: np.ndarray | None = None) -> tuple[Weights, np.ndarray, float]:
    """Of the mean of -ln P over a window, by backpropagation through its steps; the last state; the mean. live: the places that count, else all."""
    h, keep = HIDDEN, []
    flat, last = forward(w, inputs, starts, state, keep)
    n = targets.size
    order, spans, mine, _, sides, safe = logits(w, flat, targets.ravel())
    counted = np.ones(n, bool) if live is None else live.ravel()[order]
    total = int(counted.sum())
    scale = counted * np.float32(1 / total)
    g = Weights(vocabulary, np.zeros_like(w.flat))
    loss = 0.0
    for x, at in sides:
        if not safe:
            x -= x.max(axis=0)
        np.exp(x, out=x)
        sums = np.reciprocal(x.sum(axis=0))
        chosen = np.take(x, at) * sums
        loss -= float(np.log(np.maximum(chosen, 1e-30))[counted].sum())
        sums *= scale
        x *= sums
        x.reshape(-1)[at] = (chosen - 1) * scale
    p, q = (x for x, _ in sides)
    both = p @ mine.T
    g.wc[...], g.bc[...] = both[:, :-1], both[:, -1:]
    into = w.wc.T @ p
    for c, at in spans:
        s = q[:, at]
        both = s @ mine[:, at].T
        g.wm[c], g.bm[c] = both[:, :-1], both[:, -1:]
        into[:, at] += w.wm[c].T @ s
    places = np.empty(n, np.int64)
    places[order] = np.arange(n)
    d = np.take(into, places, axis=1, mode="clip")
    steps, lanes = inputs.shape
    given = np.empty((3 * h, n), np.float32)
    back = np.zeros_like(state)
    step = np.empty((3 * h, lanes), np.float32)
    for t in range(steps - 1, -1, -1):
        before, zn, gates, da, change, db = keep[t]
        now = slice(t * lanes, (t + 1) * lanes)
        top = d[:, now] + back
        stay = top * gates[h:]
        dn = top - stay
        dn *= db
        dn *= db
        da *= da
        da *= 0.5
        np.multiply(dn, zn, out=step[:h])
        np.multiply(top, change, out=step[h : 2 * h])
        step[: 2 * h] *= da
        given[: 2 * h, now] = step[: 2 * h]
        given[2 * h :, now] = dn
        np.multiply(dn, gates[:h], out=step[2 * h :])
        g.u += step @ before.T
        back = w.u.T @ step
        back += stay
        if starts[t].any():
            back *= ~starts[t]
    ids = inputs.ravel()
    by = np.argsort(ids.astype(np.int16) if vocabulary.size < 1 << 15 else ids, kind="stable")
    ids = ids[by]
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    # a last column of zeros for tokens that don't occur
    sums = np.zeros((3 * h, len(firsts) + 1), np.float32)
    np.add.reduceat(np.take(given, by, axis=1, mode="clip"), firsts, axis=1, out=sums[:, :-1])
    at = np.full(g.e.shape[1], len(firsts))
    at[ids[firsts]] = np.arange(len(firsts))
    np.take(sums, at, axis=1, out=g.e, mode="clip")
    return g, last, loss / total


def train(w: Weights, vocabulary: Vocabulary, tokens: np.ndarray, lengths: np.ndarray, moments: list) -> None:
    """One pass over documents in LANES streams, the weights changed in place. moments: of Adam, [first, second, steps]."""
    total = len(tokens)
    if not total:
        return
    lanes = max(1, min(LANES, total // (64 * WINDOW)))  # windows in the dozens, in small parts too
    steps = -(-total // lanes)
    begins = np.zeros(total, bool)
    begins[np.cumsum(lengths) - lengths] = True
    before = np.concatenate([np.array([END], tokens.dtype), tokens[:-1]])
    # no token is left out: the streams' lengths differ by one at most, and what fills up the last step doesn't count
    sizes = np.full(lanes, total // lanes) + (np.arange(lanes) < total % lanes)
    firsts = np.cumsum(sizes) - sizes
    begins[firsts] = True
    state = np.zeros((HIDDEN, lanes), np.float32)
    for at in range(0, steps, WINDOW):
        step = np.arange(at, min(at + WINDOW, steps))[:, None]
        live = step < sizes
        place = firsts + np.minimum(step, sizes - 1)
        g, state, _ = gradients(w, vocabulary, before[place], begins[place], tokens[place], state, None if live.all() else live)
        x = g.flat
        norm = float(np.sqrt((x**2).sum()))
        x *= np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        moments[2] += 1
        moments[0] += 0.1 * (x - moments[0])
        x *= x
        x -= moments[1]
        x *= 0.01
        moments[1] += x
        n = moments[2]
        np.divide(moments[1], 1 - 0.99**n, out=x)
        np.sqrt(x, out=x)
        x += 1e-6
        np.divide(moments[0], x, out=x)
        x *= np.float32(RATE / (1 - 0.9**n))
        w.flat -= x


def likelihoods(w: Weights, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """ln P of every token of whole documents, in order; each lane carries its state through its documents."""
    out = np.zeros(len(tokens), np.float32)
    firsts = np.cumsum(lengths) - lengths
    heap = [(0, lane) for lane in range(min(SCORE_LANES, len(lengths)))]
    lanes: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        lanes[lane].append(d)
        heapq.heappush(heap, (load + int(lengths[d]), lane))
    lanes = sorted((x for x in lanes if x), key=lambda x: -int(lengths[x].sum()))
    mine = [d for x in lanes for d in x]
    places = ragged(firsts[mine], lengths[mine])  # lane after lane
    sizes = np.array([int(lengths[x].sum()) for x in lanes], np.int64)
    begin = np.cumsum(sizes) - sizes
    begins = np.zeros(len(tokens), bool)
    begins[firsts] = True
    before = np.concatenate([tokens[:0], np.array([END], tokens.dtype), tokens[:-1]])
    before[begins] = END
    state = np.zeros((HIDDEN, len(lanes)), np.float32)
    for at in range(0, int(sizes.max()) if len(sizes) else 0, SCORE_WINDOW):
        live = int((sizes > at).sum())
        steps = min(SCORE_WINDOW, int(sizes[0]) - at)
        # a lane that ends within the window repeats its last place, which is left out below
        step = np.arange(at, at + steps)[:, None]
        place = places[begin[:live] + np.minimum(step, sizes[:live] - 1)]
        mine = step < sizes[:live]
        states, last = forward(w, before[place], begins[place], state[:, :live])
        kept = np.flatnonzero(mine)
        out[place[mine]] = log_probabilities(w, states if len(kept) == mine.size else states[:, kept], tokens[place[mine]])
        state = last
    return out


# over the corpus


def dictionary(rows: DataFrame) -> DataFrame:
    """(block, pos, word, n) of the blocks' dictionaries."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                words = unpacked_words(binary_data(batch.column("words").slice(row, 1), np.uint8)[0])
                n, _ = binary_data(batch.column("trained").slice(row, 1), np.int64)
                block = batch.column("block")[row].as_py()
                for i in range(0, len(words), 50_000):
                    part = words.slice(i, 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(np.arange(i, i + len(part), dtype=np.int32)), part, pa.array(n[i : i + len(part)])], ["block", "pos", "word", "n"])

    return rows.select("block", "words", "trained").mapInArrow(run, "block long, pos int, word string, n long")


def averaged(rows: DataFrame, n_blocks: int, vocabulary: Vocabulary, flat: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The weights after a round: each task's own, averaged by the tokens it went through."""

    def run(batches):
        w, used = Weights(vocabulary, flat.copy()), 0
        moments = [np.zeros_like(flat), np.zeros_like(flat), 0]
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                codes, lengths = block.coded((block.held == 0) & (np.arange(len(block.held)) % parts == part))
                train(w, vocabulary, spread(codes, vocabulary.of(block.words), END), lengths, moments)
                used += len(codes)
        if used:
            weighted = w.flat.astype(np.float64) * used
            salt = TaskContext.get().partitionId()
            chunks = [weighted[i : i + CHUNK] for i in range(0, len(weighted), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(chunks), dtype=np.int32)), pa.array(np.full(len(chunks), salt, np.int32)), pa.array(np.full(len(chunks), used)), binary_array(np.concatenate(chunks), np.array([len(x) for x in chunks]))],
                ["chunk", "salt", "tokens", "total"],
            )

    def summed(group: pa.Table) -> pa.Table:
        totals = [np.frombuffer(x.as_buffer(), np.float64) for x in group.column("total")]
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "salt": group.column("salt").slice(0, 1), "tokens": [pc.sum(group.column("tokens")).as_py()], "total": [np.sum(totals, axis=0).tobytes()]})

    schema = "chunk int, salt int, tokens long, total binary"
    trained = rows.select("block", "doc_ids", "held", "lengths", "codes", "words").mapInArrow(run, schema)
    # tasks' weights are summed in levels, so that no group holds more than FAN_IN of them
    tasks, level = n_blocks, 0
    while tasks > FAN_IN:
        tasks, level = -(-tasks // FAN_IN), level + 1
    for left in range(level, 0, -1):
        trained = trained.groupBy("chunk", F.pmod(F.xxhash64("salt", F.lit(left)), F.lit(FAN_IN**left)).cast("int").alias("to")).applyInArrow(summed, schema)
    done = sorted(trained.groupBy("chunk").applyInArrow(summed, schema).collect(), key=lambda r: r.chunk)
    if not done:
        return flat
    return np.concatenate([np.frombuffer(bytes(r.total), np.float64) / r.tokens for r in done]).astype(np.float32)


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every document."""
    rows = written(blocks(docs), "lm-blocks")
    entries = dictionary(rows)
    counts = written(entries.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    known = counts.filter("n > 0")
    frequent = [(r.word, r.n) for r in known.orderBy(F.desc("n"), "word").limit(TOKENS - RARE - 1).collect()]
    total, kinds = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()

    def ends_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(int((binary_data(batch.column("held").slice(i, 1), np.uint8)[0] == 0).sum()) for i in range(batch.num_rows))])], ["n"])

    ends = rows.select("held").mapInArrow(ends_of, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # at most TOKENS words go out with the plan
    left_out = known.filter(~F.col("word").isin([w for w, _ in frequent])) if frequent else known
    buckets = {r.b: (r.n, r.kinds) for r in left_out.groupBy(bucket(F.col("word")).alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    vocabulary = Vocabulary(frequent, buckets, ends)
    flat, n_blocks = Weights(vocabulary).flat, rows.count()
    for part in range(ROUNDS):
        flat = averaged(rows, n_blocks, vocabulary, flat, part, ROUNDS)
    n_train, n_kinds = total + ends, kinds + (1 if ends else 0)

    back = entries.select("block", "pos", "word").join(counts, "word").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("found"))
    back = back.select(F.col("block").alias("_block"), F.transform("found", lambda x: x["n"]).alias("counts"))

    def score(batches):
        w = Weights(vocabulary, flat)
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                got = np.asarray(batch.column("counts").slice(row, 1).flatten(), dtype=np.int64)
                tokens = vocabulary.of(block.words)
                base = lambda c: np.log10((c + 0.1) / (n_train + 0.1 * (n_kinds + 1)))
                bases, shares, known = base(got), vocabulary.share(tokens, got), (got > 0).astype(np.int8)
                for some in block.groups():
                    codes, lengths = block.coded(some)
                    firsts = np.cumsum(lengths) - lengths
                    sums = lambda x, kind=np.float64: np.add.reduceat(x, firsts, dtype=kind)  # noqa: B023, E731
                    model = sums(likelihoods(w, spread(codes, tokens, END), lengths)) / np.log(10)
                    model += sums(spread(codes, shares, 0.0))
                    n_known = sums(spread(codes, known, int(ends > 0)), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [block.doc_ids.filter(pa.array(some)), pa.array(block.held[some] == 1), pa.array(lengths), pa.array(n_known), pa.array(np.full(len(lengths), n_train)), pa.array(sums(spread(codes, bases, base(ends)))), pa.array(model)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

    # a block of empty texts has no words and so no counts
    joined = rows.select("block", "doc_ids", "held", "lengths", "codes", "words").join(back, F.col("block") == F.col("_block"), "left")
    return joined.withColumn("counts", F.coalesce("counts", F.array().cast("array<long>"))).drop("_block").mapInArrow(score, SCORED)


def op4_query(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
