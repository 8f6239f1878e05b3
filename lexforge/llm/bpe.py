"""BPE encoding and decoding: speculate and verify.

A word is split greedily into the longest tokens of the vocabulary (speculation,
one numpy pass over all words at a time). A sequence of tokens is what exact merging
gives if and only if no merge across any border between neighbours would have come
before the merges that made them. All borders of all words are tested at once
(verification): both sides are unrolled from the border outwards, in the order in
which their parts were made, and each step looks for a merge of the two parts that
met there. Only words with a border that fails are merged exactly.

Texts are cut into pieces as the vocabulary file says (normal form, white space,
lower case, pieces by class of character), and only the different words of a batch
are encoded; a worker keeps those it has met in a bounded cache.

Defined cases: a null text counts as empty: no ids, and the empty decoded text; null
and repeated ids are rows like others; of equal pairs in a word the left one is merged
first, as the library does; words and texts of any length are encoded whole; an empty
table gives no row; other columns are ignored.
"""

import hashlib
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import binary_array, ragged, slices, table, text_column
from lexforge.llm.tokens import _TAIL, CACHE_ENTRIES, vocabulary_path

NEVER = np.int64(1) << 40
ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class PairTable:
    """Merge of a pair of tokens by open addressing over numpy arrays: rank and result, or NEVER."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        size = 1 << int(np.ceil(np.log2(len(left) * 4)))
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NEVER, np.int64)
        self.made = np.zeros(size, np.int64)
        keys = (left.astype(np.int64) << 32) | right
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):  # place all, then again those that met a taken slot
            free = self.keys[at] == -1
            first = np.unique(at[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.keys[at[won]], self.rank[at[won]], self.made[at[won]] = keys[todo[won]], todo[won], made[todo[won]]
            left_over = np.ones(len(todo), bool)
            left_over[won] = False
            todo, at = todo[left_over], (at[left_over] + 1) & int(self.mask)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)) & self.mask).astype(np.int64)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; a slot whose key isn't the pair's stands for no merge (rank NEVER)."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        found = self.keys[at]
        more = np.flatnonzero((found != keys) & (found != -1))
        while len(more):
            at[more] = (at[more] + 1) & int(self.mask)
            found = self.keys[at[more]]
            more = more[(found != keys[more]) & (found != -1)]
        return at


class WordBPE:
    """Exact BPE of words of a tokenizers file with byte letters and a mark at the end of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, i in (vocab | self.special).items():
            self.names[i] = name
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pairs = PairTable(left, right, made)
        n = len(self.names)
        # the way each token is made: its parts and when (NEVER-like -1 for single bytes: from the start)
        self.left, self.right, self.when = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        order = np.arange(len(merges))[::-1]  # the earliest merge of a token stands
        self.left[made[order]], self.right[made[order]], self.when[made[order]] = left[order], right[order], order
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + self.mark] for x in letters], np.int64)
        # prefixes of tokens as a table of (state, byte) to state; a state may end a token, within a word or at its end
        of_letter = {x: b for b, x in enumerate(letters)}
        states: dict[bytes, int] = {b"": 0}
        steps, inner_ends, last_ends = [], [-1], [-1]
        for name, i in vocab.items():
            ends = name.endswith(self.mark) and len(name) > len(self.mark)
            text = bytes(of_letter[c] for c in (name[: -len(self.mark)] if ends else name))
            at = 0
            for k in range(len(text)):
                part = text[: k + 1]
                if part not in states:
                    states[part] = len(states)
                    steps.append((at, text[k], states[part]))
                    inner_ends.append(-1)
                    last_ends.append(-1)
                at = states[part]
            (last_ends if ends else inner_ends)[at] = i
        self.inner_ends, self.last_ends = np.array(inner_ends), np.array(last_ends)
        self.next = np.zeros((len(states), 256), np.int32)  # 0: no such prefix
        a, b, c = np.array(steps, np.int64).T
        self.next[a, b] = c
        self.longest = max(map(len, states))

    def greedy(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of the longest-match split of all words, words in order; all words advance together."""
        words, at = np.arange(len(starts)), starts.copy()
        ends = starts + lengths
        words, at = words[lengths > 0], at[lengths > 0]
        out_words, out_tokens = [], []
        while len(words):
            state, pos = np.zeros(len(words), np.int64), at.copy()
            token, until = np.full(len(words), -1, np.int64), at.copy()
            live = np.arange(len(words))
            while len(live):
                step = self.next[state[live], data[pos[live]]]
                live = live[step > 0]
                state[live] = step[step > 0]
                pos[live] += 1
                done = pos[live] == ends[words[live]]
                got = np.where(done, self.last_ends[state[live]], self.inner_ends[state[live]])
                hit = live[got >= 0]
                token[hit], until[hit] = got[got >= 0], pos[hit]
                live = live[~done]
            out_words.append(words)
            out_tokens.append(token)
            at = until
            more = at < ends[words]
            words, at = words[more], at[more]
        if not out_words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        w, t = np.concatenate(out_words), np.concatenate(out_tokens)
        order = np.argsort(w, kind="stable")
        return w[order], t[order]

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether exact merging leaves a border between each pair of tokens.

        Backwards in time: while both sides are whole, a merge of the two is
        possible until the end of time. Undoing the later of the two sides' own last
        merges leaves its part at the border; a merge of the two parts at hand
        would have been taken if it comes before the merge that was undone last.
        Equal merges go from left to right: on the left side a merge that equals
        the border's comes first, on the right side it comes after.
        """
        fine = np.ones(len(first), bool)
        todo = np.arange(len(first))
        a, b = first.astype(np.int64).copy(), second.astype(np.int64).copy()
        limit = np.full(len(first), NEVER, np.int64)  # merges of the border before this are taken
        while len(todo):
            rank = self.pairs.rank[self._matched(a, b)]
            clash = rank < limit
            fine[todo[clash]] = False
            made_a, made_b = self.when[a], self.when[b]
            go = ~clash & ((made_a >= 0) | (made_b >= 0))
            todo, a, b, made_a, made_b = todo[go], a[go], b[go], made_a[go], made_b[go]
            from_a = made_a > made_b
            limit = np.where(from_a, made_a, made_b + 1)
            a, b = np.where(from_a, self.right[a], a), np.where(from_a, b, self.left[b])
        return fine

    def _matched(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.pairs.slots(a, b)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words, side by side: (tokens, the number of each word's).

        In a round every word takes its earliest merge, from left to right; a word
        without one is done.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        tokens = self.inner[data]
        ends = np.cumsum(lengths)
        tokens[ends[lengths > 0] - 1] = self.last[data[ends[lengths > 0] - 1]]
        of = np.repeat(np.arange(len(words)), lengths)
        done_of, done_tokens = [], []
        while len(tokens):
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            slot = np.append(self.pairs.slots(tokens[:-1], tokens[1:]), 0)
            rank = self.pairs.rank[slot]
            rank[np.append(starts[1:], len(tokens)) - 1] = NEVER  # the last token of a word has no pair
            sizes = np.diff(np.append(starts, len(tokens)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            live = best < NEVER
            done_of.append(of[~live])
            done_tokens.append(tokens[~live])
            at = np.flatnonzero(live & (rank == best))
            # of hits side by side every other one, from the left
            run = np.concatenate([[True], np.diff(at) > 1]) if len(at) else np.zeros(0, bool)
            place = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1] if len(at) else at
            at = at[place % 2 == 0]
            tokens[at] = self.pairs.made[slot[at]]
            live[at + 1] = False
            tokens, of = tokens[live], of[live]
        order = np.argsort(np.concatenate(done_of), kind="stable") if done_of else np.zeros(0, np.int64)
        return (np.concatenate(done_tokens)[order] if done_tokens else np.zeros(0, np.int64)), np.bincount(np.concatenate(done_of), minlength=len(words)) if done_of else np.zeros(len(words), np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, and the number of each word's."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        of, tokens = self.greedy(data, np.cumsum(lengths) - lengths, lengths)
        counts = np.bincount(of, minlength=len(words))
        border = np.flatnonzero(of[1:] == of[:-1])
        bad_at = border[~self.compatible(tokens[border], tokens[border + 1])]
        # a token that merging doesn't make of its own bytes can't be trusted either
        bad = np.unique(np.concatenate([of[bad_at], of[tokens < 0], of[self.untrusted[tokens]]]))
        self.speculated, self.failed = getattr(self, "speculated", 0) + len(words), getattr(self, "failed", 0) + len(bad)
        if not len(bad):
            return tokens, counts
        fixed, fixed_counts = self.merged([words[i] for i in bad])
        keep = np.ones(len(words), bool)
        keep[bad] = False
        new_counts = counts.copy()
        new_counts[bad] = fixed_counts
        starts = np.cumsum(new_counts) - new_counts
        out = np.zeros(int(new_counts.sum()), np.int64)
        out[ragged(starts[keep], new_counts[keep])] = tokens[keep[of]]
        out[ragged(starts[bad], fixed_counts)] = fixed
        return out, new_counts

    @property
    def untrusted(self) -> np.ndarray:
        """Tokens that exact merging of their own bytes doesn't give; decided once, by the pairs test over their two parts."""
        if not hasattr(self, "_untrusted"):
            bad = np.zeros(len(self.names), bool)
            made = np.flatnonzero(self.when >= 0)
            # parts must stand until the token's own merge: no other merge at their border may come before
            bad[made] = ~self._stands(made)
            for i in made[np.argsort(self.when[made])]:  # a token of a part that fails, fails
                bad[i] |= bad[self.left[i]] or bad[self.right[i]]
            self._untrusted = bad
        return self._untrusted

    def _stands(self, tokens: np.ndarray) -> np.ndarray:
        """As ``compatible`` for the two parts of each token, but for the token's own merge itself."""
        fine = np.ones(len(tokens), bool)
        todo, a, b = np.arange(len(tokens)), self.left[tokens], self.right[tokens]
        while len(todo):
            made_a, made_b = self.when[a], self.when[b]
            go = (made_a >= 0) | (made_b >= 0)
            todo, a, b, made_a, made_b = todo[go], a[go], b[go], made_a[go], made_b[go]
            from_a = made_a > made_b
            limit = np.where(from_a, made_a, made_b + 1)
            a, b = np.where(from_a, self.right[a], a), np.where(from_a, b, self.left[b])
            clash = self.pairs.rank[self._matched(a, b)] < limit
            fine[todo[clash]] = False
            todo, a, b = todo[~clash], a[~clash], b[~clash]
        return fine


class TextCodec:
    """Whole texts to ids and back, by the words of a batch and a bounded cache."""

    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        self.bpe = WordBPE(path)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.bpe.special, key=len, reverse=True))) or r"(?!)")
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lengths, self.pool = array("q"), array("q"), array("I")
        self.shown: list[str] = []

    def pieces(self, chunk: str) -> list[str | int]:
        """The words of a chunk without white space around; special tokens as their ids."""
        out: list[str | int] = []
        at = 0
        for m in self.specials.finditer(chunk):
            out += self._plain(chunk[at : m.start()])
            out.append(self.bpe.special[m[0]])
            at = m.end()
        return out + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = "".join(c.lower() for c in text)  # one by one: no rule for a word's last letter
        else:
            text = text.lower()
        return self.PIECES.findall(text)

    def rows(self, chunks: list[str]) -> np.ndarray:
        if len(self.index) + len(chunks) > CACHE_ENTRIES:
            self.clear()
        index = self.index
        unknown = [x for x in chunks if x not in index]
        if unknown:
            cut = [self.pieces(x) for x in unknown]
            words = list({p for x in cut for p in x if isinstance(p, str)})
            ids, counts = self.bpe.encode_words([w.encode() for w in words]) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            of = {w: part.tolist() for w, part in zip(words, np.split(ids, np.cumsum(counts)[:-1]), strict=True)} if words else {}
            names = self.bpe.names
            for chunk, parts in zip(unknown, cut, strict=True):
                got = [t for p in parts for t in (of[p] if isinstance(p, str) else (p,))]
                index[chunk] = len(self.starts)
                self.starts.append(len(self.pool))
                self.lengths.append(len(got))
                self.pool.extend(got)
                self.shown.append(" ".join([names[t] for t in got]))
        return np.fromiter((index[x] for x in chunks), np.int64, count=len(chunks))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """All ids, the number of each text's, and each text decoded from them."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        offsets = offsets - offsets[0]
        coded = lists.flatten().dictionary_encode()
        codes = np.asarray(coded.indices, dtype=np.int64)
        fine = pc.split_pattern(pc.replace_substring_regex(coded.dictionary, _TAIL, "\\1\n\\2"), "\n")  # no chunk holds a newline
        parts = fine.flatten()
        parts = pc.if_else(pc.string_is_ascii(parts), pc.ascii_lower(parts), parts).dictionary_encode()
        rows = self.rows(parts.dictionary.to_pylist())
        starts, lengths, pool = np.array(self.starts, np.int64), np.array(self.lengths, np.int64), np.array(self.pool, np.uint32)
        shown = pa.array([self.shown[i] for i in rows], pa.string())
        rows = rows[np.asarray(parts.indices, dtype=np.int64)]
        n_parts = np.diff(np.asarray(fine.offsets, dtype=np.int64))
        part_ids = pool[ragged(starts[rows], lengths[rows])]
        ends = np.concatenate([[0], np.cumsum(lengths[rows])])[np.cumsum(n_parts)] if len(n_parts) else np.zeros(0, np.int64)
        chunk_lengths = np.diff(ends, prepend=0)
        counts = chunk_lengths[codes]
        ids = part_ids[ragged((ends - chunk_lengths)[codes], counts)]
        # decoded: the names of the ids with a space between, chunk by chunk; chunks without ids leave no space
        chunk_shown = pc.binary_join(pa.ListArray.from_arrays(fine.offsets, shown.take(parts.indices)), " ")
        some = counts > 0
        kept = np.concatenate([[0], np.cumsum(some)])[offsets]
        words = chunk_shown.take(pa.array(codes[some]))
        decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), words), " ")
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets]), decoded


_CODECS: dict[str, TextCodec] = {}


def codec(path: str) -> TextCodec:
    if path not in _CODECS:
        _CODECS[path] = TextCodec(path)
    return _CODECS[path]


def coded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian uint32) and decoded (the text of the ids) of each document."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")

    def run(batches):
        of = codec(path)
        for batch in batches:
            texts = text_column(batch)
            for i, j in slices(texts):
                ids, counts, decoded = of.encode(texts.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(counts), binary_array(ids.astype(np.uint32), counts), decoded], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def decode(ids, vocabulary: str | None = None) -> str:
    """The text of ids: the tokens' names with a space between."""
    names = codec(vocabulary or vocabulary_path("word_bpe_49k.json")).bpe.names
    return " ".join(names[i] for i in ids)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def op5_query(spark, sf_dir: str) -> DataFrame:
    found = coded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
