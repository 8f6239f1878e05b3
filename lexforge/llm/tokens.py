"""Token ids of whole texts by the tokenizers library, at the cost of their different words.

Both vocabularies cut a text at white space before any merge, so ids of a text are
the ids of its pieces one after another. A batch is cut into pieces by Arrow, the
different pieces are encoded by the library (once for each worker: a bounded cache
keeps them), and ids are gathered by numpy. Texts whose white space may not be cut
this way (runs of it, control characters) go to the library whole.
"""

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexforge.llm.common import ragged

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that a worker's cache holds before it starts afresh.
CACHE_ENTRIES = 700_000
#: Letters after which a closing run of these marks is a piece of its own in both vocabularies.
_TAIL = "^( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|]+)$"
#: A text with a match holds white space that isn't a lone space or newline.
_ODD_SPACE = "[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_WHOLE = f"{_ODD_SPACE}{_ODD_SPACE}|[\\x00\\t\\r\\f\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes Arrow strings with one tokenizers file. keeps_space: pieces keep the space before them."""

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.keeps_space = keeps_space
        #: Whether an id ends a word, where the vocabulary marks word ends.
        self.word_ends: np.ndarray | None = None
        if suffix := getattr(self.library.model, "end_of_word_suffix", None):
            self.word_ends = np.zeros(self.library.get_vocab_size(), bool)
            self.word_ends[[i for name, i in self.library.get_vocab().items() if name.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lengths, self.pool = array("q"), array("q"), array("I")

    def _rows(self, pieces: list[str]) -> np.ndarray:
        """The cache's row of each piece; unknown ones are encoded first."""
        if len(self.index) + len(pieces) > CACHE_ENTRIES:
            self.clear()
        index = self.index
        unknown = [x for x in pieces if x not in index]
        if self.word_ends is not None:
            letters, others = [], []
            for x in unknown:
                (letters if x.isalpha() else others).append(x)
            unknown = self._joined(letters) + others
        for begin in range(0, len(unknown), 5000):
            part = unknown[begin : begin + 5000]
            for word, got in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                ids = got.ids
                index[word] = len(self.starts)
                self.starts.append(len(self.pool))
                self.lengths.append(len(ids))
                self.pool.extend(ids)
        return np.fromiter(map(index.__getitem__, pieces), np.int64, count=len(pieces))

    def _joined(self, words: list[str]) -> list[str]:
        """Encodes words of letters many to a text, parted by the ids that end words; returns those left over."""
        rest: list[str] = []
        parts = [words[i : i + 500] for i in range(0, len(words), 500)]
        for part, got in zip(parts, self.library.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(got.ids, np.int64)
            ends = np.flatnonzero(self.word_ends[ids]) + 1
            if len(ends) != len(part) or len(ids) != ends[-1]:
                rest += part
                continue
            self.index.update(zip(part, range(len(self.starts), len(self.starts) + len(part)), strict=True))
            lengths = np.diff(ends, prepend=0)
            self.starts.extend((len(self.pool) + ends - lengths).tolist())
            self.lengths.extend(lengths.tolist())
            self.pool.extend(got.ids)
        return rest

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.keeps_space:
            cut = pc.replace_substring(pc.replace_substring(texts, "\n", "\x00\n\x00"), " ", "\x00 ")
            lists = pc.split_pattern(cut, "\x00")
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        offsets = offsets - offsets[0]
        codes = np.asarray(coded.indices, dtype=np.int64)
        # the different chunks, less closing marks and, where that is safe, case
        fine = pc.split_pattern(pc.replace_substring_regex(coded.dictionary, _TAIL, "\\1\x00\\2"), "\x00")
        parts = fine.flatten()
        if not self.keeps_space:
            parts = pc.if_else(pc.string_is_ascii(parts), pc.ascii_lower(parts), parts)
        parts = parts.dictionary_encode()
        rows = self._rows(parts.dictionary.to_pylist())[np.asarray(parts.indices, dtype=np.int64)]
        starts, lengths, pool = np.array(self.starts, np.int64), np.array(self.lengths, np.int64), np.array(self.pool, np.uint32)
        n_parts = np.diff(np.asarray(fine.offsets, dtype=np.int64))
        part_ids = pool[ragged(starts[rows], lengths[rows])]
        chunk_ends = np.concatenate([[0], np.cumsum(lengths[rows])])[np.cumsum(n_parts)] if len(n_parts) else np.zeros(0, np.int64)
        chunk_lengths = np.diff(chunk_ends, prepend=0)
        counts = chunk_lengths[codes]
        ids = part_ids[ragged((chunk_ends - chunk_lengths)[codes], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
        return ids, np.diff(ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of ``texts`` (no nulls), and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        odd = np.asarray(pc.match_substring_regex(texts, _WHOLE if self.keeps_space else "\\x00"))
        if not odd.any():
            return self._by_pieces(texts)
        ids, counts = self._by_pieces(texts.filter(pa.array(~odd)))
        whole = [np.array(x.ids, np.uint32) for x in self.library.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]
        lengths = np.zeros(len(texts), np.int64)
        lengths[~odd], lengths[odd] = counts, [len(x) for x in whole]
        out = np.zeros(int(lengths.sum()), np.uint32)
        starts = np.cumsum(lengths) - lengths
        out[ragged(starts[~odd], counts)] = ids
        for at, x in zip(starts[odd], whole, strict=True):
            out[at : at + len(x)] = x
        return out, lengths


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """This worker's encoder of the file."""
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = PieceEncoder(path, keeps_space)
    return _ENCODERS[path, keeps_space]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's own."""
    if end_id is None:
        return ids, counts
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
