import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexforge.llm import packing
from lexforge.llm.tokens import PieceEncoder
from tests.llm.conftest import TEXTS


@pytest.mark.parametrize("name,keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_are_the_library_s_ids(name, keeps_space):
    texts = [t or "" for t in TEXTS]
    ours = PieceEncoder(public_tokenizers.path(name), keeps_space)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    for part in (texts, texts[::-1]):
        ids, counts = ours.encode(pa.array(part))
        got = np.split(ids, np.cumsum(counts)[:-1])
        for text, one in zip(part, got, strict=True):
            assert one.tolist() == library.encode(text, add_special_tokens=False).ids, text


def expected(text):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_every_id_lies_in_one_piece_and_sequences_are_full(docs):
    window = 64
    pieces = packing.pack(docs.withColumn("ids", F.lit(1)).withColumn("part", F.lit("x")), window=window).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    whole = Counter((i, tuple(expected(t))) for i, t in rows)
    spans = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length > 0
        spans[p.sequence_id].append((p.offset, p.length))
    for k, got in spans.items():
        got.sort()
        assert got[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(got, got[1:], strict=False))
        assert sum(n for _, n in got) == window or k == max(spans)
    stream = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    built, at = Counter(), []
    for p in stream:
        assert p.start == len(at)
        at += np.frombuffer(bytes(p.ids), "<u4").tolist()
        if len(at) == p.doc_tokens:
            built[p.doc_id, tuple(at)] += 1
            at = []
    assert not at and built == whole
    firsts = {p.sequence_id for p in pieces if p.boundary}
    assert firsts


def test_sequences_and_digest(docs):
    pieces = packing.pack(docs, window=32).cache()
    made = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    by = defaultdict(list)
    for p in pieces.collect():
        by[p.sequence_id].append((p.offset, bytes(p.ids)))
    for k, v in by.items():
        assert bytes(made[k].ids) == b"".join(x for _, x in sorted(v)) and made[k].n_ids * 4 == len(made[k].ids)
    for d in packing.digest(pieces).join(pieces.select("sequence_id", "offset", "ids"), ["sequence_id", "offset"]).collect():
        assert d.ids_crc32 == zlib.crc32(bytes(d.ids))


def test_no_rows(empty):
    assert packing.pack(empty).count() == 0
