import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from lexforge.llm import lm, packing
from tests.llm.conftest import SCHEMA

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# language model


def slow_base(rows):
    tokens = {i: [*(w for w in WORDS.findall("".join(c.lower() if c.isascii() else c for c in t or ""))), None] for i, (_, t) in enumerate(rows)}
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(x for i, v in tokens.items() if not held[i] for x in v)
    n, v = sum(counts.values()), len(counts)
    return Counter((d, held[i], len(tokens[i]), sum(counts[x] > 0 for x in tokens[i]), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens[i]), 6)) for i, (d, _) in enumerate(rows))


def language(spark, docs):
    rng = np.random.default_rng(11)
    kinds = [[f"{a}{k}" for k in range(40)] for a in "abc"]
    rows = [(1000 + i, " ".join(rng.choice(kinds[i % 3], rng.integers(20, 80))), "en", "s", 1) for i in range(600)]
    return spark.createDataFrame(rows, SCHEMA).unionByName(docs).repartition(3)


def test_base_scores_and_the_gain_over_them(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "LANES", 32)
    monkeypatch.setattr(lm, "FAN_IN", 2)  # several levels of sums
    frame = language(spark, docs)
    got = lm.scored(frame.withColumn("block", F.lit("x"))).collect()
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == slow_base(rows)
    held = [r for r in got if r.held_out and r.doc_id >= 1000]
    assert sum(r.score for r in held) > 0.93 * sum(r.base_score for r in held)  # log10: less negative is better
    assert lm.scored(empty).count() == 0


def test_every_score_again(spark, docs, monkeypatch):
    """Document by document, token by token, from the counts and the weights that scoring used."""
    used = []

    def noisy(rows, n_blocks, vocabulary, flat, part, parts):
        used.append((vocabulary, (flat + np.random.default_rng(part).normal(0, 0.2, flat.shape)).astype(np.float32)))
        return used[-1][1]

    monkeypatch.setattr(lm, "averaged", noisy)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "TOKENS", 64)
    frame = language(spark, docs)
    got = Counter((r.doc_id, r.n_tokens, round(r.score, 3)) for r in lm.scored(frame).collect())
    vocabulary, flat = used[-1]
    w, counts, expected, bucket = lm.Weights(vocabulary, flat), Counter(), Counter(), {}
    lower = lambda t: WORDS.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10:
            counts.update(lower(text))
    for word, n in counts.items():
        if word not in vocabulary.words:
            total, kinds = bucket.get(b := zlib.crc32(word[-2:].encode()) % lm.RARE, (0, 0))
            bucket[b] = total + n, kinds + 1
    for doc_id, text in rows:
        tokens, state, before, score = [], np.zeros((lm.HIDDEN, 1), np.float32), lm.END, 0.0
        for word in [*lower(text), None]:
            b = None if word is None else zlib.crc32(word[-2:].encode()) % lm.RARE
            token = lm.END if word is None else vocabulary.words.get(word, int(vocabulary.rare[b]))
            states, state = lm.forward(w, np.array([[before]]), np.zeros((1, 1), bool), state)
            logits = w.wc @ states[:, 0] + w.bc[:, 0], w.wm[token // lm.MEMBERS] @ states[:, 0] + w.bm[token // lm.MEMBERS][:, 0]
            for x, at in zip(logits, divmod(token, lm.MEMBERS), strict=True):
                score += (x[at] - np.log(np.exp(x - x.max()).sum()) - x.max()) / np.log(10)
            if word is not None and word not in vocabulary.words:
                total, kinds = bucket.get(b, (0, 0))
                score += np.log10((counts[word] + 0.1) / (total + 0.1 * (kinds + 1)))
            before = token
            tokens.append(token)
        expected[doc_id, len(tokens), score] += 1
    assert got.total() == expected.total()
    mine = sorted(((i is None, i or 0, n, x) for (i, n, x), k in expected.items() for _ in range(k)))
    theirs = sorted(((i is None, i or 0, n, x) for (i, n, x), k in got.items() for _ in range(k)))
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-3 + 1e-4 * abs(a[3]) for a, b in zip(mine, theirs, strict=True))


def model():
    rng = np.random.default_rng(0)
    vocabulary = lm.Vocabulary([(f"w{i}", 100 - i) for i in range(60)], {b: (b, 2) for b in range(lm.RARE)}, 50)
    w = lm.Weights(vocabulary)
    w.flat += rng.normal(0, 0.3, w.flat.shape).astype(np.float32)
    w.bm[...] = np.where(w.bm < -20, np.float32(-30), w.bm)
    return vocabulary, w


def test_probabilities_add_up_and_words_are_found():
    vocabulary, w = model()
    state = np.random.default_rng(1).normal(size=(lm.HIDDEN, 1)).astype(np.float32)
    every = lm.log_probabilities(w, np.repeat(state, vocabulary.size, 1), np.arange(vocabulary.size))
    assert abs(np.exp(every).sum() - 1) < 1e-4
    # shares of a rare bucket: its words and one unseen word
    token = np.array([vocabulary.rare[5]] * 3)
    assert abs((10 ** vocabulary.share(token, np.array([3, 2, 0]))).sum() - 1) < 1e-9


def test_gradients_are_those_of_differences():
    vocabulary, w = model()
    rng = np.random.default_rng(2)
    inputs, goals = rng.integers(0, vocabulary.size, (5, 3)), rng.integers(0, vocabulary.size, (5, 3))
    starts = rng.random((5, 3)) < 0.2
    state = rng.normal(size=(lm.HIDDEN, 3)).astype(np.float32)
    g, *_ = lm.gradients(w, vocabulary, inputs, starts, goals, state)
    loss = lambda x: lm.gradients(x, vocabulary, inputs, starts, goals, state)[2]
    for name in ("e", "u", "wc", "bc", "wm", "bm"):
        mine = getattr(g, name).ravel()
        for at in np.argsort(-np.abs(mine))[:3]:
            plus, minus = (lm.Weights(vocabulary, w.flat.copy()) for _ in range(2))
            getattr(plus, name).ravel()[at] += 1e-2
            getattr(minus, name).ravel()[at] -= 1e-2
            assert abs((loss(plus) - loss(minus)) / 2e-2 - mine[at]) < 2e-3 + 0.05 * abs(mine[at])


def test_state_is_carried_through_whole_documents(monkeypatch):
    vocabulary, w = model()
    rng = np.random.default_rng(3)
    lengths = np.array([1, 200, 7, 33, 1, 64, 90])
    tokens = rng.integers(0, vocabulary.size, lengths.sum())
    monkeypatch.setattr(lm, "SCORE_LANES", 3)
    got = lm.likelihoods(w, tokens, lengths)
    at = 0
    for n in lengths:
        mine = tokens[at : at + n]
        states, _ = lm.forward(w, np.concatenate([[lm.END], mine[:-1]])[:, None], np.zeros((n, 1), bool), np.zeros((lm.HIDDEN, 1), np.float32))
        assert np.allclose(got[at : at + n], lm.log_probabilities(w, states, mine), atol=1e-4)
        at += n


def test_words_become_tokens_with_one_hash_an_ending(monkeypatch):
    vocabulary, _ = model()
    words = [*(f"{i}{end}" for i in range(2000) for end in ("ing", "é漢", "🙂")), "w7", "", "x", "w59", "w60"]
    expected = [vocabulary.words.get(w, int(vocabulary.rare[zlib.crc32(w[-2:].encode()) % lm.RARE])) for w in words]
    hashed = []
    real = zlib.crc32
    monkeypatch.setattr(lm.zlib, "crc32", lambda x: (hashed.append(x), real(x))[1])
    got = vocabulary.of(pa.array(words, pa.string()))
    assert got.tolist() == expected
    assert len(hashed) == len({w[-2:] for w in words if w not in vocabulary.words})
    assert len(vocabulary.of(pa.array([], pa.string()))) == 0


def test_exponentials_of_a_window_are_taken_for_all_classes_at_once(monkeypatch):
    vocabulary, w = model()
    rng = np.random.default_rng(4)
    inputs, goals = rng.integers(0, vocabulary.size, (2, 16, 8))
    calls, real = [], np.exp
    monkeypatch.setattr(lm.np, "exp", lambda *x, **more: (calls.append(x[0].shape), real(*x, **more))[1])
    lm.gradients(w, vocabulary, inputs, np.zeros(inputs.shape, bool), goals, np.zeros((lm.HIDDEN, 8), np.float32))
    assert len(calls) == 2


def test_weights_whose_exponentials_overflow():
    vocabulary, w = model()
    w.wc *= 100
    w.wm *= 100
    rng = np.random.default_rng(5)
    states, targets = rng.uniform(-1, 1, (lm.HIDDEN, 200)).astype(np.float32), rng.integers(0, vocabulary.size, 200)
    expected = np.zeros(200)
    for i, (c, m) in enumerate(zip(targets // lm.MEMBERS, targets % lm.MEMBERS, strict=True)):
        for x, at in ((w.wc @ states[:, i].astype(float) + w.bc[:, 0], c), (w.wm[c] @ states[:, i].astype(float) + w.bm[c][:, 0], m)):
            expected[i] += x[at] - x.max() - np.log(np.exp(x - x.max()).sum())
    assert expected.min() < -100
    assert np.allclose(lm.log_probabilities(w, states, targets), expected, rtol=1e-4, atol=1e-2)
    g, _, loss = lm.gradients(w, vocabulary, targets.reshape(10, 20), np.zeros((10, 20), bool), targets.reshape(10, 20), np.zeros((lm.HIDDEN, 20), np.float32))
    assert np.isfinite(g.flat).all() and np.isfinite(loss)


def test_scores_by_groups_of_documents(spark, docs, monkeypatch):
    """A block's documents are scored some at a time; each is whole and scores as in one go."""
    monkeypatch.setattr(lm, "averaged", lambda rows, n_blocks, vocabulary, flat, part, parts: (flat + np.random.default_rng(part).normal(0, 0.2, flat.shape)).astype(np.float32))
    frame = language(spark, docs)
    got = []
    for tokens in (1 << 20, 700):
        monkeypatch.setattr(lm, "SCORE_TOKENS", tokens)
        got.append(sorted(lm.scored(frame).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.base_score, r.score)))
    assert [tuple(r)[:5] for r in got[0]] == [tuple(r)[:5] for r in got[1]]
    assert np.allclose([r[5:] for r in got[0]], [r[5:] for r in got[1]], rtol=1e-5, atol=1e-4)


def test_groups_hold_each_document_once():
    block = lm.Block.__new__(lm.Block)
    block.lengths = np.array([0, 5, 1 << 21, 0, 3, 1 << 20, 7, 1 << 19])
    groups = list(block.groups())
    assert (np.sum(groups, axis=0) == 1).all()
    assert all(int((block.lengths[x] + 1).sum()) <= lm.SCORE_TOKENS or x.sum() == 1 for x in groups)


def test_updates_of_a_full_part(monkeypatch):
    vocabulary, w = model()
    seen = []
    monkeypatch.setattr(lm, "gradients", lambda w, v, inputs, starts, goals, state, *more: (seen.append(goals.shape), (lm.Weights(v, np.zeros_like(w.flat)), state, 0.0))[1])
    tokens = np.ones(256 * 2048, np.int64)
    lm.train(w, vocabulary, tokens, np.array([len(tokens)]), [np.zeros_like(w.flat), np.zeros_like(w.flat), 0])
    assert seen == [(16, 256)] * 128


def test_no_training_token_is_left_out(monkeypatch):
    vocabulary, w = model()
    rng = np.random.default_rng(6)
    monkeypatch.setattr(lm, "LANES", 5)
    for total in (1, 5 * 1024, 5 * 1024 + 3, 5 * 1040 + 4):
        tokens = rng.integers(0, vocabulary.size, total)
        seen, true = [], lm.gradients
        monkeypatch.setattr(lm, "gradients", lambda w, v, i, s, goals, state, *live, seen=seen, true=true: (seen.extend(goals.ravel() if not live or live[0] is None else goals[live[0]]), true(w, v, i, s, goals, state, *live))[1])
        lm.train(lm.Weights(vocabulary), vocabulary, tokens, np.array([total]), [np.zeros_like(w.flat), np.zeros_like(w.flat), 0])
        monkeypatch.setattr(lm, "gradients", true)
        assert Counter(seen) == Counter(tokens.tolist())
    # what doesn't count changes nothing
    inputs, goals, starts = rng.integers(0, vocabulary.size, (5, 3)), rng.integers(0, vocabulary.size, (5, 3)), np.zeros((5, 3), bool)
    live, state = np.ones((5, 3), bool), np.zeros((lm.HIDDEN, 3), np.float32)
    live[4, 1:] = False
    one = lm.gradients(w, vocabulary, inputs, starts, goals, state, live)
    inputs[4, 1:], goals[4, 1:] = 1, 2
    two = lm.gradients(w, vocabulary, inputs, starts, goals, state, live)
    assert np.allclose(one[0].flat, two[0].flat, atol=1e-6) and abs(one[2] - two[2]) < 1e-5


def test_codes_as_planes():
    codes = np.array([0, 1, 255, 256, 70_000, 2**31 - 1])
    assert (lm.from_planes(lm.planes(codes)) == codes).all()


def test_words_and_codes_compressed():
    for words in ([], [""], ["a", "", "漢字", "x\x00y", "z" * 70_000], [f"w{i}" for i in range(3000)]):
        column = pa.array(["before", *words], pa.string()).slice(1)
        got = lm.unpacked_words(lm.packed_words(column))
        got.validate(full=True)
        assert got.to_pylist() == words
    for size in (0, 1, 100_000):
        data = np.arange(size).astype(np.uint8)
        assert (lm.unsqueezed(lm.squeezed(data)) == data).all()
    assert len(lm.squeezed(lm.planes(np.arange(50_000) % 300))) < 50_000


# the pipeline


def test_pipeline_stages(spark, labelled, tmp_path):
    frame, labels = labelled
    body = [f"n{k}" for k in range(60)]
    more = [(900, " ".join(body), "en", "s", 1), (901, " ".join(body[:-1] + ["other"]), "en", "s", 1), (902, " ".join(f"k{k}" for k in range(40)) + " password=abcdefgh123", "en", "s", 1)]
    frame.unionByName(spark.createDataFrame(more, SCHEMA)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "secret scans":
            assert docs.filter("doc_id = 902").first().text.endswith("k39 [SECRET]")
    clean = {i for i in range(100, 500) if i % 4}
    assert clean <= seen["quality rules"] and 4 not in seen["quality rules"]
    assert clean <= seen["toxicity"] and not {i for i in range(100, 500) if i % 4 == 0} & seen["toxicity"]
    assert {900, 901} & seen["n-gram Jaccard join"] == {900} and clean <= seen["n-gram Jaccard join"]
    assert seen["packing"] == seen["secret scans"] == seen["n-gram Jaccard join"]
    whole = packing.digest(corpus_pipeline.run(spark, str(tmp_path)).withColumn("boundary", F.lit(False)))
    assert whole.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").exceptAll(docs.select("doc_id", "start", "length", "ids_crc32", "doc_tokens")).count() == 0


def test_pipeline_masks_both_halves_of_a_credential(spark, tmp_path):
    text = " ".join(f"k{k}" for k in range(40)) + "\nAWS_ACCESS_KEY_ID=AKIAABCDEFGHIJKL\nAWS_SECRET_ACCESS_KEY=aB3" + "x" * 37
    out = corpus_pipeline.secrets_stage(spark, spark.createDataFrame([(903, text, "en", "s", 1)], SCHEMA), str(tmp_path)).first().text
    assert out.endswith("\nAWS_[SECRET]\nAWS_SECRET_ACCESS_KEY=[SECRET]")


def test_pipeline_of_odd_tables(spark, labelled, docs, empty, tmp_path):
    """Empty, null and repeated rows, and columns with names that stages use themselves."""
    _, labels = labelled
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for k, frame in enumerate((empty, docs, docs.withColumn("score", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("verdict_of", F.lit(1)).withColumn("a.b", F.lit(2)))):
        now = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, now, str(tmp_path))
            assert out.columns == frame.columns, name
            out.write.parquet(str(tmp_path / f"{k}-{name}"))
            now = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
        last = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
        assert (last.count() == 0) == (now.count() == 0)
