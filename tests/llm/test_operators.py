import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lexforge.llm import bpe, common, jaccard, quality, repair, secrets, sharding, topk
from tests.llm.conftest import SCHEMA, TEXTS

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def clashing(docs):
    for name in ("row", "words", "key", "part", "kind", "host", "n", "cid"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def test_ragged():
    rng = np.random.default_rng(14)
    for n in (0, 1, 2, 50):
        for high in (10, 1 << 33):
            starts, lengths = rng.integers(0, high, n), rng.integers(0, 4, n)
            assert common.ragged(starts, lengths).tolist() == [s + i for s, k in zip(starts.tolist(), lengths.tolist(), strict=True) for i in range(k)]


# sharding


def slow_shard(doc_id, names):
    def bid(name):
        seed = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
        h = xxhash.xxh64_intdigest(name.encode(), seed=seed)
        return -1.0 / np.log(((h >> 11) + 0.5) / 2.0**53)

    return max(range(len(names)), key=lambda i: (bid(names[i]), -i))


def test_sharding(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sharding.shard(clashing(docs), 8, 9).collect()
    eight, nine = [str(i) for i in range(8)], [str(i) for i in range(9)]
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), slow_shard(i, eight), slow_shard(i, nine)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == expected
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard(empty, 8, 9).count() == 0


def test_weighted_shards_take_their_share(spark):
    got = spark.range(20_000).select(sharding.rendezvous(F.col("id"), {"a": 1.0, "b": 3.0}).alias("s")).groupBy("s").count().collect()
    counts = {r.s: r["count"] for r in got}
    assert abs(counts[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), {"a": 0.0})


# quality rules


def slow_counts(text):
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def normal(line):
    return re.sub(r"[ \t-\r]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" \t\n\v\f\r")


def test_base_counts(docs, spark, empty):
    phrase = "one two three four five six seven eight nine "
    more = spark.createDataFrame([(100, phrase * 2 + "x", "en", "s", 1), (101, phrase + "and " + phrase, "en", "s", 1), (102, "a a a a a a a a a a a a", "en", None, 1), (103, "#*$%&|<># 1\n 2\n\n1\n 2\n", "en", "s", 1)], SCHEMA)
    all_docs = docs.unionByName(more)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.rules(clashing(all_docs)).collect())
    assert got == Counter((r.doc_id, *slow_counts(r.text or "")) for r in all_docs.collect())
    assert quality.rules(empty).count() == 0


def slow_runs(words):
    every = range(max(1, len(words) - 4) if words else 0)
    long = [i for i in every if len(words[i]) >= 9]
    return [hashlib.md5(" ".join(words[i : i + 5]).encode()).hexdigest() for i in (long if len(long) >= 16 else every)]


def slow_families(rows):
    values = []
    for _, text, host in rows:
        runs = slow_runs(WORDS.findall(text or ""))
        values.append([(host, k, v) for k, v in enumerate(f(x[at:] for x in runs) for at in (0, 8, 16) for f in (min, max))] if runs else [])
    count = Counter(v for own in values for v in own)
    return [max((count[v], *v[1:]) for v in own)[1:] if any(count[v] > 1 for v in own) else i for i, own in enumerate(values)]


def slow_rules(rows, most_docs, most_lost):
    by_line = defaultdict(set)
    for (_, text, host), family in zip(rows, slow_families(rows), strict=True):
        for line in (text or "").split("\n"):
            if WORDS.search(line):
                by_line[host, normal(line)].add(family)
    above = {k for k, v in by_line.items() if len(v) > most_docs}
    out = Counter()
    for i, text, host in rows:
        text = text or ""
        n, *_, repeated = slow_counts(text)
        lost = sum(len(WORDS.findall(x)) for x in text.split("\n") if WORDS.search(x) and (host, normal(x)) in above)
        out[i, n < 20 or 100 * repeated > 30 * n, lost, not (n < 20 or 100 * repeated > 30 * n) and lost <= most_lost * n] += 1
    return out


def test_sketches(spark, docs, monkeypatch):
    rng = np.random.default_rng(13)
    more = [(200 + i, " ".join("x" * int(k) + str(i) for k in rng.integers(1, 14, 10 * i)), "en", "s", 1) for i in range(12)]
    docs = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    monkeypatch.setattr(quality, "CHUNK", 7)
    got = Counter((r.doc_id, tuple(sorted(r.sketches))) for r in quality.base_counts(docs).collect())
    expected = Counter()
    for d in docs.collect():
        runs = slow_runs(WORDS.findall(d.text or ""))
        values = [xxhash.xxh64_intdigest(f(x[at:] for x in runs).encode(), seed=42) for at in (0, 8, 16) for f in (min, max)] if runs else []
        expected[d.doc_id, tuple(sorted(v - (v >> 63 << 64) for v in values))] += 1
    assert got == expected


def test_line_frequency(spark, docs, monkeypatch):
    rng = np.random.default_rng(3)
    body = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10_000, n))
    rows = [(1000 + i, f"{body(30)}\nTotal 12{i % 10} views\nshare this page", "en", "hot", 1) for i in range(30)]
    notices = [" ".join(f"n{k}x{j}" for k in range(10)) for j in range(6)]
    rows += [(2000 + i, "\n".join([*rng.permutation(notices)[:3], body(5)]), "en", "hot", 1) for i in range(60)]
    rows += [(3000 + i, "copy of one text " + "with its own words all over " * 1 + " ".join(f"c{k}" for k in range(30)), "en", "hot", 1) for i in range(40)]
    own = [f"m{k}" for k in range(200)]
    for i in range(40):  # near copies: one word changed, all in one line
        own[50:51] = [f"x{i}"]
        rows.append((5000 + i, " ".join(own[:100]) + "\n" + " ".join(own[100:]), "en", "hot", 1))
    rows += [(4000, body(40) + "\nshare this page", "en", "cold", 1), (4001, body(40), "en", None, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).unionByName(docs)
    limits = {"most_docs": 5, "most_lost": 0.7}
    got = Counter((r.doc_id, r.base_failed, r.lost_words, r.kept) for r in quality.rules(clashing(frame), **limits).collect())
    assert got == slow_rules([(r.doc_id, r.text, r.source) for r in frame.collect()], **limits)
    named = frame.withColumn("verdict_of", F.lit("x")).withColumn("_Verdict_kept", F.lit(False)).withColumn("row", F.lit(1)).withColumn("a.b", F.lit(1))
    out = quality.filtered(named, **limits)
    assert out.schema == named.schema
    kept = {r.doc_id: r.text for r in out.collect()}
    assert all(i in kept for i in range(3000, 3040)), "copies of one text are one document"
    assert all(len(kept[i].split()) == 200 for i in range(5000, 5040)), "and so are near copies"
    monkeypatch.setattr(quality, "MOST_BROADCAST", 0)
    assert Counter(quality.filtered(frame, **limits).collect()) == Counter(out.select(*frame.columns).collect())
    assert "share" not in kept[1000] and kept[4000].endswith("share this page") and not any(2000 <= (i or 0) < 2060 for i in kept)


# BPE


def test_bpe_is_the_library_s(docs, empty):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected[r.doc_id, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)] += 1
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.coded(clashing(docs)).collect())
    assert got == expected
    assert bpe.coded(empty).count() == 0


def test_speculation_is_verified():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), bpe.WordBPE(path)
    rng = np.random.default_rng(1)
    pieces = [x.replace("</w>", "") for x in list(Tokenizer.from_file(path).get_vocab()) if x.replace("</w>", "").isascii() and x.replace("</w>", "").isalpha()]
    words = sorted({"".join(rng.choice(pieces, rng.integers(1, 4))).lower()[:40] for _ in range(6000)} | {"a" * k for k in range(1, 40)} | {"ab" * k for k in range(1, 20)} | {"hahaha", "lololol", "mississippi"})
    ids, counts = ours.encode_words([w.encode() for w in words])
    for word, got in zip(words, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert got.tolist() == library.encode(word, add_special_tokens=False).ids, word
        assert ours.merged([word.encode()])[0].tolist() == got.tolist()
    assert 0 < ours.failed < ours.speculated
    assert bpe.decode([3306, 1002]) == "hello</w> world</w>"


# Re-Pair token files


def test_token_files(docs, spark, empty, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path = str(tmp_path / "ids")
    repair.write(clashing(docs), path)
    got = repair.read(spark, path).collect()
    expected = Counter((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1])) for r in docs.collect())
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in got) == expected
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (-1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    # any range of any document, from the rows of the file alone
    table = spark.read.parquet(path).toArrow()
    for batch in table.to_batches():
        for row in range(batch.num_rows):
            for doc, doc_id in enumerate(batch.column("doc_ids")[row].as_py()):
                for begin, end in ((0, 3), (5, 400), (0, 10**6), (7, 7)):
                    cut = tuple(repair.ids_between(batch, row, doc, begin, end).tolist())
                    assert any(i == doc_id and ids[begin:end] == cut for i, ids in expected)
    repair.write(empty, str(tmp_path / "none"))
    assert repair.read(spark, str(tmp_path / "none")).count() == 0


def test_grammar_round_trip_and_gain():
    rng = np.random.default_rng(5)
    for ids in (np.zeros(5000, np.uint32), rng.integers(0, 4, 20_000).astype(np.uint32), np.tile(rng.integers(0, 1000, 50), 200).astype(np.uint32), rng.integers(0, 40_000, 500).astype(np.uint32)):
        counts = np.array([0, 1, len(ids) // 2 - 1, 0, len(ids) - len(ids) // 2])
        rules, expanded, seq, symbols = repair.compress(ids, counts, 50_000)
        grammar = repair.Grammar(rules, expanded, 50_000)
        assert (grammar.expand(seq) == ids).all() and symbols.sum() == len(seq)
        ends = np.cumsum(symbols)
        for d, n in enumerate(counts):
            assert len(grammar.expand(seq[ends[d] - symbols[d] : ends[d]])) == n
    assert len(seq) == 500
    assert len(repair.compress(np.zeros(5000, np.uint32), np.array([5000]), 50_000)[2]) < 500


def test_long_passages_become_few_symbols():
    rng = np.random.default_rng(8)
    passage = rng.permutation(40_000)[:512].astype(np.uint32)
    ids = np.concatenate([np.concatenate([passage, rng.integers(0, 40_000, 3).astype(np.uint32)]) for _ in range(100)])
    rules, expanded, seq, symbols = repair.compress(ids, np.array([len(ids)]), 50_000)
    assert (repair.Grammar(rules, expanded, 50_000).expand(seq) == ids).all() and symbols.sum() == len(seq)
    assert expanded.max() > 16 and len(seq) < 100 * 16


# top-k search


def slow_top(vectors, k):
    out = []
    for a, (i, x) in enumerate(vectors):
        if i % 3:
            continue
        dot = lambda y: sum(p * q for p, q in zip(x, y, strict=False))
        found = sorted(((-dot(y), j) for b, (j, y) in enumerate(vectors) if b != a))[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return Counter(out)


@pytest.mark.parametrize("batch_bytes,block_rows,size", [(1 << 20, 2048, 1), (400, 7, 1), (1 << 20, 16, 1 << 20)])
def test_top_k(spark, batch_bytes, block_rows, size, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(2)
    vectors = [(int(i), [size * int(x) for x in rng.integers(-3, 4, rng.integers(0, 6))]) for i in rng.integers(0, 40, 60)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.ArrayType(T.LongType()))])
    frame = spark.createDataFrame(vectors, schema).repartition(3)
    got = topk.top_k(frame, F.col("id") % 3 == 0, 4, batch_bytes).collect()
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == slow_top(vectors, 4)


def test_vectors_that_take_no_part(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("id", T.StringType())])
    rows = [(0, [0.5, -0.001], "x"), (1, [1.0, 1.0], "x"), (2, None, "x"), (3, [None, 1.0], "x"), (4, [float("nan"), 1.0], "x"), (5, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (6, [], "x")]
    made = topk.integer_vectors(spark.createDataFrame(rows, schema))
    assert {r.id: r.vector for r in made.collect()} == {0: [128, -1], 1: [256, 256], 6: []}
    got = topk.top_k(made, F.col("id") == 0, 5).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got)] == [(1, 1, 128 * 256 - 256), (2, 6, 0)]
    assert topk.top_k(made.limit(0), F.col("id") == 0, 5).count() == 0


# secret scans

SECRETS = [
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and more', "PASSWORD:short passwd=longenough1 Secret = 'x'", "token=token: abcdefgh", "AKIAABCDEFGHIJKL AKIASHORT AKIAAKIAAKIAAKIAZ", "api_key=\"abc.def-ghi_j\" apikey: 12345678",
    "deadbeef" * 4 + " " + "deadbeef" * 3, "é🙂 token=abcdefghi 🙂 " + "0" * 40 + "z",
    "id AKIAABCDEFGHIJKL with aB3" + "x" * 37 + " ok", "alone aB3" + "x" * 37 + " ok", "user_id: someone@home " + "." * 400 + " aB3" + "x" * 37,
    "client_id=abcd https://db.example.com/path secret=longenough1", "https://db.example.com/path only", "secret=secret=abcdefgh", None, "",
]


def slow_base(text):
    spans = []
    for kind, pattern in (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")):
        for m in re.finditer(pattern, text):
            if len(m[2]) >= 8 if kind == "assign" else m.end() - m.start() >= (16 if kind == "access" else 32):
                spans.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(spans)]


def test_base_secrets(spark, docs, empty):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(SECRETS)]
    frame = spark.createDataFrame(rows + [rows[0], (None, SECRETS[0], None, None, None)], SCHEMA).unionByName(docs)
    expected = Counter()
    for r in frame.collect():
        base = slow_base(r.text or "")
        expected[r.doc_id, *(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(base).encode()).hexdigest()] += 1
    got = secrets.digest(secrets.scan(clashing(frame))).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == expected
    for r in got:
        assert hashlib.sha256(",".join(x for x in r.spans.split(",") if x.split(":")[0] in secrets.BASE).encode()).hexdigest() == r.base_sha256
    assert secrets.scan(empty).count() == 0


def test_parts_are_linked_within_scopes(spark, monkeypatch):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(SECRETS)], SCHEMA)
    kinds = {r.doc_id: [x.split(":")[0] for x in r.spans.split(",") if x] for r in secrets.digest(secrets.scan(frame)).collect()}
    assert kinds[7] == ["access", "secret"] and kinds[8] == [] and kinds[9] == [] and kinds[11] == []
    assert kinds[10] == ["ident", "endpoint", "assign"]
    named = frame.withColumn("spans_of", F.lit("x")).withColumn("Spans_found", F.lit(1)).withColumn("a.b", F.lit(1))
    out = secrets.redacted(named)
    assert out.columns == named.columns
    monkeypatch.setattr(secrets, "MOST_BROADCAST", 0)
    assert Counter(secrets.redacted(named).collect()) == Counter(out.collect())
    hidden = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert hidden[7] == ("id [SECRET] with [SECRET] ok", 28) and hidden[8][0] == SECRETS[8] and hidden[13][0] is None
    assert hidden[0][0] == '[SECRET]" and more' and hidden[6][0] == "é🙂 [SECRET] 🙂 [SECRET]z"


def slow_spans(text, scope):
    """All pairs of parts, as the docstring says."""
    mine = [
        (secrets.ASSIGN, lambda m: len(m[2]) >= 8), (secrets.ACCESS, lambda m: len(m[0]) >= 16), ("[0-9a-f]+", lambda m: len(m[0]) >= 32),
        (secrets.SECRET, lambda m: re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])), (secrets.IDENT, lambda m: True), (secrets.ENDPOINT, lambda m: True),
    ]
    parts = sorted((m.start(), k, m.end()) for k, (pattern, good) in enumerate(mine) for m in re.finditer(pattern, text) if good(m))

    def near(p, kinds):
        return any(q != p and q[1] in kinds and (q[2] <= p[0] + (q[2] - p[0] if (q[0], q[1]) < (p[0], p[1]) else 0) and p[0] - q[2] <= scope if (q[0], q[1]) < (p[0], p[1]) else q[0] - p[2] <= scope) for q in parts)

    out = []
    for p in parts:
        ident, secret, endpoint = near(p, (1, 4)), near(p, (0, 2, 3)), near(p, (5,))
        covered = any(q[1] < 3 and q[2] > p[0] for q in parts if (q[0], q[1]) < (p[0], p[1]))
        if p[1] < 3 or p[1] == 3 and (ident or endpoint) and not covered or p[1] == 4 and secret or p[1] == 5 and ident and secret:
            out.append(f"{secrets.KINDS[p[1]]}:{p[0]}:{p[2]}")
    return ",".join(out)


def test_links_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(12)
    secret = lambda: "".join(rng.choice(list("abcXYZ0189+/"), 40))
    parts = [lambda: "AKIA" + "ABCDEFGHIJKL"[: rng.integers(9, 13)] + "9", secret, secret, lambda: "user_id: someone", lambda: "account_name=x9_y-z", lambda: "https://host.example/path", lambda: "db.in-house.org:5432", lambda: "password = hunter2hunter2", lambda: "deadbeef" * 4, lambda: "token: abc"]
    texts = []
    for _ in range(300):
        text = ""
        for k in rng.integers(0, len(parts), rng.integers(0, 7)):
            text += parts[k]() + rng.choice([" ", "\n", " \"", "é ", " " + ". " * int(rng.integers(0, 400))])
        texts.append(text)
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.scan(frame)).collect()}
    assert got == {i: slow_spans(t, secrets.SCOPE) for i, t in enumerate(texts)}
    assert sum("secret:" in x for x in got.values()) > 30 and sum("endpoint:" in x for x in got.values()) > 20


def test_long_and_hostile_texts(spark):
    """A megabyte of what patterns might trip over; and one text of 50 MB."""
    long = [x * (1_000_000 // len(x)) + " : x" for x in ("a.", "Ab ", "ab", "7", "[", "\n", "a-", "token", "token ", "user_id ", "http://", "A", "AKIA", "0a", "=", "aB3/" * 10 + " ")]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*long, "one two " * 6_000_000 + "password=abcdefgh9"])]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in secrets.digest(secrets.scan(frame)).collect()}
    assert len(got) == len(rows) and got[len(long)].n_assign == 1
    for i, t in enumerate(long):
        if i not in (7, 8, 12):  # every place of these is a start for Python's search
            assert got[i].n_hex == len([x for x in re.findall("[0-9a-f]+", t) if len(x) >= 32])
    shorter = frame.withColumn("text", F.substring("text", 1, 4_000_000))
    assert quality.rules(shorter).filter("n_words > 0").count() >= 12


def test_secrets_of_key_value_files(spark):
    secret = "aB3" + "x" * 37
    texts = [f"AWS_ACCESS_KEY_ID=AKIAABCDEFGHIJKL\nAWS_SECRET_ACCESS_KEY={secret}\n", f"AWS_SECRET_ACCESS_KEY={secret}\n", f"AKIAABCDEFGHIJKL {secret}= x", f"AKIAABCDEFGHIJKL token={secret}"]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id: r.spans.split(",") for r in secrets.digest(secrets.scan(frame)).collect()}
    at = texts[0].index(secret)
    assert found[0] == ["ident:4:34", "access:18:34", f"secret:{at}:{at + 40}"]
    assert found[1] == [""] and found[2] == ["access:0:16"] and [x.split(":")[0] for x in found[3]] == ["access", "assign"]
    hidden = {r.doc_id: r.text for r in secrets.redacted(frame).collect()}
    assert hidden[0] == "AWS_[SECRET]\nAWS_SECRET_ACCESS_KEY=[SECRET]\n" and hidden[1] == texts[1]


# n-gram Jaccard join


def slow_links(rows):
    def grams(text):
        words = WORDS.findall(text)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [grams(t) for t in rows]
    linked = defaultdict(set)
    for x in range(len(rows)):
        for y in range(x):
            union = len(sets[x] | sets[y])
            if rows[x] == rows[y] or union and len(sets[x] & sets[y]) >= 0.8 * union:
                linked[x].add(y)
                linked[y].add(x)
    return linked


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_join(spark, docs, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(common, "HOT_ROWS", block)  # 4: nearly every key with links is hot
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text, "en", "s", 1) for r in docs.collect()]
    for group in range(6):
        words = [f"g{group}w{x}" for x in rng.integers(0, 400, 60 + 40 * group)]
        for copy in range(2 + 3 * group):
            changed = list(words)
            for at in rng.integers(0, len(words), rng.integers(0, 3)):
                changed[at] = f"new{rng.integers(10**6)}"
            rows.append((1000 + 100 * group + copy, " ".join(changed), "en", "s", 1))
    rows += [rows[-1], rows[-2], (5000, rows[-1][1].replace(" ", "  \n"), "en", "s", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    linked = slow_links([t or "" for _, t, *_ in rows])
    got = jaccard.join(clashing(frame)).collect()
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, ys in linked.items():
        for y in ys:
            root[find(x)] = find(y)
    least = {}
    for x, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    expected = Counter((i, least.get(find(x)), len(linked[x])) for x, (i, *_) in enumerate(rows))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == expected
    named = frame.withColumn("copy_of", F.lit("x")).withColumn("Copy_gone", F.lit(1)).withColumn("rows", F.lit(1)).withColumn("a.b", F.lit(1))
    out = jaccard.deduplicated(named)
    assert out.columns == named.columns
    kept = Counter((r.doc_id) for r in out.collect())
    assert all(n == 1 for n in kept.values()) and sum(kept.values()) == len({find(x) for x in range(len(rows))})


def test_no_documents(empty):
    assert jaccard.join(empty).count() == 0 and jaccard.deduplicated(empty).count() == 0


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9)):
        b, r = jaccard.bands_and_rows(threshold, recall, 256)
        assert 1 - (1 - threshold**r) ** b >= recall and b * r <= 256


assert len(TEXTS) > 20
