import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from lexforge.llm import toxicity
from tests.llm.conftest import LABELS, SCHEMA, TEXTS

WORD = regex.compile(r"\p{L}+(?:'+\p{L}+)*")
PLAIN = toxicity.Lexicon({})


def slow_events(text, lexicon):
    """Totals by kind, from the rules as they are said, sign by sign."""
    totals = dict.fromkeys(toxicity.EVENTS, 0.0)
    for clause in re.split(r"[.!?;\n]", text.lower().replace("’", "'")):
        signs = [lexicon.sign(w) for w in WORD.findall(clause)]
        kinds = [s for s, _ in signs]
        alone = {}
        for i, (kind, weight) in enumerate(signs):
            if kind not in "IH":
                continue
            if "R" in kinds[:i]:
                totals["q"] += 0.25 * weight
            elif "N" in kinds[max(0, i - 3) : i]:
                totals["d"] += 0.25 * weight
            elif kind == "I" or "W" in kinds[:i]:
                alone[i] = (kind, weight * (1.5 if kind == "H" else 1.0))
        for i, (kind, weight) in alone.items():
            others = [j for j in alone if i < j]
            reach = min(i + 4, others[0] if others else len(kinds))
            aimed = "T" in kinds[max(0, i - 3) : i] or "T" in kinds[i + 1 : reach]
            totals[("a" if kind == "I" else "x") if aimed else ("i" if kind == "I" else "t")] += weight * (1.5 if aimed else 1.0)
    return [*(totals[e] for e in toxicity.EVENTS), len(WORD.findall(text.lower().replace("’", "'")))]


def of(text):
    return dict(zip(toxicity.EVENTS, toxicity.events(pa.array([text]), PLAIN)[0, :-1].tolist(), strict=True))


@pytest.mark.parametrize(
    "text,expected",
    [
        ("", {}), ("Nothing here.", {}), ("The dog is stupid.", {"i": 4}), ("You are an idiot!", {"a": 6}), ("You are not an idiot", {"d": 1}), ("She said that an idiot wrote", {"q": 1}),
        ("idiot. trash; scum\nloser", {"i": 16}), ("I will kill you", {"x": 9}), ("kill the lights", {}), ("they will destroy it all day", {"x": 9}), ("it is going to burn", {"t": 6}),
        ("we will not hurt anyone", {"d": 1}), ("Idiot2 idiot_x", {"i": 8}), ("idiotic éidiot", {}), ("pathetic worthless clown, you", {"i": 8, "a": 6}), ("'idiot' don’t", {"i": 4}),
    ],
)
def test_events_of_clauses(text, expected):
    assert {k: v for k, v in of(text).items() if v} == expected


def test_events_are_those_of_the_rules():
    rng = np.random.default_rng(0)
    lexicon = toxicity.Lexicon({"bad": ("I", 2.5), "wor-": ("I", 1.25), "worse-": ("I", 3.0), "zap": ("H", 2.0)})
    words = ["idiot", "bad", "words", "worsening", "zap", "kill", "will", "you", "not", "said", "the", "a", "don't", "on", ".", "!", "\n", "3x", "--", ","]
    texts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(400)] + [(t or "").replace("İ", "I") for t in TEXTS]  # one small letter for it, not a letter and a mark
    got = toxicity.events(pa.array(texts), lexicon)
    assert np.allclose(got, [slow_events(t, lexicon) for t in texts])


def test_weights_multiply_along_a_path():
    whole = toxicity.grammar()
    assert {o for _, outputs in whole.steps.values() for o in outputs} == {
        ("i", 1.0), ("a", 1.5), ("A", 1.5), ("t", 1.0), ("x", 1.5), ("X", 2.25), ("h", 1.0), ("h", 1.5), ("q", 0.25), ("d", 0.25)
    }


def test_long_and_hostile_texts():
    for text in ("a." * 500_000, "idiot " * 200_000, "x" * 2_000_000, "'" * 500_000, "\n" * 1_000_000, "ab" * 10 + " . " * 300_000):
        got = toxicity.events(pa.array([text, "you idiot"]), PLAIN)
        assert got[1].tolist() == [0, 6, 0, 0, 0, 0, 2] and np.isfinite(got).all()


def slow_counts(texts, kinds, units, n_kinds):
    out, clauses = defaultdict(lambda: [0] * (n_kinds + 2)), []
    for text, kind, unit in zip(texts, kinds.tolist(), units.tolist(), strict=True):
        found = set()
        for clause in re.split(r"[.!?;\n]", text.lower().replace("’", "'")):
            wish = False
            for w in WORD.findall(clause):
                entries = {w} | {w[:k] + "-" for k in range(3, 9) if k < len(w)}
                found |= entries
                if kind % 2:
                    for e in entries:
                        out[e][n_kinds] += unit
                        out[e][n_kinds + 1] += unit * wish
                wish |= w in ("will", "gonna", "should", "i'll")
        for e in found:
            out[e][kind] += unit
        clauses.append(found)
    return dict(out)


def test_counts_of_entries():
    rng = np.random.default_rng(1)
    words = ["will", "i'll", "abcdefghijkl", "abcdefgh", "abc", "ab", "Abcx", "hit", ".", "?", "\n", "7", "it’s"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(200)] + [(t or "").replace("İ", "I") for t in TEXTS]  # one small letter for it, not a letter and a mark
    kinds, units = rng.integers(0, 4, len(texts)), rng.integers(1, 1 << 30, len(texts))
    names, counts = toxicity.entry_counts(pa.array(texts), kinds, units, 4)
    assert dict(zip(names, counts.tolist(), strict=True)) == slow_counts(texts, kinds, units, 4)
    assert toxicity.entry_counts(pa.array(["", " "]), np.array([0, 1]), np.array([1, 1]), 2)[0] == []


def test_harm_is_what_follows_intent():
    counts = np.array([[0, 30], [0, 30], [30, 30], [100, 3]])
    found = toxicity.lexicon_of(["zap", "grub", "the", "will"], counts, np.array([[30, 25], [30, 3], [60, 0], [3, 0]]), np.array([300, 40])).entries
    assert found["zap"][0] == "H" and found["grub"][0] == "I" and "will" not in found
    assert found["the"][1] == pytest.approx(np.log(30.5 / 41) - np.log(30.5 / 301))


def test_fit_is_at_the_least_loss():
    """Texts with very different weights of events: a whole Newton step overshoots on these."""
    rng = np.random.default_rng(4)
    toxic = rng.random(20_000) < 0.1
    totals = np.zeros((len(toxic), len(toxicity.EVENTS) + 1))
    totals[:, -1] = rng.integers(1, 5000, len(toxic))
    totals[:, 0] = np.where(toxic, rng.exponential(400, len(toxic)), np.where(rng.random(len(toxic)) < 0.1, rng.exponential(3, len(toxic)), 0))
    totals[:, 1] = totals[:, 0] * (rng.random(len(toxic)) < 0.3)
    toxic ^= rng.random(len(toxic)) < 0.01
    rows = rng.choice([0.25, 1.0], len(toxic))
    w = toxicity.fit(totals, toxic, rows)
    x = toxicity.features(totals)
    pull = np.array([0.1] + [1.0] * (len(w) - 1))
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (rows * (p - toxic)) + pull * (w - toxicity.PRIOR)).max() < 1e-3
    assert abs(rows @ p - rows @ toxic) < 5 and p[toxic].mean() > 0.8


def test_scores_on_held_out_documents(labelled, spark, empty):
    frame, labels = labelled
    got = toxicity.scored(frame.withColumn("counts", F.lit("x")).withColumn("SCORE", F.lit("x")), labels).collect()
    assert len(got) == frame.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 < r.score < 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.doc_id % 4 == 0, r.predicted) for r in got if r.held_out and r.doc_id >= 100]
    assert held and all(toxic == bool(p) for toxic, p in held)
    # what is learned doesn't see held-out labels
    one, two = (toxicity.learned(frame, x) for x in (labels, labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))))
    assert (one.weights == two.weights).all() and one.lexicon.entries == two.lexicon.entries
    # every score again, from the rules
    texts = Counter((r.doc_id, r.text) for r in frame.collect())
    again = Counter()
    for (doc_id, text), n in texts.items():
        z = one.weights[0] + sum(w * np.log1p(x) for w, x in zip(one.weights[1:], slow_events((text or "").replace("İ", "I"), one.lexicon), strict=True))
        again[doc_id, round(float(1 / (1 + np.exp(-z))), 9)] += n
    assert Counter((r.doc_id, round(r.score, 9)) for r in got) == again
    assert toxicity.scored(empty, labels).count() == 0
    untaught = toxicity.learned(frame, labels.limit(0))
    assert (untaught.weights == toxicity.PRIOR).all() and untaught.lexicon.entries == PLAIN.entries
    kept = Counter(toxicity.filtered(frame, labels).select("doc_id", "text").collect())
    assert kept == Counter((r.doc_id, r.text) for r in frame.collect() if not (r.doc_id or 0) >= 100 or r.doc_id % 4)
    clash = frame.withColumn("score", F.lit("x")).withColumn("_Score", F.lit(1))
    assert toxicity.filtered(clash, labels).columns == clash.columns and toxicity.filtered(clash, labels).count() == sum(kept.values())


def test_an_invented_language(spark):
    """No word of the fixed lexicon: stems part toxic from clean, with endings that training never saw."""
    rng = np.random.default_rng(9)
    syllables = ["ka", "lo", "mi", "ren", "tus", "vor", "ela", "shi"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(60)]
        toxic = i % 5 == 0
        for at in rng.integers(0, 60, 4 if toxic else 0):
            words[at] = "grubzol" + word()
        rows.append((i, " ".join(words), "xx", "s", 1))
        labels.append((i, 1, int(toxic)))
    got = toxicity.scored(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).filter("held_out").collect()
    caught = [r.predicted for r in got if r.doc_id % 5 == 0]
    alarms = [r.predicted for r in got if r.doc_id % 5]
    assert len(caught) > 40 and np.mean(caught) > 0.95 and np.mean(alarms) < 0.02


def test_a_family_of_copies_weighs_as_one_text(spark):
    """Words of one toxic text with many near copies are no entries, and its family is in one fold."""
    rng = np.random.default_rng(10)
    rows, labels = [], []
    words = lambda n: [f"{a}{b}" for a, b in zip(rng.choice(["ka", "lo", "mi"], n), map(lambda x: "".join(chr(97 + int(c)) for c in str(x)), rng.integers(0, 3000, n)), strict=True)]
    copied = words(80)
    for i in range(600):
        toxic = i % 5 == 0
        if i % 10 == 0:
            text = list(copied)
            text[int(rng.integers(80))] = "changed" + chr(97 + i % 26)
        else:
            text = words(80)
            for at in rng.integers(0, 80, 4 if toxic else 0):
                text[at] = "grubzol"
        rows.append((i, " ".join(text), "xx", "s", 1))
        labels.append((i, 1, int(toxic)))
    frame, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    entries = toxicity.learned(frame, marks).lexicon.entries
    assert "grubzol" in entries and not set(entries) & set(copied)
    weights = toxicity.labelled(frame, marks, 1000).filter(F.col("kind") % 2 == 1).groupBy("units").count().collect()
    held = sum(not zlib.crc32(str(i).encode()) % 3 == 1 for i in range(0, 600, 10))
    # a copy whose change hits all of its MinHash values stands alone
    units = {r["units"]: r["count"] for r in weights}
    assert any(n >= 0.9 * held and unit == toxicity.UNIT // n for unit, n in units.items())
