"""The model tier: batches, halving, retries, replies, with backends that answer by rules."""

import json

import pytest
from pyspark.sql import functions as F

from lexforge.operators import classify, models, spans, summaries
from lexforge.sources import backends

SPANS = "file_id string, start int, end int, text string, entity_type string, confidence double"


def found(spark, rows):
    return spark.createDataFrame([(f, s, s + len(t), t, "PER", c) for f, s, t, c in rows], SPANS)


def test_verdicts_of_many_batches(spark):
    names = [("a", 20 * i, f"Ann Corp{i}" if i % 3 == 0 else f"Bob Lind{i}", 0.5) for i in range(120)]
    docs = spark.createDataFrame([("a", " ".join(f"{t:<19}" for _, _, t, _ in names)), ("b", "")], "file_id string, text string")
    got = models.classified(found(spark, names), docs, "rules").collect()
    assert len(got) == 120 and {r.batch_id for r in got} == {0, 2, 4}
    assert all(r["drop"] == ("Corp" in r.text) and r.is_person != r["drop"] and r.classification_confidence != classify.DEFAULT_CONFIDENCE for r in got)
    d = models.diagnostics(spark.createDataFrame(got)).first()
    assert tuple(d) == (120, 120, 0, 3, 0)
    assert models.classified(found(spark, names).limit(0), docs, "rules").count() == 0


def test_batches_over_the_input_limit_are_halved(spark, monkeypatch):
    rows = found(spark, [("a", 10 * i, "Ann Lind", 0.5) for i in range(7)] + [("b", 0, "Bob Ito", 0.5)])
    docs = spark.createDataFrame([("a", "x" * 9000), ("b", "y")], "file_id string, text string")
    whole = classify.halved(classify.batched(rows), docs)
    assert {(r.file_id, r.batch_id) for r in whole.collect()} == {("a", 0), ("b", 0)}
    monkeypatch.setattr(classify, "MOST_INPUT", 4000)
    halves = classify.halved(classify.batched(rows), docs).groupBy("file_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("output_budget").alias("o")).collect()
    assert {(r.file_id, r.batch_id): (r.n, r.o) for r in halves} == {("a", 0): (4, 300), ("a", 1): (3, 250), ("b", 0): (1, 150)}


def test_files_of_defaults_are_asked_again(spark):
    """The first round says nothing; what the second says counts."""
    names = [("a", 10 * i, f"Ann Lind{i}", 0.5) for i in range(4)]
    docs = spark.createDataFrame([("a", "text")], "file_id string, text string")

    def first_round(prompts, backend, **_):
        calls.append(prompts.count())
        return prompts.withColumn("reply", F.lit("nothing") if len(calls) == 1 else F.lit(json.dumps([{"span_index": i, "is_person": False, "drop": True, "reason": "other"} for i in range(4)])))

    calls = []
    mp = pytest.MonkeyPatch()
    mp.setattr(models, "asked", first_round)
    try:
        got = models.classified(found(spark, names), docs, "rules").collect()
    finally:
        mp.undo()
    assert len(calls) == 2 and len(got) == 4 and all(r["drop"] and not r.is_person for r in got)


def test_yes_no(spark):
    rows = spark.createDataFrame([(x,) for x in ("Ann Lind", "ann lind", "12345", "", None, "Bo")], "name string")
    got = {r.name: (r.is_valid, r.confidence, r.reason) for r in models.validated_names(rows, "rules").collect()}
    assert got["Ann Lind"] == (True, 0.75, "model_yes") and got["ann lind"] == (False, 0.75, "model_no") and got["12345"][1:] == (0.95, "matches_garbage_pattern_0")
    assert got[""][2] == "empty" and got[None][2] == "empty" and not got["Bo"][0]
    assert {r.name: r.reason for r in models.validated_names(rows, "rules", heuristics=False).collect()}["12345"] == "model_no"


def test_recovered_names_are_borne_out(spark, monkeypatch):
    text = "x" * 3990 + " Ann Lind and BOB ITO; ann lind " + "y" * 5000 + " Cara Venn"
    docs = spark.createDataFrame([("a", text, text), ("b", "", "")], "file_id string, raw_text string, clean_text string")
    got = {(r.start, r.text, r.role, r.normalized_name) for r in models.recovered(docs, "rules").collect()}
    assert got == {(3991, "Ann Lind", "mentioned", "Ann Lind"), (len(text) - 9, "Cara Venn", "mentioned", "Cara Venn")}
    said = [{"evidence_text": "ANN LIND", "start": 3991, "end": 3999, "role": "boss"}, {"evidence_text": "Ann Lind", "start": 3991, "end": 3999, "role": "sender"}, {"evidence_text": "Ann Lind", "start": 3990, "end": 3998}, {"evidence_text": "", "start": 0, "end": 5}, {"evidence_text": "Zed", "start": 9_000_000, "end": 9_000_003}, {"start": 1}]
    monkeypatch.setattr(models, "replied", lambda prompts, backend: prompts.withColumn("reply", F.when(F.col("chunk_start") == 0, F.lit("Sure: " + json.dumps(said))).otherwise(F.lit("no [json"))))
    assert [(r.start, r.end, r.text, r.role) for r in models.recovered(docs, "rules").collect()] == [(3991, 3999, "Ann Lind", "mentioned")]


def test_entities_of_windows(spark):
    text = "The " + "word " * 407 + "Ann Lind here. " + "more " * 300 + "Bob Ito"
    docs = spark.createDataFrame([("a", text), ("b", None), ("c", " ")], "file_id string, text string")
    got = sorted((r.start, r.text) for r in models.entities(docs, "mock").collect())
    assert got == [(0, "The"), (text.index("Ann"), "Ann Lind"), (text.index("Bob"), "Bob Ito")]
    with pytest.raises(ValueError):
        backends.tagger("none")


def test_halving_on_memory_errors():
    calls = []

    def run(items):
        calls.append(len(items))
        if len(items) > 2 or "big" in items:
            raise MemoryError
        return [x.upper() for x in items]

    assert backends.halving(run, ["a", "b", "big", "c", "d"], "none") == ["A", "B", "none", "C", "D"] and max(calls) == 5


def strict():
    from lexforge.sources.backends import MockBackend, TooLong

    def reply(prompt):
        if len(prompt) > 10:
            raise TooLong
        return str(len(prompt))

    return MockBackend(reply)


def test_only_prompts_that_are_too_long_are_cut(spark):
    prompts = spark.createDataFrame([(1, "x" * 5), (2, "x" * 30), (3, None), (4, "y" * 10)], "i int, prompt string")
    got = {r.i: r.reply for r in summaries.replied(prompts, strict, most_chars=8).collect()}
    assert got == {1: "5", 2: "8", 3: "0", 4: "10"}


def test_reduce_goes_on_until_prompts_fit(spark):
    pages = spark.createDataFrame([("a", str(i), i, "s" * 300) for i in range(1, 200)] + [("b", "1", 1, "short")], "file_id string, page string, page_number int, summary string")
    out = summaries.reduced(pages, lambda lines: F.substring(lines, 1, 300), limit=1000).collect()
    per = {}
    for r in out:
        per.setdefault(r.file_id, []).append(r)
    assert len(per["b"]) == 1 and sum(len(r.summary) + 12 for r in per["a"]) / 3 + 700 <= 1000


assert spans.CHUNK == 2048
