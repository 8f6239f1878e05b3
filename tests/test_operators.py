import random
import re

import pytest
from pyspark.sql import functions as F

from lexforge.functions import cleaning
from lexforge.operators import classify, names, search, spans, summaries, validation, work
from lexforge.plans import pipeline
from lexforge.sources import backends, files

SPAN = "file_id long, start int, end int, text string, entity_type string, confidence double, page_number int"


def span(i, start, end, text, confidence=0.7):
    return (i, start, end, text, "PER", confidence, None)


TEXTS = ["From: Mara Venn\nOtto Lind X", "éAnna BobX Cid", "Mara Venn Otto Lind met", "1. Ann Lee; Bob Ray", "", "To: J0hn Sm1th. Dear Émile Zola", "Vincent Inc of New York"]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "file_id long, text string")


def test_matches_and_entities(docs):
    pattern = re.compile(r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b")
    expected = sorted((i, m.start(), m.end(), m[0]) for i, t in enumerate(TEXTS) for m in pattern.finditer(t) if len(m[0]) >= 3)
    assert sorted((r.file_id, r.start, r.end, r.text) for r in spans.mock_entities(docs).collect()) == expected


def test_overlaps(spark):
    rows = [span(1, 0, 10, "a" * 10, 0.6), span(1, 5, 12, "b" * 7, 0.9), span(1, 20, 24, "cccc", 0.5), span(1, 20, 24, "cccc", 0.4), span(2, 0, 5, "x", 0.5), span(2, 3, 9, "y", 0.5)]
    got = spans.without_overlaps(spark.createDataFrame(rows, SPAN)).collect()
    assert sorted((r.file_id, r.start, r.end) for r in got) == [(1, 5, 12), (1, 20, 24), (2, 0, 5)]


def test_splits(spark, docs):
    rows = [span(2, 0, 19, "Mara Venn Otto Lind"), span(3, 0, 19, "1. Ann Lee; Bob Ray"), span(0, 6, 15, "Mara Venn"), span(9, 0, 4, "Lost")]
    got = spans.split_names(spark.createDataFrame(rows, SPAN), docs).collect()
    assert sorted((r.file_id, r.start, r.end, r.text) for r in got) == [(0, 6, 15, "Mara Venn"), (2, 0, 9, "Mara Venn"), (2, 10, 19, "Otto Lind"), (3, 3, 10, "Ann Lee"), (3, 12, 19, "Bob Ray"), (9, 0, 4, "Lost")]
    assert spans.capital_groups("Jan van der Berg Ann de Lee Jr.") == [(0, 16), (17, 31)]


def test_candidates_and_recovery(docs):
    got = {(r.file_id, r.text, r.pattern) for r in spans.candidates(docs).collect()}
    assert (5, "J0hn Sm1th. Dear", "header") in got or any(p == "header" and i == 5 for i, _, p in got)
    assert (2, "Mara Venn Otto Lind", "capitalized") in got
    ready = docs.select("file_id", F.col("text").alias("raw_text"), F.col("text").alias("clean_text"))
    for r in spans.recovered(ready).collect():
        assert TEXTS[r.file_id][r.start : r.end] == r.text and r.confidence == 0.5


def test_validation(spark, docs):
    rows = [span(0, 6, 15, "Mara Venn"), span(0, 6, 15, "Otto Lind"), span(0, 6, 99, "Mara Venn"), span(0, 5, 6, " "), span(0, 6, 25, "Mara Venn Otto Lind")]
    got = spans.validated(spark.createDataFrame(rows, SPAN), docs.withColumnRenamed("text", "raw_text")).collect()
    assert sorted((r.start, r.end, r.error or "") for r in got) == [(5, 6, "empty"), (6, 15, ""), (6, 15, "mismatch"), (6, 25, ""), (6, 99, "out_of_bounds")]
    stored = spark.createDataFrame([(0, 0, "Mara Venn", 6, 15), (0, 1, "Mara Venn", None, None), (0, 2, "Otto Lind", 6, 15), (77, 0, "x", 0, 1)], "file_id long, name_index int, original_text string, start int, end int")
    checked = validation.issues(stored, docs)
    assert {(r.file_id, r.name_index): r.issue_type for r in checked.collect()} == {(0, 0): None, (0, 1): "missing_offsets", (0, 2): "mismatch", (77, 0): None}
    assert tuple(validation.report(checked).first()) == (2, 4, 2, 2, 1) and validation.fixed(checked).count() == 2


def test_pages(spark):
    pages = spark.createDataFrame([(1, 1, "ab"), (1, 2, ""), (2, 1, None)], "file_id long, page_number int, text string")
    b = spans.boundaries_of(pages)
    assert sorted(tuple(r) for r in b.collect()) == [(1, 1, 0, 13), (1, 2, 13, 24), (2, 1, 0, 11)]
    got = spark.sql("select array(named_struct('page_number', 1, 'text', 'ab'), named_struct('page_number', 2, 'text', '')) p").select(cleaning.page_boundaries(F.col("p")).alias("b"))
    assert got.first().b == [0, 13, 24]
    assert tuple(got.select(*(cleaning.page_of(F.col("b"), F.lit(o)) for o in (12, 13, 24))).first()) == (1, 2, 3)
    at = spans.with_pages(spark.createDataFrame([(1, 12), (1, 13), (1, 24)], "file_id long, start int"), b)
    assert sorted((r.start, r.page_number) for r in at.collect()) == [(12, 1), (13, 2), (24, None)]
    text = spark.sql("select '' f, '' t, array(named_struct('page_number', 1, 'text', ' a '), named_struct('page_number', 2, 'text', ' ')) p, array('x', 'y') g")
    assert text.select(cleaning.assembled(F.col("f"), F.col("t"), F.col("p"), F.col("g"))).first()[0] == "[Page 1]\na"


def test_classifier(spark):
    rows = spark.createDataFrame([span(0, 0, 7, "Vincent", 0.7), span(0, 10, 18, "New York", 0.9), span(0, 20, 29, "Mara Venn", 0.7)], SPAN)
    assert [(r.text, r.drop_reason) for r in classify.mock_classified(rows).orderBy("start").collect()] == [("Vincent", "organization"), ("New York", "location"), ("Mara Venn", None)]
    reply = '[{"span_index": 0, "drop": true, "reason": "organization"}, {"span_index": 1, "drop": true, "reason": "location"}]'
    replies = spark.createDataFrame([(0, 0, reply)], "file_id long, batch_id int, reply string")
    got = classify.decided(rows, replies).orderBy("start").collect()
    assert [(r.drop, r.drop_reason, r.classification_confidence) for r in got] == [(True, "organization", 0.8), (False, None, 0.8), (False, None, 0.5)]
    assert tuple(classify.counts(classify.decided(rows, replies)).first()) == (0, 3, 2, 1, 1)
    assert classify.to_retry(classify.decided(rows, replies.limit(0))).count() == 1
    assert classify.batched(rows, 2).agg(F.max("batch_id"), F.max("output_budget")).first() == (1, 200)


def test_names_of_files(spark):
    schema = "file_id long, name_index int, normalized_name string, original_text string, role string, confidence double"
    rows = spark.createDataFrame([(1, 0, "mara venn", "", "mentioned", None), (1, 1, "", "Mara Venn", "sender", None), (1, 2, "Otto Lind", "", "attorney", 0.70), (1, 3, "Nina Ito", "", "sender", 0.69), (2, 0, "AB", None, "sender", 0.9)], schema)
    got = names.clean_files(rows).collect()
    assert sorted((r.clean_name, r.role) for r in got) == [("Mara Venn", "sender"), ("Otto Lind", "mentioned")]
    assert tuple(names.statistics(rows).select("total_names", "garbage_names", "roles_remapped", "kept_names", "deduplicated").first()) == (5, 2, 1, 2, 1)
    assert names.uncleaned(rows, names.clean_files(rows)).collect()[0].file_id == 2
    assert [n.name for n in names.lookup(rows.filter("file_id = 1"), rows.limit(0)).first().names] == ["Mara Venn", "Nina Ito", "Otto Lind"]


def test_work(spark):
    stems = lambda n: spark.createDataFrame([(f"s{i:03d}",) for i in range(n)], "stem string")
    for n, w, sizes in ((7, 4, [2, 2, 2, 1]), (5, 4, [2, 2, 1]), (1, 3, [1])):
        got = work.assigned(stems(n), w).groupBy("worker").count().orderBy("worker").collect()
        assert [r["count"] for r in got] == sizes and [r.worker for r in got] == list(range(len(sizes)))
    assert work.pending(stems(5), stems(3)).count() == 2
    assert not work.suspicious(stems(5), stems(5)).first().warning
    lines = spark.createDataFrame([(1, "a", 3), (2, "a", 5), (1, "b", None)], "seq long, stem string, person_spans int")
    assert {r.stem: r.person_spans for r in work.latest(lines).collect()} == {"a": 5, "b": None}
    gate = spark.createDataFrame([(0, 199, 0.9), (0, 200, 0.1), (0, 200, 0.2), (1, 10, 0.0)], "s int, n int, x double").select(work.nothing_to_do(F.col("s"), F.col("n"), F.col("x")).alias("g")).collect()
    assert [r.g for r in gate] == [True, True, False, False]


def test_chunks_of_prompts(spark):
    rows = spark.createDataFrame([("p", i, 10) for i in range(3)] + [("q", 0, 50), ("q", 1, 1)], "group string, idx int, tokens int")
    got = {(r.group, r.idx): r.chunk for r in summaries.chunked(rows, 16, 20).collect()}
    assert got == {("p", 0): 0, ("p", 1): 0, ("p", 2): 1, ("q", 0): 0, ("q", 1): 1}


def test_replied_tries_again(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "boom"), (3, None)], "i int, prompt string")
    assert {r.i: r.reply for r in summaries.replied(prompts, "mock").collect()}[1].startswith('{"summary"')
    assert backends.halving(lambda x: [i * 2 for i in x], [1, 2, 3]) == [2, 4, 6]

    def heavy(x):
        if len(x) > 1:
            raise MemoryError
        return [x[0] + 1]

    assert backends.halving(heavy, [1, 2, 3]) == [2, 3, 4]
    with pytest.raises(ValueError):
        backends.backend("none")


def test_reduce(spark):
    pages = spark.createDataFrame([(1, str(i), i, "x" * 300) for i in range(1, 8)] + [(2, "1", 1, "y")], "file_id long, page string, page_number int, summary string")
    got = summaries.reduced(pages, lambda lines: F.substring(lines, 1, 200), limit=500, overhead=100).collect()
    assert [r.page for r in got if r.file_id == 2] == ["1"] and 1 <= len([r for r in got if r.file_id == 1]) < 7


def test_sources(spark, tmp_path):
    import zipfile

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_bytes(b"fine \xff text")
    (tmp_path / "two.PDF").write_bytes(b"x")
    (tmp_path / "three.xyz").write_bytes(b"x")
    with zipfile.ZipFile(tmp_path / "four.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>Two</w:t></w:r></w:p></w:body></w:document>')
    assert sorted(r.kind for r in files.discovered(spark, str(tmp_path)).collect()) == ["docx", "pdf", "txt"]
    assert files.texts(spark, str(tmp_path)).first().text == "fine  text"
    assert files.docx(spark, str(tmp_path)).first().text == "One\n\nTwo"
    (tmp_path / "j").mkdir()
    for name, body in (("d1.json", '{"full_text": "t"}'), ("d1_ner.json", "{}"), ("d2.json", "{broken"), ("d3_summary.json", ""), ("d4_summary.json", '{"a": 1}'), ("d5_summary.json", "{")):
        (tmp_path / "j" / name).write_text(body)
    got = {r.file_id: r.full_text for r in files.json_documents(spark, str(tmp_path / "j")).collect()}
    assert got == {"d1": "t", "d2": None}
    assert sorted(r.problem for r in files.broken_summaries(spark, str(tmp_path / "j")).collect()) == ["corrupted", "empty"]
    shown = files.recognised(spark.createDataFrame([(1, bytearray(b"hi")), (2, None)], "i int, content binary")).orderBy("i").collect()
    assert [(r.text, r.confidence) for r in shown] == [("hi", 0.95), ("", 0.0)]


def test_streaming(spark, tmp_path):
    from lexforge.streaming import ingest

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "file_id long, text string")
    rows.write.parquet(str(tmp_path / "in"))
    run = lambda: ingest.processed(ingest.arriving(spark, str(tmp_path / "in"), rows.schema), lambda d: d, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    run()
    spark.createDataFrame([(2, "b"), (3, "c")], "file_id long, text string").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(r.file_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_search(spark):
    rows = spark.createDataFrame([(1, "Mara Venn"), (2, "VENN, MARA"), (3, "Otto Lind"), (4, "Mara Vann"), (5, "Ottilie Quill")], "file_id long, name string")
    assert search.route("doc00123") == "file" and search.route('"Mara"') == "exact" and search.route("Lind") == "phonetic" and search.route("mara ven") == "fuzzy"
    assert [r.file_id for r in search.exact(rows, "mara  VENN").collect()] == [1]
    assert {r.file_id for r in search.search(rows, "Mara Ven").collect()} >= {1, 4}
    assert {(r.a, r.b) for r in search.similar_pairs(rows, 0.5).collect()} == {("Mara Vann", "Mara Venn"), ("Mara Venn", "VENN, MARA")}
    groups = {r.name: r.entity for r in search.entities(spark, rows, 0.5).collect()}
    assert groups["Mara Venn"] == groups["VENN, MARA"] == groups["Mara Vann"] != groups["Otto Lind"]


def test_entities_of_long_chains(spark):
    rng = random.Random(5)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(310))
    names = ["M" + letters[4 * i : 4 * i + 30] for i in range(70)]  # each similar to its neighbours alone
    rows = spark.createDataFrame([(x,) for x in [*names, "Otto Lind"]], "name string")
    assert {(r.a, r.b) for r in search.similar_pairs(rows, 0.6).collect()} == {tuple(sorted(x)) for x in zip(names, names[1:])}
    assert {r.name: r.entity for r in search.entities(spark, rows).collect()} == dict.fromkeys(names, min(names)) | {"Otto Lind": "Otto Lind"}


def test_pipeline_names_are_borne_out(docs):
    found = pipeline.tier_one(docs)
    for r in pipeline.tier_two(docs, found).collect():
        assert " ".join(TEXTS[r.file_id][r.start : r.end].split()) == " ".join(r.text.split())
    got = {(r.file_id, r.clean_name) for r in pipeline.document_names(docs).collect()}
    assert (2, "Mara Venn Otto Lind") in got and not any("Vincent" in n for _, n in got)
    assert {r.stem: r.total_spans for r in pipeline.manifest(docs, found).collect()}[2] == 1
