import json
import zipfile

import pytest

import lexforge
from lexforge import cli
from lexforge.operators import repair
from lexforge.sources import files

VALID = "file_id long, start int, end int, verified_text string, needs_repair boolean, error string"


def test_replies_decide_repairs(spark):
    rows = spark.createDataFrame([(1, 0, 4, "M0RA", True, None), (1, 5, 9, "L1ND", True, None), (1, 9, 12, "OTTO", False, None), (1, 20, 22, "x", True, "mismatch")], VALID)
    assert json.loads(repair.prompts(rows).first().names) == [{"index": 0, "text": "M0RA"}, {"index": 1, "text": "L1ND"}]
    replies = spark.createDataFrame([(1, 0, 'Sure [{"index": 0, "name": " Mara "}, {"index": 1, "name": " "}]')], "file_id long, batch_id int, reply string")
    got = {r.start: (r.normalized_name, r.was_repaired) for r in repair.decided(rows, replies).collect()}
    assert got == {0: ("Mara", True), 5: ("L1Nd", True), 9: ("Otto", False)}


def test_commands(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    spark.createDataFrame([(1, "Met Mara Venn and Otto Lind today."), (2, "")], "file_id long, text string").write.parquet(at("docs"))
    assert cli.main(["ner", at("docs"), at("ner")], spark) == 0
    assert cli.main(["names", at("docs"), at("names"), "--spans", at("ner/spans")], spark) == 0
    assert {r.normalized_name for r in spark.read.parquet(at("names")).collect()} >= {"Otto Lind"}
    capsys.readouterr()
    assert cli.main(["manifest-query", at("ner/manifest"), "--limit", "1"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["stem"] == 1
    stored = spark.createDataFrame([(1, 0, "Mara Venn", 4, 13), (1, 1, "Nobody", 0, 3)], "file_id long, name_index int, original_text string, start int, end int")
    stored.write.parquet(at("stored"))
    assert cli.main(["validate", at("stored"), at("docs"), "--fix", at("fixed")], spark) == 1
    assert spark.read.parquet(at("fixed")).count() == 1


def test_texts_of_every_kind(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.txt").write_bytes("é plain".encode())
    (folder / "sub" / "b.PNG").write_bytes(b"seen on the image")
    (folder / "c.mp3").write_bytes(b"sound")
    (folder / "d.xyz").write_bytes(b"unknown")
    with zipfile.ZipFile(folder / "e.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>Two</w:t></w:r></w:p></w:body></w:document>')
    assert cli.main(["extract-text", str(folder), str(tmp_path / "texts")], spark) == 0
    got = {r.path.rsplit("/", 1)[1]: (r.kind, r.text, r.extraction_method) for r in spark.read.parquet(str(tmp_path / "texts")).collect()}
    assert got == {"a.txt": ("txt", "é plain", "text"), "b.PNG": ("image", "seen on the image", "ocr"), "e.docx": ("docx", "One\n\nTwo", "docx_text")}

    def heard():
        class Heard:
            def read(self, data):
                return {"text": data.decode(), "language": "en", "duration": 1.5, "segments": [{"start": 0.0, "end": 1.5, "text": data.decode()}]}

        return Heard()

    assert {r.text for r in files.extracted(spark, str(folder), transcriber=heard).filter("kind = 'audio'").collect()} == {"sound"}


def test_a_second_run_s_manifest_lines_count(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    for text in ("Met Mara Venn today.", "Met Mara Venn. Otto Lind too."):
        spark.createDataFrame([(1, text)], "file_id long, text string").write.mode("overwrite").parquet(at("docs"))
        assert cli.main(["ner", at("docs"), at("ner")], spark) == 0
    capsys.readouterr()
    assert cli.main(["manifest-query", at("ner/manifest")], spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(lines) == 1 and lines[0]["clean_text_length"] == 29


def test_broken_summaries_are_deleted(spark, tmp_path, capsys):
    (tmp_path / "a_summary.json").write_text("{}")
    (tmp_path / "b_summary.json").write_text("{")
    (tmp_path / "c_summary.json").write_text("")
    assert cli.main(["validate-summaries", str(tmp_path), "--delete"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"deleted": 2} and [p.name for p in tmp_path.glob("*_summary.json")] == ["a_summary.json"]


def test_summaries_of_documents(spark, tmp_path):
    rows = [("a", i, f"Page {i} of a longer document, with words.") for i in range(1, 4)] + [("b", 1, "A document of one page only."), ("c", 1, "short"), ("a", 4, "")]
    spark.createDataFrame(rows, "file_id string, page_number int, text string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["summarise", str(tmp_path / "pages"), str(tmp_path / "out"), "--model", "m", "--prompts", "p"], spark) == 0
    got = {r.file_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {"a", "b"} and got["a"].pages == 4 and all(r.short_summary == r.long_summary == "Mock summary." and r.model_version == "m" and len(r.text_hash) == 16 for r in got.values())


def test_exports():
    assert all(getattr(lexforge, name) for name in lexforge.__all__)
    with pytest.raises(AttributeError):
        lexforge.nothing  # noqa: B018
