import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexforge.functions import cleaning, layout, names, noise, quality, replies
from lexforge.functions import text as X
from lexforge.functions import vocab
from lexforge.functions.vocab import GARBAGE, INVISIBLE, SPACES
from lexforge.operators import spans

TEXTS = [
    "", "  ", "Hello world", "Ma​ria and Ann/Lee 3/4", "a\nb\x00c\td", "x|y {z} a{b}c ˜ a˜b", "éa/üb ﬁne ½ Ⅳ ™ ﷺ", "█▓ box │ text", "A01 J0HN 5am| wh!t !x 8 B8B", "no break space ﻿",
    "The letter from the office was sent to the police and then to the court in the same year. " * 4, "q1w2 e3r4 t5y6 " * 30, "�" * 20 + "x" * 300, "z " * 150, "w" * 300, "İstanbul ǅ ß ſ", "𝔘𝔫𝔦 🙂/🙂 a/𝔟",
]


def run(spark, values, *columns):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", *columns).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def slow_clean(raw, aggressive):
    blank, out = {*INVISIBLE, *SPACES, *(GARBAGE if aggressive else [])}, []
    for i, c in enumerate(raw):
        if c in blank:
            out.append(" ")
            continue
        c = unicodedata.normalize("NFKC", c)[:1] or " "
        if unicodedata.category(c) in ("Cc", "Cf") and c not in "\n\r\t":
            c = " "
        if c in "/{}˜|\\" and 0 < i < len(raw) - 1 and raw[i - 1].isalpha() and raw[i + 1].isalpha():
            c = " "
        out.append(c)
    return "".join(out)


def test_cleaning_keeps_lengths_and_offsets(spark):
    got = run(spark, TEXTS, cleaning.same_length(F.col("x")), cleaning.same_length(F.col("x"), True), cleaning.cleaned(F.col("x")), cleaning.garbage_ratio(F.col("x")))
    for raw, (plain, hard, either, ratio) in zip(TEXTS, got, strict=True):
        assert plain == slow_clean(raw, False) and hard == slow_clean(raw, True), raw
        share = sum(c in set(GARBAGE) for c in raw) / len(raw) if raw else 0.0
        assert ratio == pytest.approx(share) and either == (hard if share > 0.05 else plain) and len(either) == len(raw)


def slow_noise(t):
    if len(t) < 50:
        return 0.0
    common = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n\t.,;:!?'\"-()[]{}@#$%&*/")
    words = t.split()
    boxes = set("▀▄█▌▐░▒▓│")
    parts = [min(1, sum(c not in common for c in t) / len(t) * 10), min(1, len(re.findall(r"[A-Za-z][0-9][A-Za-z]|[0-9][A-Za-z][0-9]", t)) / 20), sum(len(w) <= 2 for w in words) / len(words) if words else 0, min(1, sum(c in boxes for c in t) / len(t) * 20)]
    return sum(p * w for p, w in zip(parts, (0.3, 0.3, 0.2, 0.2), strict=True))


def test_noise_and_fixes(spark):
    fixes = {"0": "O", "1": "I", "5": "S", "8": "B", "|": "l", "!": "l"}
    slow = lambda t: "".join(fixes[c] if c in fixes and ((i and t[i - 1].isalpha()) or (i < len(t) - 1 and t[i + 1].isalpha())) else c for i, c in enumerate(t))
    for raw, (score, fixed) in zip(TEXTS, run(spark, TEXTS, noise.score(F.col("x")), noise.fixed(F.col("x"))), strict=True):
        assert score == pytest.approx(slow_noise(raw)) and fixed == slow(raw), raw
    gate = [(500, 2, 0.15), (499, 2, 0.2), (500, 3, 0.2), (500, 0, 0.149)]
    rows = spark.createDataFrame(gate, "n int, k int, s double").select(noise.needs_recovery(F.col("n"), F.col("k"), F.col("s")).alias("g")).collect()
    assert [r.g for r in rows] == [True, False, False, False]


def test_quality_gate(spark):
    got = [r[0] for r in run(spark, TEXTS, quality.gate(F.col("x")))]
    assert got[2].reason == "too_short (11 < 200)" and not got[2].good and got[2].word_ratio == 0
    assert got[10].reason == "high_word_ratio" and got[10].good
    assert got[11].reason.startswith("digit_mixed (100.0%") and got[12].reason.startswith("weird_chars (6.2%") and got[13].reason == "tiny_tokens (median 1.0 < 2)" and got[14].reason == "giant_tokens (median 300.0 > 20)"


NAMES = {
    "14. Mara Venn": "Mara Venn", "2005 Mara Venn": "2005 Mara Venn", "2005. Mara Venn": "Mara Venn", "3Mara Venn": "Mara Venn", "7'Mara": "Mara", "Mara Venn Mara Venn Jr.": "Mara Venn Jr.", "Mara Venn Subject": "Mara Venn", "Nina To": "Nina To",
    "Mara Venn To": "Mara Venn", "Mara Venn Sent To Cc": "Mara Venn", "»Mara_Venn»": "Mara Venn", "Mara Venn...": "Mara Venn", "mara venn.": "mara venn", "Mara V.": "Mara V.", "mara. mara": "mara", "Mara Oskar Venn Venn": "Mara Oskar Venn",
    "Mara Mara Oskar Venn": "Mara Oskar Venn", "Venn Mara Venn": "Mara Venn", "Mara Venn, Mara Venn": "Mara Venn", "mara venn ve": "mara venn", "mara ma": "mara", "Mara": "Mara", "": "", "Mara Venn Mara Venn Mara Venn xx Jr": "Mara Venn", "  Otto \n Lind ": "Otto Lind",
}


def test_clean_names(spark):
    assert dict(zip(NAMES, (r[0] for r in run(spark, list(NAMES), names.clean(F.col("x")))), strict=True)) == NAMES


def test_garbage(spark):
    bad = ["AB", "Venn, Mara", "Dr Venn", "the Mara", "maraVenn", "Venn Ve", "Mara Mara", "x" * 60, "a b c d e f g h", "Mara 123", "12-34", "Abcdefghijklmno", "Unknown", "Mara\nVenn", "Mara █", "Mara • Venn", "M4ra", "Mara (Venn)", "Mara & Otto", "Mara!", "D: Venn", "Mara_Venn", "mara venn ok", "e venn", "mara v"]
    good = ["Mara Venn", "Mara V. Lind", "O'Neil Smith-Jones", "mara v lind", "Nina To"]
    assert [r[0] for r in run(spark, bad + good, names.is_garbage(F.col("x")))] == [True] * len(bad) + [False] * len(good)


def test_normal_forms(spark):
    cases = {"VENN, MARA": "Mara Venn", "Mara  Venn": "Mara Venn", "O'BRIEN-SMITH": "O'Brien-Smith", "ABC": "ABC", "a, b, c": "a, b, c", "Venn,": "Venn,"}
    assert [r[0] for r in run(spark, list(cases), names.basic_normal(F.col("x")))] == list(cases.values())
    repairs = {"M4RA V0NN": "M4Ra Vonn", "0TTO L1ND": "Otto Lind", "a/b|c~": "ablc"}
    assert [r[0] for r in run(spark, list(repairs), names.mock_repaired(F.col("x")))] == list(repairs.values())
    assert [r[0] for r in run(spark, ["Mara", "M0ra", "Ma2ra", "Mara 2", "a<b", "a-b.c'"], names.needs_repair(F.col("x")))] == [False, True, True, False, True, False]
    titles = ["JOHN O'BRIEN-SMITH MCX", "éa ßb 3d", "x"]
    assert [r[0] for r in run(spark, titles, X.title(F.col("x")))] == [t.title() if "ß" not in t else "Éa SSb 3D" for t in titles]


def test_heuristics(spark):
    cases = {"": "empty", "123": "matches_garbage_pattern_0", "aaaab": "matches_garbage_pattern_1", "Al": "matches_garbage_pattern_2", "Ab" * 30: "matches_garbage_pattern_3", "Ab 123": "matches_garbage_pattern_4", "Ab@c": "matches_garbage_pattern_5", "Mara Venn": "matches_name_pattern", "J. Venn": "matches_name_pattern", "mara venn": "default"}
    got = [r[0] for r in run(spark, list(cases), names.heuristic(F.col("x")))]
    assert [g.reason for g in got] == list(cases.values()) and [g.confidence for g in got] == [0.95] * 7 + [0.85] * 2 + [0.5]


def test_source_notes(spark):
    tails = ["\n- Quelle: Originaldokument pruefen (KI-Zusammenfassung).", "\n- **Quelle: Originaldokument prüfen (KI-Zusammenfassung).**", "\n  -  Quelle:  Originaldokument pruefen (KI-Zusammenfassung). ", "\n- **Quelle**: Originaldokument prüfen (KI Zusammenfassung).", "\n\nQuelle: Originaldokument prüfen (KI-Zusammenfassung", "\n- QUELLE: originaldokument PRUEFEN (ki-zusammenfassung). (S. 1-2)"]
    assert [r[0] for r in run(spark, ["Content." + t for t in tails], replies.sanitized(F.col("x")))] == ["Content."] * len(tails)
    kept = [None, "", "One.\n\nTwo.", "Text about Quelle water.", "x\n- Quelle: something else."]
    assert [r[0] for r in run(spark, kept, replies.sanitized(F.col("x")))] == kept


def test_replies(spark):
    got = run(spark, ['{"summary": " A ", "date": "", "document_type": "memo"}', 'Sure {"summary": "B"} done', "plain", "", '[1]', '{"summary": '], replies.summary(F.col("x")), replies.short_summary(F.col("x")))
    assert [tuple(g[0]) for g in got] == [("A", "memo", None), ("B", None, None), ("plain", None, None), ("", None, None), ("[1]", None, None), ('{"summary":', None, None)]
    assert [g[1] for g in got][:3] == ["A", "B", "plain"]
    block = '{"summary": "one two three four five six seven eight nine ten"}'
    assert [r[0] for r in run(spark, [f"<think>hm</think> {block}", f"{block} {block} {block}", "short"], replies.without_reasoning(F.col("x")))] == [block, block, "short"]
    person = F.split("x", "#")
    owners = ["Venn#Venn's pilot", "Venn#Avenn's pilot", "Venn#the pilot Venn", "venn#met Venn's  maid", "Venn#Venn'spilot"]
    assert [r[0] for r in run(spark, owners, replies.possessive(person[0], person[1]))] == [True, False, False, True, False]
    assert [r[0] for r in run(spark, [" Attorney ", "pilot", "Baker"], replies.occupation(F.col("x")))] == ["lawyer", "pilot", "baker"]


def test_verdicts(spark):
    whole = '[{"span_index": 1, "drop": true, "reason": "location", "all_roles": ["a"]}]'
    got = [r[0] for r in run(spark, [f"x {whole} y", '[{"span_index":1,"drop":true}', '[{"span_index": 0, "all_roles": ["a"], "drop": false}, {"span_index": 1, "all_roles": ["b"], "dr', "none"], replies.verdicts(F.col("x")))]
    assert len(got[0]["items"]) == 1 and not got[0].repaired
    assert got[1]["items"] is None and got[3]["items"] is None
    assert [x.span_index for x in got[2]["items"]] == [0] and got[2].repaired


def test_page_images(spark):
    page = np.full((800, 600), 255, np.uint8)
    assert layout.analysed(page)[0] == "blank"
    for y in range(60, 740, 24):
        page[y : y + 6, 60:300] = 0
    kind, dark, lines, cv = layout.analysed(page)
    assert kind == "text_like" and lines == len(range(60, 740, 24)) and cv < 0.1 and layout.DARK_TEXT <= dark <= layout.DARK_PHOTO
    assert layout.analysed(np.tile(np.array([0, 255, 255], np.uint8), (800, 200)))[0] == "photo_like"
    rows = spark.createDataFrame([(bytearray(page.tobytes()), 600), (None, 600), (bytearray(b"abc"), 2)], "p binary, w int").select(layout.textiness("p", "w").alias("t")).collect()
    assert [r.t.page_type for r in rows] == ["text_like", "uncertain", "uncertain"]
    profile = [0.0, 0.5, 0.5, 0.0, 0.9, 0.9, 0.9, 0.0, 0.9] + [0.0] * 3 + [1.0] * 3
    got = spark.createDataFrame([(profile,)], "r array<double>").select(layout.profile_bands(F.col("r"), 0.4).alias("b")).withColumn("cv", layout.profile_cv(F.col("b"))).first()
    assert got.b == layout.bands(np.array(profile), 0.4) and got.cv == pytest.approx(layout.spacing_cv(got.b))
    assert layout.spacing_cv([3]) == -1.0 and layout.spacing_cv([3, 3]) == 99.0


def test_tables_of_the_cleaner(spark):
    """Sizes, and some of each group."""
    assert len(vocab.GARBAGE) == len(set(vocab.GARBAGE)) == 216 and len(vocab.NOISE_SYMBOLS) == len(set(vocab.NOISE_SYMBOLS)) == 60 and len(vocab.SPACES) == 16
    assert set("█▓│╬■●◰←↧⇄⇖⇗⇘⇙⇚⇛►◃★✻※∀∟§¶†⁍‽⸘") <= set(vocab.GARBAGE) and not set("a·⇜⇃✼∠") & set(vocab.GARBAGE)
    texts = ["", "plain", "⇖⇗ x", "§a¶", "é" * 10 + "█", vocab.GARBAGE, "⇜⇃"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.count_among(F.col("t"), vocab.GARBAGE).alias("n"), cleaning.garbage_ratio(F.col("t")).alias("r"), cleaning.same_length(F.col("t"), True).alias("c")).collect()
    assert {r.i: r.n for r in rows} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 1, 5: 216, 6: 0}
    assert {r.i: r.c for r in rows}[5] == " " * 216 and {r.i: round(r.r, 6) for r in rows}[4] == round(1 / 11, 6)


def test_capitalised_runs(spark):
    """As the plain pattern finds them, on any length, without stack."""
    plain = re.compile(r"(?<![^\W])[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*(?![^\W])")
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("ABab1_ é\n."), rng.integers(0, 30))) for _ in range(500)] + ["Ab " * 400_000, "Abc Def1 Gh", "Ab Cd Ef2"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "file_id int, text string")
    got = {}
    for r in spans.matches(docs, spans.CAPITALISED_RUN).collect():
        got.setdefault(r.file_id, []).append((r.start, r.end))
    assert got == {i: f for i, t in enumerate(texts) if (f := [m.span() for m in plain.finditer(t)])}


def test_signals_on_hostile_texts(spark):
    for x in ("a.", "Ab ", "ab", "7", "[", "\n", "a1 ", "█"):
        row = spark.createDataFrame([(x * (1_000_000 // len(x)),)], "t string").select(quality.gate(F.col("t")).alias("g"), noise.score(F.col("t")).alias("n"), cleaning.cleaned(F.col("t")).alias("c")).first()
        assert row.g.text_length <= 1_000_000 and 0 <= row.n <= 1 and len(row.c) == len(x) * (1_000_000 // len(x))
