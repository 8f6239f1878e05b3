"""Steps whose work grew faster than their input: the same results, without the part that grew."""

import random

from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.operators import spans

SPAN = "file_id long, start int, end int, text string, entity_type string, confidence double, page_number int"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folded(rows):
    """without_overlaps of one file, pair by pair."""
    low = lambda x: (x is not None, x)
    kept, seen = [], set()
    for s in sorted(rows, key=lambda r: (low(r[1]), low(None if r[5] is None else -r[5]), low(r[2]), low(r[3]))):
        _, start, end, text, _, confidence, _ = s
        if None not in (start, end, text):
            if (start, end, text) in seen:
                continue
            seen.add((start, end, text))
        meets = [k for k in kept if None not in (start, end, k[1], k[2]) and start < k[2] and end > k[1]]
        if not meets:
            kept.append(s)
        elif None not in (confidence, meets[0][5]) and confidence > meets[0][5]:
            kept.remove(meets[0])
            kept.append(s)
    return kept


def test_overlaps_by_one_pass(spark):
    rng, rows = random.Random(3), []
    for i in range(40):
        for _ in range(rng.choice([1, 5, 40, 700])):
            start = rng.randrange(200 if i % 2 else 3000)
            end = start + rng.choice([0, 1, 3, 9, 30, -2])
            rows.append((i, rng.choice([start] * 30 + [None]), rng.choice([end] * 30 + [None]), rng.choice(["a", "b", None] if i % 3 else ["a"]), "PER", rng.choice([0.5, 0.7, 0.9, None]), None))
    got = spans.without_overlaps(spark.createDataFrame(rows, SPAN))
    want = [s for i in range(40) for s in folded([r for r in rows if r[0] == i])]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_places_of_matches_are_found_in_the_row(spark):
    text = "Mara é " * 2000 + "Otto\nLind"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (1, "Ann Lee")], "file_id long, text string")
    found = spans.matches(docs, spans.CAPITALISED_RUN)
    assert "Exchange" not in plan(found)
    rows = found.collect()
    assert len(rows) == 2002 and all((text if r.file_id == 1 and r.match != "Ann Lee" else "Ann Lee")[r.start : r.end] == r.match for r in rows)
    more = spans.recovered(docs.select("file_id", F.col("text").alias("raw_text"), F.upper("text").alias("clean_text")))
    assert "Exchange" not in plan(more) and "Join" not in plan(more) and more.count() == 0
    sums = spark.range(1).select(X.running(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: i.cast("int"))).alias("s")).first().s
    assert sums == [k * (k + 1) // 2 for k in range(1, 1001)]


REPEATED = [("Mara Venn",), ("Mara Vann",), ("Otto Lind",)] * 50 + [(None,), ("",)]


def test_pairs_of_different_names_alone(spark):
    from lexforge.operators import search

    pairs = search.similar_pairs(spark.createDataFrame(REPEATED, "name string").select(F.trim("name").alias("name")), 0.5)
    assert "sequence" not in plan(pairs) and [(r.a, r.b) for r in pairs.collect()] == [("Mara Vann", "Mara Venn")]


def test_names_are_scored_once_each(spark):
    from lexforge.operators import search

    found = search.fuzzy(spark.createDataFrame(REPEATED, "name string").select(F.trim("name").alias("name")).distinct(), "Mara Vann")
    assert {(r.name, r.distance) for r in found.collect()} == {("Mara Vann", 0), ("Mara Venn", 1)}
    # below the aggregate, the names' own plan has nothing of the score
    below = plan(found).split("HashAggregate")[-1]
    assert "mara" not in below.lower() and "sequence" not in below


def test_a_worker_holds_one_slice_of_prompts(spark):
    import os

    from lexforge.operators import summaries
    from lexforge.sources import backends

    made = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"slices-{random.random()}")

    def maker():
        def reply(prompt):
            # how many prompts were alive, as objects of Python, when this one was answered
            import gc

            with open(made, "a") as f:
                f.write(f"{max((len(x) for x in gc.get_objects() if type(x) is list and len(x) > 100 and all(type(y) is str and y.startswith('prompt ') for y in x)), default=0)}\n")
            return prompt.upper() if prompt.endswith("99") else "-"

        return backends.MockBackend(reply)

    prompts = spark.range(0, 700, 1, 1).select("id", F.concat(F.lit("prompt "), F.col("id").cast("string")).alias("prompt"), F.lit(None).cast("string").alias("more"))
    got = summaries.replied(prompts, maker).collect()
    assert [(r.id, r.prompt, r.more, r.reply) for r in got] == [(i, f"prompt {i}", None, f"PROMPT {i}" if i % 100 == 99 else "-") for i in range(700)]
    with open(made) as f:
        assert max(map(int, f)) <= summaries.REPLY_ROWS


ODD = ["", " ", "a　b  c\x1cd\xa0e", "x ", "​zero width", "plain text " * 30, "wörter mit 4mm und a1 " * 20, "\x00\x07 box ─│┌ � " * 20, "日本語 テキスト " * 40, "𝐀𝐁 " * 100, "§ · ¶ • ☆ → ╬ ✧ a/b{c}é|è", None]


def test_tables_of_characters_are_counted_from_few_pieces(spark):
    from lexforge.functions import cleaning
    from lexforge.functions.vocab import GARBAGE, NOISE_SYMBOLS

    rows = spark.createDataFrame(list(enumerate(ODD)), "i int, text string")
    for table in (GARBAGE, NOISE_SYMBOLS):
        found = rows.select("i", X.count_among(F.col("text"), table).alias("n"))
        assert "[^" not in plan(found)
        assert {r.i: r.n for r in found.collect()} == {i: None if t is None else sum(c in table for c in t) for i, t in enumerate(ODD)}
    for r in rows.select("i", cleaning.cleaned(F.col("text")).alias("c"), cleaning.same_length(F.col("text"), True).alias("a"), cleaning.same_length(F.col("text")).alias("p")).collect():
        garbage = sum(c in GARBAGE for c in ODD[r.i] or "") > 0.05 * len(ODD[r.i] or "")
        assert r.c == (r.a if garbage else r.p) and len(r.c or "") == len(ODD[r.i] or "")


def test_a_form_of_a_name_is_cleaned_once(spark):
    from lexforge.operators import names

    schema = "file_id long, name_index int, normalized_name string, original_text string, role string, confidence double"
    rows = spark.createDataFrame([(i, 0, "1. mara venn" if i % 2 else "", "Otto Lind" if i % 3 else None, "sender", None) for i in range(60)], schema)
    got = names.cleaned(rows)
    assert "Aggregate" in plan(got)
    assert sorted((r.file_id, r.clean_name) for r in got.collect()) == [(i, "Mara Venn" if i % 2 else "Otto Lind" if i % 3 else "") for i in range(60)] or {r.clean_name for r in got.collect()} == {"mara venn", "Otto Lind", ""}
    assert sorted((r.file_id, r.clean_name) for r in got.collect()) == [(i, "mara venn" if i % 2 else "Otto Lind" if i % 3 else "") for i in range(60)]


def test_gate_splits_a_text_once(spark):
    import re

    from lexforge.functions import quality

    rows = spark.createDataFrame(list(enumerate(ODD)), "i int, text string")
    gate = rows.select("i", quality.gate(F.col("text")).alias("g"))
    assert not re.search(r"regexp_replace\([^()]*\[\\x09-\\x0D", plan(gate))  # solid characters come from the tokens
    s = X.strip(F.col("text"))
    alone = {r.i: r for r in rows.select("i", quality.alpha_ratio(s).alias("a"), quality.weird_ratio(s).alias("x"), quality.token_sanity(s).alias("t"), X.tokens(F.col("text")).alias("w")).collect()}
    for r in gate.collect():
        text = (ODD[r.i] or "").strip()
        if ODD[r.i] is not None:
            assert alone[r.i].w == text.split()
        if len(text) >= 200:
            assert r.g.alpha_ratio == alone[r.i].a == sum(c.isalpha() for c in text) / len("".join(text.split())) and r.g.weird_ratio == alone[r.i].x
            assert (r.g.median_token_len, r.g.digit_mixed_ratio) == tuple(alone[r.i].t)
            assert (r.g.median_token_len, r.g.digit_mixed_ratio) == tuple(alone[r.i].t)
