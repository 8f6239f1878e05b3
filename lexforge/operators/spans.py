"""Spans: extraction with offsets, overlap, splitting, recovery, validation.

A span is a row: file_id, start, end (code points, end exclusive), text, ... Offsets
of matches come from prefix sums, in the row, of the lengths between and of matches.
"""

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.functions import names, noise
from lexforge.functions import text as X
from lexforge.functions.vocab import NAME_SUFFIXES, PARTICLES, WS

#: Window of the model's input in characters, and what two windows share.
CHUNK, OVERLAP = 2048, 100
MIN_CONFIDENCE, MOCK_CONFIDENCE = 0.3, 0.7
_EDGE = r"\p{L}\p{N}_"

# Patterns of name candidates, by priority.
# Repeats are possessive, so that a run of any length takes no stack: what follows can't be found by giving back.
# What stands before a capital is looked at once the capital is found, which is rarer.
_CAPITAL = rf"[A-Z](?<![{_EDGE}][A-Z])"
CAPITALISED_RUN = rf"{_CAPITAL}[a-z]++(?![{_EDGE}])(?:[{WS}]++[A-Z][a-z]++(?![{_EDGE}]))*+"
CANDIDATES = [
    ("header", rf"(?:From|To|CC|Cc|Attn|Dear|Sincerely)[:{WS}]+[A-Za-z][A-Za-z0-9{WS}.\-']{{2,40}}", rf"^(?:From|To|CC|Cc|Attn|Dear|Sincerely)[:{WS}]+"),
    ("capitalized", rf"{_CAPITAL}[a-z]+(?:[{WS}]+[A-Z][a-z]+){{1,3}}(?![{_EDGE}])", None),
    ("ocr_corrupted", rf"{_CAPITAL}[a-z0-9]+(?:[{WS}]+[A-Z][a-z0-9]+)?(?![{_EDGE}])", None),
]


def matched(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of every match of a pattern (none may be empty)."""

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = X.running(F.zip_with(found, gaps, lambda m, g: F.length(m) + F.length(g)))
        some = F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("match")))
        return F.when(F.size(found) > 0, some)

    return X.bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def matches(docs: DataFrame, pattern: str, text: str = "text", key: str = "file_id", *more: str) -> DataFrame:
    """key, more, idx, start, end, match of every match of a pattern (none may be empty)."""
    rows = X.once(docs.select(key, *more, F.col(text).alias("_t")), _m=matched(F.col("_t"), pattern))
    return rows.select(key, *more, F.posexplode("_m").alias("idx", "x")).select(key, *more, "idx", "x.start", "x.end", "x.match")


def chunks(docs: DataFrame, text: str = "text", key: str = "file_id", size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, chunk_start, chunk of overlapping windows; blank ones are left out."""
    n = F.length(text)
    rows = docs.filter(n > 0).select(key, text, F.explode(F.sequence(F.lit(0), n - 1, F.lit(size - overlap))).alias("chunk_start"))
    return rows.select(key, "chunk_start", F.substring(F.col(text), F.col("chunk_start") + 1, F.lit(size)).alias("chunk")).filter(X.strip(F.col("chunk")) != "")


def mock_entities(docs: DataFrame, text: str = "text", key: str = "file_id", *more: str) -> DataFrame:
    """Runs of capitalised words of three characters or more, as persons, without a page."""
    found = matches(docs, CAPITALISED_RUN, text, key, *more).filter(F.length("match") >= 3)
    return found.select(key, *more, "start", "end", F.col("match").alias("text"), F.lit("PER").alias("entity_type"), F.lit(MOCK_CONFIDENCE).alias("confidence"), F.lit(None).cast("int").alias("page_number"))


def materialised(entities: DataFrame, types=("PER",), least: float = MIN_CONFIDENCE) -> DataFrame:
    """Model entities (file_id, chunk_start, start, end, word, entity_type, confidence) as spans of the whole text."""
    word = F.regexp_replace(X.strip(F.col("word")), "^##", "")
    return (
        entities.filter(F.col("entity_type").isin(*types) & (F.col("confidence") >= least))
        .select("file_id", (F.col("chunk_start") + F.col("start")).alias("start"), (F.col("chunk_start") + F.col("end")).alias("end"), word.alias("text"), "entity_type", "confidence")
        .filter(F.length("text") >= 2)
    )


SPAN = "start:int,end:int,text:string,entity_type:string,confidence:double,page_number:int"


def without_overlaps(spans: DataFrame) -> DataFrame:
    """For each file, equal spans once; of overlapping ones the surer.

    In the order of (start, falling confidence): at the first kept span that it
    overlaps, a span takes that one's place if it is surer, else it goes. A fold over
    a file's sorted spans, within the file's task. Kept spans never overlap each other,
    so that a span can only meet the last of those that aren't empty; a span without an
    extent, or with a null in its place, is met by none that comes later.
    """
    fields = [x.split(":")[0] for x in SPAN.split(",")]
    kind, rest = f"struct<{SPAN}>", ["entity_type", "confidence", "page_number"]
    falling = (-F.col("confidence")).alias("_falling")
    gathered = F.sort_array(F.collect_list(F.struct("start", "end", "text", falling, *rest)))

    def single(s: Column) -> Column:
        twin = lambda x, y: (x["start"] == y["start"]) & (x["end"] == y["end"]) & (x["text"] == y["text"])
        return F.filter(s, lambda x, i: ~F.coalesce((i > 0) & twin(x, F.get(s, i - 1)), F.lit(False)))

    def ordered(s: Column) -> Column:
        by = F.sort_array(F.transform(s, lambda x: F.struct(*(x[f].alias(f) for f in ["start", "_falling", "end", "text", *rest]))))
        return F.transform(by, lambda x: F.struct(*(x[f].alias(f) for f in fields)).cast(kind))

    def step(acc: Column, s: Column) -> Column:
        last, out = acc["last"], acc["out"]
        meets = F.coalesce((s["start"] < last["end"]) & (s["end"] > last["start"]), F.lit(False))
        extent = F.coalesce(s["start"] < s["end"], F.lit(False))
        done = F.when(meets, out).when(~extent, F.concat(out, F.array(s))).when(last.isNull(), out).otherwise(F.concat(out, F.array(last)))
        now = F.when(F.when(meets, s["confidence"] > last["confidence"]).otherwise(extent), s).otherwise(last)
        return F.struct(now.cast(kind).alias("last"), done.cast(f"array<{kind}>").alias("out"))

    empty = F.array().cast(f"array<{kind}>").alias("out")
    fold = lambda acc, block: F.aggregate(block, F.struct(acc["last"].alias("last"), empty), step)
    folded = X.blocks(ordered(X.bind(F.col("s"), single)), F.struct(F.lit(None).cast(kind).alias("last"), empty), fold)
    kept = X.bind(folded, lambda a: F.when(a["last"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(a["last"]))))
    return X.once(spans.groupBy("file_id").agg(gathered.alias("s")), kept=kept).select("file_id", F.explode("kept").alias("s")).select("file_id", "s.*")


_NUMBERED = re.compile(r"^\s*(?:\d{1,3}[.)]\s*|[-•]\s*)")
_CAPITAL_WORD = re.compile(r"[A-Z][a-zA-Z'.\-]*")


def name_like(text: str) -> bool:
    """One to six words, a capital first, a word of two characters, half letters."""
    text = text.strip()
    words = text.split()
    return len(text) >= 2 and 1 <= len(words) <= 6 and words[0][0].isupper() and any(len(w) >= 2 for w in words) and sum(c.isalpha() for c in text) >= len(text) * 0.5


def listed_names(text: str) -> list[str]:
    """Names of a span that newlines, semicolons, tabs or three commas part; the first of these that occurs decides."""
    mark = next((m for m, least in (("\n", 1), (";", 1), ("\t", 1), (",", 3)) if text.count(m) >= least), None)
    return [] if mark is None else [c for c in (_NUMBERED.sub("", p.strip()).strip() for p in text.split(mark)) if c and name_like(c)]


def capital_groups(text: str) -> list[tuple[int, int]]:
    """(begin, end) of groups of capitalised words: a new one after two, but for particles and suffixes."""
    words = list(_CAPITAL_WORD.finditer(text))
    if len(words) < 4:
        return []
    groups, begin, n = [], 0, 1
    for i, m in enumerate(words[1:], 1):
        low = m[0].lower().rstrip(".")
        if n >= 2 and low not in PARTICLES and low not in NAME_SUFFIXES:
            groups.append((words[begin].start(), words[i - 1].end()))
            begin, n = i, 1
        else:
            n += 1
    return [*groups, (words[begin].start(), words[-1].end())]


def parts_of(span: str, context: str, lead: int) -> list[tuple[int, int, str]]:
    """(begin, end, text), from the span's start on, of the names that a span holds; [] if it is one name.

    context: the source from the span's start to some way past its end; lead: the span's length in the source.
    """
    if len(names_ := listed_names(span)) >= 2:
        at, found = 0, []
        for name in names_:
            i = context.find(name, at, lead + len(name))
            if i >= 0:
                found.append((i, i + len(name), name))
                at = i + len(name)
        if len(found) >= 2:
            return found
    groups = capital_groups(span)
    if len(groups) < 2 or any(context[a:b] != span[a:b] for a, b in groups if len(span[a:b].strip()) >= 4):
        return []
    kept = [(a, b, span[a:b].strip()) for a, b in groups if len(span[a:b].strip()) >= 4]
    return kept if len(kept) >= 2 else []


_PARTS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())]))


@F.pandas_udf(_PARTS)
def _split(text: pd.Series, context: pd.Series, lead: pd.Series) -> pd.Series:
    return pd.Series([[{"begin": a, "end": b, "text": t} for a, b, t in parts_of(s or "", c or "", int(n))] for s, c, n in zip(text, context, lead, strict=True)])


def split_names(spans: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Person spans that hold several names, as one row a name; others as they are. docs: file_id, text.

    Only spans that could hold several names go through Python.
    """
    spans = spans.withColumn("_several", (F.col("entity_type") == "PER") & (F.col("text").rlike(r"[\n;\t]|,.*,.*,") | F.col("text").rlike(r"(?:[A-Z][^A-Z]*){4}")))
    one = spans.filter(~F.col("_several")).drop("_several")
    some = spans.filter("_several").drop("_several").join(docs.select("file_id", F.col(text).alias("_source")), "file_id", "left")
    n = F.col("end") - F.col("start")
    some = some.withColumn("_parts", _split(F.col("text"), F.substring(F.col("_source"), F.col("start") + 1, n + F.length("text")), n)).drop("_source")
    split = some.withColumn("p", F.explode_outer("_parts")).withColumns(
        {"end": F.coalesce(F.col("start") + F.col("p.end"), F.col("end")), "text": F.coalesce(F.col("p.text"), F.col("text")), "start": F.col("start") + F.coalesce(F.col("p.begin"), F.lit(0))}
    )
    return one.unionByName(split.select(*one.columns))


def with_pages(spans: DataFrame, boundaries: DataFrame) -> DataFrame:
    """page_number of each span by its start. boundaries: file_id, page_number, page_start, page_end (exclusive).

    An interval join within the file: at most one page holds an offset.
    """
    b = boundaries.select(F.col("file_id").alias("_f"), F.col("page_number").alias("_page"), "page_start", "page_end")
    joined = spans.join(b, (F.col("file_id") == F.col("_f")) & (F.col("start") >= F.col("page_start")) & (F.col("start") < F.col("page_end")), "left")
    return joined.withColumn("page_number", F.col("_page")).drop("_f", "_page", "page_start", "page_end")


def boundaries_of(pages: DataFrame) -> DataFrame:
    """file_id, page_number (by position), page_start, page_end of pages (file_id, page_number, text): a running sum, the last end open."""
    size = F.length(F.concat(F.lit("[Page "), F.col("page_number").cast("string"), F.lit("]\n"))) + F.length(F.coalesce("text", F.lit(""))) + 2
    w = Window.partitionBy("file_id").orderBy("page_number")
    upto = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return pages.select("file_id", F.row_number().over(w).alias("page_number"), (upto - size).cast("int").alias("page_start"), upto.cast("int").alias("page_end"))


def _candidates(docs: DataFrame, text: str, *more: str) -> DataFrame:
    """more, rank, pattern, start, end, text of the candidates of each row; a place belongs to the first pattern that finds it."""

    def of(rank: int, kind: str, pattern: str, lead: str | None) -> Column:
        skip = lambda m: F.length(F.regexp_extract(m, lead, 0)) if lead else F.lit(0)
        made = lambda m: F.struct((m["start"] + skip(m["match"])).alias("start"), m["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("pattern"), (F.substring(m["match"], skip(m["match"]) + 1, F.length(m["match"])) if lead else m["match"]).alias("text"))
        return F.coalesce(F.transform(matched(F.col("_t"), pattern), made), F.array().cast("array<struct<start:int,end:int,rank:int,pattern:string,text:string>>"))

    def first(found: Column) -> Column:
        return F.filter(found, lambda x, i: (i == 0) | (x["start"] != F.get(found, i - 1)["start"]) | (x["end"] != F.get(found, i - 1)["end"]))

    found = F.sort_array(F.concat(*(of(rank, *c) for rank, c in enumerate(CANDIDATES))))
    rows = X.once(docs.select(*more, F.col(text).alias("_t")), _m=X.bind(found, first)).select(*more, F.explode("_m").alias("x"))
    rows = rows.select(*more, "x.rank", "x.pattern", "x.start", "x.end", X.strip(F.col("x.text")).alias("text")).filter(F.length("text").between(3, 50))
    letters = X.count_not(F.col("text"), r"^\p{L}")
    return rows.filter((letters >= 2) & (letters >= 0.5 * F.length("text")))


def candidates(docs: DataFrame, text: str = "text", key: str = "file_id") -> DataFrame:
    """Names that recognition may have missed, by three patterns; a place belongs to the first pattern that finds it."""
    first = Window.partitionBy(key, "start", "end").orderBy("rank")
    return _candidates(docs, text, key).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n").select(key, "rank", "pattern", "start", "end", "text")


def recovered(docs: DataFrame, clean: str = "clean_text", raw: str = "raw_text") -> DataFrame:
    """Candidates of the clean text that stand in the raw one of their row and look like names, at confidence 0.5."""
    rows = docs.select("file_id", F.col(clean).alias("_clean"), F.col(raw).alias("_raw"))
    rows = X.once(rows, _same=F.col("_raw") == F.col("_clean"))
    found = _candidates(rows, "_clean", "file_id", "_same", "_raw")
    same = F.col("_same") | (F.substring(F.col("_raw"), F.col("start") + 1, F.length("text")) == F.col("text"))
    return found.filter(same & noise.name_like(F.col("text"))).select(
        "file_id", "start", (F.col("start") + F.length("text")).alias("end"), "text", F.lit("PER").alias("entity_type"), F.lit(0.5).alias("confidence"), F.lit(None).cast("int").alias("page_number")
    )


def merged(spans: DataFrame, more: DataFrame) -> DataFrame:
    """``spans``, and rows of ``more`` at places that none of them has."""
    return spans.unionByName(more.join(spans.select("file_id", "start", "end"), ["file_id", "start", "end"], "left_anti").dropDuplicates(["file_id", "start", "end"]).select(*spans.columns))


def error_of(start: Column, end: Column, text: Column, raw: Column) -> Column:
    """out_of_bounds, empty, mismatch, or null for a span that its source bears out."""
    return _error(start, end, text, F.substring(raw, start + 1, end - start), F.length(raw))


def _error(start: Column, end: Column, text: Column, actual: Column, size: Column) -> Column:
    return (
        F.when((start < 0) | (end > size) | (start >= end), F.lit("out_of_bounds"))
        .when(X.strip(actual) == "", F.lit("empty"))
        .when((X.strip(actual) != X.strip(text)) & (X.squeezed(actual) != X.squeezed(text)), F.lit("mismatch"))
    )


def validated(spans: DataFrame, docs: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Spans that aren't dropped, with verified_text, needs_repair and error (null: valid). A text is measured once, and cut once a span."""
    if "drop" in spans.columns:
        spans = spans.filter(~F.col("drop"))
    sized = X.once(docs.select("file_id", F.col(raw).alias("_raw")), _size=F.length("_raw"))
    joined = X.once(spans.join(sized, "file_id"), _actual=F.substring(F.col("_raw"), F.col("start") + 1, F.col("end") - F.col("start"))).drop("_raw")
    joined = X.once(joined, error=_error(F.col("start"), F.col("end"), F.col("text"), F.col("_actual"), F.col("_size")))
    valid = F.when(F.col("error").isNull(), X.strip(F.col("_actual")))
    return joined.withColumn("verified_text", valid).withColumn("needs_repair", F.when(F.col("error").isNull(), names.needs_repair(F.col("verified_text")))).drop("_actual", "_size")


def repaired(valid: DataFrame) -> DataFrame:
    """normalized_name and was_repaired of validated spans, without a model."""
    return valid.filter("error IS NULL").withColumns(
        {"normalized_name": F.when(F.col("needs_repair"), names.mock_repaired(F.col("verified_text"))).otherwise(names.basic_normal(F.col("verified_text"))), "was_repaired": F.col("needs_repair")}
    )
