"""Registered queries of the library's own operators, and their SQL for DuckDB."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions import cleaning, names, noise, quality, replies
from lexforge.functions import text as X
from lexforge.functions.vocab import (
    COMMON_WORDS, EMAIL_TOKENS, GUARDED_TOKENS, HONORIFICS, NOT_NAMES, OCCUPATION_SYNONYMS, ROLE_PRIORITY, STOPWORDS, SUFFIX_TOKENS, WS, WS_CHARS, clean_map, punct_class,
)
from lexforge.operators import classify, models, search, spans, summaries, validation, work
from lexforge.operators import names as names_op
from lexforge.plans import pipeline
from lexforge.sources import files
from lexforge.sources.shared import spread

FLAGSHIP = "q40_names_by_language"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found) if name in ("documents", "conversations", "pages", "customer") else found


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "file_id")


def pages(spark, sf_dir: str) -> DataFrame:
    """Conversations as documents of pages."""
    t = table(spark, sf_dir, "conversations")
    return t.select(F.col("conv_id").alias("file_id"), (F.col("turn") + 1).cast("int").alias("page_number"), "text", "role")


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(q(w) for w in words)


#: The same expressions in Spark and DuckDB: invented names, spoilt in sixteen ways by key.
FIRST = "CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate("Mara Otto Nina Ilse Juno Pavel Tess Ravi".split())) + " END"
LAST = "CASE CAST(floor(c_custkey / 8) AS BIGINT) % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate("Venn Lind Okoye Brandt Solis Quill Marsh Ito".split())) + " END"
RAW = f"""CASE CAST(floor(c_custkey / 64) AS BIGINT) % 24
 WHEN 0 THEN concat({FIRST}, ' ', {LAST}) WHEN 1 THEN concat('14. ', {FIRST}, ' ', {LAST}) WHEN 2 THEN concat({FIRST}, ' ', {LAST}, ' ', {FIRST}, ' ', {LAST}, ' Jr.')
 WHEN 3 THEN concat({FIRST}, ' ', {LAST}, ' Subject') WHEN 4 THEN upper(concat({FIRST}, ' ', {LAST})) WHEN 5 THEN concat({LAST}, ', ', {FIRST}) WHEN 6 THEN replace(replace(upper(concat({FIRST}, ' ', {LAST})), 'I', '1'), 'O', '0')
 WHEN 7 THEN concat({FIRST}, chr(10), {LAST}) WHEN 8 THEN concat({FIRST}, ' ', {LAST}, '..') WHEN 9 THEN concat({FIRST}, '_', {LAST}) WHEN 10 THEN concat('Dr ', {FIRST}, ' ', {LAST}) WHEN 11 THEN concat(lower({FIRST}), {LAST})
 WHEN 12 THEN concat('» ', {FIRST}, ' ', {LAST}, ' «!') WHEN 13 THEN concat({FIRST}, ' ', {LAST}, ' ', substr({LAST}, 1, 2)) WHEN 14 THEN lower(concat({FIRST}, ' ', {LAST})) WHEN 15 THEN concat('2005 ', {FIRST}, ' ', {LAST})
 WHEN 16 THEN concat({LAST}, ' ', {FIRST}, ' ', {LAST}) WHEN 17 THEN concat({FIRST}, ' ', {LAST}, ' ', {LAST}) WHEN 18 THEN concat('3', {FIRST}, ' ', {LAST}) WHEN 19 THEN concat({FIRST}, '. ', {FIRST})
 WHEN 20 THEN concat({FIRST}, ' ', {LAST}, ' Inc') WHEN 21 THEN concat({FIRST}, ' of California') WHEN 22 THEN concat('the ', {FIRST}, ' ', {LAST}, ' to from sent') ELSE concat({FIRST}, ' & ', {LAST}, ' 555 1234') END"""
ROLE = "CASE c_custkey % 5 WHEN 0 THEN 'sender' WHEN 1 THEN 'recipient' WHEN 2 THEN 'attorney' WHEN 3 THEN 'mentioned' ELSE 'other' END"
CONFIDENCE = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_custkey % 10) / 10.0e0 END"


def name_cases(spark, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "customer")
    return t.select(
        F.col("c_nationkey").alias("file_id"), F.col("c_custkey").alias("name_index"), F.expr(RAW).alias("original_text"), F.lit(None).cast("string").alias("normalized_name"), F.expr(ROLE).alias("role"),
        F.expr(CONFIDENCE).cast("double").alias("confidence"),
    )


NAME_CASES = f"name_cases AS (SELECT c_nationkey AS file_id, c_custkey AS name_index, {RAW} AS original_text, {ROLE} AS role, CAST({CONFIDENCE} AS DOUBLE) AS confidence FROM customer)"
WSC = f"'[{WS}]+'"


def sql_strip(x: str) -> str:
    return f"trim({x}, {q(WS_CHARS)})"


def sql_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {WSC}), lambda t: t <> '')"


def sql_count(x: str, inside: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, {q('[' + inside + ']+')}, '', 'g')))"


def sql_not(x: str, inside: str) -> str:
    return f"length(regexp_replace({x}, {q('[' + inside + ']+')}, '', 'g'))"


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


# text quality

_SIGNALS = f"""
t AS (SELECT doc_id, {sql_strip('text')} AS s FROM documents),
u AS (SELECT doc_id, s, length(s) AS n, regexp_extract_all(lower(s), '[a-z]{{3,}}') AS words, {sql_tokens('s')} AS toks FROM t),
v AS (SELECT doc_id, n,
  CASE WHEN len(words) < 5 THEN 0.0 ELSE len(list_filter(words, lambda w: w IN ({listed(COMMON_WORDS)}))) / CAST(len(words) AS DOUBLE) END AS word_ratio,
  CASE WHEN {sql_not('s', WS)} = 0 THEN 0.0 ELSE {sql_not('s', '^\\p{L}')} / CAST({sql_not('s', WS)} AS DOUBLE) END AS alpha_ratio,
  CASE WHEN n = 0 THEN 0.0 ELSE {sql_count('s', quality.WEIRD)} / CAST(n AS DOUBLE) END AS weird_ratio,
  coalesce(list_median(list_transform(toks, lambda x: length(x))), 0.0) AS median_token_len,
  CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda x: regexp_matches(x, '[a-zA-Z]') AND regexp_matches(x, '\\p{{Nd}}'))) / CAST(len(toks) AS DOUBLE) END AS digit_mixed_ratio
  FROM u)"""


@query(
    "q01_text_quality_signals",
    f"WITH {_SIGNALS} SELECT doc_id, round(word_ratio, 6) AS word_ratio, round(alpha_ratio, 6) AS alpha_ratio, round(weird_ratio, 6) AS weird_ratio, CAST(median_token_len AS DOUBLE) AS median_token_len, round(digit_mixed_ratio, 6) AS digit_mixed_ratio FROM v",
)
def text_quality_signals(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", X.strip(F.col("text")).alias("s"))
    s = F.col("s")
    t = t.select("doc_id", quality.word_ratio(s).alias("w"), quality.alpha_ratio(s).alias("a"), quality.weird_ratio(s).alias("x"), quality.token_sanity(s).alias("t"))
    return t.select("doc_id", F.round("w", 6).alias("word_ratio"), F.round("a", 6).alias("alpha_ratio"), F.round("x", 6).alias("weird_ratio"), "t.median_token_len", F.round("t.digit_mixed_ratio", 6).alias("digit_mixed_ratio"))


@query(
    "q02_text_quality_gate",
    f"""WITH {_SIGNALS}, g AS (SELECT doc_id, CAST(n AS INTEGER) AS text_length, CASE WHEN n < 200 THEN 'too_short' WHEN weird_ratio > 0.05 THEN 'weird_chars' WHEN median_token_len < 2 THEN 'tiny_tokens' WHEN median_token_len > 20 THEN 'giant_tokens'
    WHEN digit_mixed_ratio > 0.4 THEN 'digit_mixed' WHEN word_ratio >= 0.55 THEN 'high_word_ratio' WHEN word_ratio <= 0.25 THEN 'low_word_ratio' WHEN alpha_ratio < 0.5 THEN 'gray_low_alpha' ELSE 'gray_passed' END AS reason FROM v)
    SELECT doc_id, text_length, reason, reason IN ('high_word_ratio', 'gray_passed') AS good FROM g""",
)
def text_quality_gate(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", quality.gate(F.col("text")).alias("g"))
    return t.select("doc_id", "g.text_length", F.regexp_extract("g.reason", "^([a-z_]+)", 1).alias("reason"), "g.good")


@query("q03_quality_by_label", f"WITH {_SIGNALS} SELECT quality, count(*) AS n, round(avg(word_ratio), 6) AS word_ratio, round(avg(alpha_ratio), 6) AS alpha_ratio FROM v JOIN labels USING (doc_id) GROUP BY quality")
def quality_by_label(spark, sf_dir):
    t = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").select("quality", X.strip(F.col("text")).alias("s"))
    t = t.select("quality", quality.word_ratio(F.col("s")).alias("w"), quality.alpha_ratio(F.col("s")).alias("a"))
    return t.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("w"), 6).alias("word_ratio"), F.round(F.avg("a"), 6).alias("alpha_ratio"))


# cleaning and noise

_SRC, _DST = (tuple(zip(*((a, b) for a, b in zip(*clean_map(False), strict=True) if a != "\0"), strict=True)))
_BETWEEN = f"regexp_replace(regexp_replace(text, {q('(\\p{L})[' + punct_class() + '](\\p{L})')}, '\\1 \\2', 'g'), {q('(\\p{L})[' + punct_class() + '](\\p{L})')}, '\\1 \\2', 'g')"


@query("q04_same_length_clean", f"SELECT doc_id, md5(translate({_BETWEEN}, {q(''.join(_SRC))}, {q(''.join(_DST))})) AS clean_md5, CAST(length(text) AS INTEGER) AS n FROM documents")
def same_length_clean(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", cleaning.same_length(F.col("text")).alias("c"))
    return t.select("doc_id", F.md5("c").alias("clean_md5"), F.length("c").alias("n"))


# The tables of the cleaner and of the noise score, stated here once more, as ranges.
_BOXES = r"\x{203B}\x{2500}\x{2502}\x{250C}\x{2510}\x{2514}\x{2518}\x{251C}\x{2524}\x{252C}\x{2534}\x{253C}\x{2550}-\x{256C}\x{2580}\x{2584}\x{2588}\x{258C}\x{2590}-\x{2593}\x{25A0}\x{25A1}\x{25AA}\x{25AB}\x{25CB}\x{25CC}\x{25CF}\x{2605}\x{2606}\x{2726}\x{2727}"
_JUNK = _BOXES + r"\x{25D0}-\x{25F0}\x{25B6}-\x{25BA}\x{25C0}-\x{25C3}\x{2190}-\x{21A7}\x{21C4}-\x{21DB}\x{2729}-\x{273B}\x{2200}-\x{221F}\x{A7}\x{B6}\x{2020}-\x{2023}\x{203C}\x{203D}\x{2043}\x{2047}-\x{2049}\x{204C}\x{204D}\x{2E18}"
_NOISE = f"""noisy AS (SELECT doc_id, length(text) AS n, {sql_count('text', _JUNK)} / CAST(length(text) AS DOUBLE) AS garbage,
 CASE WHEN length(text) < 50 THEN 0.0 ELSE least(1.0, {sql_not('text', noise.COMMON)} / CAST(length(text) AS DOUBLE) * 10) * 0.3
 + least(1.0, len(regexp_extract_all(text, '[A-Za-z][0-9][A-Za-z]|[0-9][A-Za-z][0-9]')) / 20.0e0) * 0.3
 + (CASE WHEN len({sql_tokens('text')}) = 0 THEN 0.0 ELSE len(list_filter({sql_tokens('text')}, lambda t: length(t) <= 2)) / CAST(len({sql_tokens('text')}) AS DOUBLE) END) * 0.2
 + least(1.0, {sql_count('text', _BOXES)} / CAST(length(text) AS DOUBLE) * 20) * 0.2 END AS noise FROM documents)"""


@query("q05_noise_and_recovery", f"WITH {_NOISE} SELECT doc_id, round(garbage, 6) AS garbage_ratio, round(noise, 6) AS noise_score, n >= 500 AND noise >= 0.15 AS needs_recovery FROM noisy")
def noise_and_recovery(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"), cleaning.garbage_ratio(F.col("text")).alias("g"), noise.score(F.col("text")).alias("s"))
    return t.select("doc_id", F.round("g", 6).alias("garbage_ratio"), F.round("s", 6).alias("noise_score"), noise.needs_recovery(F.col("n"), F.lit(0), F.col("s")).alias("needs_recovery"))


_BOUNDS = """sized AS (SELECT conv_id AS file_id, turn, length('[Page ' || CAST(turn + 1 AS INTEGER) || ']' || chr(10)) + length(coalesce(text, '')) + 2 AS n FROM conversations),
bounds AS (SELECT file_id, CAST(row_number() OVER w AS INTEGER) AS page_number, CAST(sum(n) OVER w - n AS INTEGER) AS page_start, CAST(sum(n) OVER w AS INTEGER) AS page_end FROM sized WINDOW w AS (PARTITION BY file_id ORDER BY turn))"""


@query("q06_page_boundaries", f"WITH {_BOUNDS} SELECT file_id, page_number, page_start, page_end FROM bounds")
def page_boundaries(spark, sf_dir):
    return spans.boundaries_of(pages(spark, sf_dir))


@query(
    "q07_span_pages",
    f"WITH {_BOUNDS}, p AS (SELECT conv_id AS file_id, turn, CAST((turn * 997 + conv_id * 31) % 2500 AS INTEGER) AS start FROM conversations) SELECT p.file_id, p.turn, p.start, page_number FROM p LEFT JOIN bounds b ON p.file_id = b.file_id AND start >= page_start AND start < page_end",
)
def span_pages(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file_id"), "turn", ((F.col("turn") * 997 + F.col("conv_id") * 31) % 2500).cast("int").alias("start"))
    return spans.with_pages(t, spans.boundaries_of(pages(spark, sf_dir)))


# spans

_NER = f"""tok AS (SELECT doc_id, text, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+') AS t, regexp_split_to_array(text, '[\\p{{L}}\\p{{N}}_]+') AS g FROM documents),
ex AS (SELECT doc_id, text, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS t, unnest(g[1:len(t)]) AS g FROM tok),
pos AS (SELECT doc_id, text, i, t, g, sum(length(t) + length(g)) OVER (PARTITION BY doc_id ORDER BY i) AS e, regexp_full_match(t, '[A-Z][a-z]+') AS cap FROM ex),
cap AS (SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND regexp_full_match(g, '[{WS}]+') THEN 0 ELSE 1 END AS new FROM pos WHERE cap WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grp AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cap),
ner AS (SELECT doc_id AS file_id, CAST(min(e - length(t)) AS INTEGER) AS "start", CAST(max(e) AS INTEGER) AS "end", substring(any_value(text), CAST(min(e - length(t)) AS BIGINT) + 1, CAST(max(e) - min(e - length(t)) AS BIGINT)) AS text FROM grp GROUP BY doc_id, k HAVING max(e) - min(e - length(t)) >= 3)"""


@query("q08_mock_entities", f"WITH {_NER} SELECT file_id, \"start\", \"end\", text FROM ner")
def mock_entities(spark, sf_dir):
    return spans.mock_entities(documents(spark, sf_dir)).select("file_id", "start", "end", "text")


@query("q09_chunks", f"WITH c AS (SELECT doc_id AS file_id, CAST(unnest(range(0, length(text), 1948)) AS INTEGER) AS chunk_start, text FROM documents) SELECT file_id, chunk_start, md5(substring(text, chunk_start + 1, 2048)) AS chunk_md5 FROM c WHERE {sql_strip('substring(text, chunk_start + 1, 2048)')} <> ''")
def chunks(spark, sf_dir):
    return spans.chunks(documents(spark, sf_dir)).select("file_id", "chunk_start", F.md5("chunk").alias("chunk_md5"))


_CLASSES = f"""kinds AS (SELECT *, {' OR '.join(f"contains(lower(original_text), '{x}')" for x in classify.ORGANISATIONS)} AS org, {' OR '.join(f"contains(lower(original_text), '{x}')" for x in classify.LOCATIONS)} AS place FROM name_cases)"""


@query("q10_classified", f"WITH {NAME_CASES}, {_CLASSES} SELECT file_id, name_index, NOT (org OR place) AS is_person, CASE WHEN org THEN 'organization' WHEN place THEN 'location' END AS drop_reason FROM kinds")
def classified(spark, sf_dir):
    t = classify.mock_classified(name_cases(spark, sf_dir).withColumnRenamed("original_text", "text"))
    return t.select("file_id", "name_index", "is_person", "drop_reason")


@query(
    "q11_document_type",
    "WITH t AS (SELECT conv_id, turn, lower(CASE conv_id % 6 WHEN 0 THEN 'From: a To: b ' WHEN 1 THEN 'Flight 7, passenger ' WHEN 2 THEN 'Dear all, ' WHEN 3 THEN 'the defendant ' ELSE '' END || text) AS t FROM conversations) SELECT conv_id, turn, CASE WHEN contains(t, 'from:') AND contains(t, 'to:') THEN 'email' WHEN contains(t, 'flight') AND (contains(t, 'passenger') OR contains(t, 'manifest')) THEN 'flight_log' WHEN contains(t, 'dear ') OR contains(t, 'sincerely') THEN 'letter' WHEN contains(t, 'plaintiff') OR contains(t, 'defendant') THEN 'legal' ELSE 'other' END AS document_type FROM t",
)
def document_type(spark, sf_dir):
    head = F.expr("CASE conv_id % 6 WHEN 0 THEN 'From: a To: b ' WHEN 1 THEN 'Flight 7, passenger ' WHEN 2 THEN 'Dear all, ' WHEN 3 THEN 'the defendant ' ELSE '' END")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", classify.document_type(F.concat(head, F.col("text"))).alias("document_type"))


#: Spans that hold, miss, or lie outside their texts, by key.
_START, _SIZE = "CAST((doc_id * 7) % 90 - 2 AS INTEGER)", "CAST(doc_id % 15 AS INTEGER)"
_SPAN_TEXT = "CASE WHEN doc_id % 4 = 0 THEN 'Otto Lind' WHEN doc_id % 4 = 1 THEN concat(' ', substring(text, greatest({s}, 0) + 1, {n})) ELSE substring(text, greatest({s}, 0) + 1, {n}) END".format(s=_START, n=_SIZE)
_MADE = f'made AS (SELECT doc_id AS file_id, text AS source, {_START} AS "start", {_START} + {_SIZE} AS "end", {_SPAN_TEXT} AS text FROM documents)'
_ACTUAL = 'substring(source, greatest("start", 0) + 1, "end" - "start")'
_SQUEEZE = lambda x: f"trim(regexp_replace({x}, {WSC}, ' ', 'g'), {q(WS_CHARS)})"


def made_spans(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "documents")
    return t.select(F.col("doc_id").alias("file_id"), F.expr(_START).alias("start"), F.expr(f"{_START} + {_SIZE}").alias("end"), F.expr(_SPAN_TEXT).alias("text"))


@query(
    "q12_validated_spans",
    f"""WITH {_MADE} SELECT file_id, "start", "end", CASE WHEN "start" < 0 OR "end" > length(source) OR "start" >= "end" THEN 'out_of_bounds' WHEN {sql_strip(_ACTUAL)} = '' THEN 'empty'
    WHEN {sql_strip(_ACTUAL)} <> {sql_strip('text')} AND {_SQUEEZE(_ACTUAL)} <> {_SQUEEZE('text')} THEN 'mismatch' END AS error FROM made""",
)
def validated_spans(spark, sf_dir):
    docs = documents(spark, sf_dir).select("file_id", F.col("text").alias("raw_text"))
    return spans.validated(made_spans(spark, sf_dir), docs).select("file_id", "start", "end", "error")


_ISSUE = f"""issue AS (SELECT file_id, CASE WHEN file_id % 9 = 0 THEN 'missing_offsets' WHEN "start" < 0 OR "end" > length(source) OR "start" >= "end" THEN 'out_of_bounds'
 WHEN {sql_strip(_ACTUAL)} <> {sql_strip('text')} AND {_SQUEEZE(_ACTUAL)} <> {_SQUEEZE('text')} THEN 'mismatch' END AS issue_type FROM made)"""


def _checked(spark, sf_dir):
    names_ = made_spans(spark, sf_dir).withColumn("start", F.when(F.col("file_id") % 9 != 0, F.col("start"))).withColumnRenamed("text", "original_text")
    return validation.issues(names_, documents(spark, sf_dir))


@query("q13_validation_by_type", f"WITH {_MADE}, {_ISSUE} SELECT issue_type, count(*) AS n FROM issue WHERE issue_type IS NOT NULL GROUP BY issue_type")
def validation_by_type(spark, sf_dir):
    return validation.by_type(_checked(spark, sf_dir))


@query(
    "q14_validation_report",
    f"WITH {_MADE}, {_ISSUE} SELECT count(DISTINCT file_id) AS total_files, count(*) AS total_names, count(*) FILTER (issue_type IS NULL) AS valid_names, count(*) FILTER (issue_type IS NOT NULL) AS invalid_names, count(DISTINCT file_id) FILTER (issue_type IS NOT NULL) AS files_with_issues FROM issue",
)
def validation_report(spark, sf_dir):
    return validation.report(_checked(spark, sf_dir))


# names

_TITLE = lambda x: f"array_to_string(list_transform(regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda r: upper(r[1]) || lower(r[2:])), '')"
_UPPER = lambda x: f"({x} = upper({x}) AND {x} <> lower({x}))"
_NORMAL = f"""sq AS (SELECT *, {_SQUEEZE('original_text')} AS s FROM name_cases), sw AS (SELECT *, CASE WHEN len(string_split(s, ',')) = 2 AND trim(string_split(s, ',')[1]) <> '' AND trim(string_split(s, ',')[2]) <> '' THEN trim(string_split(s, ',')[2]) || ' ' || trim(string_split(s, ',')[1]) ELSE s END AS w FROM sq),
mr AS (SELECT *, replace(replace(replace(translate(original_text, '015|', 'OISl'), '/', ''), '\\', ''), '~', '') AS m FROM sw)"""


@query(
    "q15_normal_forms",
    f"WITH {NAME_CASES}, {_NORMAL} SELECT name_index, CASE WHEN length(w) > 3 AND {_UPPER('w')} THEN {_TITLE('w')} ELSE w END AS normal, regexp_matches(original_text, '[015/{{}}\\x{{2DC}}|\\\\@#$%^&*=+\\[\\]<>]') OR regexp_matches(original_text, '\\p{{L}}\\p{{Nd}}\\p{{L}}') AS needs_repair, {_SQUEEZE(f'CASE WHEN {_UPPER("m")} THEN {_TITLE("m")} ELSE m END')} AS repaired FROM mr",
)
def normal_forms(spark, sf_dir):
    x = F.col("original_text")
    return name_cases(spark, sf_dir).select("name_index", names.basic_normal(x).alias("normal"), names.needs_repair(x).alias("needs_repair"), names.mock_repaired(x).alias("repaired"))


_LOW = "rtrim(lower(t), '.')"
_CLEAN = f"""c1 AS (SELECT *, ltrim(regexp_replace(translate(regexp_replace(original_text, '[\\x{{200B}}-\\x{{200F}}\\x{{2028}}-\\x{{202F}}\\x{{FEFF}}\\x{{AD}}]', '', 'g'), '_', ' '), {WSC}, ' ', 'g'), {q(names.LEADING)}) AS x FROM name_cases),
c2 AS (SELECT *, regexp_extract(x, '^([0-9]+)([.{WS})\\-:?'']+)[{WS}]*(.*)$', ['num', 'mark', 'rest']) AS m, regexp_extract(x, '^[0-9]{{1,2}}''*([A-Za-z].*)$', 1) AS fused, regexp_matches(x, '^([0-9]+)([.{WS})\\-:?'']+)[{WS}]*(.*)$') AS listed FROM c1),
c3 AS (SELECT * EXCLUDE (x, m, fused), CASE WHEN listed THEN CASE WHEN (length(ltrim(m.num, '0')) <= 3 AND coalesce(TRY_CAST(m.num AS BIGINT), 999) <= 300 OR {sql_strip('m.mark')} IN ('.', ')', ':', '-')) AND length(m.rest) >= 3 THEN m.rest ELSE x END WHEN length(fused) >= 3 THEN fused ELSE x END AS x FROM c2),
c4 AS (SELECT * EXCLUDE (x), regexp_replace(regexp_replace(rtrim(x, {q(names.TRAILING)}), '\\.{{2,}}[{WS}]*$', ''), '([a-z]{{2}})\\.$', '\\1') AS x FROM c3),
c5 AS (SELECT *, {sql_tokens(f"regexp_replace(regexp_replace(x, '[{WS}]*[,;—–()/|][{WS}]*', ' ', 'g'), '[{WS}]+-[{WS}]+', ' ', 'g')")} AS w FROM c4),
c6 AS (SELECT *, len(w) AS n, list_transform(w, lambda t: rtrim(t, '.')) AS bare, list_filter(range(CAST(len(w) // 2 AS BIGINT), 1, -1), lambda b: w[1:b] = w[b + 1:2 * b])[1] AS b FROM c5),
c7 AS (SELECT *, w[1:b] AS block, coalesce(list_filter(range(0, n - b + 1, b), lambda p: w[p + 1:p + b] <> w[1:b])[1], b * (n // b)) AS stop FROM c6),
c8 AS (SELECT *, list_transform(w[stop + 1:], lambda t: CASE WHEN {_LOW} IN ({listed(SUFFIX_TOKENS)}) THEN 1 WHEN list_contains(list_transform(block, lambda z: lower(z)), lower(t)) THEN 0 ELSE -1 END) AS kinds FROM c7),
c9 AS (SELECT * EXCLUDE (x), CASE WHEN n < 2 THEN x WHEN contains(x, '.') AND len(list_distinct(list_transform(bare, lambda t: lower(t)))) = 1 THEN bare[1]
 WHEN b IS NOT NULL THEN array_to_string(list_concat(block, list_filter(w[stop + 1:stop + coalesce(nullif(list_position(kinds, -1), 0) - 1, len(kinds))], lambda t: {_LOW} IN ({listed(SUFFIX_TOKENS)}))), ' ')
 WHEN n >= 3 AND w[n] = w[n - 1] THEN array_to_string(w[1:n - 1], ' ') WHEN n >= 3 AND w[1] = w[2] THEN array_to_string(list_concat(w[1:1], w[3:]), ' ') WHEN n >= 3 AND lower(w[1]) = lower(w[n]) THEN array_to_string(w[2:], ' ') ELSE x END AS x FROM c8),
c10 AS (SELECT * EXCLUDE (w, n), {sql_tokens('x')} AS w FROM c9),
c11 AS (SELECT * EXCLUDE (w), w[1:list_reduce(list_prepend(CAST(len(w) AS BIGINT), range(1, len(w) + 1)), lambda m, _: CASE WHEN m >= 2 AND lower(w[m]) IN ({listed(EMAIL_TOKENS)}) OR m >= 3 AND lower(w[m]) IN ({listed(GUARDED_TOKENS)}) THEN m - 1 ELSE m END)] AS w FROM c10),
c12 AS (SELECT *, len(w) AS n, lower(w[len(w)]) AS z, lower(w[1]) AS y, lower(w[len(w) - 1]) AS p FROM c11),
cleaned AS (SELECT file_id, name_index, role, confidence, {sql_strip("array_to_string(CASE WHEN n >= 2 AND length(z) >= 2 AND (length(y) > length(z) AND starts_with(y, z) OR n >= 3 AND length(p) > length(z) AND starts_with(p, z)) THEN w[1:n - 1] ELSE w END, ' ')")} AS clean_name FROM c12)"""


@query("q16_clean_names", f"WITH {NAME_CASES}, {_CLEAN} SELECT name_index, clean_name FROM cleaned")
def clean_names(spark, sf_dir):
    return name_cases(spark, sf_dir).select("name_index", names.clean(F.col("original_text")).alias("clean_name"))


def _garbage(x: str) -> str:
    w = sql_tokens(x)
    n, first, last = f"len({w})", f"({w})[1]", f"({w})[len({w})]"
    stop, toks = listed(STOPWORDS), lambda words: f"{_LOW} IN ({listed(words)})"
    return " OR ".join(
        f"({r})"
        for r in [
            f"length({x}) >= 60", f"{n} >= 8", f"length({x}) <= 2", f"regexp_matches({x}, '\\p{{Nd}}{{3,}}')", f"NOT regexp_matches({x}, '[a-zA-Z]')", f"length({x}) > 12 AND NOT regexp_matches({x}, '[ .-]')",
            f"NOT contains({x}, ' ') AND regexp_matches({x}, '[a-z][A-Z]')", f"rtrim(lower({x}), '.') IN ({listed(NOT_NAMES)})", f"regexp_matches({x}, '[\\n\\r]')", f"{n} >= 2 AND len(list_distinct(list_transform({w}, lambda t: lower(t)))) = 1",
            f"regexp_matches({x}, '[\\x{{2580}}-\\x{{259F}}\\x{{25A0}}-\\x{{25FF}}]')", f"regexp_matches({x}, '[{names.SYMBOLS}]')", f"regexp_matches({x}, '\\p{{Nd}}') AND regexp_matches({x}, '[a-zA-Z]')", f"regexp_matches({x}, '[)(}}{{\\[\\]]')",
            f"len(list_filter({w}, lambda t: {toks(HONORIFICS)})) > 0", f"regexp_matches({x}, '[,&!:_]')", f"{n} >= 2 AND lower({last}) IN ({stop})", f"{n} >= 2 AND lower({first}) IN ({stop})",
            f"{n} >= 1 AND (regexp_full_match({first}, '\\p{{Ll}}') OR {n} >= 2 AND regexp_full_match({last}, '\\p{{Ll}}'))", f"{n} >= 2 AND length({last}) >= 2 AND length({first}) > length({last}) AND starts_with(lower({first}), lower({last}))",
        ]
    )


@query("q17_garbage_names", f"WITH {NAME_CASES} SELECT name_index, {_garbage('original_text')} AS is_garbage FROM name_cases")
def garbage_names(spark, sf_dir):
    return name_cases(spark, sf_dir).select("name_index", names.is_garbage(F.col("original_text")).alias("is_garbage"))


_ORDER = "CASE role " + " ".join(f"WHEN '{r}' THEN {i}" for r, i in ROLE_PRIORITY.items()) + " END"
_KEPT = f"""{_CLEAN}, judged AS (SELECT file_id, name_index, clean_name, CASE WHEN role IN ({listed(ROLE_PRIORITY)}) THEN role ELSE 'mentioned' END AS role, role NOT IN ({listed(ROLE_PRIORITY)}) AS remapped,
 ({_garbage('clean_name')}) OR coalesce(confidence < 0.7, false) AS bad FROM cleaned),
kept AS (SELECT * FROM judged WHERE NOT bad QUALIFY row_number() OVER (PARTITION BY file_id, lower(clean_name) ORDER BY {_ORDER}, name_index) = 1)"""


@query("q18_one_of_each", f"WITH {NAME_CASES}, {_KEPT} SELECT file_id, name_index, clean_name, role FROM kept")
def one_of_each(spark, sf_dir):
    return names_op.clean_files(name_cases(spark, sf_dir)).select("file_id", "name_index", "clean_name", "role")


@query(
    "q19_name_statistics",
    f"WITH {NAME_CASES}, {_KEPT} SELECT count(*) AS total_names, count(*) FILTER (bad) AS garbage_names, count(*) FILTER (NOT bad AND remapped) AS roles_remapped, (SELECT count(*) FROM kept) AS kept_names, count(*) FILTER (NOT bad) - (SELECT count(*) FROM kept) AS deduplicated FROM judged",
)
def name_statistics(spark, sf_dir):
    return names_op.statistics(name_cases(spark, sf_dir))


_REPEATED = "len(list_filter(range(1, length(s) - 2), lambda i: s[i] <> chr(10) AND s[i] = s[i + 1] AND s[i] = s[i + 2] AND s[i] = s[i + 3])) > 0"


@query(
    "q20_heuristic_names",
    f"""WITH {NAME_CASES}, h AS (SELECT name_index, {sql_strip('original_text')} AS s FROM name_cases), r AS (SELECT *, CASE WHEN s = '' THEN 'empty' WHEN regexp_matches(s, '^[^a-zA-Z]*$') THEN 'matches_garbage_pattern_0' WHEN {_REPEATED} THEN 'matches_garbage_pattern_1'
    WHEN regexp_matches(s, '^.{{1,2}}$') THEN 'matches_garbage_pattern_2' WHEN regexp_matches(s, '^.{{60,}}$') THEN 'matches_garbage_pattern_3' WHEN regexp_matches(s, '[0-9]{{3,}}') THEN 'matches_garbage_pattern_4' WHEN regexp_matches(s, '[^\\p{{L}}\\p{{N}}_{WS}\\-.'',]') THEN 'matches_garbage_pattern_5' END AS reason FROM h)
    SELECT name_index, reason IS NULL AS is_valid, CAST(CASE WHEN reason IS NOT NULL THEN 0.95 WHEN regexp_matches(s, '{names.LIKELY_NAME}') THEN 0.85 ELSE 0.5 END AS DOUBLE) AS confidence, coalesce(reason, CASE WHEN regexp_matches(s, '{names.LIKELY_NAME}') THEN 'matches_name_pattern' ELSE 'default' END) AS reason FROM r""",
)
def heuristic_names(spark, sf_dir):
    return name_cases(spark, sf_dir).select("name_index", names.heuristic(F.col("original_text")).alias("h")).select("name_index", "h.is_valid", F.col("h.confidence").cast("double").alias("confidence"), "h.reason")


# work


def _stems(spark, sf_dir):
    inputs = table(spark, sf_dir, "documents").select(F.format_string("doc%08d", "doc_id").alias("stem"))
    return inputs, table(spark, sf_dir, "labels").select(F.format_string("doc%08d", "doc_id").alias("stem"))


_STEMS = "i AS (SELECT printf('doc%08d', doc_id) AS stem FROM documents), o AS (SELECT printf('doc%08d', doc_id) AS stem FROM labels), p AS (SELECT DISTINCT stem FROM i WHERE stem NOT IN (SELECT stem FROM o))"


@query("q21_pending", f"WITH {_STEMS} SELECT stem FROM p")
def pending(spark, sf_dir):
    return work.pending(*_stems(spark, sf_dir))


@query("q22_assigned", f"WITH {_STEMS} SELECT stem, CAST(floor((row_number() OVER (ORDER BY stem) - 1) / ceil(count(*) OVER () / 7.0)) AS INTEGER) AS worker FROM p")
def assigned(spark, sf_dir):
    return work.assigned(work.pending(*_stems(spark, sf_dir)), 7)


@query("q23_manifest_latest", "SELECT user_id, max(event_id) AS seq, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def manifest_latest(spark, sf_dir):
    return work.latest(table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), "event_type", "value"), "user_id")


@query("q24_manifest_top", "WITH m AS (SELECT CAST(user_id AS VARCHAR) AS stem, count(*) AS person_spans, round(sum(value), 4) AS v FROM events GROUP BY user_id) SELECT stem, person_spans FROM m WHERE person_spans BETWEEN 2 AND 1000 ORDER BY person_spans DESC, stem LIMIT 20")
def manifest_top(spark, sf_dir):
    m = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("stem")).agg(F.count(F.lit(1)).alias("person_spans"))
    return work.top(m, 2, 1000, limit=20)


@query("q25_tier_two_gate", f"WITH {_NOISE}, {_NER}, c AS (SELECT file_id, count(*) AS k FROM ner GROUP BY file_id) SELECT doc_id, coalesce(k, 0) = 0 AND (n < 200 OR noise < 0.15) AS skipped FROM noisy LEFT JOIN c ON doc_id = file_id")
def tier_two_gate(spark, sf_dir):
    docs = documents(spark, sf_dir)
    n = spans.mock_entities(docs).groupBy("file_id").agg(F.count(F.lit(1)).alias("k"))
    rows = docs.select("file_id", F.length("text").alias("n"), noise.score(F.col("text")).alias("noise")).join(n, "file_id", "left")
    return rows.select(F.col("file_id").alias("doc_id"), work.nothing_to_do(F.coalesce("k", F.lit(0)), F.col("n"), F.col("noise")).alias("skipped"))


# summaries

_PROMPT = "'Summarise page ' || CAST(turn + 1 AS INTEGER) || ' of ' || count(*) OVER (PARTITION BY conv_id) || ' in one or two factual sentences, and list professions that its text states, as JSON.' || chr(10) || chr(10)"
_PROMPTS = f"""pr AS (SELECT conv_id, turn, {sql_strip("coalesce(text, '')")} AS s, {_PROMPT} AS head FROM conversations),
pt AS (SELECT conv_id, turn, CASE WHEN length(s) >= 10 THEN head || CASE WHEN length(s) > 6000 THEN substring(s, 1, 6000) || chr(10) || '[... truncated ...]' ELSE s END END AS prompt FROM pr)"""


def _prompts(spark, sf_dir):
    n = F.count(F.lit(1)).over(Window.partitionBy("file_id"))
    return pages(spark, sf_dir).select("file_id", "page_number", summaries.page_prompt(F.col("page_number"), n, F.col("text")).alias("prompt"))


@query("q26_page_prompts", f"WITH {_PROMPTS} SELECT conv_id AS file_id, CAST(turn + 1 AS INTEGER) AS page_number, md5(prompt) AS prompt_md5, CAST(length(prompt) // 3 AS INTEGER) AS tokens FROM pt")
def page_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir).select("file_id", "page_number", F.md5("prompt").alias("prompt_md5"), summaries.prompt_tokens(F.col("prompt")).alias("tokens"))


@query(
    "q27_token_chunks",
    f"""WITH RECURSIVE {_PROMPTS}, b AS (SELECT conv_id AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(prompt) // 3 AS t FROM pt WHERE prompt IS NOT NULL),
    f AS (SELECT g, i, t, 1 AS n, t AS s, 0 AS c FROM b WHERE i = 1 UNION ALL SELECT b.g, b.i, b.t, CASE WHEN f.n >= 3 OR f.s + b.t > 400 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n >= 3 OR f.s + b.t > 400 THEN b.t ELSE f.s + b.t END, CASE WHEN f.n >= 3 OR f.s + b.t > 400 THEN f.c + 1 ELSE f.c END FROM f JOIN b ON b.g = f.g AND b.i = f.i + 1)
    SELECT g AS "group", CAST(i AS INTEGER) AS idx, CAST(c AS INTEGER) AS chunk FROM f""",
)
def token_chunks(spark, sf_dir):
    p = _prompts(spark, sf_dir).filter("prompt IS NOT NULL")
    p = p.select(F.col("file_id").alias("group"), F.row_number().over(Window.partitionBy("file_id").orderBy("page_number")).alias("idx"), summaries.prompt_tokens(F.col("prompt")).alias("tokens"))
    return summaries.chunked(p, 3, 400).select("group", "idx", "chunk")


_PERSON = "CASE (conv_id + turn) % 5 WHEN 0 THEN 'mara venn' WHEN 1 THEN 'Otto Lind' WHEN 2 THEN 'Nobody Known' WHEN 3 THEN 'Owner' ELSE '' END"
_WORK = "CASE (conv_id * 3 + turn) % 6 WHEN 0 THEN ' Attorney ' WHEN 1 THEN 'pilot' WHEN 2 THEN 'Maid' WHEN 3 THEN 'baker' WHEN 4 THEN '' ELSE 'judge' END"
_EVIDENCE = "CASE (conv_id + turn) % 7 WHEN 0 THEN 'not on the page' WHEN 1 THEN '' ELSE concat('Owner''s pilot ', CAST(turn AS STRING)) END"
_REPLY = f"""CASE (conv_id + 2 * turn) % 5 WHEN 0 THEN 'no object here' WHEN 1 THEN concat('Sure: {{"summary": " A page. ", "occupation_mentions": [{{"occupation": "', {_WORK}, '", "surface_form": "x", "person_name": "', {_PERSON}, '", "confidence": 0.5, "evidence_span": "', {_EVIDENCE}, '"}}]}} end')
 ELSE concat('{{"summary": "Two.", "date": "", "document_type": "memo", "occupation_mentions": [{{"occupation": "', {_WORK}, '", "surface_form": "x", "person_name": "', {_PERSON}, '", "confidence": 0.5, "evidence_span": "', {_EVIDENCE}, '"}}, {{"occupation": "chef", "surface_form": "", "confidence": 1, "evidence_span": ""}}]}}') END"""
_PAGE_TEXT = "concat('Owner''s pilot ', CAST(turn AS STRING), ' ', text)"
_KIND = "CASE " + " ".join(f"WHEN lower(trim(occ)) = '{k}' THEN '{v}'" for k, v in OCCUPATION_SYNONYMS.items()) + " ELSE lower(trim(occ)) END"
_MENTIONS = f"""rp AS (SELECT conv_id, turn, {_PAGE_TEXT} AS page, {_REPLY} AS reply FROM conversations), js AS (SELECT *, TRY_CAST(regexp_extract(reply, '\\{{(?s:.)*\\}}') AS JSON) AS j FROM rp WHERE contains(reply, '{{')),
mm AS (SELECT conv_id, turn, page, unnest(from_json(json_extract(j, '$.occupation_mentions'), '["JSON"]')) AS m, unnest(range(0, CAST(json_array_length(j, '$.occupation_mentions') AS BIGINT))) AS place FROM js),
mf AS (SELECT conv_id, turn, page, place, m ->> '$.occupation' AS occ, m ->> '$.surface_form' AS sf, coalesce(m ->> '$.person_name', '') AS person, coalesce(m ->> '$.evidence_span', '') AS ev FROM mm),
mo AS (SELECT conv_id AS file_id, CAST(turn + 1 AS INTEGER) AS page_number, CAST(place AS INTEGER) AS place, {_KIND} AS occupation, CASE lower(CASE WHEN ev <> '' AND contains(lower(ev), lower(person) || '''s ') THEN '' ELSE person END) WHEN 'mara venn' THEN 'Mara Venn' WHEN 'otto lind' THEN 'Otto Lind' END AS person_name
 FROM mf WHERE occ <> '' AND sf <> '' AND (ev = '' OR contains(page, ev)))"""


def _mapped(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file_id"), (F.col("turn") + 1).cast("int").alias("page_number"), F.expr(_PAGE_TEXT).alias("text"), F.lit("embedded").alias("text_source"), F.expr(_REPLY).alias("reply"))
    allowed = t.select("file_id").distinct().select("file_id", F.array(F.lit("Mara Venn"), F.lit("Otto Lind")).alias("names"))
    return summaries.mapped(t.drop("reply"), t.select("file_id", "page_number", "reply"), allowed)


@query("q28_occupation_mentions", f"WITH {_MENTIONS} SELECT file_id, page_number, place, occupation, person_name FROM mo")
def occupation_mentions(spark, sf_dir):
    return summaries.occupations(_mapped(spark, sf_dir))


@query(
    "q29_occupation_summary",
    f"""WITH {_MENTIONS}, k AS (SELECT file_id, occupation, count(*) AS n, min(page_number * 1000 + place) AS f FROM mo GROUP BY ALL), pp AS (SELECT file_id, person_name, array_to_string(list_sort(list(DISTINCT occupation)), ',') AS o FROM mo WHERE person_name IS NOT NULL GROUP BY ALL),
    a AS (SELECT file_id, string_agg(occupation || '=' || n, ';' ORDER BY n DESC, f) AS by_occupation FROM k GROUP BY file_id), b AS (SELECT file_id, string_agg(person_name || '=' || o, ';' ORDER BY person_name) AS by_person FROM pp GROUP BY file_id),
    u AS (SELECT file_id, array_to_string(list_sort(list(DISTINCT occupation) FILTER (person_name IS NULL)), ';') AS unlinked FROM mo GROUP BY file_id)
    SELECT a.file_id, by_occupation, coalesce(by_person, '') AS by_person, coalesce(unlinked, '') AS unlinked FROM a LEFT JOIN b USING (file_id) LEFT JOIN u USING (file_id)""",
)
def occupation_summary(spark, sf_dir):
    s = summaries.occupation_summary(summaries.occupations(_mapped(spark, sf_dir)))
    return s.select(
        "file_id",
        F.array_join(F.transform("by_occupation", lambda x: F.concat_ws("=", x["occupation"], x["n"].cast("string"))), ";").alias("by_occupation"),
        F.coalesce(F.array_join(F.transform("by_person", lambda x: F.concat_ws("=", x["person"], F.array_join(x["occupations"], ","))), ";"), F.lit("")).alias("by_person"),
        F.array_join("unlinked", ";").alias("unlinked"),
    )


@query("q30_page_groups", f"""WITH {_MENTIONS}, g AS (SELECT conv_id AS file_id, turn, CASE WHEN contains(reply, '{{') THEN trim(coalesce(TRY_CAST(regexp_extract(reply, '\\{{(?s:.)*\\}}') AS JSON) ->> '$.summary', '')) ELSE reply END AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM rp)
SELECT file_id, 'pp. ' || min(turn + 1) || '-' || max(turn + 1) AS page, CAST(i // 3 AS INTEGER) AS page_number, string_agg('Page ' || (turn + 1) || ': ' || s, chr(10) ORDER BY turn) AS summary FROM g GROUP BY file_id, i // 3""")
def page_groups(spark, sf_dir):
    return summaries.grouped(_mapped(spark, sf_dir), 3)


_CACHE = "cache AS (SELECT doc_id AS file_id, CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE substring(sha256(text), 1, 16) END AS text_hash, CASE WHEN doc_id % 5 = 0 THEN 'm0' ELSE 'm1' END AS model_version, 'p1' AS prompt_version FROM documents)"


@query("q31_to_compute", f"WITH {_CACHE} SELECT doc_id AS file_id, substring(sha256(text), 1, 16) AS text_hash FROM documents d WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.file_id = d.doc_id AND c.text_hash = substring(sha256(d.text), 1, 16) AND model_version = 'm1' AND prompt_version = 'p1')")
def to_compute(spark, sf_dir):
    docs = documents(spark, sf_dir)
    cache = docs.select("file_id", F.when(F.col("file_id") % 3 == 0, "old").otherwise(summaries.text_hash(F.col("text"))).alias("text_hash"), F.when(F.col("file_id") % 5 == 0, "m0").otherwise("m1").alias("model_version"), F.lit("p1").alias("prompt_version"))
    return summaries.to_compute(docs, cache, "m1", "p1").select("file_id", "text_hash")


_NOTE = "CASE doc_id % 6 WHEN 0 THEN concat(chr(10), '- Quelle: Originaldokument pruefen (KI-Zusammenfassung).') WHEN 1 THEN concat(chr(10), chr(10), '**Quelle:** Originaldokument prüfen (KI Zusammenfassung') WHEN 2 THEN concat(chr(10), '- Quelle: something else.') ELSE '' END"
_NOTE_TEXT = f"concat('Content of ', CAST(doc_id AS STRING), '.', {_NOTE})"


@query("q32_sanitized", f"SELECT doc_id, CASE WHEN regexp_matches({_NOTE_TEXT}, {q(replies.SOURCE_NOTE)}) THEN rtrim(regexp_replace({_NOTE_TEXT}, {q(replies.SOURCE_NOTE)}, '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) ELSE {_NOTE_TEXT} END AS summary FROM documents")
def sanitized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", replies.sanitized(F.expr(_NOTE_TEXT)).alias("summary"))


# files

_WORDS = f"CAST(len({sql_tokens('coalesce(text, %s)' % q(''))}) AS INTEGER)"
_ROUTE = f"rt AS (SELECT conv_id AS file_id, turn, {_WORDS} AS wc, CASE WHEN {_WORDS} >= 10 THEN 'embedded' WHEN turn % 2 = 0 THEN 'none' ELSE 'ocr' END AS src FROM conversations)"


def _page_stats(spark, sf_dir):
    return pages(spark, sf_dir).select("file_id", "page_number", "text", files.word_count(F.col("text")).alias("word_count"), (F.col("page_number") % 2 == 0).alias("has_images"), F.lit("text_like").alias("page_type"))


@query("q33_scanned", f"WITH {_ROUTE} SELECT file_id, avg(CASE WHEN wc >= 10 THEN 1.0 ELSE 0.0 END) < 0.1 AS is_scanned FROM rt GROUP BY file_id")
def scanned(spark, sf_dir):
    return files.scanned(_page_stats(spark, sf_dir))


@query(
    "q34_file_kinds",
    "WITH f AS (SELECT page_id, url || CASE page_id % 7 WHEN 0 THEN '.PDF' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.docx' WHEN 3 THEN '.txt' WHEN 4 THEN '.mp3' WHEN 5 THEN '.mkv' ELSE '.xyz' END AS p FROM pages) SELECT page_id, CASE lower(regexp_extract(p, '\\.[^./]+$')) WHEN '.pdf' THEN 'pdf' WHEN '.jpeg' THEN 'image' WHEN '.docx' THEN 'docx' WHEN '.txt' THEN 'txt' WHEN '.mp3' THEN 'audio' WHEN '.mkv' THEN 'video' END AS kind FROM f",
)
def file_kinds(spark, sf_dir):
    p = F.concat(F.col("url"), F.expr("CASE page_id % 7 WHEN 0 THEN '.PDF' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.docx' WHEN 3 THEN '.txt' WHEN 4 THEN '.mp3' WHEN 5 THEN '.mkv' ELSE '.xyz' END"))
    return table(spark, sf_dir, "pages").select("page_id", files.kind_of(p).alias("kind"))


@query("q35_routed_pages")
def routed_pages(spark, sf_dir):
    return files.method_of(files.routed(_page_stats(spark, sf_dir)))


# search

_KEYED = f"ks AS (SELECT DISTINCT original_text AS name, {_SQUEEZE("regexp_replace(lower(original_text), '[^\\p{L}\\p{N}]+', ' ', 'g')")} AS k FROM name_cases), tg AS (SELECT name, k, list_distinct(list_transform(range(1, length(k) + 2), lambda i: substring('  ' || k || ' ', CAST(i AS BIGINT), 3))) AS t FROM ks)"
_SIM = "len(list_intersect(a.t, b.t)) / CAST(len(list_distinct(list_concat(a.t, b.t))) AS DOUBLE)"


@query("q36_similar_names", f"WITH {NAME_CASES}, {_KEYED} SELECT a.name AS a, b.name AS b, round({_SIM}, 6) AS score FROM tg a JOIN tg b ON a.name < b.name WHERE round({_SIM}, 6) >= 0.6")
def similar_names(spark, sf_dir):
    return search.similar_pairs(name_cases(spark, sf_dir).select(F.col("original_text").alias("name")), 0.6)


@query("q37_fuzzy_search", f"WITH {NAME_CASES}, {_KEYED}, q AS (SELECT list_distinct(list_transform(range(1, 11), lambda i: substring('  mara vann ', CAST(i AS BIGINT), 3))) AS t) SELECT name, round({_SIM}, 6) AS score, CAST(levenshtein(a.k, 'mara vann') AS INTEGER) AS distance FROM tg a, q b WHERE {_SIM} >= 0.3")
def fuzzy_search(spark, sf_dir):
    found = search.fuzzy(name_cases(spark, sf_dir).select(F.col("original_text").alias("name")).distinct(), "Mara Vann")
    return found.select("name", F.round("score", 6).alias("score"), "distance")


@query(
    "q38_full_text",
    "WITH w AS (SELECT doc_id AS file_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents), x AS (SELECT term, file_id, count(*) AS tf FROM w WHERE term IN ('licensed', 'token', 'idiot') GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM x GROUP BY term) SELECT file_id, round(sum(tf * ln(1 + (SELECT count(*) FROM documents) / CAST(df AS DOUBLE))), 6) AS score FROM x JOIN d USING (term) GROUP BY file_id",
)
def full_text(spark, sf_dir):
    return search.full_text(documents(spark, sf_dir), "Licensed token, idiot")


@query("q39_phonetic")
def phonetic(spark, sf_dir):
    return search.phonetic(name_cases(spark, sf_dir).select(F.col("original_text").alias("name")), "Maria Ven")


# the model tier, with a backend that answers by rules


def _name_docs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Invented names as spans one after another, and the texts they stand in."""
    t = name_cases(spark, sf_dir).select(F.col("name_index").alias("file_id"), F.col("original_text").alias("text"))
    found = t.select("file_id", F.lit(0).alias("start"), F.length("text").alias("end"), "text", F.lit("PER").alias("entity_type"), F.lit(0.6).alias("confidence"))
    return found, t


@query("q46_model_classified", f"WITH {NAME_CASES}, {_CLASSES} SELECT name_index AS file_id, NOT (org OR place) AS is_person, CASE WHEN org THEN 'organization' WHEN place THEN 'location' END AS drop_reason FROM kinds")
def model_classified(spark, sf_dir):
    return models.classified(*_name_docs(spark, sf_dir), "rules").select("file_id", "is_person", "drop_reason")


@query(
    "q47_model_repaired",
    f"WITH {NAME_CASES}, {_NORMAL}, nr AS (SELECT *, regexp_matches(original_text, '[015/{{}}\\x{{2DC}}|\\\\@#$%^&*=+\\[\\]<>]') OR regexp_matches(original_text, '\\p{{L}}\\p{{Nd}}\\p{{L}}') AS needs FROM sw) SELECT name_index AS file_id, needs AS was_repaired, CASE WHEN needs THEN {_SQUEEZE("translate(original_text, '015|', 'OISl')")} WHEN length(w) > 3 AND {_UPPER('w')} THEN {_TITLE('w')} ELSE w END AS normalized_name FROM nr",
)
def model_repaired(spark, sf_dir):
    found, _ = _name_docs(spark, sf_dir)
    valid = found.withColumns({"error": F.lit(None).cast("string"), "verified_text": F.col("text"), "needs_repair": names.needs_repair(F.col("text"))})
    return models.repaired(valid, "rules").select("file_id", "was_repaired", "normalized_name")


@query(
    "q48_model_yes_no",
    f"WITH {NAME_CASES}, y AS (SELECT name_index, {sql_tokens('original_text')} AS w FROM name_cases) SELECT name_index, len(w) >= 2 AND len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) = len(w) AS is_valid, 0.75 AS confidence FROM y",
)
def model_yes_no(spark, sf_dir):
    t = name_cases(spark, sf_dir).select("name_index", F.col("original_text").alias("name"))
    return models.validated_names(t, "rules", heuristics=False).select("name_index", "is_valid", "confidence")


@query("q49_model_entities")
def model_entities(spark, sf_dir):
    return models.entities(documents(spark, sf_dir), "mock").select("file_id", "start", "end", "text")


@query("q50_model_recovered")
def model_recovered(spark, sf_dir):
    docs = documents(spark, sf_dir).select("file_id", F.col("text").alias("raw_text"), F.col("text").alias("clean_text"))
    return models.recovered(docs, "rules").select("file_id", "start", "end", "text", "role", "confidence")


@query("q51_aggressive_clean", f"SELECT doc_id, md5(regexp_replace(translate({_BETWEEN}, {q(''.join(_SRC))}, {q(''.join(_DST))}), '[' || '{_JUNK}' || ']', ' ', 'g')) AS clean_md5 FROM documents")
def aggressive_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(cleaning.same_length(F.col("text"), True)).alias("clean_md5"))


# whole plans

_ORGS = " OR ".join(f"contains(lower(text), '{x}')" for x in classify.ORGANISATIONS + classify.LOCATIONS)


@query("q40_names_by_language")
def names_by_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = pipeline.document_names(docs)
    per = docs.select("file_id", "lang").join(found.select("file_id", "clean_name"), "file_id", "left")
    return per.groupBy("lang").agg(F.count_distinct("file_id").alias("documents"), F.count("clean_name").alias("names"), F.count_distinct(F.lower("clean_name")).alias("different_names"))


@query("q41_person_mentions", f"WITH {_NER} SELECT text, count(*) AS n, count(DISTINCT file_id) AS files FROM ner WHERE NOT ({_ORGS}) GROUP BY text")
def person_mentions(spark, sf_dir):
    found = classify.mock_classified(spans.mock_entities(documents(spark, sf_dir))).filter("is_person AND NOT drop")
    return found.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_id").alias("files"))


@query("q42_candidates")
def candidates(spark, sf_dir):
    return spans.candidates(documents(spark, sf_dir))


@query("q43_split_names")
def split_names(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return spans.split_names(spans.mock_entities(docs), docs)


@query("q44_without_overlaps")
def without_overlaps(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = spans.mock_entities(docs)
    more = spans.recovered(docs.select("file_id", F.col("text").alias("raw_text"), F.col("text").alias("clean_text")))
    return spans.without_overlaps(found.unionByName(more))


@query("q45_entities")
def entities(spark, sf_dir):
    return search.entities(spark, name_cases(spark, sf_dir).select(F.col("original_text").alias("name")).distinct())


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
