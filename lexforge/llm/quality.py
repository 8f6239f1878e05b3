"""Quality rules: base counts of every text, and cross-document line frequency.

Lines are normalised (lower case, digits as 0, white space collapsed) and hashed. For
every host the distinct documents with a line are counted. Lines in more than
``most_docs`` documents of a host are removed, however large the host is, and a
document that loses more than ``most_lost`` of its words is rejected.

Copies and near copies of a text count as one document, or a group of them would take
each other's lines away. A document is known by six values: least and greatest
hashes of its runs of five words (those that start at a long word, if there are enough
of them), by several parts of the hash, each of which two texts share with a chance of
their similarity. Its family is the value that most
documents of the host have; a document that shares none is its own.

One pass over the texts gives a narrow row a document (counts, line hashes, values),
which is written; all that follows shuffles such rows only. Counts are summed before
the shuffle, and the lines above the limit, like the values of large families, are
copied ``SALTS`` times, so that rows of one very common key are dealt over as many
tasks. DataFrame functions only.

Defined cases: a null or empty text has no words and fails the base rules; a null
source is a host of its own; repeated rows are judged one by one; among values that
equally many documents have, the one of the last part decides; texts of any length
are read whole; an empty table gives no row; other columns, of any name, are ignored.
Functions that write their narrow rows run that job when they are called.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import bounded_broadcast, fresh, table, written

#: What separates words, as a regular expression's class and as characters.
SPACE = " \\x09-\\x0D"
SPACE_CHARS = " \t\n\u000b\f\r"
WINDOW = 8
SALTS = 16
#: Words of a run, and where in its hash (of 32 hexadecimal digits) a part begins; least and greatest of each are kept.
RUN, PARTS, CHUNK = 5, (1, 9, 17), 4096
#: Runs start at words of this length, where a text has as many of them; else at every word.
LONG, LEAST_RUNS = 9, 16
#: Rows and line hashes that a broadcast of verdicts may have.
MOST_BROADCAST = 1 << 20


def bind(value: Column, use) -> Column:
    """use(value), with ``value`` evaluated once a row."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{SPACE}]+"))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words within a window of ``width`` words that is found twice or more."""

    def covered(s: Column) -> Column:
        # s: (hash, place) in order; a window repeats if a neighbour has its hash
        twice = F.transform(s, lambda x, k: F.when(F.coalesce((k > 0) & (F.get(s, k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)), x["i"]))
        places = F.sort_array(F.filter(twice, lambda x: x.isNotNull()))
        return bind(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))), F.lit(0), lambda a, x: a + x))

    def of_windows(w: Column) -> Column:
        pairs = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(bind(F.sort_array(pairs), covered))

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.slice(h, F.lit(1), F.size(h) - (width - 1)), lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, width))))
        return bind(windows, of_windows)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(bind(hashed, of_hashes)).cast("long")


def sketches(words: Column) -> Column:
    """Hashes of the least and the greatest run by every part of its hash; none without words.

    Runs are hashed CHUNK at a time, so a long text holds no array of all its hashes.
    """

    def part(m: Column, at: int) -> Column:
        return F.transform(m, lambda x: F.substring(x, at, 33 - at))

    def ends(m: Column) -> Column:
        parts = [part(m, at) if at > 1 else m for at in PARTS]
        return F.array(*(end for part in parts for end in (F.array_min(part), F.array_max(part))))

    def run(i: Column) -> Column:
        return F.md5(F.concat_ws(" ", *(F.get(words, i + k) for k in range(RUN))).cast("binary"))

    def chunked(starts: Column) -> Column:
        pieces = F.sequence(F.lit(1), F.size(starts), F.lit(CHUNK))
        return bind(F.transform(pieces, lambda c: bind(F.transform(F.slice(starts, c, F.lit(CHUNK)), run), ends)), best)

    def best(x: Column) -> Column:
        at = lambda k: F.transform(x, lambda y: F.get(y, F.lit(k)))
        return F.array(*(F.xxhash64((F.array_max if k % 2 else F.array_min)(at(k))) for k in range(2 * len(PARTS))))

    every = F.sequence(F.lit(0), F.greatest(F.size(words) - RUN, F.lit(0)))
    long = F.filter(every, lambda i: F.length(F.get(words, i)) >= LONG)
    chosen = bind(long, lambda x: F.when(F.size(x) >= LEAST_RUNS, x).otherwise(every))
    return F.when(F.size(words) > 0, bind(chosen, chunked)).otherwise(F.array().cast("array<long>"))


def with_words(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))


def normalised(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), f"[{SPACE}]+", " "))


def base_counts(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, the counts over whole texts, base_failed, content (a hash of the text), host, lines, and ``more``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("source").cast("string").alias("host"), *more)
    names = [c for c in rows.columns if c not in ("doc_id", "text", "host")]
    rows = rows.select("*", words_of(F.col("text")).alias("words"), with_words(F.col("text")).alias("with_words"))
    n_words = F.size("words").cast("long")
    rows = rows.select(
        "doc_id",
        "host",
        *names,
        F.xxhash64("text").alias("content"),
        n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("with_words") - F.size(F.array_distinct("with_words"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        sketches(F.col("words")).alias("sketches"),
        F.transform("with_words", lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.size(words_of(x)).alias("words"))).alias("lines"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def salted(keys: DataFrame) -> DataFrame:
    """Every row SALTS times, with its ``salt``."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def families(rows: DataFrame) -> DataFrame:
    """row, shared (the family's value) of the documents whose host has another with a value of theirs."""
    values = rows.select("row", "host", F.posexplode("sketches").alias("place", "value"))
    common = values.groupBy("host", "place", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    common = salted(common.select(F.col("host").alias("of"), F.col("place").alias("p"), F.col("value").alias("v"), "n"))
    found = values.join(common, F.col("host").eqNullSafe(F.col("of")) & (F.col("place") == F.col("p")) & (F.col("value") == F.col("v")) & (F.pmod("row", F.lit(SALTS)) == F.col("salt")))
    return found.groupBy("row").agg(F.max(F.struct("n", "place", "value")).alias("best")).select("row", F.xxhash64("best.place", "best.value").alias("shared"))


def rules(docs: DataFrame, most_docs: int = 10, most_lost: float = 0.7, *more: Column) -> DataFrame:
    """A row a document: its counts, base_failed, lost_words, removed (hashes of its removed lines), content, kept."""
    rows = written(base_counts(docs, *more).withColumn("row", F.monotonically_increasing_id()), "quality")
    known = rows.select("row", "host", "lines").join(families(rows), "row", "left")
    lines = known.select("row", "host", F.coalesce("shared", "row").alias("family"), F.explode("lines").alias("x")).select("row", "host", "family", "x.line", "x.words")
    # partial sums leave one row a task for each line and family, so a common line makes no large group
    above = lines.groupBy("host", "line").agg(F.count_distinct("family").alias("n")).filter(F.col("n") > most_docs)
    above = salted(above.select(F.col("host").alias("of"), F.col("line").alias("frequent")))
    lines = rows.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    lost = (
        lines.join(above, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("frequent")) & (F.pmod("row", F.lit(SALTS)) == F.col("salt")))
        .groupBy("row")
        .agg(F.sum("words").alias("lost_words"), F.collect_set("line").alias("removed"))
    )
    lost_words = F.coalesce(F.col("lost_words"), F.lit(0))
    return (
        rows.drop("lines", "sketches")
        .join(lost, "row", "left")
        .withColumn("lost_words", lost_words)
        .withColumn("removed", F.coalesce(F.col("removed"), F.array().cast("array<long>")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= most_lost * F.col("n_words")))
        .drop("row")
    )


def filtered(docs: DataFrame, **limits) -> DataFrame:
    """The documents that the rules keep, without their removed lines, with the columns of ``docs``.

    Verdicts of documents that go or lose lines are sent to the texts while they are
    few (MOST_BROADCAST); beyond that both sides are shuffled.
    """
    of, content, host, kept, removed, mine = (fresh(docs, c) for c in ("verdict_of", "verdict_content", "verdict_host", "verdict_kept", "verdict_removed", "verdict_mine"))
    verdicts = rules(docs, **limits).filter(~F.col("kept") | (F.size("removed") > 0))
    drop = verdicts.groupBy(F.col("doc_id").alias(of), F.col("content").alias(content), F.col("host").alias(host)).agg(F.min("kept").alias(kept), F.first("removed").alias(removed))
    drop = written(drop, "verdicts")
    size = drop.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size(removed)), F.lit(0))).first()[0]
    drop = bounded_broadcast(drop, MOST_BROADCAST) if size <= MOST_BROADCAST else drop
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.withColumn(mine, F.xxhash64(text)).join(
        drop, F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.col(mine) == F.col(content)) & F.col("source").cast("string").eqNullSafe(F.col(host)), "left"
    )
    shorter = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col(removed), F.xxhash64(normalised(x)))), "\n")
    cut = F.size(removed) > 0
    out = joined.filter(F.coalesce(F.col(kept), F.lit(True))).withColumn("text", F.when(cut, shorter).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_query(spark, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words")


OP3_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 7)) AS i FROM d WHERE len(words) >= 8)
), rep AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt
  FROM (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY r, win) > 1)
), reps AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM rep GROUP BY r),
i AS (
  SELECT r, source, words, generate_series(1, greatest(len(words) - 4, 1)) AS every, list_filter(every, lambda i: length(words[i]) >= 9) AS long
  FROM d WHERE len(words) > 0
), g AS (
  SELECT r, source, md5(array_to_string(words[i:i + 4], ' ')) AS m
  FROM (SELECT r, source, words, unnest(CASE WHEN len(long) >= 16 THEN long ELSE every END) AS i FROM i)
), s AS (
  SELECT r, source, unnest([{'p': 0, 'v': min(m)}, {'p': 1, 'v': max(m)}, {'p': 2, 'v': min(m[9:])}, {'p': 3, 'v': max(m[9:])}, {'p': 4, 'v': min(m[17:])}, {'p': 5, 'v': max(m[17:])}]) AS x
  FROM g GROUP BY r, source
), f AS (
  SELECT r, max({'n': n, 'x': x}).x AS x FROM (SELECT r, x, count(*) OVER (PARTITION BY source, x) AS n FROM s) WHERE n > 1 GROUP BY r
), l AS (
  SELECT d.r, source, coalesce(f.x.p || ' ' || f.x.v, 'r' || d.r) AS family,
         trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ \\x09-\\x0D]+', ' ', 'g')) AS line,
         len(list_filter(regexp_split_to_array(line, '[ \\x09-\\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT r, source, unnest(lines) AS line FROM d) d LEFT JOIN f ON d.r = f.r
), above AS (
  SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT family) > 10
), lost AS (
  SELECT r, sum(n) AS n FROM l JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.line = a.line GROUP BY r
), c AS (
  SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(reps.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_words
  FROM d LEFT JOIN reps ON d.r = reps.r LEFT JOIN lost ON d.r = lost.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_words <= 0.7 * n_words AS kept, lost_words
FROM c
"""
