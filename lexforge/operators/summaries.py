"""Summaries of documents: pages, prompts, chunks, map and reduce, occupations, cache."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions import replies
from lexforge.functions import text as X
from lexforge.sources.shared import written

# Limits of prompts and batches.
PAGE_CHARS, MIN_PAGE_CHARS, MIN_DOCUMENT_CHARS, CHUNK_COUNT, CHUNK_TOKENS, CONTEXT_TOKENS, OUTPUT_MARGIN, MOST_PAGES = 6000, 10, 20, 16, 96_000, 32_768, 1000, 5000
BLANK_PAGE = "Blank page."
#: Our own wording; the parts that vary are the page, the number of pages and the text.
PAGE_PROMPT = "Summarise page %d of %d in one or two factual sentences, and list professions that its text states, as JSON.\n\n%s"


def skippable(text: Column, source: Column) -> Column:
    """Blank, shorter than ten characters, or without extractable text."""
    return (F.length(X.strip(F.coalesce(text, F.lit("")))) < MIN_PAGE_CHARS) | F.coalesce(source == "none", F.lit(False))


def page_prompt(number: Column, pages: Column, text: Column) -> Column:
    """Null for a page too short."""
    s = X.strip(F.coalesce(text, F.lit("")))
    cut = F.when(F.length(s) > PAGE_CHARS, F.concat(F.substring(s, 1, PAGE_CHARS), F.lit("\n[... truncated ...]"))).otherwise(s)
    return F.when(F.length(s) >= MIN_PAGE_CHARS, F.format_string(PAGE_PROMPT, number, pages, cut))


def prompt_tokens(prompt: Column) -> Column:
    return F.floor(F.length(prompt) / 3).cast("int")


def chunked(prompts: DataFrame, count: int = CHUNK_COUNT, tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Adds chunk to (group, idx, tokens): the next one when the count is reached or the tokens would pass the limit.

    The state starts afresh at every chunk, so it is a fold over a group's rows in
    order; the fold keeps the place, the count and the sum, and one entry a chunk.
    """
    rows = F.array_sort(F.collect_list(F.struct("idx", "tokens")))
    kinds = "struct<n:int,sum:bigint,starts:array<int>>"

    def step(s: Column, x: Column) -> Column:
        new = (s["n"] == 0) | (s["n"] >= count) | (s["sum"] + x["tokens"] > tokens)
        return F.struct(F.when(new, 1).otherwise(s["n"] + 1).alias("n"), F.when(new, x["tokens"]).otherwise(s["sum"] + x["tokens"]).cast("bigint").alias("sum"), F.when(new, F.concat(s["starts"], F.array(x["idx"].cast("int")))).otherwise(s["starts"]).alias("starts")).cast(kinds)

    first = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<int>").alias("starts")).cast(kinds)
    starts = prompts.groupBy("group").agg(F.aggregate(rows, first, step, lambda s: s["starts"]).alias("starts"))
    chunks = starts.select("group", F.posexplode("starts").alias("chunk", "first")).withColumn("until", F.lead("first").over(Window.partitionBy("group").orderBy("chunk")))
    c = chunks.withColumnRenamed("group", "_g")
    return prompts.join(c, (F.col("group") == F.col("_g")) & (F.col("idx") >= F.col("first")) & (F.coalesce(F.col("idx") < F.col("until"), F.lit(True)))).drop("_g", "first", "until")


def mapped(pages: DataFrame, page_replies: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """file_id, page, summary, mentions of every page (file_id, page_number, text, text_source).

    page_replies: file_id, page_number, reply; skipped pages need none. allowed: file_id, names.
    """
    rows = pages.join(page_replies, ["file_id", "page_number"], "left")
    names = F.lit(None).cast("array<string>")
    if allowed is not None:
        rows, names = rows.join(allowed.select("file_id", F.col("names").alias("_allowed")), "file_id", "left"), F.col("_allowed")
    skip = skippable(F.col("text"), F.col("text_source"))
    reply = F.col("reply")
    return rows.select(
        "file_id",
        F.col("page_number").cast("string").alias("page"),
        "page_number",
        F.when(skip, F.lit(BLANK_PAGE)).otherwise(replies.summary(reply)["summary"]).alias("summary"),
        F.when(skip, F.array().cast(f"array<{replies.MENTION}>")).otherwise(replies.mentions(reply, F.col("text"), names)).alias("mentions"),
    )


def occupations(mapped_pages: DataFrame) -> DataFrame:
    """file_id, occupation, person_name, page_number, place of every mention."""
    rows = mapped_pages.select("file_id", "page_number", F.posexplode("mentions").alias("place", "m"))
    return rows.select("file_id", "page_number", "place", F.nullif("m.occupation", F.lit("")).alias("occupation"), F.nullif("m.person_name", F.lit("")).alias("person_name")).filter("occupation IS NOT NULL")


def occupation_summary(found: DataFrame) -> DataFrame:
    """file_id, by_person, by_occupation, unlinked of mentions (file_id, occupation, person_name, page_number, place).

    by_person: (person, sorted occupations), persons sorted; by_occupation: (occupation,
    count), most first, ties by first mention; unlinked: sorted.
    """
    people = found.filter("person_name IS NOT NULL").groupBy("file_id", "person_name").agg(F.array_sort(F.collect_set("occupation")).alias("occupations"))
    by_person = people.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(F.col("person_name").alias("person"), "occupations"))).alias("by_person"))
    kinds = found.groupBy("file_id", "occupation").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_number", "place")).alias("first"))
    ranked = kinds.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", "occupation", "n"))).alias("r"))
    by_occupation = ranked.select("file_id", F.transform("r", lambda x: F.struct(x["occupation"].alias("occupation"), x["n"].alias("n"))).alias("by_occupation"))
    unlinked = found.groupBy("file_id").agg(F.array_sort(F.collect_set(F.when(F.col("person_name").isNull(), F.col("occupation")))).alias("unlinked"))
    return by_occupation.join(by_person, "file_id", "left").join(unlinked, "file_id", "left")


def allowed_lines(names: DataFrame) -> DataFrame:
    """file_id, lines of names (file_id, names: array of (priority, name, role)); (none) for none."""
    line = F.array_join(F.transform("names", lambda n: F.concat(F.lit("- "), n["name"], F.lit(" — "), n["role"])), "\n")
    return names.select("file_id", F.coalesce(F.nullif(line, F.lit("")), F.lit("(none)")).alias("lines"))


def page_lines(mapped_pages: DataFrame) -> DataFrame:
    """file_id, lines: 'Page n: summary' by page."""
    rows = F.array_sort(F.collect_list(F.struct("page_number", F.concat(F.lit("Page "), F.col("page"), F.lit(": "), F.coalesce("summary", F.lit(""))).alias("line"))))
    return mapped_pages.groupBy("file_id").agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("lines"))


def document_header(**parts: Column) -> Column:
    """'Label: value' lines of the parts that aren't null or empty."""
    return F.concat_ws("\n", *(F.when(F.nullif(c.cast("string"), F.lit("")).isNotNull(), F.concat(F.lit(f"{k.replace('_', ' ').capitalize()}: "), c.cast("string"))) for k, c in parts.items()))


def group_size(prompt_tokens_total: Column, pages: Column, overhead: int, limit: int = CONTEXT_TOKENS - OUTPUT_MARGIN) -> Column:
    """Pages that go into one partial summary, two at least."""
    room = limit - overhead - OUTPUT_MARGIN if limit - overhead - OUTPUT_MARGIN > 0 else limit // 2
    each = F.greatest(F.floor(prompt_tokens_total / pages), F.lit(1))
    return F.greatest(F.floor(F.lit(room) / each), F.lit(2)).cast("int")


def grouped(mapped_pages: DataFrame, size: int) -> DataFrame:
    """One level of a hierarchical reduce: 'pp. a-b' groups of ``size`` pages with their lines, in order."""
    w = Window.partitionBy("file_id").orderBy("page_number")
    rows = mapped_pages.withColumn("_g", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    item = F.struct("page_number", "page", "summary")
    got = rows.groupBy("file_id", "_g").agg(F.array_sort(F.collect_list(item)).alias("x"))
    label = F.concat(F.lit("pp. "), F.get("x", F.lit(0))["page"], F.lit("-"), F.element_at("x", -1)["page"])
    text = F.array_join(F.transform("x", lambda r: F.concat(F.lit("Page "), r["page"], F.lit(": "), F.coalesce(r["summary"], F.lit("")))), "\n")
    return got.select("file_id", label.alias("page"), F.col("_g").alias("page_number"), text.alias("summary"))


def reduced(mapped_pages: DataFrame, summarise, limit: int = CONTEXT_TOKENS - OUTPUT_MARGIN, overhead: int = 700) -> DataFrame:
    """Pages of every file, in groups until they fit one prompt. summarise: Column of lines to a Column.

    Each level cuts the rows of a file by the group's size, and is written when this is
    called; a level at least halves a file's rows, so their number is the logarithm of
    the longest file's pages. A single row that doesn't fit stays as it is.
    """
    now = mapped_pages.select("file_id", "page", "page_number", "summary")
    while True:
        size = F.sum(F.length("summary") + 12).over(Window.partitionBy("file_id"))
        n = F.count(F.lit(1)).over(Window.partitionBy("file_id"))
        rows = now.withColumns({"_size": F.floor(size / 3), "_n": n})
        fits = rows.filter((F.col("_size") + overhead <= limit) | (F.col("_n") <= 1)).drop("_size", "_n")
        over = rows.filter((F.col("_size") + overhead > limit) & (F.col("_n") > 1))
        if not over.limit(1).count():
            return fits
        over = over.withColumn("_g", group_size(F.col("_size"), F.col("_n"), overhead, limit))
        w = Window.partitionBy("file_id").orderBy("page_number")
        over = over.withColumn("_g", F.floor((F.row_number().over(w) - 1) / F.col("_g")).cast("int"))
        got = over.groupBy("file_id", "_g").agg(F.array_sort(F.collect_list(F.struct("page_number", "page", "summary"))).alias("x"))
        label = F.concat(F.lit("pp. "), F.get("x", F.lit(0))["page"], F.lit("-"), F.element_at("x", -1)["page"])
        lines = F.array_join(F.transform("x", lambda r: F.concat(F.lit("Page "), r["page"], F.lit(": "), F.coalesce(r["summary"], F.lit("")))), "\n")
        now = written(fits.unionByName(got.select("file_id", label.alias("page"), F.col("_g").alias("page_number"), summarise(lines).alias("summary"))), "reduce")


SHORT_PROMPT = "Summarise this document in two sentences, by these notes of its pages.\n\n"
LONG_PROMPT = "Summarise this document at length, by these notes of its pages.\n\n"


def documents_summarised(pages: DataFrame, backend: str, model: str, prompt_version: str) -> DataFrame:
    """file_id, short_summary, long_summary, pages, text_hash, model_version, prompt_version of documents (file_id, page_number, text).

    Documents of less than MIN_DOCUMENT_CHARS are left out. Pages are summarised one by
    one; a document of one page goes by its text, others by their pages' notes, which
    are put together (and cut to the context) until they fit a prompt. The short and
    the long prompt of a document are asked in one batch. Replies are written when this is called.
    """
    whole = pages.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda p: F.coalesce(p["text"], F.lit(""))), "\n").alias("document"), F.count(F.lit(1)).alias("pages"))
    whole = whole.filter(F.length(X.strip(F.col("document"))) >= MIN_DOCUMENT_CHARS)
    rows = pages.withColumn("text_source", F.lit(None).cast("string")).join(whole.select("file_id", "pages"), "file_id")
    prompt = F.when(~skippable(F.col("text"), F.col("text_source")), page_prompt(F.col("page_number"), F.col("pages").cast("int"), F.col("text")))
    several = rows.filter("pages > 1")
    got = replied(several.select("file_id", "page_number", prompt.alias("prompt")).filter("prompt IS NOT NULL"), backend)
    notes = written(mapped(several.drop("pages"), got.select("file_id", "page_number", "reply")), "page-notes")
    most = (CONTEXT_TOKENS - OUTPUT_MARGIN) * 3
    reduced_notes = page_lines(reduced(notes, lambda lines: F.substring(lines, 1, PAGE_CHARS)))
    lines = reduced_notes.unionByName(whole.filter("pages <= 1").select("file_id", F.substring("document", 1, most).alias("lines")))
    kinds = F.explode(F.array(F.struct(F.lit("short").alias("kind"), F.lit(SHORT_PROMPT).alias("head")), F.struct(F.lit("long").alias("kind"), F.lit(LONG_PROMPT).alias("head"))))
    prompts = lines.select("file_id", "lines", kinds.alias("k")).select("file_id", "k.kind", F.concat("k.head", "lines").alias("prompt"))
    told = replied(prompts, backend).select("file_id", "kind", replies.summary(F.col("reply"))["summary"].alias("summary"))
    both = told.groupBy("file_id").agg(F.max(F.when(F.col("kind") == "short", F.col("summary"))).alias("short_summary"), F.max(F.when(F.col("kind") == "long", F.col("summary"))).alias("long_summary"))
    return whole.join(both, "file_id").select("file_id", "short_summary", "long_summary", "pages", text_hash(F.col("document")).alias("text_hash"), F.lit(model).alias("model_version"), F.lit(prompt_version).alias("prompt_version"))


def merged_direct(mentions: DataFrame) -> DataFrame:
    """Mentions of two replies (file_id, source, place, occupation, person_name, evidence_span), the first of equal ones."""
    w = Window.partitionBy("file_id", "occupation", "person_name", "evidence_span").orderBy("source", "place")
    return mentions.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def text_hash(text: Column) -> Column:
    return F.substring(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256), 1, 16)


def to_compute(docs: DataFrame, cache: DataFrame, model: str, prompt: str, text: str = "text") -> DataFrame:
    """Documents without a cached summary of the same text, model and prompts."""
    c = cache.select("file_id", "text_hash", "model_version", "prompt_version")
    now = docs.withColumn("text_hash", text_hash(F.col(text)))
    valid = c.filter((F.col("model_version") == model) & (F.col("prompt_version") == prompt))
    return now.join(valid.select("file_id", "text_hash"), ["file_id", "text_hash"], "left_anti")


def selected(docs: DataFrame, cache: DataFrame, model: str, prompt: str, *, wanted: DataFrame | None = None, resume_from: str | None = None, skip: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Listed files, from one on, without skipped ones, not cached, and of these the first ``limit``."""
    rows = docs
    if wanted is not None:
        rows = rows.join(wanted.select("file_id"), "file_id", "left_semi")
    if resume_from is not None and rows.filter(F.col("file_id") == resume_from).limit(1).count():
        rows = rows.filter(F.col("file_id") >= resume_from)
    if skip is not None:
        rows = rows.join(skip.select("file_id"), "file_id", "left_anti")
    rows = rows.filter(F.length(X.strip(F.coalesce("text", F.lit("")))) >= MIN_DOCUMENT_CHARS)
    rows = to_compute(rows, cache, model, prompt)
    return rows if limit is None else rows.orderBy("file_id").limit(limit)


#: Prompts whose texts and replies a worker holds at a time, rounded to whole batches.
REPLY_ROWS = 256


def replied(prompts: DataFrame, backend_name: str, tries: int = 2, most_chars: int = CONTEXT_TOKENS * 3, column: str = "prompt", batch: int = CHUNK_COUNT) -> DataFrame:
    """Adds reply, by a model backend a worker holds: batches first, then single prompts again; '' where none comes.

    A prompt goes as it is; only one that the model finds too long (TooLong) is cut to
    ``most_chars`` and asked once more. An error of a prompt doesn't touch the others.
    """
    from pyspark.sql import types as T

    schema = T.StructType([*prompts.schema.fields, T.StructField("reply", T.StringType())])
    rows = max(1, REPLY_ROWS // batch) * batch

    def run(frames):
        import pyarrow as pa

        from lexforge.sources.backends import TooLong, backend

        model = backend(backend_name)

        def answered(frame):
            asked = [p or "" for p in frame.column(column).to_pylist()]
            got: list[str | None] = []
            for i in range(0, len(asked), batch):
                part = asked[i : i + batch]
                try:
                    got += model.generate_batch(part)
                except Exception:  # a batch that fails is asked one by one below
                    got += [None] * len(part)
            for i, r in enumerate(got):
                for _ in range(tries if not r else 0):
                    try:
                        got[i] = model.generate(asked[i])
                    except TooLong:
                        asked[i], got[i] = asked[i][:most_chars], None
                    except Exception:
                        got[i] = None
                    if got[i]:
                        break
            return pa.RecordBatch.from_arrays([*frame.columns, pa.array([r or "" for r in got], told)], schema=frame.schema.append(pa.field("reply", told)))

        for whole in frames:
            kind = whole.schema.field(column).type
            told = kind if pa.types.is_string(kind) or pa.types.is_large_string(kind) else pa.string()
            # a worker holds the texts and replies of one slice, however many rows come at once
            for i in range(0, whole.num_rows, rows):
                yield answered(whole.slice(i, rows))

    return prompts.mapInArrow(run, schema)
