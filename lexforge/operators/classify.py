"""Classification of spans: batches, prompts, replies, rules, defaults."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.replies import DEFAULT_CONFIDENCE, REPLY_CONFIDENCE, SAFE_ABOVE, verdicts

# Batches and budgets of the classifier, rules of the mock one.
BATCH, PER_SPAN, OVERHEAD, MOST_OUTPUT, MOST_INPUT, CONTEXT, DOCUMENT_CHARS = 50, 50, 100, 4096, 24_000, 150, 8000
ORGANISATIONS = ["inc", "corp", "llc", "ltd", "company"]
LOCATIONS = ["new york", "los angeles", "florida", "california"]


def contains_any(x: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | x.contains(p)
    return out


def mock_classified(spans: DataFrame) -> DataFrame:
    """Organisations and places by parts of words are dropped; all others are persons."""
    low = F.lower("text")
    org, place = contains_any(low, ORGANISATIONS), contains_any(low, LOCATIONS)
    return spans.withColumns(
        {
            "is_person": ~(org | place), "role": F.when(org | place, F.lit("")).otherwise(F.lit("mentioned")), "drop": org | place,
            "drop_reason": F.when(org, F.lit("organization")).when(place, F.lit("location")), "classification_confidence": F.when(org | place, F.lit(0.8)).otherwise(F.lit(0.7)),
        }
    )


def document_type(text: Column) -> Column:
    """By parts of the text; the first rule that holds."""
    t = F.lower(text)
    return (
        F.when(t.contains("from:") & t.contains("to:"), F.lit("email"))
        .when(t.contains("flight") & (t.contains("passenger") | t.contains("manifest")), F.lit("flight_log"))
        .when(t.contains("dear ") | t.contains("sincerely"), F.lit("letter"))
        .when(t.contains("plaintiff") | t.contains("defendant"), F.lit("legal"))
        .otherwise(F.lit("other"))
    )


def estimated_tokens(document: Column, span_chars: Column, system_chars: int = 1500) -> Column:
    """Without a tokenizer: six characters for four tokens, over the prompt's parts."""
    return ((F.least(F.length(document), F.lit(DOCUMENT_CHARS)) + span_chars + system_chars) / 4 * 1.5).cast("int")


def batched(spans: DataFrame, batch: int = BATCH) -> DataFrame:
    """Adds span_index (by start in the file), batch_id and the batch's output budget."""
    size = min(batch, (MOST_OUTPUT - OVERHEAD) // PER_SPAN)
    w = Window.partitionBy("file_id").orderBy("start", "end")
    rows = spans.withColumn("span_index", F.row_number().over(w) - 1).withColumn("batch_id", F.floor(F.col("span_index") / size).cast("int"))
    n = F.count(F.lit(1)).over(Window.partitionBy("file_id", "batch_id"))
    return rows.withColumn("output_budget", F.least(F.lit(MOST_OUTPUT), n * PER_SPAN + OVERHEAD))


def halved(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Batches whose prompt is estimated over MOST_INPUT tokens as two, the first of the larger half."""
    batch = Window.partitionBy("file_id", "batch_id")
    head = docs.select(F.col("file_id").alias("_of"), F.substring(text, 1, DOCUMENT_CHARS).alias("_head"))
    rows = rows.join(head, F.col("file_id") == F.col("_of"), "left")
    chars = F.sum(F.length("text") + 2 * CONTEXT).over(batch)
    n, place = F.count(F.lit(1)).over(batch), F.col("span_index") - F.min("span_index").over(batch)
    second = (estimated_tokens(F.coalesce("_head", F.lit("")), chars) > MOST_INPUT) & (place >= F.ceil(n / 2))
    rows = rows.withColumn("_second", second.cast("int")).withColumn("batch_id", (2 * F.col("batch_id") + F.col("_second")).cast("int")).drop("_of", "_head", "_second")
    return rows.withColumn("output_budget", F.least(F.lit(MOST_OUTPUT), F.count(F.lit(1)).over(batch) * PER_SPAN + OVERHEAD))


def prompts(spans: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """file_id, batch_id, output_budget, payload: each batch's spans with their surroundings as JSON, and the document's head.

    Spans that have a batch_id keep it.
    """
    rows = (spans if "batch_id" in spans.columns else batched(spans)).join(docs.select("file_id", F.col(text).alias("_t")), "file_id")
    around = F.substring(F.col("_t"), F.greatest(F.col("start") - CONTEXT, F.lit(0)) + 1, F.col("end") - F.greatest(F.col("start") - CONTEXT, F.lit(0)) + CONTEXT)
    item = F.struct((F.col("span_index") - F.min("span_index").over(Window.partitionBy("file_id", "batch_id"))).alias("span_index"), F.col("text"), F.col("start"), F.col("end"), around.alias("context"))
    rows = rows.withColumn("_item", item)
    return rows.groupBy("file_id", "batch_id").agg(F.max("output_budget").alias("output_budget"), F.to_json(F.array_sort(F.collect_list("_item"))).alias("spans"), F.first(F.substring("_t", 1, DOCUMENT_CHARS)).alias("document"))


def decided(spans: DataFrame, replies: DataFrame) -> DataFrame:
    """Spans with their batch's verdicts. replies: file_id, batch_id, reply.

    A verdict belongs to the span of its index, or of its place where it has none; the
    later of two counts. Spans without one are persons at the default confidence. A
    drop of a sure span doesn't hold, unless the reply had to be mended.
    """
    rows = spans if "batch_id" in spans.columns else batched(spans)
    within = (F.col("span_index") - F.min("span_index").over(Window.partitionBy("file_id", "batch_id"))).cast("int")
    got = replies.select("file_id", "batch_id", verdicts(F.col("reply")).alias("v")).select("file_id", "batch_id", "v.repaired", F.posexplode("v.items").alias("place", "item"))
    last = F.row_number().over(Window.partitionBy("file_id", "batch_id", "within").orderBy(F.desc("place")))
    got = got.withColumn("within", F.coalesce("item.span_index", "place")).withColumn("_n", last).filter("_n = 1").drop("_n")
    joined = rows.withColumn("within", within).join(got, ["file_id", "batch_id", "within"], "left")
    some = F.col("item").isNotNull()
    safe = (F.col("confidence") > SAFE_ABOVE) & ~F.coalesce("repaired", F.lit(False))
    drop = F.coalesce("item.drop", F.lit(False)) & ~safe
    role = F.coalesce(F.nullif(F.col("item.role"), F.lit("")), F.lit("mentioned"))
    return joined.withColumns(
        {
            "is_person": F.coalesce("item.is_person", F.lit(True)), "role": role, "all_roles": F.coalesce("item.all_roles", F.array(F.lit("mentioned"))), "drop": drop,
            "drop_reason": F.when(drop | ~(F.coalesce("item.drop", F.lit(False))), F.col("item.reason")),
            "classification_confidence": F.when(some, F.lit(REPLY_CONFIDENCE)).otherwise(F.lit(DEFAULT_CONFIDENCE)),
        }
    ).drop("item", "place", "within", "repaired")


def counts(classified: DataFrame) -> DataFrame:
    """file_id, total_spans, person_spans, dropped_spans, defaulted_spans."""
    return classified.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("total_spans"), F.count_if(F.col("is_person") & ~F.col("drop")).alias("person_spans"), F.count_if("drop").alias("dropped_spans"),
        F.count_if(F.col("classification_confidence") == DEFAULT_CONFIDENCE).alias("defaulted_spans"),
    )


def to_retry(classified: DataFrame) -> DataFrame:
    """Files of several spans, over half of which took the default."""
    return counts(classified).filter("defaulted_spans > 0.5 * total_spans AND total_spans > 1").select("file_id")
