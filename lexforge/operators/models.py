"""The model tier: prompts through a backend that every worker makes once, and what their replies decide.

Prompts are rows. They are dealt by their output budget, so that a batch holds prompts
of like budgets, and a batch that fails is asked one by one; nothing of it comes to the
driver. Replies are read by column expressions.
"""

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions import names, noise
from lexforge.functions import text as X
from lexforge.functions.vocab import ROLE_PRIORITY
from lexforge.operators import classify, repair, spans
from lexforge.operators.summaries import replied
from lexforge.sources.shared import written

#: Our own wording; the JSON of the batch follows.
CLASSIFY_PROMPT = "For each span tell as JSON whether it names a person (span_index, is_person, role, drop, reason).\n"
REPAIR_PROMPT = "Correct the spelling of each name; answer as a JSON array of index and name.\n"
YES_NO_PROMPT = "Is this the name of a person? Answer YES or NO.\n"
RECOVER_PROMPT = "List the names of persons in this text, which starts at offset %d, as a JSON array of evidence_text, start, end, role.\n"
# Characters of a recovery prompt, confidences of recovered and of validated names.
RECOVERY_CHARS, RECOVERED_CONFIDENCE, YES_NO_CONFIDENCE = 4000, 0.7, 0.75
RECOVERED = "array<struct<evidence_text:string,start:int,end:int,role:string>>"


def asked(prompts: DataFrame, backend: str, budget: str = "output_budget", batch: int = 16, partitions: int | None = None) -> DataFrame:
    """Adds reply to prompts, batches of like budgets together."""
    ranged = prompts.repartitionByRange(*([partitions] if partitions else []), F.col(budget)).sortWithinPartitions(budget)
    return replied(ranged, backend, batch=batch)


def classified(found: DataFrame, docs: DataFrame, backend: str, text: str = "text") -> DataFrame:
    """Spans (file_id, start, end, text, confidence, ...) with the model's verdicts.

    Batches whose prompt is estimated over the input limit are halved once. Files over
    half of whose spans took the default are asked once more, and what they get then counts.
    The prompts are answered when this is called.
    """
    batches = classify.halved(classify.batched(found), docs, text)

    def round_(rows: DataFrame, name: str) -> DataFrame:
        prompts = classify.prompts(rows, docs, text).withColumn("prompt", F.concat(F.lit(CLASSIFY_PROMPT), F.col("spans"), F.lit("\n"), F.col("document")))
        replies = asked(prompts.select("file_id", "batch_id", "output_budget", "prompt"), backend).select("file_id", "batch_id", "reply")
        return written(classify.decided(rows, replies), name)

    first = round_(batches, "classified")
    again = classify.to_retry(first)
    second = round_(batches.join(again, "file_id", "left_semi"), "classified-again")
    return first.join(again, "file_id", "left_anti").unionByName(second.select(*first.columns))


def diagnostics(decided: DataFrame) -> DataFrame:
    """One row: spans, those with a verdict, those that took the default, batches, and batches without any verdict."""
    default = F.col("classification_confidence") == classify.DEFAULT_CONFIDENCE
    per = decided.groupBy("file_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(default).alias("d"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("spans"), F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).alias("parsed"), F.coalesce(F.sum("d"), F.lit(0)).alias("defaults"),
        F.count(F.lit(1)).alias("batches"), F.count_if(F.col("n") == F.col("d")).alias("failed_batches"),
    )


def repaired(valid: DataFrame, backend: str) -> DataFrame:
    """Valid names with normalized_name and was_repaired, by the model where they need repair. Prompts are answered when this is called."""
    prompts = repair.prompts(valid).withColumn("prompt", F.concat(F.lit(REPAIR_PROMPT), F.col("names")))
    replies = written(asked(prompts.select("file_id", "batch_id", "output_budget", "prompt"), backend).select("file_id", "batch_id", "reply"), "repairs")
    return repair.decided(valid, replies)


def validated_names(rows: DataFrame, backend: str, name: str = "name", heuristics: bool = True) -> DataFrame:
    """Adds is_valid, confidence, reason. With heuristics, what they find to be garbage isn't asked."""
    judged = rows.withColumn("_h", names.heuristic(F.col(name)))
    ask = F.lit(True) if not heuristics else F.col("_h.is_valid")
    sure = judged.filter(~ask).select(*rows.columns, F.lit(False).alias("is_valid"), F.col("_h.confidence").alias("confidence"), F.col("_h.reason").alias("reason"))
    prompts = judged.filter(ask).drop("_h").withColumn("prompt", F.concat(F.lit(YES_NO_PROMPT), F.coalesce(F.col(name), F.lit(""))))
    answer = F.upper(X.strip(F.col("reply")))
    told = replied(prompts, backend).select(*rows.columns, answer.startswith("YES").alias("is_valid"), F.lit(YES_NO_CONFIDENCE).alias("confidence"), F.when(answer.startswith("YES"), F.lit("model_yes")).otherwise(F.lit("model_no")).alias("reason"))
    return told.unionByName(sure)


def recovered(docs: DataFrame, backend: str) -> DataFrame:
    """Spans that a model names in the texts (file_id, raw_text, clean_text), each borne out by the raw text.

    A place must hold the evidence, but for case; then the text there counts. Of equal
    places the first stays. Unknown roles become mentioned.
    """
    parts = spans.chunks(docs.select("file_id", "clean_text"), "clean_text", size=RECOVERY_CHARS, overlap=0)
    prompts = parts.select("file_id", "chunk_start", F.concat(F.format_string(RECOVER_PROMPT, F.col("chunk_start")), F.col("chunk")).alias("prompt"))
    items = F.from_json(F.regexp_extract("reply", r"(\[[\s\S]*\])", 1), RECOVERED)
    said = replied(prompts, backend).select("file_id", "chunk_start", F.posexplode(items).alias("place", "x")).select("file_id", "chunk_start", "place", "x.*")
    said = said.filter((F.coalesce("evidence_text", F.lit("")) != "") & (F.col("start") >= 0) & (F.col("start") < F.col("end")))
    joined = said.join(docs.select("file_id", F.col("raw_text").alias("_raw")), "file_id").filter(F.col("end") <= F.length("_raw"))
    joined = joined.withColumn("text", F.substring(F.col("_raw"), F.col("start") + 1, F.col("end") - F.col("start"))).drop("_raw")
    joined = joined.filter((F.lower("text") == F.lower("evidence_text")) & noise.name_like(F.col("text")))
    first = Window.partitionBy("file_id", "start", "end").orderBy("chunk_start", "place")
    role = F.when(F.col("role").isin(*ROLE_PRIORITY), F.col("role")).otherwise(F.lit("mentioned"))
    return joined.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(
        "file_id", "start", "end", "text", F.lit("PER").alias("entity_type"), F.lit(RECOVERED_CONFIDENCE).alias("confidence"), F.lit(None).cast("int").alias("page_number"), role.alias("role"), noise.fixed(F.col("text")).alias("normalized_name")
    )


ENTITIES = "file_id {key}, chunk_start int, start int, end int, word string, entity_type string, confidence double"


def entities(docs: DataFrame, tagger: str, text: str = "text", least: float = spans.MIN_CONFIDENCE) -> DataFrame:
    """Spans by a token-classification model over overlapping windows, without overlaps. tagger: a registered name.

    A window that doesn't fit memory is tagged in halves of its batch, down to single
    windows, which then have no entity.
    """
    windows = spans.chunks(docs.select("file_id", text), text)
    key = dict(windows.dtypes)["file_id"]

    def run(frames):
        from lexforge.sources.backends import halving, tagger as made

        model = made(tagger)
        for frame in frames:
            found = halving(model.tag, list(frame["chunk"]), [])
            rows = [(f, c, e["start"], e["end"], e["word"], e["entity_type"], e["confidence"]) for f, c, es in zip(frame["file_id"], frame["chunk_start"], found, strict=True) for e in es]
            yield pd.DataFrame(rows, columns=["file_id", "chunk_start", "start", "end", "word", "entity_type", "confidence"])

    found = spans.materialised(windows.mapInPandas(run, ENTITIES.format(key=key)), least=least)
    return spans.without_overlaps(found.withColumn("page_number", F.lit(None).cast("int")))

