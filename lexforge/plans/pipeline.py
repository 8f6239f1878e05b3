"""The document pipeline: tiers over DataFrames, from texts to clean names of documents.

Tier one cleans and finds spans; tier two recovers, classifies, validates against the
raw text, and repairs. Each returns plans; a run writes between tiers, so that the
second can be repeated without the first.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import cleaning, noise
from lexforge.functions import text as X
from lexforge.operators import classify, names, spans, work
from lexforge.sources.shared import written


@dataclass(frozen=True)
class Options:
    """least_confidence: of spans; recovery: whether noisy texts are searched again; least_noise: of its gate."""

    least_confidence: float = spans.MIN_CONFIDENCE
    recovery: bool = True
    least_noise: float = noise.GATE_NOISE


def prepared(docs: DataFrame) -> DataFrame:
    """file_id, raw_text, clean_text, noise_score of (file_id, text); files without text are left out."""
    rows = docs.filter(F.coalesce(F.col("text"), F.lit("")) != "")
    return X.once(rows.select("file_id", F.col("text").alias("raw_text")), clean_text=cleaning.cleaned(F.col("raw_text")), noise_score=noise.score(F.col("raw_text")))


def tier_one(docs: DataFrame, entities=spans.mock_entities, options: Options = Options(), ready: DataFrame | None = None) -> DataFrame:
    """Spans of the clean texts. entities: (DataFrame, text column) to spans; the mock stands for a model. ready: the prepared texts, if they are at hand."""
    ready = prepared(docs) if ready is None else ready
    found = entities(ready, "clean_text").filter(F.col("confidence") >= options.least_confidence)
    return found


def manifest(docs: DataFrame, found: DataFrame, seq: int | None = None) -> DataFrame:
    """The manifest's lines of a tier-one run; seq: its place among all runs."""
    ready = prepared(docs).select("file_id", F.length("clean_text").alias("clean_text_length"), "noise_score")
    n = found.groupBy("file_id").agg(F.count(F.lit(1)).alias("total_spans"), F.count_if(F.col("entity_type") == "PER").alias("person_spans"))
    return work.manifest_of(ready.join(n, "file_id", "left"), seq)


def tier_two(docs: DataFrame, found: DataFrame, classified=classify.mock_classified, options: Options = Options(), ready: DataFrame | None = None) -> DataFrame:
    """Names with offsets, all of them borne out by the raw text, and their normal forms."""
    ready = prepared(docs) if ready is None else ready
    if options.recovery:
        n = found.groupBy("file_id").agg(F.count(F.lit(1)).alias("_n"))
        noisy = ready.join(n, "file_id", "left").filter(noise.needs_recovery(F.length("clean_text"), F.coalesce("_n", F.lit(0)), F.col("noise_score"), options.least_noise))
        found = spans.merged(found, spans.recovered(noisy.select("file_id", "raw_text", "clean_text")))
    kept = classified(found).filter(F.col("is_person") & ~F.col("drop"))
    return spans.repaired(spans.validated(kept, ready))


def mentions(valid: DataFrame) -> DataFrame:
    """Tier two's names as rows of the names table."""
    return valid.select("file_id", F.xxhash64("file_id", "start", "end").alias("name_index"), "normalized_name", F.col("text").alias("original_text"), "start", "end", "role", "confidence")


def document_names(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """file_id, name_index (the place in the text), clean_name, role, confidence, of every document's names, one of each.

    Prepared texts, spans and valid names are written once, when this is called; what follows reads them.
    """
    ready = written(prepared(docs), "prepared")
    found = written(tier_one(docs, options=options, ready=ready), "spans")
    valid = tier_two(docs, found, options=options, ready=ready)
    rows = valid.select("file_id", F.col("start").alias("name_index"), "normalized_name", F.col("text").alias("original_text"), "start", "end", "role", "confidence")
    return names.clean_files(written(rows, "mentions"))
