"""Replies of language models: structured parts, with defined results for broken ones."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.functions.vocab import OCCUPATION_SYNONYMS

MENTION = "struct<occupation:string,surface_form:string,person_name:string,confidence:double,evidence_span:string>"
SUMMARY = "struct<summary:string,document_type:string,date:string,occupation_mentions:array<" + MENTION + ">>"
VERDICT = "struct<span_index:int,is_person:boolean,role:string,all_roles:array<string>,drop:boolean,reason:string>"
#: Confidence of a span that no reply speaks of, and of one that a reply decides.
DEFAULT_CONFIDENCE, REPLY_CONFIDENCE, SAFE_ABOVE = 0.5, 0.8, 0.85


def parsed(reply: Column, schema: str) -> Column:
    """The reply as JSON, else its part from the first to the last brace; null if neither is an object."""
    s = X.strip(F.coalesce(reply, F.lit("")))
    whole = F.when(s.startswith("{") & F.try_parse_json(s).isNotNull(), s)
    inner = F.regexp_extract(s, r"(\{[\s\S]*\})", 1)
    return F.from_json(F.coalesce(whole, F.when(F.try_parse_json(inner).isNotNull(), inner)), schema)


def occupation(x: Column) -> Column:
    """The canonical occupation, or the trimmed lower-case form itself."""
    key = F.lower(X.strip(x))
    table = F.create_map(*(F.lit(v) for pair in OCCUPATION_SYNONYMS.items() for v in pair))
    return F.coalesce(F.try_element_at(table, key), key)


def possessive(person: Column, evidence: Column) -> Column:
    """Whether the evidence has the person's name as a whole word with 's and white space after it."""
    e, p = F.lower(evidence), F.concat(F.lower(person), F.lit("'s"))
    pieces = F.split(F.concat(F.lit(" "), e, F.lit("")), F.concat(F.lit(r"\Q"), p, F.lit(r"\E")), -1)
    met = F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x, i: ~x.rlike(r"[\p{L}\p{N}_]$") & F.get(pieces, i + 1).rlike(r"^[\s\x{A0}]"))
    return F.exists(met, lambda x: x)


def mentions(reply: Column, page: Column, allowed: Column | None = None) -> Column:
    """The reply's occupation mentions that hold: occupation and form given, evidence in the page's text.

    Occupations are canonical. A person goes where the evidence has them as the owner
    of the professional, or, where ``allowed`` names are given, where none is theirs;
    the allowed name's spelling stands.
    """

    def one(m: Column) -> Column:
        evidence = F.coalesce(m["evidence_span"], F.lit(""))
        person = F.when((F.coalesce(m["person_name"], F.lit("")) != "") & ~((evidence != "") & possessive(m["person_name"], evidence)), m["person_name"])
        if allowed is not None:
            person = F.when(person.isNotNull() & allowed.isNotNull(), F.get(F.filter(allowed, lambda a: F.lower(a) == F.lower(person)), 0)).otherwise(F.when(allowed.isNull(), person))
        return F.struct(occupation(m["occupation"]).alias("occupation"), m["surface_form"].alias("surface_form"), person.alias("person_name"), F.coalesce(m["confidence"], F.lit(0.0)).alias("confidence"), evidence.alias("evidence_span"))

    def holds(m: Column) -> Column:
        evidence = F.coalesce(m["evidence_span"], F.lit(""))
        given = (F.coalesce(m["occupation"], F.lit("")) != "") & (F.coalesce(m["surface_form"], F.lit("")) != "")
        return given & ((F.coalesce(page, F.lit("")) == "") | (evidence == "") | page.contains(evidence))

    found = F.coalesce(parsed(reply, SUMMARY)["occupation_mentions"], F.array().cast(f"array<{MENTION}>"))
    return F.transform(F.filter(found, holds), one)


def summary(reply: Column) -> Column:
    """struct(summary, document_type, document_date); the whole text where no object is in it, '' as null."""
    blank = lambda x: F.nullif(X.strip(x), F.lit(""))
    return X.bind(
        parsed(reply, SUMMARY),
        lambda p: F.struct(
            F.when(p.isNotNull(), X.strip(F.coalesce(p["summary"], F.lit("")))).otherwise(X.strip(F.coalesce(reply, F.lit("")))).alias("summary"),
            blank(p["document_type"]).alias("document_type"),
            blank(p["date"]).alias("document_date"),
        ),
    )


def short_summary(reply: Column) -> Column:
    """The summary of an object that has one, else the text."""
    return X.bind(parsed(reply, SUMMARY), lambda p: F.coalesce(X.strip(p["summary"]), X.strip(F.coalesce(reply, F.lit("")))))


def without_reasoning(reply: Column, least: int = 50) -> Column:
    """Without reasoning blocks, and with only the first of a JSON block that is repeated."""
    s = X.strip(F.regexp_replace(reply, r"<think>[\s\S]*?</think>\s*", ""))
    close = F.instr(s, "}")
    block = X.strip(F.substring(s, F.lit(1), close))
    rest = X.strip(F.substring(s, close + 1, F.length(s)))
    repeated = (F.length(s) >= 2 * least) & (close > 1) & (close - 1 < F.length(s) - 10) & block.startswith("{") & rest.startswith(F.substring(block, 1, 20))
    return F.when(repeated, block).otherwise(s)


def verdicts(reply: Column) -> Column:
    """struct(items, repaired): the array of verdicts of a reply, or null items if it has none.

    The array runs from the first to the last bracket. One that is cut off, but holds
    a closing bracket somewhere, is closed after its last whole object.
    """
    whole = F.regexp_extract(reply, r"(\[[\s\S]*\])", 1)
    cut = F.concat(F.regexp_extract(reply, r"(\[[\s\S]*\})", 1), F.lit("]"))
    good = F.try_parse_json(whole).isNotNull() & (whole != "")
    mended = ~good & (whole != "") & F.try_parse_json(cut).isNotNull()
    text = F.when(good, whole).when(mended, cut)
    return F.struct(F.from_json(text, f"array<{VERDICT}>").alias("items"), mended.alias("repaired"))


SOURCE_NOTE = (
    r"(?im)(?:^|\n)[ \t]*(?:-[ \t]*)?(?:\*\*)?Quelle(?:\*\*)?:(?:\*\*)?[ \t]*Originaldokument[ \t]+(?:pruefen|prüfen)[ \t]*\(KI[- ]Zusammenfassung"
    r"[^\n]*\s*$"
)


def sanitized(text: Column) -> Column:
    """Without source-note lines; null stays null, other text stays as it is."""
    return F.when(text.rlike(SOURCE_NOTE), F.rtrim(F.regexp_replace(text, SOURCE_NOTE, ""), F.lit(" \t\n\r"))).otherwise(text)
