"""Offset-preserving cleaning: every code point gives one code point."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.functions.vocab import GARBAGE, clean_map, punct_class

#: Above this share of garbage a text is cleaned aggressively.
AGGRESSIVE_ABOVE = 0.05


def _mapped(raw: Column, use) -> Column:
    """use(text) of the raw text with OCR punctuation between its letters as spaces; that text itself where it is plain ASCII, which has no character that a map changes."""
    marks = punct_class()
    between = F.regexp_replace(raw, rf"[{marks}](?<=\p{{L}}[{marks}])(?=\p{{L}})", " ")
    return X.bind(between, lambda b: F.when(b.rlike(r"[^\x09\x0A\x0D\x20-\x7E]"), use(b)).otherwise(b))


def same_length(raw: Column, aggressive: bool = False) -> Column:
    """The raw text with junk as spaces, at its length. OCR punctuation goes between letters of the raw text only."""
    return _mapped(raw, lambda b: F.translate(b, *clean_map(aggressive)))


def garbage_ratio(raw: Column) -> Column:
    n = F.length(raw)
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0.0)).otherwise(X.count_among(raw, GARBAGE).cast("double") / n)


def cleaned(raw: Column) -> Column:
    """As ``same_length``, aggressive where garbage is over the threshold."""
    return _mapped(raw, lambda b: F.when(garbage_ratio(raw) > AGGRESSIVE_ABOVE, F.translate(b, *clean_map(True))).otherwise(F.translate(b, *clean_map(False))))


def assembled(full_text: Column, text: Column, pages: Column, paragraphs: Column) -> Column:
    """The text of a document: full_text, else text, else pages with their markers, else paragraphs; '' counts as missing."""
    marked = F.transform(F.filter(pages, lambda p: X.strip(F.coalesce(p["text"], F.lit(""))) != ""), lambda p: F.concat(F.lit("[Page "), p["page_number"].cast("string"), F.lit("]\n"), X.strip(p["text"])))
    blank = lambda x: F.nullif(x, F.lit(""))
    return F.coalesce(blank(full_text), blank(text), blank(F.array_join(marked, "\n\n")), F.array_join(paragraphs, "\n\n"), F.lit(""))


def page_boundaries(pages: Column) -> Column:
    """[0] and the running sum of marker, text and two newlines of every page, blank ones included."""
    size = lambda p: F.length(F.concat(F.lit("[Page "), p["page_number"].cast("string"), F.lit("]\n"))) + F.length(F.coalesce(p["text"], F.lit(""))) + 2
    return F.aggregate(pages, F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + size(p))))


def page_of(boundaries: Column, offset: Column) -> Column:
    """The page of an offset, by the last boundary that isn't after it."""
    return F.size(F.filter(boundaries, lambda b: b <= offset))


def verified(raw: Column, clean: Column, start: Column, end: Column, text: Column) -> Column:
    """Whether the slice of either text is ``text``."""
    cut = lambda t: F.substring(t, start + 1, end - start)
    return (cut(raw) == text) | (cut(clean) == text)
