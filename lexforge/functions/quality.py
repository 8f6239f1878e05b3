"""Text-quality gate: signals of a text, and the ordered decision over them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.functions.vocab import COMMON_WORDS, WS

# Thresholds of the gate.
MIN_CHARS, WORDS_GOOD, WORDS_BAD, GRAY_ALPHA, MAX_WEIRD, MIN_MEDIAN, MAX_MEDIAN, MAX_DIGIT_MIX = 200, 0.55, 0.25, 0.50, 0.05, 2, 20, 0.40
#: Replacement character, control characters other than \t\n\r, box drawing, blocks, specials.
WEIRD = r"\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{2500}-\x{259F}\x{FFF0}-\x{FFFE}"
#: All of these and some more, in few ranges.
ROUGHLY_WEIRD = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F\x{2500}-\x{FFFE}]"


def ratio(part: Column, whole: Column) -> Column:
    return X.bind(whole, lambda n: F.when(n == 0, F.lit(0.0)).otherwise(part.cast("double") / n))


def word_ratio(text: Column, dictionary=tuple(COMMON_WORDS)) -> Column:
    """Share of ASCII words of three letters or more in the dictionary; 0 with fewer than five."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))
    return X.bind(words, lambda w: F.when(F.size(w) < 5, F.lit(0.0)).otherwise(F.size(F.filter(w, lambda x: x.isin(*dictionary))).cast("double") / F.size(w)))


def alpha_ratio(text: Column, tokens: Column | None = None) -> Column:
    """Letters among characters that aren't white space. tokens: the text's, if they are at hand."""
    solid = X.count_not(text, WS) if tokens is None else F.length(F.array_join(tokens, ""))
    return ratio(X.count_not(text, r"^\p{L}"), solid)


def weird_ratio(text: Column) -> Column:
    some = text.rlike(ROUGHLY_WEIRD)
    return ratio(F.when(some, X.count_of(text, WEIRD)).otherwise(F.when(text.isNotNull(), F.lit(0))), F.length(text))


def token_sanity(text: Column, tokens: Column | None = None) -> Column:
    """(median token length, share of tokens with both a letter and a digit). tokens: the text's, if they are at hand."""

    def of(t: Column) -> Column:
        lengths = F.sort_array(F.transform(t, lambda x: F.length(x)))
        n = F.size(t)
        mixed = F.when(text.rlike(r"\p{Nd}"), F.size(F.filter(t, lambda x: x.rlike(r"\p{Nd}") & x.rlike("[a-zA-Z]")))).otherwise(F.lit(0))
        middle = X.bind(lengths, lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / F.lit(2.0))
        return F.struct(F.coalesce(middle, F.lit(0.0)).alias("median_token_len"), ratio(mixed, n).alias("digit_mixed_ratio"))

    return X.bind(X.tokens(text), of) if tokens is None else of(tokens)


def percent(x: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(x * 100, 1))  # ties to even


def gate(text: Column, dictionary=tuple(COMMON_WORDS)) -> Column:
    """struct(good, reason, text_length, word_ratio, alpha_ratio, weird_ratio, median_token_len, digit_mixed_ratio).

    Null and blank texts are too short. A short text's other signals are 0.
    """

    def signals(s: Column) -> Column:
        long = F.length(s) >= MIN_CHARS
        none = F.array().cast("array<string>")
        return X.bind(F.when(long, X.tokens(s)).otherwise(none), lambda tokens: of(s, long, tokens))

    def of(s: Column, long: Column, tokens: Column) -> Column:
        sanity = token_sanity(s, tokens)
        value = lambda x: F.when(long, x).otherwise(F.lit(0.0))
        return F.struct(
            F.length(s).alias("n"), value(word_ratio(s, dictionary)).alias("w"), value(alpha_ratio(s, tokens)).alias("a"), value(weird_ratio(s)).alias("x"),
            F.when(long, sanity).otherwise(F.struct(F.lit(0.0).alias("median_token_len"), F.lit(0.0).alias("digit_mixed_ratio"))).alias("t"),
        )

    def decided(v: Column) -> Column:
        w, a, x, m, d = v["w"], v["a"], v["x"], v["t"]["median_token_len"], v["t"]["digit_mixed_ratio"]
        reason = (
            F.when(v["n"] < MIN_CHARS, F.format_string(f"too_short (%d < {MIN_CHARS})", v["n"]))
            .when(x > MAX_WEIRD, F.concat(F.lit("weird_chars ("), percent(x), F.lit(" > 5%)")))
            .when(m < MIN_MEDIAN, F.format_string(f"tiny_tokens (median %.1f < {MIN_MEDIAN})", m))
            .when(m > MAX_MEDIAN, F.format_string(f"giant_tokens (median %.1f > {MAX_MEDIAN})", m))
            .when(d > MAX_DIGIT_MIX, F.concat(F.lit("digit_mixed ("), percent(d), F.lit(" > 40%)")))
            .when(w >= WORDS_GOOD, F.lit("high_word_ratio"))
            .when(w <= WORDS_BAD, F.concat(F.lit("low_word_ratio ("), percent(w), F.lit(" <= 25%)")))
            .when(a < GRAY_ALPHA, F.concat(F.lit("gray_low_alpha (word="), percent(w), F.lit(", alpha="), percent(a), F.lit(")")))
            .otherwise(F.lit("gray_passed"))
        )
        return X.bind(reason, lambda r: F.struct(r.isin("high_word_ratio", "gray_passed").alias("good"), r.alias("reason"), v["n"].alias("text_length"), w.alias("word_ratio"), a.alias("alpha_ratio"), x.alias("weird_ratio"), m.alias("median_token_len"), d.alias("digit_mixed_ratio")))

    return X.bind(X.bind(X.strip(F.coalesce(text, F.lit(""))), signals), decided)
