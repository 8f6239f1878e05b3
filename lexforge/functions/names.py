"""Names: cleaning, repeated spans, garbage rules, normal forms, repair, heuristics."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.functions.vocab import EMAIL_TOKENS, GUARDED_TOKENS, HONORIFICS, NOT_NAMES, ROLE_PRIORITY, STOPWORDS, SUFFIX_TOKENS, WS

# Marks at the ends of names.
LEADING = "'. ,-;:!?°•\"_►▶◀▷◁▸◂▹◃·‣◦◉▣◆◇▰▱→⇒—–»›#…()[]{}=`~|/\\@^+<>‘’“”„‹"
TRAILING = ",;:!?°•\"'►▶◀▷◁▸◂▹◃·‣◦◉▣◆◇▰▱→⇒—–»›‹#…()[]{}=`~|/\\@^+<>‘’“”„"
SYMBOLS = "°•►▶◀▷◁▸◂▹◃·‣◦◉▣◆◇▰▱→⇒"
REPAIRS = {"0": "O", "1": "I", "5": "S", "|": "l", "/": "", "\\": "", "~": ""}


def lowered(token: Column) -> Column:
    return F.rtrim(F.lower(token), F.lit("."))


def last(t: Column, back: int = 0) -> Column:
    return F.get(t, F.size(t) - 1 - back)


def unrepeated(name: Column) -> Column:
    """A name whose tokens repeat, once; others as they are.

    In order: one token between periods, a repeated block of two tokens or more
    (suffixes after it stay), an echo of the last or first token, a wrap-around.
    """
    words = X.tokens(F.regexp_replace(F.regexp_replace(name, f"[{WS}]*[,;—–()/|][{WS}]*", " "), f"[{WS}]+-[{WS}]+", " "))

    def of(w: Column) -> Column:
        n = F.size(w)
        bare = F.transform(w, lambda t: F.rtrim(t, F.lit(".")))
        one = name.contains(".") & (F.size(F.array_distinct(F.transform(bare, lambda t: F.lower(t)))) == 1)
        sizes = F.when(n >= 4, F.sequence(F.floor(n / 2).cast("int"), F.lit(2), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        size = F.get(F.filter(sizes, lambda b: F.slice(w, F.lit(1), b) == F.slice(w, b + 1, b)), 0)

        def of_block(b: Column) -> Column:
            block = F.slice(w, F.lit(1), b)
            # whole blocks from the start that are the first one
            starts = F.sequence(F.lit(0), n - b, b)
            other = F.get(F.filter(starts, lambda p: F.slice(w, p + 1, b) != block), 0)
            rest = F.slice(w, F.coalesce(other, F.element_at(starts, -1) + b) + 1, n)
            small = F.transform(block, lambda t: F.lower(t))
            kinds = F.transform(rest, lambda t: F.when(lowered(t).isin(SUFFIX_TOKENS), 1).when(F.array_contains(small, F.lower(t)), 0).otherwise(-1))
            stop = F.array_position(kinds, -1)
            upto = F.when(stop > 0, stop - 1).otherwise(F.size(rest)).cast("int")
            kept = F.filter(F.slice(rest, F.lit(1), upto), lambda t: lowered(t).isin(SUFFIX_TOKENS))
            return F.array_join(F.concat(block, kept), " ")

        first, final = F.get(w, 0), last(w)
        head, tail = F.array_join(F.slice(w, F.lit(1), n - 1), " "), F.array_join(F.slice(w, F.lit(2), F.greatest(n - 1, F.lit(0))), " ")
        return (
            F.when(n < 2, name)
            .when(one, F.get(bare, 0))
            .when(size.isNotNull(), X.bind(size, of_block))
            .when((n >= 3) & (final == last(w, 1)), head)
            .when((n >= 3) & (first == F.get(w, 1)), F.concat_ws(" ", first, F.array_join(F.slice(w, F.lit(3), F.greatest(n - 2, F.lit(0))), " ")))
            .when((n >= 3) & (F.lower(first) == F.lower(final)), tail)
            .otherwise(name)
        )

    return X.bind(words, of)


def without_metadata(name: Column) -> Column:
    """Without mail header words at the end; to and from go only where three tokens or more stand."""

    def of(w: Column) -> Column:
        def step(m: Column, _: Column) -> Column:
            t = F.lower(F.get(w, m - 1))
            return F.when(((m >= 2) & t.isin(EMAIL_TOKENS)) | ((m >= 3) & t.isin(GUARDED_TOKENS)), m - 1).otherwise(m)

        return F.array_join(F.slice(w, F.lit(1), F.aggregate(w, F.size(w), step)), " ")

    return X.bind(X.tokens(name), of)


def without_stub(name: Column) -> Column:
    """Without a last token that begins the first one or, among three or more, the one before it."""

    def of(w: Column) -> Column:
        n, end, first, before = F.size(w), F.lower(last(w)), F.lower(F.get(w, 0)), F.lower(last(w, 1))
        begins = lambda whole: (F.length(whole) > F.length(end)) & whole.startswith(end)
        stub = (n >= 2) & (F.length(end) >= 2) & (begins(first) | ((n >= 3) & begins(before)))
        return F.when(stub, F.array_join(F.slice(w, F.lit(1), n - 1), " ")).otherwise(name)

    return X.bind(X.tokens(name), of)


def clean(name: Column) -> Column:
    """The name without marks, numbers and words around it that aren't part of it, in this order."""
    step = lambda use: lambda x: X.bind(x, use)
    x = F.regexp_replace(name, r"[\x{200B}-\x{200F}\x{2028}-\x{202F}\x{FEFF}\x{AD}]", "")
    x = F.regexp_replace(F.translate(x, "_", " "), f"[{WS}]+", " ")
    x = F.ltrim(x, F.lit(LEADING))

    def numbered(s: Column) -> Column:
        listed = rf"^([0-9]+)([.{WS})\-:?']+)[{WS}]*(.*)$"
        number, mark, rest = (F.regexp_extract(s, listed, k) for k in (1, 2, 3))
        small = (F.length(F.regexp_replace(number, "^0+", "")) <= 3) & (F.coalesce(number.try_cast("bigint"), F.lit(999)) <= 300)
        fused = F.regexp_extract(s, r"^[0-9]{1,2}'*([A-Za-z].*)$", 1)
        return (
            F.when(s.rlike(listed), F.when((small | X.strip(mark).isin(".", ")", ":", "-")) & (F.length(rest) >= 3), rest).otherwise(s))
            .when(F.length(fused) >= 3, fused)
            .otherwise(s)
        )

    x = step(numbered)(x)
    x = F.rtrim(x, F.lit(TRAILING))
    x = F.regexp_replace(x, rf"\.{{2,}}[{WS}]*$", "")
    x = F.regexp_replace(x, r"(?<=[a-z]{2})\.$", "")
    return X.strip(step(without_stub)(step(without_metadata)(step(unrepeated)(x))))


def garbage_flags(name: Column, w: Column | None = None) -> dict[str, Column]:
    """Every rule as a column of its own. w: the name's tokens, where they are at hand."""
    w = X.tokens(name) if w is None else w
    n, first, final = F.size(w), F.get(w, 0), F.lower(last(w))
    low = F.lower(first)
    lone = lambda t: F.coalesce(t.rlike(r"^\p{Ll}$"), F.lit(False))
    return {
        "too_long": F.length(name) >= 60,
        "many_tokens": n >= 8,
        "too_short": F.length(name) <= 2,
        "digit_run": name.rlike(r"\p{Nd}{3,}"),
        "no_letters": ~name.rlike("[a-zA-Z]"),
        "run_together": (F.length(name) > 12) & ~name.rlike("[ .-]"),
        "camel": ~name.contains(" ") & name.rlike("[a-z][A-Z]"),
        "not_a_name": lowered(name).isin(NOT_NAMES),
        "newline": name.rlike(r"[\n\r]"),
        "one_token": (n >= 2) & (F.size(F.array_distinct(F.transform(w, lambda t: F.lower(t)))) == 1),
        "shapes": name.rlike(r"[\x{2580}-\x{259F}\x{25A0}-\x{25FF}]"),
        "symbols": name.rlike(f"[{SYMBOLS}]"),
        "digits": name.rlike(r"\p{Nd}") & name.rlike("[a-zA-Z]"),
        "brackets": name.rlike(r"[)(}{\[\]]"),
        "honorific": F.exists(w, lambda t: lowered(t).isin(HONORIFICS)),
        "marks": name.rlike("[,&!:_]"),
        "stopword_last": (n >= 2) & final.isin(STOPWORDS),
        "stopword_first": (n >= 2) & low.isin(STOPWORDS),
        "lone_letter": lone(first) | ((n >= 2) & lone(last(w))),
        "stub": (n >= 2) & (F.length(final) >= 2) & (F.length(low) > F.length(final)) & low.startswith(final),
    }


def is_garbage(name: Column) -> Column:
    def any_of(n: Column, w: Column) -> Column:
        out = F.lit(False)
        for rule in garbage_flags(n, w).values():
            out = out | F.coalesce(rule, F.lit(False))
        return out

    # the name and its tokens once a row, wherever the optimiser moves this
    return X.bind(name, lambda n: X.bind(X.tokens(n), lambda w: any_of(n, w)))


def role(x: Column) -> Column:
    return F.when(x.isin(list(ROLE_PRIORITY)), x).otherwise(F.lit("mentioned"))


def priority(x: Column) -> Column:
    out = F.lit(99)
    for name, at in ROLE_PRIORITY.items():
        out = F.when(x == name, at).otherwise(out)
    return out


def confident(x: Column, least: float = 0.70) -> Column:
    """Not below the threshold; unknown confidence passes."""
    return x.isNull() | (x >= least)


def basic_normal(name: Column) -> Column:
    """One space between words; 'Last, First' turned round; capitals as a title."""
    s = X.squeezed(name)
    parts = F.split(s, ",", -1)
    left, right = X.strip(F.get(parts, 0)), X.strip(F.get(parts, 1))
    swapped = F.when((F.size(parts) == 2) & (left != "") & (right != ""), F.concat_ws(" ", right, left)).otherwise(s)
    return X.bind(swapped, lambda x: F.when((F.length(x) > 3) & X.is_upper(x), X.title(x)).otherwise(x))


def needs_repair(name: Column) -> Column:
    return name.rlike(r"[015/{}\x{2DC}|\\@#$%^&*=+\[\]<>]") | name.rlike(r"(?<=\p{L})\p{Nd}(?=\p{L})")


def mock_repaired(name: Column) -> Column:
    kept = {k: v for k, v in REPAIRS.items() if v}
    swapped = F.translate(F.translate(name, "".join(kept), "".join(kept.values())), "".join(k for k in REPAIRS if not REPAIRS[k]), "")
    return X.squeezed(X.bind(swapped, lambda x: F.when(X.is_upper(x), X.title(x)).otherwise(x)))


#: Patterns of heuristic garbage, in order; the first that is found is the reason.
HEURISTIC_GARBAGE = [r"^[^a-zA-Z]*$", r"(.)\1{3,}", r"^.{1,2}$", r"^.{60,}$", "[0-9]{3,}", rf"[^\p{{L}}\p{{N}}_{WS}\-.',]", rf"^[{WS}\-.',]+$"]
LIKELY_NAME = r"^[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*$|^[A-Z]+(?:\s+[A-Z]+)*$|^[A-Z]\.\s*[A-Z][a-z]+$|^[A-Z][a-z]+,\s*[A-Z][a-z]+$"


def heuristic(name: Column) -> Column:
    """struct(is_valid, confidence, reason) without a model."""
    s = X.strip(name)
    reason = F.when(F.coalesce(s, F.lit("")) == "", F.lit("empty"))
    for i, p in enumerate(HEURISTIC_GARBAGE):
        reason = reason.when(s.rlike(p), F.lit(f"matches_garbage_pattern_{i}"))
    valid = s.rlike(LIKELY_NAME)
    return X.bind(
        reason,
        lambda r: F.struct(
            r.isNull().alias("is_valid"),
            F.when(r.isNotNull(), 0.95).when(valid, 0.85).otherwise(0.5).alias("confidence"),
            F.when(r.isNotNull(), r).when(valid, F.lit("matches_name_pattern")).otherwise(F.lit("default")).alias("reason"),
        ),
    )
