"""Small text expressions that several operators share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.vocab import WS, WS_CHARS, as_class

#: WS below U+1680.
LATIN_WS = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WS_CHARS))


def squeezed(x: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.btrim(F.regexp_replace(x, f"[{WS}]+", " "))


def tokens(x: Column) -> Column:
    """Runs of other characters than white space."""

    def parts(inner: Column) -> Column:
        # few texts have white space beyond Latin-1; the others are split by a class of few ranges
        apart = F.when(inner.rlike(r"[\x{1680}-\x{10FFFF}]"), F.split(inner, f"[{WS}]+")).otherwise(F.split(inner, f"[{LATIN_WS}]+"))
        return F.when(inner == "", F.array().cast("array<string>")).otherwise(apart)

    return bind(strip(x), parts)


def count_of(x: Column, inside: str) -> Column:
    """Characters of a class."""
    return F.length(x) - F.length(F.regexp_replace(x, f"[{inside}]+", ""))


def count_among(x: Column, characters: str) -> Column:
    """Characters of a table. What lies near some of them is taken out first, in one pass over a class of few ranges."""
    rough = F.array_join(F.regexp_extract_all(x, F.lit(f"[{as_class(characters, 0x400)}]+"), F.lit(0)), "")
    return bind(rough, lambda r: F.when(r == "", F.lit(0)).otherwise(count_of(r, as_class(characters))))


def count_not(x: Column, inside: str) -> Column:
    return F.length(F.regexp_replace(x, f"[{inside}]+", ""))


def is_upper(x: Column) -> Column:
    """Some cased letter, and no small one."""
    return (x == F.upper(x)) & (x != F.lower(x))


def title(x: Column) -> Column:
    """The first letter of every run of letters as a capital, the others small."""
    runs = F.regexp_extract_all(x, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def bind(value: Column, use) -> Column:
    """use(value), with ``value`` evaluated once a row."""
    return F.transform(F.array(value), use)[0]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are evaluated once a row, however often what follows refers to them.

    A filter or projection above would otherwise take in their expressions, and
    evaluate them again for every reference.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


#: Elements of a block of an array that a fold goes through.
BLOCK = 256


def blocks(values: Column, state: Column, fold) -> Column:
    """fold(state, block) over blocks of an array: lists that grow with a block, instead of with the array, keep a fold linear.

    fold(state, block) is a struct with the fields of ``state``; its field ``out`` is what the block adds to the list.
    """

    def over(v: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            return bind(fold(acc, F.slice(v, i + 1, F.lit(BLOCK))), lambda r: r.withField("out", F.concat(acc["out"], r["out"])))

        return F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK)), state, step)

    return bind(values, over)


def running(values: Column) -> Column:
    """Running sums of an array of int, in the row."""
    empty = F.array().cast("array<int>")

    def fold(acc: Column, block: Column) -> Column:
        return F.aggregate(block, F.struct(acc["at"].alias("at"), empty.alias("out")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out")))

    return blocks(values, F.struct(F.lit(0).alias("at"), empty.alias("out")), fold)["out"]
