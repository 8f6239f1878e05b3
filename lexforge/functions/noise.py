"""Noise of recognised text, the recovery gate, and conservative fixes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.functions.vocab import GARBAGE, NOISE_SYMBOLS

#: Characters that no noise is seen in, inside a class.
COMMON = r"a-zA-Z0-9 \n\t.,;:!?'\"\-()\[\]{}@#$%&*/"
# The gate, and characters that recognition confuses.
GATE_LENGTH, GATE_NAMES, GATE_NOISE = 500, 2, 0.15
FIXES = {"0": "O", "1": "I", "5": "S", "8": "B", "|": "l", "!": "l"}


def score(raw: Column) -> Column:
    """0 (clean) to 1; 0 below 50 characters."""
    n = F.length(raw)
    capped = lambda x: F.least(F.lit(1.0), x)
    uncommon = capped(X.count_not(raw, COMMON) / n * 10)
    found = F.when(raw.rlike("[0-9]"), F.size(F.regexp_extract_all(raw, F.lit("[A-Za-z][0-9][A-Za-z]|[0-9][A-Za-z][0-9]"), F.lit(0)))).otherwise(F.lit(0))
    broken = capped(found / F.lit(20.0))
    short = X.bind(X.tokens(raw), lambda t: F.when(F.size(t) == 0, F.lit(0.0)).otherwise(F.size(F.filter(t, lambda x: F.length(x) <= 2)) / F.size(t).cast("double")))
    boxes = capped(X.count_among(raw, NOISE_SYMBOLS) / n * 20)
    return F.when(F.coalesce(n, F.lit(0)) < 50, F.lit(0.0)).otherwise(uncommon * 0.3 + broken * 0.3 + short * 0.2 + boxes * 0.2)


def needs_recovery(length: Column, names: Column, noise: Column, least_noise: float = GATE_NOISE) -> Column:
    return (length >= GATE_LENGTH) & (names <= GATE_NAMES) & (noise >= least_noise)


def legacy_noise(raw: Column) -> Column:
    """About five times the share of garbage."""
    return F.when(F.length(raw) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), X.count_among(raw, GARBAGE).cast("double") / F.length(raw) * 5))


def name_like(text: Column) -> Column:
    """Two letters, 60 % letters but for spaces, not all capitals above four characters, some capital."""
    letters = X.count_not(text, r"^\p{L}")
    rest = F.length(F.regexp_replace(text, " ", ""))
    return (letters >= 2) & (letters >= 0.6 * rest) & ~((F.length(text) > 4) & X.is_upper(text)) & text.rlike(r"\p{Lu}")


def fixed(text: Column) -> Column:
    """Confused characters next to a letter of the original text, replaced."""
    stand_ins = {c: chr(0xE000 + i) for i, c in enumerate(FIXES)}  # no letters, so neighbours stay what they were
    out = text
    for c, place in stand_ins.items():
        out = F.regexp_replace(out, rf"(?<=\p{{L}})\Q{c}\E|\Q{c}\E(?=\p{{L}})", place)
    return F.translate(out, "".join(stand_ins.values()), "".join(FIXES.values()))
