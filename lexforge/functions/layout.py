"""Page images: what a page looks like, from its rows of ink."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.functions import text as X

# Fixed values of the page analysis.
WIDTH, HEIGHT, DARK_BLANK, DARK_TEXT, DARK_PHOTO, MIN_LINES, MAX_CV, SIGMA, PEAK_DISTANCE, BAND = 600, 800, 0.005, 0.02, 0.20, 8, 0.8, 1.5, 8, (2, 15)

PAGE = T.StructType([T.StructField("page_type", T.StringType()), T.StructField("dark_ratio", T.DoubleType()), T.StructField("line_count", T.IntegerType()), T.StructField("regularity", T.DoubleType())])


def blurred(rows: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    if sigma <= 0:
        return rows
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(rows, kernel / kernel.sum(), mode="same")


def peaks(rows: np.ndarray, distance: int = PEAK_DISTANCE) -> list[int]:
    """Local maxima above mean and half a deviation, ``distance`` apart."""
    if len(rows) < 3 or (least := rows.mean() + 0.5 * rows.std()) <= 0:
        return []
    inner = rows[1:-1]
    found, last = [], -distance
    for i in (np.flatnonzero((inner > least) & (inner >= rows[:-2]) & (inner >= rows[2:])) + 1).tolist():
        if i - last >= distance:
            found.append(i)
            last = i
    return found


def bands(rows: np.ndarray, least: float) -> list[int]:
    """Middles of runs of ink as thick as a line of text."""
    ink = np.concatenate([[0], (rows > least).astype(np.int8), [0]])
    starts, ends = np.flatnonzero(np.diff(ink) == 1), np.flatnonzero(np.diff(ink) == -1)
    fit = (ends - starts >= BAND[0]) & (ends - starts <= BAND[1])
    return ((starts + ends)[fit] // 2).tolist()


def spacing_cv(places: list[int]) -> float:
    """Deviation of the distances by their mean; -1 below two places, 99 without a mean."""
    if len(places) < 2:
        return -1.0
    d = np.diff(places)
    return 99.0 if d.mean() <= 0 else float(d.std() / d.mean())


def analysed(gray: np.ndarray) -> tuple[str, float, int, float]:
    """(page_type, dark_ratio, line_count, regularity) of a gray image."""
    dark = gray < np.median(gray) * 0.7
    share = float(dark.mean()) if dark.size else 0.0
    if share < DARK_BLANK:
        return "blank", share, 0, -1.0
    if share > DARK_PHOTO:
        return "photo_like", share, 0, -1.0
    rows = blurred(dark.mean(axis=1))
    some = rows[rows > 0.001]
    by_peaks, by_bands = peaks(rows), bands(rows, float(np.median(some)) * 0.3 if len(some) else 0.015)
    lines = by_bands if len(by_bands) >= len(by_peaks) else by_peaks
    cv = spacing_cv(lines)
    if len(lines) >= MIN_LINES and share >= DARK_TEXT and 0 <= cv < MAX_CV:
        return "text_like", share, len(lines), cv
    return ("blank" if share < DARK_TEXT else "uncertain"), share, len(lines), cv


@F.pandas_udf(PAGE)
def textiness(pixels: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Of gray pages as bytes, row by row, ``width`` bytes a row; broken ones are uncertain."""
    out = []
    for data, w in zip(pixels, width, strict=True):
        ok = data is not None and w and len(data) and len(data) % w == 0
        out.append(analysed(np.frombuffer(data, np.uint8).reshape(-1, int(w))) if ok else ("uncertain", 0.0, 0, -1.0))
    return pd.DataFrame(out, columns=["page_type", "dark_ratio", "line_count", "regularity"])


def is_text_like(page_type: Column) -> Column:
    return page_type == "text_like"


def profile_bands(rows: Column, least: float) -> Column:
    """Middles of ink runs of a row profile (array of doubles), by expressions alone."""
    ink = F.transform(rows, lambda x: x > least)
    starts = F.filter(F.transform(ink, lambda x, i: F.when(x & ((i == 0) | ~F.coalesce(F.get(ink, i - 1), F.lit(False))), i)), lambda x: x.isNotNull())
    ends = F.filter(F.transform(ink, lambda x, i: F.when(x & ~F.coalesce(F.get(ink, i + 1), F.lit(False)), i + 1)), lambda x: x.isNotNull())
    pairs = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    fit = F.filter(pairs, lambda p: (p["e"] - p["s"]).between(*BAND))
    return F.transform(fit, lambda p: F.floor((p["s"] + p["e"]) / 2).cast("int"))


def profile_cv(places: Column) -> Column:
    gaps = lambda p: F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda x, i: (x - F.get(p, i)).cast("double"))

    def of(g: Column) -> Column:
        mean = F.aggregate(g, F.lit(0.0), lambda a, x: a + x) / F.size(g)
        return X.bind(mean, lambda m: F.when(m <= 0, F.lit(99.0)).otherwise(F.sqrt(F.aggregate(g, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / F.size(g)) / m))

    return F.when(F.size(places) < 2, F.lit(-1.0)).otherwise(X.bind(gaps(places), of))
