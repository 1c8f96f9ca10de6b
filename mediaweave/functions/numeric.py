"""Scalar numeric functions: overlaps, hashes of frames, vectors, delays and sample positions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

TOLERANCE = 1e-9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, wherever and however often body uses it."""
    return F.transform(F.array(value), body)[0]


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(end_a, end_b) - F.greatest(start_a, start_b))


def overlaps(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return F.least(end_a, end_b) > F.greatest(start_a, start_b)


def contains(start: Column, end: Column, at: Column) -> Column:
    """Half-open: the start is inside, the end is not."""
    return (at >= start) & (at < end)


def is_close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    return F.abs(a - b) <= F.greatest(F.greatest(F.abs(a), F.abs(b)) * tolerance, F.lit(tolerance))


def two_places(x: Column) -> Column:
    """x as text with two decimals, rounded as C and Python do: by the exact binary value, a true half to the even digit. The JVM's
    %.2f rounds the shortest decimal that stands for x, so 0.285, which is stored as less, gives it 0.29."""

    def text(x: Column) -> Column:
        top = x * 134217729.0  # 2 ** 27 + 1: the upper half of the digits, so that both parts times 200 are exact
        high = top - (top - x)
        twice = x * 200.0
        over = (high * 200.0 - twice) + (x - high) * 200.0  # what 200 x is beyond its rounded product
        low = F.floor(twice / 2.0)
        half = F.signum(twice - (low * 2 + 1) + over)  # which side of the middle of two hundredths 200 x lies on
        n = low + F.when((half > 0) | ((half == 0) & (low % 2 != 0)), F.lit(1)).otherwise(F.lit(0))
        return F.concat(F.format_string("%d.", F.floor(n / 100).cast("long")), F.lpad((n % 100).cast("string"), 2, "0"))

    sign = F.when((x < 0) | (x.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit(""))
    large = F.abs(x) >= 2.0**45  # its halves are no longer told from whole hundredths by floor's long
    plain = F.when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf"))).when(large, F.format_string("%.2f", x))
    return F.when(x.isNotNull(), plain.otherwise(F.concat(sign, text(F.abs(x)))))


def hash_bits(coefficients: Column) -> Column:
    """16 hex digits of 64 coefficients: a bit, most significant first, says that a coefficient is above the median of
    all but the first."""
    def half(start: int, median: Column) -> Column:
        bits = F.transform(F.slice(coefficients, start, 32), lambda c: F.when(c > median, F.lit(1)).otherwise(F.lit(0)).cast("long"))
        return F.lower(F.lpad(F.hex(F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a * 2 + b)), 8, "0"))

    return let(F.array_sort(F.slice(coefficients, 2, 63))[31], lambda median: F.concat(half(1, median), half(33, median)))


def hash_halves(hash_hex: Column) -> Column:
    """Two 32-bit numbers of 16 hex digits; a 64-bit one would not fit a signed long."""
    half = lambda start: F.conv(F.substring(hash_hex, start, 8), 16, 10).cast("long")
    return F.struct(half(1).alias("high"), half(9).alias("low"))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two structs of halves."""
    return F.bit_count(a["high"].bitwiseXOR(b["high"])) + F.bit_count(a["low"].bitwiseXOR(b["low"]))


_SIZE, _LOW = 32, 8


def dct_coefficients(gray: np.ndarray) -> np.ndarray:
    """The 64 low-frequency cosine coefficients of a 32 x 32 grey image, row by row."""
    at = np.arange(_SIZE)
    basis = np.cos(np.pi * (2 * at[None, :] + 1) * np.arange(_LOW)[:, None] / (2 * _SIZE))
    return (basis @ gray.reshape(_SIZE, _SIZE).astype(float) @ basis.T).reshape(-1)


@pandas_udf(T.ArrayType(T.DoubleType()))
def dct_udf(images: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Coefficients of 1,024 grey values, row by row, that an injected decoder has resized."""
    for s in images:
        yield s.map(lambda px: None if px is None else dct_coefficients(np.asarray(px, float)).tolist())


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def l2_normalized(vector: Column) -> Column:
    """The unit vector; an error for a zero vector or one with values that are not finite."""
    finite = F.forall(vector, lambda x: ~F.isnan(x) & (F.abs(x) != float("inf")))
    wrong = F.raise_error(F.lit("a vector must be finite and not zero")).cast("array<double>")
    return let(norm(vector), lambda size: F.when((size > 0) & finite, F.transform(vector, lambda x: x.cast("double") / size)).otherwise(wrong))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_valid(vector: Column, size: int | None = None) -> Column:
    good = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return good & (F.size(vector) == size) if size else good


def softmax(logits: Column) -> Column:
    def share(exps: Column) -> Column:
        return let(F.aggregate(exps, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(exps, lambda x: x / total))

    return let(F.array_max(logits), lambda top: let(F.transform(logits, lambda x: F.exp(x - top)), share))


def backoff(attempts_used: Column, initial: float, factor: float, most: float) -> Column:
    return F.least(F.lit(initial) * F.pow(F.lit(factor), attempts_used - 1), F.lit(most))


def stt_samples(start: Column, end: Column, rate: int = 16_000) -> tuple[Column, Column]:
    """Sample range of a chunk, truncated towards zero."""
    return (start * rate).cast("long"), (end * rate).cast("long")


def event_samples(start: Column, end: Column, total: Column, rate: int = 16_000, slack: float = 0.01, least: int = 400) -> tuple[Column, Column, Column]:
    """Sample range of a window, rounded half to even; an end up to `slack` seconds beyond the audio is clamped. The third
    value says how many samples of silence fill a short window."""
    a, b = F.rint(start * rate).cast("long"), F.rint(end * rate).cast("long")
    b = F.when((b > total) & (b - total <= int(slack * rate)), total).otherwise(b)
    return a, b, F.greatest(F.lit(0).cast("long"), F.lit(least).cast("long") - (b - a))


def seconds_of(samples: Column, rate: int = 16_000) -> Column:
    return F.round(samples / rate, 3)


def wav_duration(size_bytes: Column, rate: int = 16_000) -> Column:
    """Seconds of 16-bit mono PCM behind a 44-byte header."""
    return (size_bytes - 44) / (rate * 2)


def frame_rate(ratio: Column) -> Column:
    """num/den to 3 places, 0 where the denominator is 0."""
    parts = F.split(ratio, "/")
    num, den = parts[0].try_cast("double"), F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("double"), F.lit(1.0))
    return F.round(F.when(den == 0, 0.0).otherwise(num / F.nullif(den, F.lit(0.0))), 3)
