"""Token lists, score vectors and probabilities as array and map columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the words that the truncating form keeps.
MAX_TOKENS = 128


def word_tokens(cleaned: Column | str, most: int | None = None) -> Column:
    """The words of cleaned text, which are parted by one blank; the first `most` only when given."""
    cleaned = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    words = F.split(cleaned, " ") if most is None else F.slice(F.split(cleaned, " ", most + 1), 1, most)
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(words)


def argmax(scores: Column) -> Column:
    """0-based place of the largest score, the first one among equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row.

    A lambda evaluates what it mentions for every element; what should be
    computed once is bound first, as the element of a one-element array.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(scores: Column) -> Column:
    """Scores to probabilities over the array; a NULL score gets 0."""

    def weights(top: Column) -> Column:
        return F.transform(scores, lambda s: F.coalesce(F.exp((s - top).cast("double")), F.lit(0.0)))

    def shares(parts: Column) -> Column:
        total = F.aggregate(parts, F.lit(0.0), lambda acc, w: acc + w)
        return with_value(total, lambda whole: F.transform(parts, lambda w: w / whole))

    return with_value(with_value(F.array_max(scores), weights), shares)


def confidence(probabilities: Column) -> Column:
    """The largest probability."""
    return F.array_max(probabilities)


def name_array(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def name_of(index: Column, names: Sequence[str], missing: str = "Unknown") -> Column:
    """Label name at a 0-based index, `missing` outside the list."""
    return F.coalesce(F.get(name_array(names), index), F.lit(missing))


def probability_map(probabilities: Column, names: Sequence[str]) -> Column:
    """`{category: probability}`; a place without a name is called `L_<place>`."""
    named = name_array(names)

    def keyed(values: Column) -> Column:
        def name(_: Column, place: Column) -> Column:
            return F.coalesce(F.get(named, place), F.concat(F.lit("L_"), place.cast("string")))

        return F.map_from_arrays(F.transform(values, name), values)

    return with_value(probabilities, keyed)


def confidence_flag(value: Column, threshold: float = 0.75) -> Column:
    """`ok` from the threshold up, `below_threshold` under it."""
    return F.when(value >= F.lit(threshold), "ok").otherwise("below_threshold")


def _rounded(value: Column, decimals: int) -> Column:
    """The binary value itself to so many decimals, an exact tie to the even digit.

    Scaling rounds, so what it loses is computed as well (a product split into
    halves); only then is it known on which side of a half the value lies.
    """
    scale, half_bits = 10.0**decimals, float((1 << 27) + 1)

    def split(x: Column) -> tuple[Column, Column]:
        high = x * half_bits - (x * half_bits - x)
        return high, x - high

    size = F.abs(value.cast("double"))
    product = size * scale
    (a, b), (c, d) = split(size), split(F.lit(scale))
    lost = ((a * c - product) + a * d + b * c) + b * d
    whole = F.floor(product).cast("double")
    side = (product - (whole + 0.5)) + lost
    up = (side > 0) | ((side == 0) & (whole % 2 == 1))
    return F.signum(value.cast("double")) * (whole + F.when(up, 1.0).otherwise(0.0)) / scale


def fixed4(value: Column) -> Column:
    """Four decimals, as in a confidence line."""
    return F.format_string("%.4f", _rounded(value, 4))


def percent(value: Column, decimals: int = 2) -> Column:
    """A share as a percentage with the given number of decimals."""
    return F.format_string(f"%.{decimals}f%%", _rounded(value * 100, decimals))
