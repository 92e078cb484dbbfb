"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def no_activity_as_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def clip_at_zero(value: Column) -> Column:
    """Negative forecasts become 0; unlike a bare ``greatest`` a NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def id_from_label(label: Column) -> Column:
    """The integer after the last underscore of a series name, or -1 when there is none."""
    digits = F.regexp_extract(label, r"_(-*[0-9]+)$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(-1))


def area_label(area_id: Column) -> Column:
    return F.concat_ws("_", F.lit("area"), area_id.cast("string"))


def order_text(*parts: Column) -> Column:
    """An ARIMA order rendered as ``(p, d, q)``."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[p.cast("string") for p in parts]), F.lit(")"))


# Unit names of the size report, each 1024 times the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def human_bytes(n: Column) -> Column:
    """Byte count as text with two decimals; sizes past the last unit stay in it."""
    size = n.cast("double")

    def shown(power: int) -> Column:
        return F.format_string(f"%.2f {SIZE_UNITS[power]}", F.bround(size / F.lit(1024.0 ** power), 2))

    text = shown(len(SIZE_UNITS) - 1)
    for power in reversed(range(len(SIZE_UNITS) - 1)):
        text = F.when(F.abs(size) < F.lit(1024.0 ** (power + 1)), shown(power)).otherwise(text)
    return text


def require(condition: Column, message: str, value: Column) -> Column:
    """``value`` where the condition holds; the job fails with ``message`` otherwise."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("double"))
