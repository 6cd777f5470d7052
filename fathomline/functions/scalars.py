"""Scalar expressions: calendar shares, null masks, tolerant casts, activations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; a BIGINT range frame over it is exact where an interval frame over timestamps is not."""
    return F.unix_micros(ts.cast("timestamp"))


def time_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)) / F.lit(1440.0)


def time_of_day_by_remainder(ts: Column) -> Column:
    return F.pmod(micros(ts), F.lit(MICROS_PER_DAY)) / F.lit(float(MICROS_PER_DAY))


def time_of_day_by_position(t: Column, steps_per_day: int) -> Column:
    return F.pmod(t, F.lit(steps_per_day)) / F.lit(float(steps_per_day))


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts) / F.lit(7.0)


def day_of_week_by_position(t: Column, steps_per_day: int) -> Column:
    return F.pmod(F.floor(t / steps_per_day), F.lit(7)) / F.lit(7.0)


def day_of_month(ts: Column) -> Column:
    return (F.dayofmonth(ts) - 1) / F.lit(31.0)


def day_of_year(ts: Column) -> Column:
    return (F.dayofyear(ts) - 1) / F.lit(366.0)


def finite(value: Column) -> Column:
    """NaN and infinities become NULL, the engine's one missing value."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def missing_to_zero(value: Column) -> Column:
    return F.coalesce(finite(value), F.lit(0.0))


def valid_mask(value: Column, null_value: float | None = None) -> Column:
    """Which cells count. Without ``null_value`` the non-NULL ones; else those not close to it (NULL is not close)."""
    if null_value is None:
        return value.isNotNull()
    return F.coalesce(F.abs(value - F.lit(null_value)) > 5e-5 + 1e-5 * abs(null_value), F.lit(True))


def reconstruction_mask(t: Column, channel: Column, percent: int) -> Column:
    """A reproducible mask that hides about ``percent`` of the cells."""
    return F.pmod(t * 7919 + channel * 104_729, F.lit(100)) >= percent


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) from a hash of seed and keys: the same for a row wherever and whenever it is computed, so a lost
    task draws what it drew before."""
    code = F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), *(F.col(k) if isinstance(k, str) else k for k in keys)).cast("binary")), 1, 12)
    return F.conv(code, 16, 10).cast("double") / float(1 << 48)


def random_mask(ratio: float, seed: int, *keys: Column | str) -> Column:
    """Visible cells: all but a share of ``ratio``, by a hash of the keys."""
    return uniform(seed, *keys) > ratio


def tolerant_double(text: Column) -> Column:
    return text.try_cast("double")


def tolerant_timestamp(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


ACTIVATIONS = {
    "relu": lambda x: F.greatest(x, F.lit(0.0)),
    "sigmoid": lambda x: 1 / (1 + F.exp(-x)),
    "tanh": F.tanh,
    "silu": lambda x: x / (1 + F.exp(-x)),
    "elu": lambda x: F.when(x > 0, x).otherwise(F.exp(x) - 1),
    "leaky_relu": lambda x: F.when(x > 0, x).otherwise(x * 0.01),
    "softplus": lambda x: F.log(1 + F.exp(x)),
    "gelu": lambda x: 0.5 * x * (1 + F.tanh(F.lit(0.7978845608028654) * (x + 0.044715 * x * x * x))),
}


def activation(name: str, x: Column) -> Column:
    return ACTIVATIONS[name](x)


def chebyshev(x: Column, k: Column) -> Column:
    """Basis k of x squashed twice into (-1, 1)."""
    return F.cos(k * F.acos(F.tanh(F.tanh(x))))


def position_encoding(position: Column, feature: Column, width: int) -> Column:
    angle = position * F.exp(-F.log(F.lit(10_000.0)) * (feature - F.pmod(feature, F.lit(2))) / width)
    return F.when(F.pmod(feature, F.lit(2)) == 0, F.sin(angle)).otherwise(F.cos(angle))


def feature_source(name: Column) -> Column:
    """The raw signal a feature column was derived from; a raw column names itself."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(.+)_(?:lag|ma|std|max|min)_[0-9]+m$", 1), F.lit("")), name)


def config_identity(config: Column) -> Column:
    return F.md5(config.cast("string"))
