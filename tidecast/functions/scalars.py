"""Row-wise cleaning and recoding expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def flag_in(col: Column | str, values: Iterable) -> Column:
    return flag(_col(col).isin(list(values)))


def flag_above(col: Column | str, limit: float = 0) -> Column:
    return flag(no_nan(_col(col)) > limit)


def no_nan(col: Column | str) -> Column:
    """NaN as NULL: Spark orders NaN above every number, so one-sided rules would keep it."""
    col = _col(col)
    return F.when(~F.isnan(col), col)


def recode(col: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary recode as one map literal (for dictionaries of a few entries)."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    value = F.try_element_at(table, _col(col))
    return value if default is None else F.coalesce(value, F.lit(default))


def clean_numeric(
    col: Column | str, words: Mapping[str, float] | None = None, default: float | None = 0.0
) -> Column:
    """Numeric value of a text column: known words, lenient parse, then the default."""
    col = _col(col).cast("string")
    value = col.try_cast("double")
    if words:
        value = F.coalesce(recode(col, words), value)
    value = no_nan(value)
    return value if default is None else F.coalesce(value, F.lit(default))


def bucket_label(col: Column | str, limit: float, low: str = "low", high: str = "high") -> Column:
    return F.when(_col(col) <= limit, F.lit(low)).otherwise(F.lit(high))


def round_half_even(col: Column | str) -> Column:
    return F.bround(_col(col), 0).cast("int")


def absolute_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.abs(_col(actual) - _col(predicted))


def signed_error(actual: Column | str, predicted: Column | str) -> Column:
    """Positive means the prediction was too high."""
    return _col(predicted) - _col(actual)


def json_number(col: Column | str, path: str, default: float | None = None) -> Column:
    value = F.get_json_object(_col(col), path).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


WEATHER_PAYLOAD = (
    "struct<current: struct<temp: double, humidity: double, wind_speed: double, "
    "clouds: double, rain: struct<`1h`: double>>>"
)


def weather_from_json(col: Column | str) -> dict[str, Column]:
    """Columns of a current-weather payload; rain is optional and defaults to 0."""
    current = F.from_json(_col(col), WEATHER_PAYLOAD).getField("current")
    return {
        "temperature": current.getField("temp"),
        "humidity": current.getField("humidity"),
        "wind_speed": current.getField("wind_speed"),
        "cloud_cover_numeric": current.getField("clouds"),
        "amount_of_precipitation": F.coalesce(
            current.getField("rain").getField("1h"), F.lit(0.0)
        ),
    }


def hash_fraction(*keys: Column | str, seed: int = 42) -> Column:
    """Stable pseudo-random number in [0, 1) from the row's key (same on every run and retry)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
