"""Trip cleaning: ordered quality rules with median imputation."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import (
    MAX_AMOUNT,
    MAX_DISTANCE,
    MAX_PASSENGERS,
    PAYMENT_CODES,
    RATE_CODES,
    VENDOR_CODES,
)
from tidecast.operators.quality import (
    apply_rules,
    between_ts,
    drop_all_null,
    funnel_of,
    impute_median,
    mark_either_in,
    normalise_nan,
    rules_passed,
)
from tidecast.sources.contracts import downcast

# role -> column of the published trip files
TRIP_COLUMNS = {
    "pickup": "tpep_pickup_datetime",
    "dropoff": "tpep_dropoff_datetime",
    "pickup_zone": "PULocationID",
    "dropoff_zone": "DOLocationID",
    "vendor": "VendorID",
    "rate": "RatecodeID",
    "payment": "payment_type",
    "passengers": "passenger_count",
    "distance": "trip_distance",
    "fare": "fare_amount",
    "total": "total_amount",
    "tip": "tip_amount",
    "tolls": "tolls_amount",
    "surcharge": "congestion_surcharge",
}
IMPUTED = ["passengers", "distance", "fare", "total"]


def row_rules(c: Mapping[str, str], start, end, closed: str = "both") -> list[tuple[str, Column]]:
    """Rules that run before imputation."""
    return [
        ("time_range", between_ts(c["pickup"], start, end, closed)),
        ("either_zone", F.col("__zone_ok")),
        ("time_order", F.col(c["dropoff"]) >= F.col(c["pickup"])),
        (
            "critical_present",
            F.col(c["pickup"]).isNotNull()
            & F.col(c["pickup_zone"]).isNotNull()
            & F.col(c["dropoff_zone"]).isNotNull(),
        ),
    ]


def value_rules(c: Mapping[str, str]) -> list[tuple[str, Column]]:
    """Rules on imputed values."""
    return [
        ("vendor", F.col(c["vendor"]).isin(VENDOR_CODES)),
        ("rate", F.col(c["rate"]).isin(RATE_CODES)),
        ("payment", F.col(c["payment"]).isin(PAYMENT_CODES)),
        ("distance", F.col(c["distance"]).between(0, MAX_DISTANCE)),
        ("passengers", F.col(c["passengers"]).between(0, MAX_PASSENGERS)),
        ("fare", F.col(c["fare"]).between(0, MAX_AMOUNT)),
        ("total", F.col(c["total"]).between(0, MAX_AMOUNT)),
        ("tip", F.col(c["tip"]) >= 0),
        ("tolls", F.col(c["tolls"]) >= 0),
    ]


def _prepare(trips, zones, zone_key, c, start, end, closed, exact):
    either = [c["pickup_zone"], c["dropoff_zone"]]
    marked = mark_either_in(normalise_nan(trips), either, zones, zone_key, "__zone_ok")
    # a drop-off after a pick-up is after the start, too: known before the sides of a join meet
    basis = apply_rules(marked.where(F.col(c["dropoff"]) >= start), row_rules(c, start, end, closed))
    imputed = [c[role] for role in IMPUTED]

    def fill(df):
        return impute_median(df, imputed, basis, exact).na.fill({c["surcharge"]: 0.0})

    return marked, basis, fill


def clean_trips(
    trips: DataFrame,
    zones: DataFrame,
    zone_key: str,
    start,
    end,
    columns: Mapping[str, str] = TRIP_COLUMNS,
    closed: str = "both",
    exact_medians: bool = True,
    drop_empty: bool = False,
    narrow: Mapping[str, str] | None = None,
    few: DataFrame | None = None,
) -> DataFrame:
    """Rows that satisfy every rule, with NULLs imputed by medians of the rows that
    satisfy the rules before imputation.

    Trips are read twice, for the medians and for the result, and nothing runs before the query does.
    ``drop_empty`` drops columns without a single value, for which it looks at the data (see
    :func:`drop_all_null`, also for ``few``); ``narrow`` casts columns to smaller types, after imputation and before the
    range rules.
    """
    c = columns
    if drop_empty:
        trips = drop_all_null(trips, few=few)
    _, basis, fill = _prepare(trips, zones, zone_key, c, start, end, closed, exact_medians)
    filled = fill(basis)
    filled = downcast(filled, narrow) if narrow else filled
    return apply_rules(filled, value_rules(c)).drop("__zone_ok")


def cleaning_funnel(
    trips: DataFrame,
    zones: DataFrame,
    zone_key: str,
    start,
    end,
    columns: Mapping[str, str] = TRIP_COLUMNS,
    closed: str = "both",
    exact_medians: bool = True,
    complete: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows left after each rule of :func:`clean_trips`, counted in one pass.

    The rules on values become one number a row before anything is joined. Where pick-up or zones come from a
    large join, ``trips`` may lack them and ``complete`` joins them: it then deals that number, not the values.
    """
    c, whole = columns, complete or (lambda df: df)
    _, _, fill = _prepare(whole(trips), zones, zone_key, c, start, end, closed, exact_medians)
    before, after = row_rules(c, start, end, closed), value_rules(c)
    numbered = whole(fill(normalise_nan(trips)).withColumn("__values_passed", rules_passed(after)))
    marked = mark_either_in(numbered, [c["pickup_zone"], c["dropoff_zone"]], zones, zone_key, "__zone_ok")
    return funnel_of(marked, rules_passed(before, F.col("__values_passed")), [name for name, _ in before + after])
