"""Grouped statistics, model metrics, error slices, histograms and drift measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import DRIFT_RATIO
from tidecast.names import ACTUAL, HOUR, PREDICTED
from tidecast.operators.quantiles import exact_quantiles


def mean_and_count(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.avg(m).alias(m) for m in measures], F.count(measures[-1]).alias(count)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First non-NULL value of each column per key in the given order."""
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns]
    )


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


# -- regression metrics -------------------------------------------------------
def regression_metrics(
    df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED, by: Sequence[str] = ()
) -> DataFrame:
    """n, MAE, MSE, RMSE and R2 in one aggregation pass."""
    err = F.col(actual) - F.col(predicted)
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(err)).alias("mae"),
            F.avg(err * err).alias("mse"),
            F.var_pop(actual).alias("__var"),
        )
        .select(
            *by,
            "n",
            "mae",
            "mse",
            F.sqrt("mse").alias("rmse"),
            F.when(F.col("__var") > 0, 1 - F.col("mse") / F.col("__var")).alias("r2"),
        )
    )


def error_slices(
    df: DataFrame, dims: Sequence[str], error: str = "absolute_error", within: Sequence[str] = ()
) -> DataFrame:
    """Mean error per value of each dimension, all dimensions in one GROUPING SETS pass.

    Result: ``(*within, dim, value, n, mean_error)``. ``within`` keys are part of
    every grouping set.
    """
    typed = df.select(
        *within, *[F.col(d).cast("string").alias(d) for d in dims], F.col(error).alias("__error")
    )
    sets = [[F.col(k) for k in [*within, d]] for d in dims]
    grouped = typed.groupingSets(sets, *within, *dims).agg(
        *[F.grouping(d).alias(f"__g_{d}") for d in dims],
        F.count(F.lit(1)).alias("n"),
        F.avg("__error").alias("mean_error"),
    )
    dim = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.lit(d)) for d in dims])
    value = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.col(d)) for d in dims])
    return grouped.select(*within, dim.alias("dim"), value.alias("value"), "n", "mean_error")


def top_groups(df: DataFrame, keys: Sequence[str], error: str, k: int, name: str = "mean_error") -> DataFrame:
    """The k groups with the highest mean error; ties go to the smaller key."""
    means = df.groupBy(*keys).agg(F.avg(error).alias(name))
    # rounding before the sort keeps ties stable across summation orders
    return means.withColumn(name, F.round(name, 6)).orderBy(F.desc(name), *keys).limit(k)


def bias(df: DataFrame, keys: Sequence[str], actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Mean and exact median signed error per key; no key's errors are ever gathered in a buffer."""
    errors = df.select(*keys, (F.col(predicted) - F.col(actual)).cast("double").alias("__error"))
    means = errors.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("__error").alias("mean_bias"))
    middle = exact_quantiles(errors, ["__error"], [0.5], keys).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("q0").alias("median_bias"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return means.join(middle, same, "left").select(*keys, "n", "mean_bias", "median_bias")


def hourly_mae(df: DataFrame, hour: str = HOUR, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    return df.groupBy(hour).agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Binary confusion counts with accuracy, precision and recall, one pass."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )


# -- distributions ------------------------------------------------------------
def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the maximum belongs to the last bin."""
    raw = F.floor((value - low) * bins / (high - low))
    return F.when(high <= low, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, bin, n)`` over equal-width bins between the column's extremes."""
    data = df.select(*by, F.col(column).cast("double").alias("v")).where("v is not null")
    if by:
        ranges = data.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        ranged = data.join(ranges, list(by))
        low, high = F.col("lo"), F.col("hi")
    else:
        packed = data.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
        ranged, low, high = data, packed.getField("lo"), packed.getField("hi")
    return (
        ranged.select(*by, _bin_of(F.col("v"), low, high, bins).alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: Kernel widths beyond which a value adds less than 1e-12 of a kernel's height to a point.
REACH = 7.5


def density(df: DataFrame, column: str, points: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """Gaussian density curve ``(*by, point, x, density)`` with Scott's bandwidth, one curve per key.

    Equal values are counted first; each distinct one then adds its part to the points within ``REACH``
    bandwidths, combined map-side to one row per key, point and task. What lies farther is left out: at most
    exp(-REACH^2 / 2) < 1e-12 of a kernel's height for each value, so the error of a density is below
    1e-12 / (bandwidth * sqrt(2 pi)). The bandwidth shrinks with the number of values, so the
    work per value falls to a few points on wide data. All points are returned.
    """
    keys = list(by) or ["__all"]
    data = df.withColumn("__all", F.lit(0)).select(*keys, F.col(column).cast("double").alias("v")).where("v is not null")
    counted = data.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))
    stats = data.groupBy(*keys).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("sd")
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    table = stats.select(*keys, "lo", step.alias("step"), "n", (F.pow("n", F.lit(-0.2)) * F.col("sd")).alias("h"))
    reach = F.col("h") * REACH
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - reach - F.col("lo")) / F.col("step")).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((F.col("v") + reach - F.col("lo")) / F.col("step")).cast("int"))
    near = counted.join(table, keys).where(F.col("step") > 0).withColumns({"first": first, "last": last}).where("first <= last")
    parts = near.select(*keys, "v", "c", "lo", "step", "h", F.explode(F.sequence("first", "last")).alias("point"))
    z = (F.col("lo") + F.col("step") * F.col("point") - F.col("v")) / F.col("h")
    sums = parts.groupBy(*keys, "point").agg(F.sum(F.col("c") * F.exp(z * z * -0.5)).alias("s"))
    grid = table.select(*keys, "lo", "step", "n", "h", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    same = F.col("g.point") == F.col("s.point")
    for k in keys:
        same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}"))
    curve = F.try_divide(F.coalesce("s.s", F.lit(0.0)), F.col("g.n") * F.col("g.h") * F.sqrt(2 * F.pi()))
    x = F.col("g.lo") + F.col("g.step") * F.col("g.point")
    return grid.alias("g").join(sums.alias("s"), same, "left").select(*[F.col(f"g.{k}") for k in by], "g.point", x.alias("x"), curve.alias("density"))


def population_shift(df: DataFrame, column: str, is_current: Column, bins: int = 10) -> DataFrame:
    """Population stability per bin between a base and a current period.

    Bin edges come from the base period; values beyond it fall into the outer bins.
    Empty bins count as one millionth so that the logarithm stays defined.
    """
    data = df.select(F.col(column).cast("double").alias("v"), is_current.alias("cur")).where(
        "v is not null"
    )
    packed = (
        data.where("not cur").agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    )
    low, high = packed.getField("lo"), packed.getField("hi")
    raw = F.floor((F.col("v") - low) * bins / (high - low))
    bin_no = (
        F.when(high <= low, F.lit(0))
        .otherwise(F.greatest(F.lit(0), F.least(raw, F.lit(bins - 1))))
        .cast("int")
    )
    per_bin = data.groupBy(bin_no.alias("bin")).agg(
        F.count_if(~F.col("cur")).alias("base_n"), F.count_if("cur").alias("current_n")
    )
    # one row per bin: this window is as long as the list of bins
    everything = Window.partitionBy()
    floor_share = F.lit(1e-6)
    p = F.greatest(F.try_divide("base_n", F.sum("base_n").over(everything)), floor_share)
    q = F.greatest(F.try_divide("current_n", F.sum("current_n").over(everything)), floor_share)
    return per_bin.select("bin", "base_n", "current_n", ((q - p) * F.ln(q / p)).alias("psi"))


# -- monitoring ---------------------------------------------------------------
def drift(errors_per_hour: DataFrame, offline_mae: Column | float, ratio: float = DRIFT_RATIO) -> DataFrame:
    """Drift when the mean of hourly MAEs exceeds ``ratio`` times the offline MAE."""
    limit = (offline_mae if isinstance(offline_mae, Column) else F.lit(offline_mae)) * ratio
    return errors_per_hour.agg(F.avg("mae").alias("online_mae")).select(
        "online_mae",
        limit.alias("drift_limit"),
        (F.col("online_mae") > limit).cast("int").alias("is_drifting"),
    )


def latest_mean(df: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """Mean of columns over the rows of the newest timestamp."""
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) == newest).agg(*[F.avg(c).alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns of the newest row per key (partial maxima merge map-side)."""
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r"))
        .select(*keys, "r.*")
    )


def one_hot(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """One 0/1 column per given level, all levels kept; the other columns pass through."""
    return df.select(
        *[c for c in df.columns if c != column],
        *[F.coalesce(F.col(column) == v, F.lit(False)).cast("int").alias(f"{column}_{v}") for v in levels],
    )
