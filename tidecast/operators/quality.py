"""Data-quality rules: filters, funnel, null profile, imputation, assertions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.scalars import no_nan
from tidecast.operators.quantiles import approx_quantiles, exact_quantiles

Rule = tuple[str, Column]


# -- filters ------------------------------------------------------------------
def between_ts(col: Column | str, start, end, closed: str = "left") -> Column:
    """Time range predicate; with literal bounds it is pushed into the Parquet scan.

    ``closed`` is ``left`` (half-open, the safe choice for adjoining periods) or ``both``.
    """
    col = F.col(col) if isinstance(col, str) else col
    if closed == "both":
        return (col >= start) & (col <= end)
    if closed == "left":
        return (col >= start) & (col < end)
    raise ValueError(f"closed must be 'left' or 'both', not {closed}")


def lookback(col: Column | str, now: Column, hours: int) -> Column:
    """Rows of the last ``hours`` hours up to and including ``now``."""
    return between_ts(col, now - F.make_dt_interval(F.lit(0), F.lit(hours)), now, closed="both")


def mark_either_in(
    df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str, name: str
) -> DataFrame:
    """Boolean column ``name``: some of ``columns`` holds a key of the dimension ``keys``.

    One marker join per column keeps the dimension free to grow: Spark broadcasts
    it while it is under its own size limit and falls back to a shuffle join
    beyond it.
    """
    out, marks = df, []
    for i, column in enumerate(columns):
        side = keys.select(F.col(key).alias(f"__key_{i}")).distinct().withColumn(f"__in_{i}", F.lit(True))
        out = out.join(side, F.col(column) == F.col(f"__key_{i}"), "left").drop(f"__key_{i}")
        marks.append(f"__in_{i}")
    return out.withColumn(name, F.coalesce(*marks, F.lit(False))).drop(*marks)


def either_in(df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str) -> DataFrame:
    """Rows where at least one of ``columns`` holds a key of the dimension."""
    return mark_either_in(df, columns, keys, key, "__either").where("__either").drop("__either")


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column."""
    return df.withColumns(
        {
            f.name: no_nan(f.name).cast(f.dataType)
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


# -- funnel -------------------------------------------------------------------
def rules_passed(rules: Sequence[Rule], then: Column | int = 0) -> Column:
    """Number of ordered rules that a row passes before the first one it fails; ``then`` more if it fails none."""
    passes = F.lit(len(rules)) + then
    for i, (_, rule) in reversed(list(enumerate(rules))):
        passes = F.when(F.coalesce(rule, F.lit(False)), passes).otherwise(F.lit(i))
    return passes


def quality_funnel(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows left after each ordered rule, and the share of all rows, in one scan.

    Result: ``(step, rule, rows, retention_pct)`` with step 0 for the input.
    """
    return funnel_of(df, rules_passed(rules), [name for name, _ in rules])


def funnel_of(df: DataFrame, passes: Column, names: Sequence[str]) -> DataFrame:
    """:func:`quality_funnel` of rows whose number of passed rules is known."""
    per_stop = df.select(passes.alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    counts = per_stop.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("p") >= i, F.col("n"))), F.lit(0)).alias(f"r{i}")
            for i in range(len(names) + 1)
        ]
    )
    steps = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("rule"),
            F.col(f"r{i}").alias("rows"),
        )
        for i, name in enumerate(["input", *names])
    ]
    return counts.select("r0", F.explode(F.array(*steps)).alias("s")).select(
        "s.step",
        "s.rule",
        "s.rows",
        F.round(F.try_divide(F.col("s.rows") * 100.0, F.col("r0")), 4).alias("retention_pct"),
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return reduce(lambda d, rule: d.where(rule[1]), rules, df)


# -- null profile -------------------------------------------------------------
def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, data_type, n_rows, n_null, null_pct)`` for every column, one scan."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("data_type"),
                F.col(f"n{i}").alias("n_null"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counted.select("n_rows", F.explode(rows).alias("c")).select(
        "c.column",
        "c.data_type",
        "n_rows",
        "c.n_null",
        F.round(F.try_divide(F.col("c.n_null") * 100.0, F.col("n_rows")), 4).alias("null_pct"),
    )


def drop_all_null(df: DataFrame, probe_rows: int = 1000, few: DataFrame | None = None) -> DataFrame:
    """Drop columns without a single value.

    The schema depends on the data, so this runs here: most columns show a value in a few rows, and only
    the others are looked for in the whole table, in a scan of these columns alone. ``few`` may give any rows
    of ``df`` that cost less than its first ones, which take all of its joins; columns it lacks are looked for
    in the whole table.
    """

    def without_value(frame: DataFrame, columns: list[str]) -> list[str]:
        counts = frame.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first()
        return [c for c in columns if counts[c] == 0]

    few = df.limit(probe_rows) if few is None else few
    seen = [c for c in df.columns if c in few.columns]
    empty = set(without_value(few, seen) if seen else [])
    unseen = [c for c in df.columns if c in empty or c not in seen]
    if not unseen:
        return df
    # rows without any of them are left out first: a column that is null by its expression then reads nothing
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in unseen])
    return df.drop(*without_value(df.select(*unseen).where(some), unseen))


# -- imputation ---------------------------------------------------------------
def medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """One row with the median of each column under its own name (null without values)."""
    found = (exact_quantiles if exact else approx_quantiles)(df, columns, [0.5])
    return found.agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(c) for c in columns])


def impute_median(
    df: DataFrame, columns: Sequence[str], basis: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    """NULL -> median of the column over ``basis`` (default: ``df`` itself).

    The medians - one row - are a scalar sub-query of the plan, so nothing runs before the query does.
    ``exact=False`` takes them from a sketch with a rank error of n / 10,000.
    """
    found = medians(df if basis is None else basis, columns, exact).select(F.struct(*columns)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), found.getField(c)) for c in columns})


# -- assertions ---------------------------------------------------------------
class ExpectationError(ValueError):
    """A data expectation does not hold."""


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, n_violations)``: rows that do not satisfy each rule, one scan."""
    counted = df.agg(
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"v{i}")
            for i, (_, rule) in enumerate(rules)
        ]
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("n_violations"))
        for i, (name, _) in enumerate(rules)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def expect(df: DataFrame, rules: Sequence[Rule], allow_empty: bool = False) -> DataFrame:
    """Return ``df`` unchanged, or raise when it is empty or a rule is violated."""
    checked = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"v{i}")
            for i, (_, rule) in enumerate(rules)
        ],
    ).first()
    if checked["n"] == 0 and not allow_empty:
        raise ExpectationError("no rows")
    broken = {name: checked[f"v{i}"] for i, (name, _) in enumerate(rules) if checked[f"v{i}"]}
    if broken:
        raise ExpectationError(f"violated rules: {broken}")
    return df


def coverage(df: DataFrame, ts: str, expected_start: Column, expected_end: Column) -> DataFrame:
    """Observed range of ``ts`` and whether it covers the expected range."""
    return df.agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")).select(
        "first_seen",
        "last_seen",
        (
            (F.col("first_seen") <= expected_start) & (F.col("last_seen") >= expected_end)
        ).cast("int").alias("covers"),
    )
