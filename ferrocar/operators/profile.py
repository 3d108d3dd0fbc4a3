"""Data profiling: counts, completeness and summaries, each in one pass."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrocar.functions import text


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def existing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def with_suffix(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def value_counts(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    """Rows per value, most frequent first."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def _per_column(df: DataFrame, columns: Sequence[str], out: str, stat) -> DataFrame:
    return df.agg(*[stat(F.col(f"`{c}`")).alias(c) for c in columns]).unpivot(
        [], [F.col(f"`{c}`") for c in columns], "column", out
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column."""
    return _per_column(df, columns or df.columns, "nulls", lambda c: F.count_if(c.isNull()))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of present values per column, in percent."""
    return _per_column(
        df, columns or df.columns, "pct", lambda c: F.try_divide(F.count(c), F.count(F.lit(1))) * 100.0
    )


def describe_series(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per bounded series."""
    quarters = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        quarters.alias("_q"),
        F.max(value).alias("max"),
    )
    q = F.col("_q")
    return out.select(
        *keys, "count", "mean", "std", "min", q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max"
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def removed_by(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, and the difference, in one pass."""
    kept = F.count_if(keep)
    total = F.count(F.lit(1))
    return df.agg(total.alias("before"), kept.alias("after"), (total - kept).alias("removed"))


def catalogue_summary(listings: DataFrame) -> DataFrame:
    """Listings, brands and brand-model pairs.

    Distinct counts run over the grouped pairs, which is far less than the listings.
    """
    pairs = listings.groupBy("brand", "model").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.sum("n").alias("cars"),
        F.count_distinct("brand").alias("brands"),
        F.count_distinct(text.brand_model_label(F.col("brand"), F.col("model"))).alias("models"),
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column, keep_null=False).limit(n)


def tail_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last rows by the given order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def extraction_rates(listings: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Share of extracted values per page, and over all pages where the key is missing."""
    rates = [
        (F.try_divide(F.count(c), F.count(F.lit(1))) * 100.0).alias(f"{c}_pct") for c in columns
    ]
    return listings.rollup(key).agg(F.count(F.lit(1)).alias("listings"), *rates)
