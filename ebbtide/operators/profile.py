"""Audits of raw sources before anything is built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import is_finite, real
from ebbtide.spec import ID, SECONDS_PER_DAY, Cohort

PERIOD_LENGTH = {"year": 4, "month": 6, "day": 8}


def _eight_digits(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text.rlike("^[0-9]{8}$"), text)


def date_coverage(df: DataFrame, date_col: str) -> DataFrame:
    """All rows, and the first and last value among those with eight digits."""
    day = _eight_digits(F.col(date_col))
    return df.agg(
        F.count("*").alias("rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )


def rows_by_period(df: DataFrame, date_col: str, grain: str = "month") -> DataFrame:
    """Rows per year, month or day among eight-digit dates, in order."""
    day = _eight_digits(F.col(date_col))
    return (
        df.select(F.substring(day, 1, PERIOD_LENGTH[grain]).alias("period"))
        .where(F.col("period").isNotNull())
        .groupBy("period")
        .agg(F.count("*").alias("rows"))
        .orderBy("period")
    )


def tagged_union(sources: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Named tables stacked with their name in ``source``."""
    parts = [df.select(F.lit(name).alias("source"), *columns) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def date_range_by_source(sources: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Rows and the range of each date column per source, over values of length eight.

    Every source is aggregated on its own without a grouping key, because minima
    of text per key would make Spark sort all rows.
    """
    aggregates = [F.count("*").alias("rows")]
    for c in columns:
        value = F.when(F.length(c) == 8, F.col(c))
        aggregates += [F.min(value).alias(f"min_{c}"), F.max(value).alias(f"max_{c}")]
    parts = [df.agg(*aggregates).select(F.lit(name).alias("source"), "*") for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def cohort_ids(labels: Mapping[str, DataFrame], id_col: str = ID) -> DataFrame:
    """Distinct non-missing customers over all label tables."""
    return tagged_union(labels, [id_col]).select(id_col).dropna().distinct()


def cohort_sizes(labels: Mapping[str, DataFrame], id_col: str = ID) -> DataFrame:
    """Label rows and distinct customers per label table."""
    return (
        tagged_union(labels, [id_col])
        .groupBy("source")
        .agg(F.count("*").alias("label_rows"), F.count_distinct(id_col).alias("customers"))
    )


def expiry_match(
    sources: Mapping[str, DataFrame],
    labels: Mapping[str, DataFrame],
    cohorts: Sequence[Cohort],
    id_col: str = ID,
    expiry_col: str = "membership_expire_date",
) -> DataFrame:
    """How many customers of each cohort have an expiry in its target month, per source.

    Transactions are first reduced to one row per source, customer and expiry
    date in a target month, so the join moves neither raw rows nor a customer
    with very many.
    """
    members = reduce(
        lambda a, b: a.unionByName(b),
        [
            labels[c.name].select(
                id_col, F.lit(c.name).alias("cohort"), F.lit(c.target).alias("_month")
            )
            for c in cohorts
        ],
    ).dropna(subset=[id_col]).distinct()
    reduced = (
        tagged_union(sources, [id_col, expiry_col])
        .withColumn("_month", F.substring(expiry_col, 1, 6))
        .where(F.col("_month").isin([c.target for c in cohorts]))
        .groupBy("source", id_col, "_month", expiry_col)
        .agg(F.count("*").alias("_rows"))
    )
    matched = (
        members.join(reduced, [id_col, "_month"])
        .groupBy("cohort", "source")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.count_distinct(id_col).alias("_matched"),
            F.min(expiry_col).alias("min_expiry"),
            F.max(expiry_col).alias("max_expiry"),
        )
    )
    sizes = (
        members.groupBy("cohort")
        .agg(F.count("*").alias("cohort_size"))
        .select("*", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
    )
    found = F.coalesce("_matched", F.lit(0))
    return sizes.join(matched, ["cohort", "source"], "left").select(
        "cohort",
        "source",
        F.coalesce("_rows", F.lit(0)).alias("matching_rows"),
        found.alias("matched_customers"),
        (F.col("cohort_size") - found).alias("unmatched_customers"),
        "min_expiry",
        "max_expiry",
    )


def _suspicious(value: Column, low: float, high: float) -> Column:
    return ~is_finite(value) | (value < low) | (value > high)


def value_anomalies(
    sources: Mapping[str, DataFrame],
    column: str,
    ids: DataFrame,
    id_col: str = ID,
    low: float = 0.0,
    high: float = SECONDS_PER_DAY,
) -> DataFrame:
    """Rows, cohort rows, finite range and counts of bad values, per source.

    Rows are reduced to one per source and customer before the customers are
    compared with the cohort.
    """
    value = real(F.col(column))
    finite = is_finite(value)
    per_customer = (
        tagged_union(sources, [id_col, column])
        .groupBy("source", id_col)
        .agg(
            F.count("*").alias("_rows"),
            F.min(F.when(finite, value)).alias("_min"),
            F.max(F.when(finite, value)).alias("_max"),
            F.count_if(finite & (value < low)).alias("_low"),
            F.count_if(finite & (value > high)).alias("_high"),
            F.count_if(~finite).alias("_bad"),
        )
        .join(ids.select(id_col).distinct().withColumn("_member", F.lit(True)), id_col, "left")
    )

    def in_cohort(c: str) -> Column:
        return F.when(F.col("_member"), F.col(c))

    def cohort_sum(c: str) -> Column:
        return F.coalesce(F.sum(in_cohort(c)), F.lit(0))

    return per_customer.groupBy("source").agg(
        F.sum("_rows").alias("rows"),
        cohort_sum("_rows").alias("cohort_rows"),
        F.min(in_cohort("_min")).alias("min_value"),
        F.max(in_cohort("_max")).alias("max_value"),
        cohort_sum("_low").alias("below_low"),
        cohort_sum("_high").alias("above_high"),
        cohort_sum("_bad").alias("non_finite"),
    )


def anomaly_examples(
    sources: Mapping[str, DataFrame],
    column: str,
    ids: DataFrame,
    date_col: str = "date",
    id_col: str = ID,
    low: float = 0.0,
    high: float = SECONDS_PER_DAY,
    n: int = 20,
) -> DataFrame:
    """The first ``n`` suspicious rows of each source by customer and date, numbered.

    No more than ``n`` rows of one customer can be among them, so each task first
    keeps ``n`` rows per customer and, after the cohort test, ``n`` per source:
    Spark applies both limits before it shuffles.
    """
    order = [F.col(date_col).asc_nulls_first(), F.col(column).asc_nulls_first()]
    per_customer = Window.partitionBy("source", id_col).orderBy(*order)
    per_source = Window.partitionBy("source").orderBy(id_col, *order)
    bad = (
        tagged_union(sources, [id_col, date_col, column])
        .where(_suspicious(real(F.col(column)), low, high))
        .withColumn("example", F.row_number().over(per_customer))
        .where(F.col("example") <= n)
        .drop("example")
        .join(ids.select(id_col).distinct(), id_col, "left_semi")
    )
    return bad.withColumn("example", F.row_number().over(per_source)).where(F.col("example") <= n)


def unreadable_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that are present but not numbers, per column."""
    counts = [
        F.count_if(F.col(c).isNotNull() & real(F.col(c)).isNull()).alias(c) for c in columns
    ]
    return df.agg(*counts).unpivot([], list(columns), "column", "unreadable")
