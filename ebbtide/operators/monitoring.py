"""Coverage, drift and control limits of scoring batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import ratio
from ebbtide.operators.prepare import align_categories, category_schema, numeric_value
from ebbtide.operators.rank import exact_quantiles, ranked


def _missing(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], name: str) -> DataFrame:
    def share(c: str) -> Column:
        text = F.col(c).cast("string")
        bad = numeric_value(c).isNull() if c in numeric else (text.isNull() | (text == ""))
        return ratio(F.count_if(bad), F.count("*")).alias(c)

    columns = [*numeric, *categories]
    return df.agg(*[share(c) for c in columns]).unpivot([], columns, "feature", name)


def coverage(
    batch: DataFrame, reference: DataFrame, numeric: Sequence[str], categories: Sequence[str]
) -> DataFrame:
    """Missing share per feature in the batch and the reference, and the share of unseen levels."""
    aligned = align_categories(batch, category_schema(reference, categories), categories)
    unknown = aligned.agg(
        *[ratio(F.count_if(F.col(c).isNull()), F.count("*")).alias(c) for c in categories]
    ).unpivot([], list(categories), "feature", "unknown_share")
    return (
        _missing(batch, numeric, categories, "missing_share")
        .join(_missing(reference, numeric, categories, "reference_missing_share"), "feature")
        .join(unknown, "feature", "left")
    )


def _binned(df: DataFrame, columns: Sequence[str], edges: Column, name: str) -> DataFrame:
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    long = long.withColumn("_edges", F.element_at(edges, F.col("feature")))
    value = F.col("value")
    bin_no = F.when(value.isNull() | F.isnan(value), -1).otherwise(
        F.size(F.filter("_edges", lambda e: e < value))
    )
    return (
        long.groupBy("feature", bin_no.alias("bin"))
        .agg(F.count("*").alias(f"_{name}"))
        .withColumn(f"_{name}_total", F.sum(f"_{name}").over(Window.partitionBy("feature")))
    )


def drift(
    batch: DataFrame, reference: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-4
) -> DataFrame:
    """Population stability index per feature over the reference's quantile bins.

    Missing values form a bin of their own, and empty bins count as ``floor``.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = (
        exact_quantiles(reference, columns, inner)
        .groupBy("column")
        .agg(F.array_sort(F.collect_set("value")).alias("edges"))
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "edges"))))
        .scalar()
    )
    both = _binned(reference, columns, edges, "was").join(
        _binned(batch, columns, edges, "now"), ["feature", "bin"], "full"
    )

    def filled(name: str) -> Column:
        return F.greatest(
            F.coalesce(ratio(F.col(f"_{name}"), F.col(f"_{name}_total")), F.lit(0.0)), F.lit(floor)
        )

    now, was = filled("now"), filled("was")
    return both.groupBy("feature").agg(F.sum((now - was) * F.log(now / was)).alias("psi"))


def run_metrics(batches: DataFrame, run_col: str, id_col: str, date_col: str) -> DataFrame:
    """Rows, repeated ids and freshest feature date per scoring run."""
    per_id = batches.groupBy(run_col, id_col).agg(
        F.count("*").alias("_n"), F.max(date_col).alias("_latest")
    )
    return per_id.groupBy(F.col(run_col).alias("run_id")).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.date_format(F.max("_latest"), "yyyyMMdd").alias("latest_feature_date"),
    )


def decile_counts(batches: DataFrame, run_col: str, decile_col: str = "risk_decile") -> DataFrame:
    """Rows per scoring run and decile."""
    return batches.groupBy(F.col(run_col).alias("run_id"), F.col(decile_col).alias("decile")).agg(F.count("*").alias("decile_rows"))


def _decile_alerts(numbered: DataFrame, deciles: DataFrame, max_shift: float) -> DataFrame:
    """``run_id`` and whether a decile's share of the run moved, or a decile appeared or went, since the run before."""
    counts = deciles.join(numbered.select("run_id", "rows", "_no"), "run_id")
    shares = counts.select("_no", "decile", ratio(F.col("decile_rows"), F.col("rows")).alias("_share"))
    before = shares.select((F.col("_no") + 1).alias("_no"), "decile", F.col("_share").alias("_was"))
    both = shares.join(before, (shares["_no"] == before["_no"]) & shares["decile"].eqNullSafe(before["decile"]), "full")
    moved = F.coalesce(F.abs(F.col("_share") - F.col("_was")) > max_shift, F.lit(True))
    per_run = both.select(F.coalesce(shares["_no"], before["_no"]).alias("_no"), moved.alias("_moved")).groupBy("_no").agg(F.max("_moved").alias("_moved"))
    return numbered.join(per_run, "_no", "left").select("run_id", (F.coalesce("_moved", F.lit(False)) & (F.col("_no") > 1)).alias("decile_alert"))


def control_limits(
    runs: DataFrame, max_change: float = 0.5, deciles: DataFrame | None = None, max_decile_shift: float = 0.05
) -> DataFrame:
    """Compare every run with the one before it and flag volume, duplicates and stale features.

    ``runs`` has one row per scoring run. With ``deciles`` (see :func:`decile_counts`) a column ``decile_alert`` tells
    runs in which the share of a decile moved by more than ``max_decile_shift`` or a decile came or went.
    Runs are numbered by a distributed rank and joined to the one before by number.
    """
    numbered = ranked(runs, [F.col("run_id")], rank="_no", total="_runs").drop("_runs")
    before = numbered.select((F.col("_no") + 1).alias("_no"), F.col("rows").alias("_before"), F.col("latest_feature_date").alias("_seen"))
    rows = F.col("rows")
    change = F.try_divide((rows - F.col("_before")).cast("double"), F.col("_before").cast("double"))
    out = numbered.join(before, "_no", "left").select(
        "run_id",
        "rows",
        "duplicate_rows",
        "latest_feature_date",
        change.alias("row_change"),
        F.coalesce(F.abs(change) > max_change, F.lit(False)).alias("volume_alert"),
        (F.col("duplicate_rows") > 0).alias("duplicate_alert"),
        F.coalesce(F.col("latest_feature_date") <= F.col("_seen"), F.lit(False)).alias("freshness_alert"),
    )
    return out if deciles is None else out.join(_decile_alerts(numbered, deciles, max_decile_shift), "run_id")
