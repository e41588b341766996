"""Point-in-time feature rows: nothing from the target month or later is ever used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as SqlWindow
from pyspark.sql import functions as F

from ebbtide.functions.scalars import month_start, months_crossed, parse_day, ratio, shift_month
from ebbtide.operators.rollup import member_attributes
from ebbtide.spec import (
    AGE_RANGE,
    ID,
    LABEL,
    TRANSACTION_FEATURES,
    USAGE_FEATURES,
    Cohort,
    Feature,
    Window,
)

TARGET = "target_expiry_month"


def in_window(month: Column, target: Column, window: Window) -> Column:
    """Whether a ``yyyyMM`` month lies in a window before the target month."""
    end = target if window.stop == 0 else shift_month(target, -window.stop)
    inside = month < end
    if window.start is not None:
        inside = inside & (month >= shift_month(target, -window.start))
    return inside


def _with_bounds(anchors: DataFrame, features: Sequence[Feature]) -> tuple[DataFrame, list[str]]:
    """Anchors with the window bounds worked out once per anchor, not once per month row."""
    steps = sorted(
        {s for f in features for s in (f.window.start, f.window.stop) if s}
    )
    names = [f"_t{s}" for s in steps]
    return anchors.select(
        "*", *[shift_month(F.col(TARGET), -s).alias(n) for s, n in zip(steps, names)]
    ), names


def _inside(window: Window) -> Column:
    month = F.col("month")
    end = F.col(f"_t{window.stop}") if window.stop else F.col(TARGET)
    inside = month < end
    return inside if window.start is None else inside & (month >= F.col(f"_t{window.start}"))


def _products(features: Sequence[Feature]) -> dict[str, Column]:
    return {
        f"_{f.column}_x_{f.weight}": F.col(f.column) * F.col(f.weight)
        for f in features
        if f.kind == "weighted"
    }


def activity(table: DataFrame, features: Sequence[Feature], id_col: str = ID) -> DataFrame:
    """The columns of a customer-month table that the features read, summed to one row per month."""
    products = _products(features)
    columns = list(dict.fromkeys([f.column for f in features if f.kind != "weighted"]
                                 + [f.weight for f in features if f.weight]))
    periods = {f.column for f in features if f.kind == "periods"}
    return table.select(
        id_col,
        "month",
        *columns,
        *[p.alias(n) for n, p in products.items()],
        *[(F.col(c) > 0).alias(f"_{c}_active") for c in periods],
    )


def _one_row_per_month(rows: DataFrame, id_col: str) -> DataFrame:
    measures = [c for c in rows.columns if c not in (id_col, "month")]
    flags = {c for c in measures if c.endswith("_active")}
    # A given number of partitions is never merged: many buffers are open at once in the tasks that follow, each of them
    # a multiple of what the task reads.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, id_col).groupBy(id_col, "month").agg(
        *[(F.max(c) if c in flags else F.sum(c)).alias(c) for c in measures]
    )


def _windowed(features: Sequence[Feature], copies: Column) -> list[Column]:
    """One conditional aggregate per feature, over rows that are unique per month."""
    out = []
    for f in features:
        inside = _inside(f.window)
        if f.kind == "periods":
            value = F.count_if(inside & F.col(f"_{f.column}_active"))
        elif f.kind == "weighted":
            product, weight = F.col(f"_{f.column}_x_{f.weight}"), F.col(f.weight)
            # A month without an average still counts in the divisor, and months
            # outside the window make an otherwise missing numerator zero.
            value = ratio(
                F.sum(F.when(inside, product).when(weight.isNotNull(), 0.0)),
                F.sum(F.when(inside, weight)),
            )
        else:
            zero = F.lit(0).cast(f.dtype)
            value = F.sum(F.when(inside, F.col(f.column)).otherwise(zero)) * copies
        out.append(value.cast(f.dtype).alias(f.name))
    return out


def period_features(
    anchors: DataFrame,
    table: DataFrame,
    features: Sequence[Feature],
    id_col: str = ID,
    before: str | None = None,
) -> DataFrame:
    """Features per ``(customer, cohort)`` from one customer-month table.

    A customer with two labels in a cohort has two anchor rows, and sums then
    count that customer's months twice. ``before`` is a literal upper month, for
    pruning the scan when the cutoffs are known.
    """
    rows = activity(table.where(F.col("month") < before) if before else table, features, id_col)
    keyed, bounds = _with_bounds(
        anchors.groupBy(id_col, "cohort", TARGET).agg(F.count("*").alias("_copies")), features
    )
    months = _one_row_per_month(rows, id_col)
    joined = keyed.join(
        months, (keyed[id_col] == months[id_col]) & (months["month"] < keyed[TARGET]), "left"
    ).drop(months[id_col])
    return (
        joined.groupBy(id_col, "cohort", TARGET, "_copies", *bounds)
        .agg(*_windowed(features, F.col("_copies")))
        .select(id_col, "cohort", *[f.name for f in features])
    )


def usage_features(anchors: DataFrame, usage: DataFrame, id_col: str = ID, before: str | None = None) -> DataFrame:
    return period_features(anchors, usage, USAGE_FEATURES, id_col, before)


def transaction_features(anchors: DataFrame, tx: DataFrame, id_col: str = ID, before: str | None = None) -> DataFrame:
    return period_features(anchors, tx, TRANSACTION_FEATURES, id_col, before)


def clean_age(age: Column, low: int = AGE_RANGE[0], high: int = AGE_RANGE[1]) -> Column:
    return F.when(age.between(low, high), age)


def tenure_months(registered: Column, target: Column) -> Column:
    """Month boundaries from registration to the cutoff; negative if registered later."""
    return months_crossed(parse_day(registered), month_start(target))


def build_snapshot(
    anchors: DataFrame,
    usage: DataFrame,
    tx: DataFrame,
    members: DataFrame,
    id_col: str = ID,
    label_col: str = LABEL,
    before: str | None = None,
) -> DataFrame:
    """One feature row per anchor, from usage, transactions and members.

    Usage and transaction months are stacked into one table, so there is a single
    join and a single aggregation. Everything is partitioned by customer once: the
    month roll-up, the join with the anchors, the features and the join with the
    members reuse it. Monthly tables hold a bounded number of rows per customer,
    so that partitioning cannot be skewed by raw activity.
    """
    features = [*USAGE_FEATURES, *TRANSACTION_FEATURES]
    if before:
        usage, tx = usage.where(F.col("month") < before), tx.where(F.col("month") < before)
    rows = activity(usage, USAGE_FEATURES, id_col).unionByName(
        activity(tx, TRANSACTION_FEATURES, id_col), allowMissingColumns=True
    )
    months = _one_row_per_month(rows, id_col)
    base = anchors.select(id_col, "cohort", TARGET, "anchor_expiry_date", label_col)
    keyed, bounds = _with_bounds(base, features)
    joined = keyed.join(
        months, (keyed[id_col] == months[id_col]) & (months["month"] < keyed[TARGET]), "left"
    ).drop(months[id_col])
    copies = F.count("*").over(SqlWindow.partitionBy(id_col, "cohort"))
    measured = (
        joined.groupBy(*base.columns, *bounds)
        .agg(*_windowed(features, F.lit(1)))
        .withColumn("_copies", copies)
    )
    attributes = member_attributes(members, id_col)

    def filled(f: Feature) -> Column:
        value = F.col(f.name)
        if f.kind == "weighted":
            return value
        if f.kind == "sum":
            value = value * F.col("_copies")
        return F.coalesce(value, F.lit(0).cast(f.dtype)).alias(f.name)

    return measured.join(attributes, id_col, "left").select(
        *base.columns,
        clean_age(F.col("bd")).alias("age"),
        "city",
        "gender",
        "registered_via",
        tenure_months(F.col("registration_init_time"), F.col(TARGET)).alias("tenure_months_at_cutoff"),
        *[filled(f) for f in features],
    )


def cutoff_anchors(
    ids: DataFrame, cutoffs: Sequence[Cohort], tx: DataFrame, id_col: str = ID, labels: DataFrame | None = None
) -> DataFrame:
    """Every customer at every cutoff, for backfilling many months in one run.

    The label is NULL unless ``labels`` (with ``cohort`` and a label) has it.
    """
    from ebbtide.operators.rollup import cohort_anchors

    points = F.array(
        *[F.struct(F.lit(c.name).alias("cohort"), F.lit(c.target).alias(TARGET)) for c in cutoffs]
    )
    grid = ids.select(id_col).distinct().select(id_col, F.inline(points))
    if labels is None:
        grid = grid.withColumn(LABEL, F.lit(None).cast("int"))
    else:
        grid = grid.join(labels.select(id_col, "cohort", LABEL), [id_col, "cohort"], "left")
    return cohort_anchors(grid, tx, id_col)


def multi_cutoff_snapshot(
    ids: DataFrame,
    cutoffs: Sequence[Cohort],
    usage: DataFrame,
    tx_events: DataFrame,
    tx_monthly: DataFrame,
    members: DataFrame,
    id_col: str = ID,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Snapshots at any number of cutoffs from one pass over the monthly tables."""
    anchors = cutoff_anchors(ids, cutoffs, tx_events, id_col, labels)
    return build_snapshot(
        anchors, usage, tx_monthly, members, id_col, before=max(c.target for c in cutoffs)
    )
