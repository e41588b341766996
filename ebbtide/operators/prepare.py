"""Model inputs: cleaning, category levels, exact splits, imputation and scaling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import is_finite, ratio, real
from ebbtide.operators.lookup import attach, attach_each, bounded
from ebbtide.operators.rank import exact_quantiles, ranked
from ebbtide.session import durable
from ebbtide.spec import (
    CATEGORICAL_FEATURES,
    ID,
    LABEL,
    NUMERIC_FEATURES,
    RARE_LEVEL_ROWS,
    UNKNOWN_LEVEL,
)

INFREQUENT_LEVEL = "infrequent"
#: Hexadecimal digits of a hash, digits that one histogram looks at, and rows that one task may order.
HASH_DIGITS, RADIX_DIGITS, RADIX_ROWS = 32, 3, 100_000


def numeric_value(column: str) -> Column:
    """A single-precision number as double, NULL if it is missing, not a number or infinite."""
    value = real(F.col(column)).cast("float").cast("double")
    usable = is_finite(value)
    if column == "tenure_months_at_cutoff":
        usable = usable & (value >= 0)
    return F.when(usable, value)


def prepare_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    return df.withColumns({c: numeric_value(c) for c in columns})


def category_value(column: str, unknown: str = UNKNOWN_LEVEL) -> Column:
    text = F.col(column).cast("string")
    return F.when(text.isNull() | (text == ""), unknown).otherwise(text)


def prepare_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    return df.withColumns({c: category_value(c) for c in columns})


def _levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per feature and prepared level."""
    return (
        df.select(*[category_value(c).alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "level")
        .groupBy("feature", "level")
        .agg(F.count("*").alias("rows"))
    )


def category_schema(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Every prepared level of each feature with its 0-based place in sorted order."""
    placed = ranked(
        _levels(df, columns).select("feature", "level"), [F.col("level")], ["feature"]
    )
    return placed.select("feature", "level", (F.col("rank") - 1).cast("int").alias("position"))


def align_categories(
    df: DataFrame, schema: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES
) -> DataFrame:
    """Prepared categories restricted to the levels of a stored schema; unseen ones become NULL."""
    known = schema.where(F.col("feature").isin(list(columns))).select("feature", "level", F.col("level").alias("known"))
    return attach_each(prepare_categories(df, columns), known, columns)


def shuffle_key(id_col: str, seed: int | str) -> Column:
    """A repeatable pseudo-random ordering of ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _quotas(sizes: DataFrame, wanted: Column, by: str) -> DataFrame:
    """Whole rows per class adding up to ``wanted``, by largest remainder."""
    everything = Window.partitionBy()
    exact = F.col("_n") * wanted / F.sum("_n").over(everything)
    shares = sizes.select(
        by, "_n", F.floor(exact).alias("_base"), (exact - F.floor(exact)).alias("_rest"), wanted.alias("_wanted")
    )
    place = F.row_number().over(Window.orderBy(F.col("_rest").desc(), F.col(by).asc()))
    left_over = F.col("_wanted") - F.sum("_base").over(everything)
    return shares.select(
        by, (F.col("_base") + F.when(place <= left_over, 1).otherwise(0)).cast("bigint").alias("_quota")
    )


def _held(df: DataFrame) -> DataFrame:
    """The rows as they are now: local if they are few, else stored."""
    small = bounded(df)
    return durable(df) if small is None else small


def _histogram(rows: DataFrame, by: Sequence[str], depth: int) -> DataFrame:
    digits = F.substring("_mix", depth + 1, RADIX_DIGITS).alias("_digits")
    return _held(rows.groupBy(*by, digits).agg(F.count("*").alias("_n")))


def _ends(counts: DataFrame, label: str) -> DataFrame:
    """Per class the digits in which its first ``_left`` rows end, and how many of these are left there."""
    up_to = Window.partitionBy(label).orderBy("_digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_to") - F.col("_n")
    ends = counts.withColumn("_to", F.sum("_n").over(up_to)).where((F.col("_to") >= F.col("_left")) & (before < F.col("_left")))
    found = ends.select(label, F.concat("_prefix", "_digits").alias("_prefix"), (F.col("_left") - before).alias("_left"), "_n")
    return _held(found)


def _pick(df: DataFrame, wanted: Callable[[Column], Column], label: str, id_col: str, seed: int | str) -> DataFrame:
    """Mark the first rows of each class in a seeded order of the ids, ``wanted`` (of the number of rows) altogether.

    Radix selection: a histogram of the next digits of the hashes finds the stretch in which a class's quota ends, scan by
    scan, until it holds few rows; only those are ordered. The rows themselves are marked by a filter, and none moves.
    """
    rows = df.select(label, shuffle_key(id_col, seed).alias("_mix"), F.col(id_col).alias("_id"))
    counts = _histogram(rows, [label], 0)
    sizes = counts.groupBy(label).agg(F.sum("_n").alias("_n"))
    quotas = _quotas(sizes, wanted(F.sum("_n").over(Window.partitionBy())), label).select(
        F.col(label).alias("_class"), F.lit("").alias("_prefix"), F.col("_quota").alias("_left")
    )
    state = _ends(counts.join(quotas, F.col(label).eqNullSafe(F.col("_class"))).drop("_class"), label)
    depth = RADIX_DIGITS

    def near() -> DataFrame:
        return attach(rows, state, [label]).where(F.substring("_mix", 1, depth) == F.col("_prefix"))

    while depth < HASH_DIGITS and (state.agg(F.max("_n")).first()[0] or 0) > RADIX_ROWS:
        state = _ends(_histogram(near(), [label, "_prefix", "_left"], depth), label)
        depth += RADIX_DIGITS
    placed = near().withColumn("_place", F.row_number().over(Window.partitionBy(label).orderBy("_mix", "_id")))
    last = placed.where(F.col("_place") == F.col("_left")).select(label, F.col("_mix").alias("_last_mix"), F.col("_id").alias("_last_id"))
    ended = attach(df.withColumn("_mix", shuffle_key(id_col, seed)), last, [label])
    picked = F.col("_last_mix").isNotNull() & (F.struct("_mix", F.col(id_col)) <= F.struct("_last_mix", "_last_id"))
    return ended.withColumn("_picked", picked).drop("_mix", "_last_mix", "_last_id")


def stratified_split(
    df: DataFrame, test_share: float = 0.2, seed: int | str = 42, label: str = LABEL, id_col: str = ID
) -> DataFrame:
    """Mark rows ``train`` or ``test`` in column ``split`` with exact sizes and class shares.

    The test part has ``ceil(test_share * n)`` rows. The training rows of each
    class are the first ones in a seeded pseudo-random order of the ids, so the
    split does not depend on partitioning. Ids have to be unique within a class: rows
    that share one fall on the same side.
    """
    picked = _pick(df, lambda n: n - F.ceil(F.lit(float(test_share)) * n.cast("double")), label, id_col, seed)
    return picked.withColumn("split", F.when(F.col("_picked"), "train").otherwise("test")).drop("_picked")


def stratified_sample(
    df: DataFrame, n: int, seed: int | str = 42, label: str = LABEL, id_col: str = ID
) -> DataFrame:
    """``min(n, rows)`` rows with the class shares of the input."""
    picked = _pick(df, lambda rows: F.least(F.lit(n).cast("bigint"), rows), label, id_col, seed)
    return picked.where("_picked").drop("_picked")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``n / (classes * n_class)`` per class."""
    everything = Window.partitionBy()
    return (
        df.groupBy(label)
        .agg(F.count("*").alias("_n"))
        .select(
            label,
            F.col("_n").alias("customers"),
            ratio(F.sum("_n").over(everything), F.count("*").over(everything) * F.col("_n")).alias("weight"),
        )
    )


def balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows with the weight of their class."""
    return attach(df, class_weights(df, label).select(label, "weight"), [label])


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of the non-missing values; None for a column without any."""
    found = {r["column"]: r["value"] for r in exact_quantiles(df, columns, [0.5]).collect()}
    return {c: found.get(c) for c in columns}


def incomplete_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def indicator_name(column: str) -> str:
    return f"{column}_missing"


def impute(df: DataFrame, fill: Mapping[str, float | None], flagged: Sequence[str]) -> DataFrame:
    """Fill missing values and add a 0/1 indicator for the flagged columns."""
    flags = {indicator_name(c): F.when(F.col(c).isNull(), 1.0).otherwise(0.0) for c in flagged}
    values = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items() if v is not None}
    return df.withColumns(flags).withColumns(values)


def median_impute(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill with the medians of ``fit_on`` (default: the data itself) and flag its incomplete columns."""
    source = df if fit_on is None else fit_on
    return impute(df, medians(source, columns), incomplete_columns(source, columns))


def population_std(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    return {c: (row[c] or 1.0) for c in columns}


def scale_std(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Divide by the population standard deviation, without centring; constants stay as they are."""
    std = population_std(df if fit_on is None else fit_on, columns)
    return df.withColumns({c: F.col(c) / F.lit(float(std[c])) for c in columns})


def level_map(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, min_rows: int = RARE_LEVEL_ROWS
) -> DataFrame:
    """Levels with their row count and the level used for modelling; rare ones share one."""
    return _levels(df, columns).withColumn(
        "model_level",
        F.when(F.col("rows") < min_rows, INFREQUENT_LEVEL).otherwise(F.col("level")),
    )


def group_rare_levels(
    df: DataFrame,
    columns: Sequence[str] = CATEGORICAL_FEATURES,
    min_rows: int = RARE_LEVEL_ROWS,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Replace levels by their modelling level; a level never seen in fitting becomes NULL."""
    levels = level_map(df if fit_on is None else fit_on, columns, min_rows).select("feature", "level", "model_level")
    return attach_each(prepare_categories(df, columns), levels, columns)
