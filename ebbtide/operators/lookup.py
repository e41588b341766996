"""Joining a large table to a derived lookup table whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import durable

BROADCAST_ROWS = 200_000
SALTS = 64


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """The table as a local relation if it has at most ``max_rows`` rows, else None.

    Never fetches more than ``max_rows + 1`` rows. A local relation also pins the
    values, so later reads cannot see a different result.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join that treats NULL keys as equal.

    A lookup within ``max_rows`` is broadcast. A larger one is joined by shuffle,
    with every lookup row repeated once per salt, so that a key carrying a large
    part of ``df`` is spread over ``SALTS`` tasks. The salt depends on the row and
    its input partition only: it is the same when a task runs again, and equal
    rows from different partitions still part.
    """
    small = bounded(lookup, max_rows)
    return _joined(df, lookup if small is None else small, on, small is not None)


def attach_each(
    df: DataFrame,
    stacked: DataFrame,
    columns: Sequence[str],
    feature: str = "feature",
    level: str = "level",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace each column by the value that a stacked lookup (feature, level, value) has for it, else NULL.

    The lookup is looked at once for all columns; the columns then share its rows, or its stored copy if it is large.
    """
    (value,) = [c for c in stacked.columns if c not in (feature, level)]
    small = bounded(stacked, max_rows)
    source = durable(stacked) if small is None else small
    out = df
    for c in columns:
        own = source.where(F.col(feature) == c).select(F.col(level).alias(c), F.col(value).alias("_value"))
        out = _joined(out, own, [c], small is not None).withColumn(c, F.col("_value")).drop("_value")
    return out


def _joined(df: DataFrame, lookup: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    values = [c for c in lookup.columns if c not in on]
    renamed = lookup.select(*[F.col(k).alias(f"_k_{k}") for k in on], *values)
    if small:
        match = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in on]
        return df.join(F.broadcast(renamed), match, "left").select(*df.columns, *values)
    hashable = [F.col(c) for c, kind in df.dtypes if "map<" not in kind]
    mixed = F.xxhash64(*hashable, F.spark_partition_id())
    salted = df.withColumn("_salt", F.pmod(mixed, F.lit(SALTS)).cast("int"))
    copies = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match = [salted[k].eqNullSafe(copies[f"_k_{k}"]) for k in on]
    match.append(salted["_salt"] == copies["_copy"])
    return salted.join(copies, match, "left").select(*df.columns, *values)
