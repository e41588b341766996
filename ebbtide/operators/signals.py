"""Descriptive churn rates by banded signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.spec import LABEL, SIGNALS, SignalBand


def band_of(signal: SignalBand) -> Column:
    """The band label; missing and negative values fall into the rest band."""
    (value, label), *others = signal.labels
    chain = F.when(F.col(signal.column) == value, label)
    for value, label in others:
        chain = chain.when(F.col(signal.column) == value, label)
    return chain.otherwise(signal.rest)


def signal_bands(snapshot: DataFrame, signals: Sequence[SignalBand] = SIGNALS) -> DataFrame:
    return snapshot.select("*", *[band_of(s).alias(s.band_column) for s in signals])


def signal_rates(
    snapshot: DataFrame, signals: Sequence[SignalBand] = SIGNALS, label_col: str = LABEL
) -> DataFrame:
    """Customers, churners and churn rate per cohort, signal and band, in one pass.

    Customers are first counted per combination of bands, so the rows fanned out
    per signal are the few combinations, not the customers.
    """
    bands = [s.band_column for s in signals]
    combinations = (
        snapshot.select("cohort", label_col, *[band_of(s).alias(s.band_column) for s in signals])
        .groupBy("cohort", *bands)
        .agg(
            F.count("*").alias("_n"),
            F.sum(label_col).alias("_churners"),
            F.count(label_col).alias("_labelled"),
        )
    )
    pairs = F.array(
        *[F.struct(F.lit(s.signal).alias("signal"), F.col(s.band_column).alias("band")) for s in signals]
    )
    return (
        combinations.select("cohort", "_n", "_churners", "_labelled", F.inline(pairs))
        .groupBy("cohort", "signal", "band")
        .agg(
            F.sum("_n").alias("customers"),
            F.sum("_churners").alias("churners"),
            F.try_divide(F.sum("_churners"), F.sum("_labelled")).alias("churn_rate"),
        )
        .orderBy("signal", "cohort", "band")
    )
