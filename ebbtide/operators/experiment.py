"""Randomised outreach: assignment within routes, effect and balance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import ratio
from ebbtide.operators.prepare import shuffle_key
from ebbtide.operators.rank import hexadecimal, ranked
from ebbtide.spec import ID, LABEL, ActionTexts
from ebbtide.operators.queue import suggested_action

ROUTES = ActionTexts(
    cancellation="cancellation", renewal="renewal", adoption="other", personal="other"
)
TREATMENT, CONTROL = "treatment", "control"
Z_95 = 1.959963984540054


def action_route() -> Column:
    """Route of a customer by the same ordered rules as the suggested action."""
    return suggested_action(ROUTES)


def assign_arms(
    customers: DataFrame, seed: int | str = 42, id_col: str = ID, previous: DataFrame | None = None
) -> DataFrame:
    """One-to-one treatment and control within each route.

    New customers alternate arms in a seeded pseudo-random order of their ids.
    Customers in ``previous`` keep their arm whatever their route is now.
    """
    new = customers
    if previous is not None:
        new = customers.join(previous.select(id_col), id_col, "left_anti")
    mixed = ranked(
        new.withColumn("_mix", shuffle_key(id_col, seed)),
        [hexadecimal(F.col("_mix")), F.col(id_col)],
        ["route"],
        rank="_place",
    )
    drawn = mixed.withColumn("arm", F.when(F.col("_place") % 2 == 1, TREATMENT).otherwise(CONTROL)).select(
        *customers.columns, "arm"
    )
    if previous is None:
        return drawn
    kept = customers.join(previous.select(id_col, "arm"), id_col)
    return drawn.unionByName(kept.select(*customers.columns, "arm"))


def itt_effect(assigned: DataFrame, label: str = LABEL) -> DataFrame:
    """Treatment minus control churn with a 95 % normal interval, per route and overall.

    Customers count in the arm they were assigned to.
    """
    per_route = assigned.groupBy("route", "arm").agg(
        F.count("*").alias("_n"), F.sum(label).alias("_churned")
    )
    levels = F.explode(F.array(F.col("route"), F.lit("all")))
    def arm_sum(column: str, arm: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("arm") == arm, F.col(column))), F.lit(0))

    sides = (
        per_route.select(levels.alias("route"), "arm", "_n", "_churned")
        .groupBy("route")
        .agg(
            arm_sum("_n", TREATMENT).alias("treatment_customers"),
            arm_sum("_n", CONTROL).alias("control_customers"),
            ratio(arm_sum("_churned", TREATMENT), arm_sum("_n", TREATMENT)).alias("treatment_rate"),
            ratio(arm_sum("_churned", CONTROL), arm_sum("_n", CONTROL)).alias("control_rate"),
        )
    )

    def variance(rate: str, n: str) -> Column:
        return F.try_divide(F.col(rate) * (1 - F.col(rate)), F.col(n).cast("double"))

    difference = F.col("treatment_rate") - F.col("control_rate")
    margin = F.lit(Z_95) * F.sqrt(
        variance("treatment_rate", "treatment_customers") + variance("control_rate", "control_customers")
    )
    return sides.select(
        "*",
        difference.alias("difference"),
        (difference - margin).alias("ci_low"),
        (difference + margin).alias("ci_high"),
    ).orderBy("route")


def balance_check(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Customers per arm and the treatment share for each value of each column."""
    counts = assigned.groupBy(*columns, "arm").agg(F.count("*").alias("_n"))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("characteristic"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    treated = F.coalesce(F.sum(F.when(F.col("arm") == TREATMENT, F.col("_n"))), F.lit(0))
    return (
        counts.select(F.inline(pairs), "arm", "_n")
        .groupBy("characteristic", "value")
        .agg(
            treated.alias("treatment_customers"),
            (F.sum("_n") - treated).alias("control_customers"),
            ratio(treated, F.sum("_n")).alias("treatment_share"),
        )
        .orderBy("characteristic", "value")
    )
