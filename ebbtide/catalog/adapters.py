"""The engine's input tables expressed over the driver's order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import rollup
from ebbtide.spec import Cohort

COHORTS = (Cohort("early", "200001"), Cohort("late", "200007"))
MORE_CUTOFFS = (
    Cohort("m1", "199907"), Cohort("m2", "200001"), Cohort("m3", "200004"), Cohort("m4", "200007"),
)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def _day(c) -> F.Column:
    return F.date_format(c, "yyyyMMdd")


def customer_id(c: str) -> F.Column:
    return F.col(c).cast("string").alias("msno")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan_days = (F.col("o_orderkey") % 3 + 1) * 30
    flag = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        customer_id("o_custkey"),
        F.col("o_orderpriority").alias("payment_method_id"),
        plan_days.cast("string").alias("payment_plan_days"),
        F.col("o_totalprice").cast("string").alias("plan_list_price"),
        F.when(F.col("o_orderkey") % 10 == 0, "0")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("actual_amount_paid"),
        F.when(flag == "F", "1").otherwise("0").alias("is_auto_renew"),
        F.when(F.col("o_orderkey") % 211 == 0, "20001399")
        .otherwise(_day("o_orderdate"))
        .alias("transaction_date"),
        _day(F.date_add(F.to_date("o_orderdate"), plan_days.cast("int"))).alias("membership_expire_date"),
        F.when((flag == "P") & (F.col("o_orderpriority") == "5-LOW"), "1").otherwise("0").alias("is_cancel"),
        F.to_date("o_orderdate").alias("_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two transaction files that overlap by two months."""
    tx = _orders(spark, sf_dir)
    return {
        "v1": tx.where(F.col("_date") < F.lit("2000-08-01").cast("date")).drop("_date"),
        "v2": tx.where(F.col("_date") >= F.lit("2000-06-01").cast("date")).drop("_date"),
    }


def stacked_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.stack_events(*transactions(spark, sf_dir).values())


def distinct_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.dedupe_events(*transactions(spark, sf_dir).values())


def _cohort_flags(cohort: Cohort) -> tuple[F.Column, F.Column]:
    """Whether a customer ordered before the target month, and in the year from it."""
    cutoff = F.lit(f"{cohort.target[:4]}-{cohort.target[4:]}-01").cast("date")
    day = F.to_date("o_orderdate")
    return F.max(day < cutoff), F.max((day >= cutoff) & (day < F.add_months(cutoff, 12)))


def labels(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers with an order before the target month; churned without one in the following year."""
    orders = table(spark, sf_dir, "orders")
    out = {}
    for c in COHORTS:
        before, after = _cohort_flags(c)
        out[c.name] = (
            orders.groupBy(customer_id("o_custkey"))
            .agg(before.alias("_before"), after.alias("_after"))
            .where("_before")
            .select("msno", F.when(F.col("_after"), "0").otherwise("1").alias("is_churn"))
        )
    return out


def cohort_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stacked labels of both cohorts from a single pass over the orders."""
    per_cohort = []
    for c in COHORTS:
        before, after = _cohort_flags(c)
        per_cohort.append(
            F.struct(
                F.lit(c.name).alias("cohort"),
                F.lit(c.target).alias("target_expiry_month"),
                F.when(after, 0).otherwise(1).alias("is_churn"),
                before.alias("_before"),
            )
        )
    customers = table(spark, sf_dir, "orders").groupBy(customer_id("o_custkey"))
    rows = customers.agg(F.array(*per_cohort).alias("_rows")).select("msno", F.inline("_rows"))
    return rows.where("_before").drop("_before")


def logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two daily log files without overlap; seconds are often missing, negative, huge or infinite."""
    lines = table(spark, sf_dir, "lineitem")
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key, price = F.col("l_orderkey"), F.col("l_extendedprice")
    seconds = (
        F.when(key % 101 == 0, float("nan"))
        .when(key % 97 == 0, -price)
        .when(key % 89 == 0, None)
        .when(key % 83 == 0, float("inf"))
        .otherwise(price)
    )
    line, third = F.col("l_linenumber"), F.col("l_linenumber") % 3
    all_logs = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        customer_id("o_custkey"),
        _day("l_shipdate").alias("date"),
        line.alias("num_25"),
        third.alias("num_50"),
        third.alias("num_75"),
        third.alias("num_985"),
        F.col("l_quantity").cast("int").alias("num_100"),
        line.alias("num_unq"),
        seconds.alias("total_secs"),
        F.to_date("l_shipdate").alias("_date"),
    )
    split = F.lit("2000-07-01").cast("date")
    return {
        "v1": all_logs.where(F.col("_date") < split).drop("_date"),
        "v2": all_logs.where(F.col("_date") >= split).drop("_date"),
    }


def all_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = logs(spark, sf_dir)
    return parts["v1"].unionByName(parts["v2"])


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        _day(F.min("o_orderdate")).alias("registration_init_time")
    )
    customers = table(spark, sf_dir, "customer")
    fourth = F.col("c_custkey") % 4
    return customers.join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        customer_id("c_custkey"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.floor(F.col("c_acctbal") / 90).cast("string").alias("bd"),
        F.when(fourth == 0, None).when(fourth == 1, "").otherwise(F.col("c_mktsegment")).alias("gender"),
        (F.col("c_custkey") % 5).cast("string").alias("registered_via"),
        "registration_init_time",
    )


def planted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a score that carries a known signal."""
    return cohort_labels(spark, sf_dir).select(
        "msno",
        "cohort",
        "is_churn",
        ((F.col("msno").cast("bigint") * 7919 % 1000 + F.col("is_churn") * 400) / F.lit(1400.0)).alias("risk_score"),
    )


def tied_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a score built from order counts, which has very few distinct values."""
    orders = table(spark, sf_dir, "orders").select(
        customer_id("o_custkey"), F.to_date("o_orderdate").alias("_date")
    )
    counted = cohort_labels(spark, sf_dir)
    cutoff = F.to_date(F.concat("target_expiry_month", F.lit("01")), "yyyyMMdd")
    monthly = orders.groupBy("msno", F.trunc("_date", "month").alias("_month")).agg(F.count("*").alias("_n"))
    before = F.when(F.col("_month") < cutoff, F.col("_n")).otherwise(0)
    year = F.when(
        (F.col("_month") < cutoff) & (F.col("_month") >= F.add_months(cutoff, -12)), F.col("_n")
    ).otherwise(0)
    return (
        counted.join(monthly, "msno")
        .groupBy("msno", "cohort", "is_churn")
        .agg(F.sum(before).alias("_h"), F.sum(year).alias("_l12"))
        .select(
            "msno", "cohort", "is_churn",
            (F.lit(1.0) / (F.col("_h") + F.col("_l12") * 2 + 1)).alias("risk_score"),
        )
    )
