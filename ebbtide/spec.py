"""Names, windows, features and texts shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# The input contract, thresholds and texts that results must carry.

ID = "msno"
LABEL = "is_churn"

TRANSACTION_COLUMNS = (
    "msno",
    "payment_method_id",
    "payment_plan_days",
    "plan_list_price",
    "actual_amount_paid",
    "is_auto_renew",
    "transaction_date",
    "membership_expire_date",
    "is_cancel",
)

LOG_COUNTERS = ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq")
LOG_SECONDS = "total_secs"

MEMBER_COLUMNS = (
    "msno",
    "city",
    "bd",
    "gender",
    "registered_via",
    "registration_init_time",
)

SECONDS_PER_DAY = 86_400
EXTREME_SECONDS = 1_000_000_000
AGE_RANGE = (13, 100)
SCORE_EPSILON = 1e-6
RARE_LEVEL_ROWS = 20
UNKNOWN_LEVEL = "Unknown"

NUMERIC_FEATURES = (
    "age",
    "tenure_months_at_cutoff",
    "log_rows_last_month",
    "listening_secs_last3",
    "listening_secs_prev3",
    "listening_secs_last6",
    "completed_plays_last3",
    "daily_unique_song_sum_last3",
    "active_months_last3",
    "active_months_prev3",
    "log_rows_history",
    "transactions_last_month",
    "transactions_last3",
    "transactions_prev3",
    "transactions_history",
    "paid_amount_last3",
    "auto_renew_count_last3",
    "cancel_count_last3",
    "weighted_avg_plan_days_last3",
)
CATEGORICAL_FEATURES = ("city", "gender", "registered_via")

QUEUE_SIGNALS = (
    "cancel_count_last3",
    "auto_renew_count_last3",
    "transactions_last_month",
    "paid_amount_last3",
    "listening_secs_last3",
)

# Highest decile of each band; deciles past the last cut get the rest label.
BAND_CUTS = (("High", 1), ("Elevated", 2), ("Moderate", 6))
BAND_CUTS_WIDE = (("High", 1), ("Elevated", 3), ("Moderate", 6))
BAND_REST = "Low"


@dataclass(frozen=True)
class ActionTexts:
    cancellation: str
    renewal: str
    adoption: str
    personal: str


BATCH_ACTIONS = ActionTexts(
    cancellation="Review cancellation activity; contact to understand the issue and offer a relevant resolution.",
    renewal="Check expiry and renewal status; send a timely reminder. Troubleshoot payment only if an issue is confirmed.",
    adoption="Consider a product-adoption check-in; inactivity alone should not trigger an expensive intervention.",
    personal="Personalized retention review; check recent account context.",
)
REVIEW_ACTIONS = ActionTexts(
    cancellation="Review cancellation activity; use customer-success outreach to understand the issue and offer a relevant resolution.",
    renewal="Check renewal timing and payment/auto-renew status; send a timely reminder and troubleshoot only if an issue is confirmed.",
    adoption="Offer a product-adoption check-in; do not use inactivity alone as the trigger.",
    personal="Personalized retention check-in; review recent account context.",
)


@dataclass(frozen=True)
class SignalBand:
    """One banded signal: exact values get a label, everything else the rest label."""

    signal: str
    band_column: str
    column: str
    labels: tuple[tuple[int, str], ...]
    rest: str


SIGNALS = (
    SignalBand("Auto-renew transactions, last 3 months", "auto_renew_band",
               "auto_renew_count_last3", ((0, "0"), (1, "1")), "2+"),
    SignalBand("Cancellation transactions, last 3 months", "cancel_band",
               "cancel_count_last3", ((0, "0"),), "1+"),
    SignalBand("Listening activity, last month", "activity_band",
               "log_rows_last_month", ((0, "No listening logs last month"),),
               "Listening logs last month"),
    SignalBand("Transaction activity, last month", "transaction_band",
               "transactions_last_month", ((0, "No transaction last month"),),
               "Transaction last month"),
    SignalBand("Payment recorded, last 3 months", "payment_band",
               "paid_amount_last3", ((0, "No recorded payment last 3 months"),),
               "Payment recorded last 3 months"),
    SignalBand("Listening seconds, last 3 months", "listening_band",
               "listening_secs_last3", ((0, "No listening seconds last 3 months"),),
               "Listening seconds last 3 months"),
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Cohort:
    """A labelled population and the month (``yyyyMM``) its subscriptions expire in."""

    name: str
    target: str


DEFAULT_COHORTS = (Cohort("train", "201702"), Cohort("train_v2", "201703"))


@dataclass(frozen=True)
class Window:
    """Months ``[T - start, T - stop)`` before the target month T; no start means all history."""

    start: int | None
    stop: int = 0


LAST1 = Window(1)
LAST3 = Window(3)
PREV3 = Window(6, 3)
LAST6 = Window(6)
HISTORY = Window(None)


@dataclass(frozen=True)
class Feature:
    """A point-in-time feature over a customer-month table.

    ``kind``: ``sum`` adds up ``column``; ``periods`` counts the distinct months
    in which ``column`` is positive; ``weighted`` averages ``column`` by ``weight``.
    """

    name: str
    column: str
    window: Window
    kind: str = "sum"
    dtype: str = "bigint"
    weight: str | None = None


USAGE_FEATURES = (
    Feature("log_rows_last_month", "log_rows", LAST1),
    Feature("listening_secs_last3", "total_secs_clean", LAST3, dtype="double"),
    Feature("listening_secs_prev3", "total_secs_clean", PREV3, dtype="double"),
    Feature("listening_secs_last6", "total_secs_clean", LAST6, dtype="double"),
    Feature("completed_plays_last3", "num_100", LAST3),
    Feature("daily_unique_song_sum_last3", "num_unq", LAST3),
    Feature("active_months_last3", "log_rows", LAST3, kind="periods"),
    Feature("active_months_prev3", "log_rows", PREV3, kind="periods"),
    Feature("log_rows_history", "log_rows", HISTORY),
)

TRANSACTION_FEATURES = (
    Feature("transactions_last_month", "transaction_count", LAST1),
    Feature("transactions_last3", "transaction_count", LAST3),
    Feature("transactions_prev3", "transaction_count", PREV3),
    Feature("transactions_history", "transaction_count", HISTORY),
    Feature("paid_amount_last3", "paid_amount_sum", LAST3, dtype="double"),
    Feature("auto_renew_count_last3", "auto_renew_count", LAST3),
    Feature("cancel_count_last3", "cancel_count", LAST3),
    Feature("weighted_avg_plan_days_last3", "avg_plan_days", LAST3,
            kind="weighted", dtype="double", weight="transaction_count"),
)
