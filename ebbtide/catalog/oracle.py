"""DuckDB statements that state each registered query independently, over the same tables."""

from __future__ import annotations

import re

# Fixed values, written out here so that a wrong one elsewhere shows.
BATCH_TEXTS = (
    "Review cancellation activity; contact to understand the issue and offer a relevant resolution.",
    "Check expiry and renewal status; send a timely reminder. Troubleshoot payment only if an issue is confirmed.",
    "Consider a product-adoption check-in; inactivity alone should not trigger an expensive intervention.",
    "Personalized retention review; check recent account context.",
)
REVIEW_TEXTS = (
    "Review cancellation activity; use customer-success outreach to understand the issue and offer a relevant resolution.",
    "Check renewal timing and payment/auto-renew status; send a timely reminder and troubleshoot only if an issue is confirmed.",
    "Offer a product-adoption check-in; do not use inactivity alone as the trigger.",
    "Personalized retention check-in; review recent account context.",
)
BANDS = {
    "auto_renew_band": ("Auto-renew transactions, last 3 months",
        "CASE auto_renew_count_last3 WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '2+' END"),
    "cancel_band": ("Cancellation transactions, last 3 months", "CASE cancel_count_last3 WHEN 0 THEN '0' ELSE '1+' END"),
    "activity_band": ("Listening activity, last month",
        "CASE log_rows_last_month WHEN 0 THEN 'No listening logs last month' ELSE 'Listening logs last month' END"),
    "transaction_band": ("Transaction activity, last month",
        "CASE transactions_last_month WHEN 0 THEN 'No transaction last month' ELSE 'Transaction last month' END"),
    "payment_band": ("Payment recorded, last 3 months",
        "CASE paid_amount_last3 WHEN 0 THEN 'No recorded payment last 3 months' ELSE 'Payment recorded last 3 months' END"),
    "listening_band": ("Listening seconds, last 3 months",
        "CASE listening_secs_last3 WHEN 0 THEN 'No listening seconds last 3 months' ELSE 'Listening seconds last 3 months' END"),
}
BAND_COLUMNS = ", ".join(f"{case} AS {name}" for name, (_, case) in BANDS.items())

PLAN_DAYS = "30 * (1 + o_orderkey % 3)"


def _label_view(target: str) -> str:
    day = f"DATE '{target[:4]}-{target[4:]}-01'"
    return f"""
        SELECT CAST(o_custkey AS VARCHAR) AS msno,
               CASE WHEN COUNT(*) FILTER (WHERE o_orderdate >= {day}
                         AND o_orderdate < {day} + INTERVAL 12 MONTH) > 0 THEN '0' ELSE '1' END AS is_churn
        FROM orders GROUP BY o_custkey
        HAVING COUNT(*) FILTER (WHERE o_orderdate < {day}) > 0"""


USAGE_COUNTERS = ", ".join(
    f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq")
)
FINITE = "(total_secs IS NOT NULL AND isfinite(total_secs))"
CLEAN = f"CASE WHEN NOT {FINITE} OR total_secs < 0 THEN 0 WHEN total_secs > 86400 THEN 86400 ELSE total_secs END"
CLEAN_SUMS = f"""
    ROUND(CAST(SUM(CAST({CLEAN} AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_secs_clean,
    COUNT(*) FILTER (WHERE NOT {FINITE} OR total_secs < 0) AS invalid_secs_rows,
    COUNT(*) FILTER (WHERE {FINITE} AND total_secs > 86400) AS capped_secs_rows"""


def _month(start: int | None, alias: str, stop: int = 0) -> str:
    def back(n: int) -> str:
        return f"strftime(a.cutoff - INTERVAL {n} MONTH, '%Y%m')" if n else "a.target_expiry_month"

    low = f"{alias}.month >= {back(start)} AND " if start else ""
    return f"{low}{alias}.month < {back(stop)}"


def _sum(expression: str, condition: str, name: str, type_: str = "BIGINT") -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN {expression} ELSE 0 END) AS {type_}) AS {name}"


U1, U3, UP, U6, UH = (_month(1, "u"), _month(3, "u"), _month(6, "u", 3), _month(6, "u"), _month(None, "u"))
T1, T3, TP, TH = (_month(1, "t"), _month(3, "t"), _month(6, "t", 3), _month(None, "t"))

USAGE_FEATURES = f"""
    {_sum("u.log_rows", U1, "log_rows_last_month")},
    ROUND({_sum("CAST(u.total_secs_clean AS DECIMAL(18,2))", U3, "listening_secs_last3", "DOUBLE").replace(" AS listening_secs_last3", "")}, 2) AS listening_secs_last3,
    ROUND({_sum("CAST(u.total_secs_clean AS DECIMAL(18,2))", UP, "x", "DOUBLE").replace(" AS x", "")}, 2) AS listening_secs_prev3,
    ROUND({_sum("CAST(u.total_secs_clean AS DECIMAL(18,2))", U6, "x", "DOUBLE").replace(" AS x", "")}, 2) AS listening_secs_last6,
    {_sum("u.num_100", U3, "completed_plays_last3")},
    {_sum("u.num_unq", U3, "daily_unique_song_sum_last3")},
    COUNT(DISTINCT CASE WHEN {U3} AND u.log_rows > 0 THEN u.month END) AS active_months_last3,
    COUNT(DISTINCT CASE WHEN {UP} AND u.log_rows > 0 THEN u.month END) AS active_months_prev3,
    {_sum("u.log_rows", UH, "log_rows_history")}"""

TX_FEATURES = f"""
    {_sum("t.transaction_count", T1, "transactions_last_month")},
    {_sum("t.transaction_count", T3, "transactions_last3")},
    {_sum("t.transaction_count", TP, "transactions_prev3")},
    {_sum("t.transaction_count", TH, "transactions_history")},
    ROUND({_sum("CAST(t.paid_amount_sum AS DECIMAL(18,2))", T3, "x", "DOUBLE").replace(" AS x", "")}, 2) AS paid_amount_last3,
    {_sum("t.auto_renew_count", T3, "auto_renew_count_last3")},
    {_sum("t.cancel_count", T3, "cancel_count_last3")},
    ROUND(SUM(CASE WHEN {T3} THEN t.avg_plan_days * t.transaction_count ELSE 0 END)
          / NULLIF(SUM(CASE WHEN {T3} THEN t.transaction_count ELSE 0 END), 0), 6) AS weighted_avg_plan_days_last3"""

USAGE_NAMES = ("log_rows_last_month", "listening_secs_last3", "listening_secs_prev3", "listening_secs_last6",
               "completed_plays_last3", "daily_unique_song_sum_last3", "active_months_last3",
               "active_months_prev3", "log_rows_history")
TX_NAMES = ("transactions_last_month", "transactions_last3", "transactions_prev3", "transactions_history",
            "paid_amount_last3", "auto_renew_count_last3", "cancel_count_last3")


def _features(anchors: str, usage: str, tx: str, suffix: str) -> dict[str, str]:
    return {
        f"uf{suffix}": f"""
            SELECT a.msno, a.cohort, {USAGE_FEATURES}
            FROM {anchors} a LEFT JOIN {usage} u ON u.msno = a.msno AND u.month < a.target_expiry_month
            GROUP BY a.msno, a.cohort""",
        f"tf{suffix}": f"""
            SELECT a.msno, a.cohort, {TX_FEATURES}
            FROM {anchors} a LEFT JOIN {tx} t ON t.msno = a.msno AND t.month < a.target_expiry_month
            GROUP BY a.msno, a.cohort""",
        f"snap{suffix}": f"""
            SELECT a.msno, a.cohort, a.target_expiry_month, a.anchor_expiry_date, a.is_churn,
                CASE WHEN m.bd BETWEEN 13 AND 100 THEN m.bd END AS age, m.city, m.gender, m.registered_via,
                CAST((year(a.cutoff) - year(m.reg)) * 12 + month(a.cutoff) - month(m.reg) AS INTEGER)
                    AS tenure_months_at_cutoff,
                {", ".join(f"COALESCE(u.{n}, 0) AS {n}" for n in USAGE_NAMES)},
                {", ".join(f"COALESCE(t.{n}, 0) AS {n}" for n in TX_NAMES)},
                t.weighted_avg_plan_days_last3
            FROM {anchors} a LEFT JOIN uf{suffix} u USING (msno, cohort)
            LEFT JOIN tf{suffix} t USING (msno, cohort) LEFT JOIN member_rows m USING (msno)""",
    }


def _tx_monthly(source: str) -> str:
    return f"""
        SELECT msno, strftime(try_strptime(transaction_date, '%Y%m%d'), '%Y%m') AS month,
            COUNT(*) AS transaction_count,
            ROUND(CAST(SUM(CAST(actual_amount_paid AS DECIMAL(12,2))) AS DOUBLE), 2) AS paid_amount_sum,
            ROUND(CAST(SUM(CAST(plan_list_price AS DECIMAL(12,2))) AS DOUBLE), 2) AS list_price_sum,
            ROUND(AVG(CAST(payment_plan_days AS DOUBLE)), 6) AS avg_plan_days,
            COUNT(*) FILTER (WHERE is_auto_renew = '1') AS auto_renew_count,
            COUNT(*) FILTER (WHERE is_cancel = '1') AS cancel_count,
            COUNT(DISTINCT payment_method_id) AS payment_method_count
        FROM {source} WHERE try_strptime(transaction_date, '%Y%m%d') IS NOT NULL GROUP BY 1, 2"""


CUTOFFS = (("m1", "199907"), ("m2", "200001"), ("m3", "200004"), ("m4", "200007"))

VIEWS: dict[str, str] = {
    "tx_all": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS msno, o_orderpriority AS payment_method_id,
            CAST({PLAN_DAYS} AS VARCHAR) AS payment_plan_days, CAST(o_totalprice AS VARCHAR) AS plan_list_price,
            CASE WHEN o_orderkey % 10 = 0 THEN '0' ELSE CAST(o_totalprice AS VARCHAR) END AS actual_amount_paid,
            CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS is_auto_renew,
            CASE WHEN o_orderkey % 211 = 0 THEN '20001399' ELSE strftime(o_orderdate, '%Y%m%d') END AS transaction_date,
            strftime(CAST(o_orderdate AS DATE) + CAST({PLAN_DAYS} AS INTEGER), '%Y%m%d') AS membership_expire_date,
            CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '1' ELSE '0' END AS is_cancel,
            CAST(o_orderdate AS DATE) AS day
        FROM orders""",
    "tx_v1": "SELECT * EXCLUDE (day) FROM tx_all WHERE day < DATE '2000-08-01'",
    "tx_v2": "SELECT * EXCLUDE (day) FROM tx_all WHERE day >= DATE '2000-06-01'",
    "tx_sources": "SELECT 'v1' AS source, * FROM tx_v1 UNION ALL SELECT 'v2' AS source, * FROM tx_v2",
    "tx": "SELECT * FROM tx_v1 UNION SELECT * FROM tx_v2",
    "lbl_early": _label_view("200001"),
    "lbl_late": _label_view("200007"),
    "cohort_rows": """
        SELECT msno, 'early' AS cohort, '200001' AS target_expiry_month, CAST(is_churn AS INTEGER) AS is_churn FROM lbl_early
        UNION ALL
        SELECT msno, 'late' AS cohort, '200007' AS target_expiry_month, CAST(is_churn AS INTEGER) AS is_churn FROM lbl_late""",
    "id_rows": "SELECT msno FROM lbl_early UNION SELECT msno FROM lbl_late",
    "log_rows_all": """
        SELECT CAST(o_custkey AS VARCHAR) AS msno, strftime(l_shipdate, '%Y%m%d') AS date,
            l_linenumber AS num_25, l_linenumber % 3 AS num_50, l_linenumber % 3 AS num_75,
            l_linenumber % 3 AS num_985, CAST(l_quantity AS INTEGER) AS num_100, l_linenumber AS num_unq,
            CASE WHEN l_orderkey % 101 = 0 THEN CAST('nan' AS DOUBLE)
                 WHEN l_orderkey % 97 = 0 THEN -l_extendedprice
                 WHEN l_orderkey % 89 = 0 THEN NULL
                 WHEN l_orderkey % 83 = 0 THEN CAST('inf' AS DOUBLE)
                 ELSE l_extendedprice END AS total_secs,
            CASE WHEN l_shipdate < DATE '2000-07-01' THEN 'v1' ELSE 'v2' END AS source
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "usage_raw": f"""
        SELECT msno, substr(date, 1, 6) AS month, {USAGE_COUNTERS},
            ROUND(COALESCE(SUM(CASE WHEN NOT isnan(total_secs) THEN total_secs END), 0), 2) AS total_secs, COUNT(*) AS log_rows
        FROM log_rows_all GROUP BY 1, 2""",
    "usage_raw_cohort": "SELECT * FROM usage_raw WHERE msno IN (SELECT msno FROM id_rows)",
    "usage_clean_all": f"""
        SELECT msno, substr(date, 1, 6) AS month, {USAGE_COUNTERS}, COUNT(*) AS log_rows, {CLEAN_SUMS}
        FROM log_rows_all GROUP BY 1, 2""",
    "usage_clean": "SELECT * FROM usage_clean_all WHERE msno IN (SELECT msno FROM id_rows)",
    "txm_all": _tx_monthly("tx"),
    "txm": "SELECT * FROM txm_all WHERE msno IN (SELECT msno FROM id_rows)",
    "anchor_rows": """
        SELECT c.msno, c.cohort, c.target_expiry_month, c.is_churn,
            MAX(CASE WHEN strftime(try_strptime(t.membership_expire_date, '%Y%m%d'), '%Y%m') = c.target_expiry_month
                     THEN t.membership_expire_date END) AS anchor_expiry_date,
            strptime(c.target_expiry_month || '01', '%Y%m%d') AS cutoff
        FROM cohort_rows c LEFT JOIN tx t ON c.msno = t.msno GROUP BY ALL""",
    "member_raw": """
        SELECT CAST(c_custkey AS VARCHAR) AS msno, CAST(c_nationkey AS VARCHAR) AS city,
            CAST(CAST(floor(c_acctbal / 90) AS BIGINT) AS VARCHAR) AS bd,
            CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE c_mktsegment END AS gender,
            CAST(c_custkey % 5 AS VARCHAR) AS registered_via, f.registration_init_time
        FROM customer LEFT JOIN (
            SELECT o_custkey, strftime(MIN(o_orderdate), '%Y%m%d') AS registration_init_time
            FROM orders GROUP BY o_custkey) f ON c_custkey = o_custkey""",
    "member_rows": """
        SELECT msno, MAX(TRY_CAST(city AS INTEGER)) AS city, MAX(TRY_CAST(bd AS INTEGER)) AS bd,
            MAX(gender) AS gender, MAX(registered_via) AS registered_via,
            MAX(registration_init_time) AS registration_init_time,
            try_strptime(MAX(registration_init_time), '%Y%m%d') AS reg
        FROM member_raw GROUP BY msno""",
    **_features("anchor_rows", "usage_clean", "txm", ""),
    "grid": " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS VARCHAR) AS msno, '{n}' AS cohort, '{m}' AS target_expiry_month FROM customer"
        for n, m in CUTOFFS
    ),
    "grid_anchors": """
        SELECT c.msno, c.cohort, c.target_expiry_month, CAST(NULL AS INTEGER) AS is_churn,
            MAX(CASE WHEN substr(t.membership_expire_date, 1, 6) = c.target_expiry_month
                     THEN t.membership_expire_date END) AS anchor_expiry_date,
            strptime(c.target_expiry_month || '01', '%Y%m%d') AS cutoff
        FROM grid c LEFT JOIN tx t ON c.msno = t.msno GROUP BY ALL""",
    **_features("grid_anchors", "usage_clean_all", "txm_all", "_grid"),
    "planted": """
        SELECT msno, cohort, is_churn,
            (CAST(msno AS BIGINT) * 7919 % 1000 + 400 * is_churn) / CAST(1400 AS DOUBLE) AS risk_score
        FROM cohort_rows""",
    "tied": """
        SELECT c.msno, c.cohort, c.is_churn, CAST(1 AS DOUBLE) / (1
            + COUNT(*) FILTER (WHERE o_orderdate < strptime(c.target_expiry_month || '01', '%Y%m%d'))
            + 2 * COUNT(*) FILTER (WHERE o_orderdate < strptime(c.target_expiry_month || '01', '%Y%m%d')
                AND o_orderdate >= strptime(c.target_expiry_month || '01', '%Y%m%d') - INTERVAL 12 MONTH)) AS risk_score
        FROM cohort_rows c JOIN orders ON c.msno = CAST(o_custkey AS VARCHAR)
        GROUP BY c.msno, c.cohort, c.is_churn, c.target_expiry_month""",
    "late_planted": "SELECT msno, is_churn, risk_score FROM planted WHERE cohort = 'late'",
    "late_ranked": """
        SELECT *, row_number() OVER (ORDER BY risk_score DESC, msno) AS risk_rank, COUNT(*) OVER () AS ranked_customers
        FROM late_planted""",
    "late_deciles": """
        SELECT *, CAST(LEAST((risk_rank - 1) * 10 // ranked_customers + 1, 10) AS INTEGER) AS risk_decile
        FROM late_ranked""",
    "late_bands": """
        SELECT *, CASE WHEN risk_decile = 1 THEN 'High' WHEN risk_decile = 2 THEN 'Elevated'
            WHEN risk_decile <= 6 THEN 'Moderate' ELSE 'Low' END AS risk_band FROM late_deciles""",
    "two_models": """
        SELECT 'Boosted trees' AS model, CASE WHEN cohort = 'early' THEN 'Internal validation' ELSE 'Later cohort' END
            AS period, * FROM planted
        UNION ALL
        SELECT 'Logistic baseline', CASE WHEN cohort = 'early' THEN 'Internal validation' ELSE 'Later cohort' END, *
        FROM tied""",
}

VIEWS["isotonic_full"] = """
        WITH pts AS (SELECT risk_score AS x, AVG(is_churn) AS y, COUNT(*) AS w FROM planted WHERE cohort = 'early' GROUP BY 1),
        acc AS (SELECT x, row_number() OVER o AS i, SUM(w) OVER o AS cw, SUM(w * y) OVER o AS cy FROM pts
            WINDOW o AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
        spans AS (SELECT a.i AS a, b.i AS b,
                (b.cy - COALESCE(p.cy, 0)) / (b.cw - COALESCE(p.cw, 0)) AS mean
            FROM acc a JOIN acc b ON b.i >= a.i LEFT JOIN acc p ON p.i = a.i - 1),
        low AS (SELECT a, b, MIN(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS m FROM spans),
        fit AS (SELECT acc.x, MAX(low.m) AS v FROM low JOIN acc ON acc.i = low.b GROUP BY acc.x),
        near AS (SELECT s.msno, s.risk_score AS x, (SELECT MAX(x) FROM fit WHERE x <= s.risk_score) AS x0,
                (SELECT MIN(x) FROM fit WHERE x >= s.risk_score) AS x1 FROM late_planted s)
        SELECT n.msno, GREATEST(LEAST(
            CASE WHEN n.x0 IS NULL THEN g.v WHEN n.x1 IS NULL OR n.x0 = n.x1 THEN f.v
                 ELSE f.v + (g.v - f.v) * (n.x - n.x0) / (n.x1 - n.x0) END,
            CAST(0.999999 AS DOUBLE)), CAST(0.000001 AS DOUBLE)) AS calibrated_score
        FROM near n LEFT JOIN fit f ON f.x = n.x0 LEFT JOIN fit g ON g.x = n.x1"""
VIEWS["isotonic"] = "SELECT msno, ROUND(calibrated_score, 6) AS calibrated_score FROM isotonic_full"
SNAPSHOT_COLUMNS = "* EXCLUDE (target_expiry_month, anchor_expiry_date)"
VIEWS["late_snap"] = "SELECT * FROM snap WHERE cohort = 'late'"


def _curve(source: str, by: str, label: str = "is_churn", score: str = "risk_score") -> str:
    """Running positives and negatives per distinct score."""
    part = f"PARTITION BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"""
        SELECT {head}score, pos, neg,
            SUM(pos) OVER (w ROWS UNBOUNDED PRECEDING) AS cum_pos, SUM(neg) OVER (w ROWS UNBOUNDED PRECEDING) AS cum_neg,
            SUM(pos) OVER ({part}) AS total_pos, SUM(neg) OVER ({part}) AS total_neg
        FROM (SELECT {head}{score} AS score, COUNT(*) FILTER (WHERE {label} = 1) AS pos,
                     COUNT(*) FILTER (WHERE {label} = 0) AS neg FROM {source} GROUP BY {head}{score})
        WINDOW w AS ({part} ORDER BY score DESC)"""


AP = "ROUND(SUM(pos / CAST(total_pos AS DOUBLE) * cum_pos / (cum_pos + cum_neg)), 6) AS average_precision"
AUC = """ROUND(SUM(pos * (total_neg - cum_neg + neg / CAST(2 AS DOUBLE)))
         / (CAST(MAX(total_pos) AS DOUBLE) * MAX(total_neg)), 6) AS roc_auc"""
K10 = "GREATEST(1, CAST(ceil(CAST(0.1 AS DOUBLE) * COUNT(*)) AS BIGINT))"
VIEWS["curve"] = _curve("planted", "cohort")
VIEWS["curve_tied"] = _curve("tied", "cohort")
VIEWS["curve_models"] = _curve("two_models", "model, period")


def _kth(source: str, by: str) -> str:
    return f"""
        SELECT {by}, n AS customers, k, risk_score AS threshold FROM (
            SELECT {by}, risk_score, COUNT(*) OVER (PARTITION BY {by}) AS n,
                GREATEST(1, CAST(ceil(CAST(0.1 AS DOUBLE) * COUNT(*) OVER (PARTITION BY {by})) AS BIGINT)) AS k,
                row_number() OVER (PARTITION BY {by} ORDER BY risk_score DESC) AS rn FROM {source})
        WHERE rn = k"""


VIEWS["kth"] = _kth("planted", "cohort")
VIEWS["kth_models"] = _kth("(SELECT * FROM two_models WHERE period = 'Internal validation')", "model")


def _flag_metrics(pos: str, n: str, hit: str, called: str) -> str:
    return f"""
        ROUND({called} / CAST({n} AS DOUBLE), 6) AS flagged_share,
        ROUND(COALESCE({hit} / CAST(NULLIF({called}, 0) AS DOUBLE), 0), 6) AS precision,
        ROUND(COALESCE({hit} / CAST(NULLIF({pos}, 0) AS DOUBLE), 0), 6) AS recall,
        ROUND(COALESCE(({hit} / CAST(NULLIF({called}, 0) AS DOUBLE)) / NULLIF({pos} / CAST({n} AS DOUBLE), 0), 0), 6)
            AS lift_at_threshold"""


def _lift(source: str, by: str) -> str:
    return f"""
        SELECT {by}, "group", customers, churners, ROUND(churners / CAST(customers AS DOUBLE), 6) AS churn_rate,
            ROUND((churners / CAST(customers AS DOUBLE)) / (SUM(churners) OVER p / CAST(SUM(customers) OVER p AS DOUBLE)), 6) AS lift,
            CAST(SUM(customers) OVER w AS BIGINT) AS cumulative_customers,
            CAST(SUM(churners) OVER w AS BIGINT) AS cumulative_churners,
            ROUND(SUM(churners) OVER w / CAST(SUM(churners) OVER p AS DOUBLE), 6) AS cumulative_churn_recall
        FROM (SELECT {by}, "group", COUNT(*) AS customers, CAST(SUM(is_churn) AS BIGINT) AS churners FROM (
                SELECT *, CAST(LEAST((row_number() OVER (PARTITION BY {by} ORDER BY risk_score DESC, msno) - 1) * 10
                    // COUNT(*) OVER (PARTITION BY {by}) + 1, 10) AS INTEGER) AS "group" FROM {source})
              GROUP BY {by}, "group")
        WINDOW p AS (PARTITION BY {by}), w AS (PARTITION BY {by} ORDER BY "group" ROWS UNBOUNDED PRECEDING)"""


VIEWS["lift"] = _lift("planted", "cohort")
VIEWS["lift_models"] = _lift("two_models", "model, period")


def _bins(source: str) -> str:
    edges = ", ".join(
        f"(SELECT quantile_cont(risk_score, CAST({i} AS DOUBLE) / 10) FROM {source})" for i in range(11)
    )
    return f"""
        WITH e AS (SELECT DISTINCT edge FROM (SELECT unnest([{edges}]) AS edge)),
        b AS (SELECT s.is_churn, s.risk_score,
                     GREATEST(1, (SELECT COUNT(*) FROM e WHERE e.edge < s.risk_score)) AS bin FROM {source} s)
        SELECT CAST(bin AS INTEGER) AS bin, COUNT(*) AS customers, ROUND(AVG(risk_score), 6) AS mean_score,
               ROUND(AVG(is_churn), 6) AS observed_churn_rate FROM b GROUP BY bin"""


CLIP = "GREATEST(LEAST({0}, CAST(0.999999 AS DOUBLE)), CAST(0.000001 AS DOUBLE))"


def _loss(score: str) -> str:
    p = CLIP.format(score)
    return f"ROUND(AVG(CASE WHEN is_churn = 1 THEN -ln({p}) ELSE -ln(1 - {p}) END), 6) AS log_loss"


def _brier(score: str) -> str:
    return f"ROUND(AVG(({score} - is_churn) * ({score} - is_churn)), 6) AS brier_score"


def _action(texts) -> str:
    cancellation, renewal, adoption, personal = texts
    return f"""CASE WHEN cancel_count_last3 > 0 THEN '{cancellation}'
        WHEN auto_renew_count_last3 = 0 OR transactions_last_month = 0 OR paid_amount_last3 = 0 THEN '{renewal}'
        WHEN listening_secs_last3 = 0 THEN '{adoption}' ELSE '{personal}' END"""


def _queue(condition: str, texts) -> str:
    return f"""
        SELECT b.msno, ROUND(b.risk_score, 6) AS risk_score, b.risk_decile, b.risk_band, s.cancel_count_last3,
            s.auto_renew_count_last3, s.transactions_last_month, s.paid_amount_last3, s.listening_secs_last3,
            {_action(texts)} AS suggested_action
        FROM late_bands b JOIN late_snap s USING (msno) WHERE {condition}"""


def _sampled(source: str, wanted: str) -> str:
    """Rows in md5 order within their class, with the class quota by largest remainder."""
    return f"""
        sizes AS (SELECT is_churn, COUNT(*) AS n FROM {source} GROUP BY is_churn),
        want AS (SELECT CAST({wanted} AS BIGINT) AS w, SUM(n) AS total FROM sizes),
        share AS (SELECT is_churn, n * w / CAST(total AS DOUBLE) AS x, w FROM sizes, want),
        quota AS (SELECT is_churn, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, is_churn)
            <= w - SUM(floor(x)) OVER () THEN 1 ELSE 0 END AS q FROM share),
        mixed AS (SELECT s.msno, s.is_churn, q, row_number() OVER (PARTITION BY s.is_churn
            ORDER BY md5('42:' || s.msno), s.msno) AS rn FROM {source} s JOIN quota USING (is_churn))"""


VIEWS["early_rows"] = "SELECT msno, is_churn FROM cohort_rows WHERE cohort = 'early'"
VIEWS["order_levels"] = """
    SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM orders WHERE o_orderpriority < '3'"""
VIEWS["routed"] = """
    SELECT msno, is_churn, CASE WHEN cancel_count_last3 > 0 THEN 'cancellation'
        WHEN auto_renew_count_last3 = 0 OR transactions_last_month = 0 OR paid_amount_last3 = 0 THEN 'renewal'
        ELSE 'other' END AS route FROM late_snap"""
VIEWS["armed"] = """
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY route ORDER BY md5('42:' || msno), msno) % 2 = 1
        THEN 'treatment' ELSE 'control' END AS arm FROM routed"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
COLUMN_COUNTS = (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4)


def _quantiles() -> str:
    parts = []
    for column in ("l_extendedprice", "l_quantity"):
        for p in ("0.0", "0.1", "0.25", "0.5", "0.9", "0.99", "1.0"):
            parts.append(
                f"SELECT '{column}' AS \"column\", CAST({p} AS DOUBLE) AS probability, "
                f"ROUND(quantile_cont({column}, CAST({p} AS DOUBLE)), 4) AS value FROM lineitem"
            )
    return " UNION ALL ".join(parts)


SECONDS = """ROUND(MIN(total_secs), 2) AS min_monthly_secs, ROUND(MAX(total_secs), 2) AS max_monthly_secs,
    ROUND(SUM(total_secs), 2) AS total_secs_sum, COUNT(*) FILTER (WHERE NOT isfinite(total_secs)) AS non_finite_rows,
    COUNT(*) FILTER (WHERE total_secs < 0) AS negative_rows"""
PUBLIC_ANCHORS = "msno, cohort, target_expiry_month, is_churn, anchor_expiry_date"
F32 = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"

BODIES: dict[str, str] = {
    "sink_parquet_zstd": "SELECT * FROM txm",
    "sink_queue_without_label": """
        SELECT msno, ROUND(risk_score, 6) AS risk_score, risk_rank, ranked_customers,
            CAST(risk_decile AS BIGINT) AS risk_decile, risk_band FROM late_bands""",
    "source_rows": " UNION ALL ".join(
        f"SELECT '{t}' AS source, {n} AS column_count, COUNT(*) AS rows FROM {t}"
        for t, n in zip(TABLES, COLUMN_COUNTS)
    ),
    "date_coverage": """
        SELECT COUNT(*) AS rows, MIN(transaction_date) AS min_date, MAX(transaction_date) AS max_date FROM tx_sources""",
    "rows_by_month": "SELECT substr(transaction_date, 1, 6) AS period, COUNT(*) AS rows FROM tx_sources GROUP BY 1",
    "events_rows_by_day": "SELECT strftime(ts, '%Y%m%d') AS period, COUNT(*) AS rows FROM events GROUP BY 1",
    "date_range_by_source": """
        SELECT source, COUNT(*) AS rows, MIN(transaction_date) AS min_transaction_date,
            MAX(transaction_date) AS max_transaction_date, MIN(membership_expire_date) AS min_membership_expire_date,
            MAX(membership_expire_date) AS max_membership_expire_date FROM tx_sources GROUP BY source""",
    "expiry_match": """
        WITH sizes AS (SELECT cohort, target_expiry_month, COUNT(DISTINCT msno) AS n FROM cohort_rows GROUP BY ALL),
        hits AS (SELECT c.cohort, t.source, COUNT(*) AS rows, COUNT(DISTINCT t.msno) AS matched,
                MIN(t.membership_expire_date) AS lo, MAX(t.membership_expire_date) AS hi
            FROM tx_sources t JOIN cohort_rows c ON c.msno = t.msno
                AND substr(t.membership_expire_date, 1, 6) = c.target_expiry_month GROUP BY ALL)
        SELECT s.cohort, v.source, COALESCE(h.rows, 0) AS matching_rows, COALESCE(h.matched, 0) AS matched_customers,
            s.n - COALESCE(h.matched, 0) AS unmatched_customers, h.lo AS min_expiry, h.hi AS max_expiry
        FROM sizes s CROSS JOIN (VALUES ('v1'), ('v2')) v(source)
        LEFT JOIN hits h ON h.cohort = s.cohort AND h.source = v.source""",
    "value_anomalies": f"""
        SELECT source, COUNT(*) AS rows, COUNT(*) FILTER (WHERE kept) AS cohort_rows,
            MIN(total_secs) FILTER (WHERE kept AND {FINITE}) AS min_value,
            MAX(total_secs) FILTER (WHERE kept AND {FINITE}) AS max_value,
            COUNT(*) FILTER (WHERE kept AND {FINITE} AND total_secs < 0) AS below_low,
            COUNT(*) FILTER (WHERE kept AND {FINITE} AND total_secs > 86400) AS above_high,
            COUNT(*) FILTER (WHERE kept AND NOT {FINITE}) AS non_finite
        FROM (SELECT *, msno IN (SELECT msno FROM id_rows) AS kept FROM log_rows_all) GROUP BY source""",
    "anomaly_examples": f"""
        SELECT source, msno, date, CAST(rn AS INTEGER) AS example, CASE WHEN isnan(total_secs) THEN 'nan'
            WHEN isinf(total_secs) THEN 'inf' ELSE CAST(CAST(ROUND(total_secs, 2) AS DECIMAL(18,2)) AS VARCHAR) END AS total_secs FROM (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY msno, date, total_secs NULLS FIRST) AS rn
            FROM log_rows_all WHERE (NOT {FINITE} OR total_secs < 0 OR total_secs > 86400)
                AND msno IN (SELECT msno FROM id_rows)) WHERE rn <= 20""",
    "unreadable_values": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS unreadable FROM tx_sources"
        for c in ("payment_plan_days", "payment_method_id", "is_cancel")
    ),
    "cohort_ids": "SELECT msno FROM id_rows",
    "cohort_sizes": """
        SELECT 'early' AS source, COUNT(*) AS label_rows, COUNT(DISTINCT msno) AS customers FROM lbl_early
        UNION ALL SELECT 'late', COUNT(*), COUNT(DISTINCT msno) FROM lbl_late""",
    "cohort_labels": "SELECT * FROM cohort_rows",
    "dedupe_transactions": "SELECT * FROM tx",
    "restrict_to_cohort": "SELECT * FROM tx WHERE msno IN (SELECT msno FROM id_rows)",
    "monthly_usage": "SELECT * FROM usage_raw",
    "monthly_clean_seconds": f"""
        SELECT msno, substr(date, 1, 6) AS month, {CLEAN_SUMS} FROM log_rows_all GROUP BY 1, 2""",
    "merge_clean_seconds": f"""
        WITH late_clean AS (SELECT msno, substr(date, 1, 6) AS month, {CLEAN_SUMS}
            FROM log_rows_all WHERE source = 'v2' GROUP BY 1, 2)
        SELECT u.* EXCLUDE (total_secs), COALESCE(c.total_secs_clean, 0) AS total_secs_clean,
            COALESCE(c.invalid_secs_rows, 0) AS invalid_secs_rows, COALESCE(c.capped_secs_rows, 0) AS capped_secs_rows
        FROM usage_raw u LEFT JOIN late_clean c USING (msno, month)""",
    "monthly_clean_usage": "SELECT * FROM usage_clean",
    "incremental_usage": "SELECT * FROM usage_clean",
    "available_sources": """
        SELECT 'customer' AS source, TRUE AS present, COUNT(*) AS rows FROM customer
        UNION ALL SELECT 'lineitem', TRUE, COUNT(*) FROM lineitem
        UNION ALL SELECT 'orders', TRUE, COUNT(*) FROM orders
        UNION ALL SELECT 'refunds', FALSE, 0""",
    "events_daily_usage": """
        SELECT CAST(user_id AS VARCHAR) AS msno, strftime(ts, '%Y%m%d') AS day,
            COUNT(*) FILTER (WHERE event_type = 'click') AS clicks, COUNT(*) AS log_rows,
            ROUND(CAST(SUM(CAST(CASE WHEN value < 0 OR value IS NULL THEN 0 WHEN value > 50 THEN 50 ELSE value END
                AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_secs_clean,
            COUNT(*) FILTER (WHERE value IS NULL OR value < 0) AS invalid_secs_rows,
            COUNT(*) FILTER (WHERE value > 50) AS capped_secs_rows
        FROM events GROUP BY 1, 2""",
    "monthly_transactions": "SELECT * FROM txm",
    "cohort_anchors": f"SELECT {PUBLIC_ANCHORS} FROM anchor_rows",
    "member_attributes": "SELECT * EXCLUDE (reg) FROM member_rows",
    "usage_features": "SELECT * FROM uf",
    "transaction_features": "SELECT * FROM tf",
    "clean_age": "SELECT msno, CASE WHEN bd BETWEEN 13 AND 100 THEN bd END AS age FROM member_rows",
    "tenure_months": """
        SELECT msno, CAST(date_diff('month', reg, TIMESTAMP '2000-01-01') AS INTEGER) AS tenure_months_at_cutoff
        FROM member_rows""",
    "snapshot_features": "SELECT * FROM snap",
    "multi_cutoff_snapshot": "SELECT * EXCLUDE (is_churn) FROM snap_grid",
    "usage_diagnostics": f"""
        SELECT {SECONDS}, COUNT(*) FILTER (WHERE abs(total_secs) > 1000000000) AS extreme_rows FROM usage_raw_cohort""",
    "usage_diagnostics_by_month": f"SELECT month, {SECONDS} FROM usage_raw_cohort GROUP BY month",
    "clean_seconds_summary": """
        SELECT ROUND(MIN(total_secs_clean), 2) AS minimum_monthly_seconds,
            ROUND(MAX(total_secs_clean), 2) AS maximum_monthly_seconds,
            ROUND(CAST(SUM(CAST(total_secs_clean AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_clean_seconds,
            CAST(SUM(invalid_secs_rows) AS BIGINT) AS invalid_daily_rows,
            CAST(SUM(capped_secs_rows) AS BIGINT) AS capped_daily_rows FROM usage_clean""",
    "monthly_tx_summary": """
        SELECT COUNT(*) AS customer_month_rows, COUNT(DISTINCT msno) AS customers, MIN(month) AS first_month,
            MAX(month) AS last_month FROM txm""",
    "anchor_coverage": """
        SELECT cohort, COUNT(*) AS customers, COUNT(anchor_expiry_date) AS customers_with_anchor,
            COUNT(*) - COUNT(anchor_expiry_date) AS customers_without_anchor FROM anchor_rows GROUP BY cohort""",
    "snapshot_churn_summary": """
        SELECT cohort, COUNT(*) AS customers, CAST(SUM(is_churn) AS BIGINT) AS churned_customers,
            ROUND(AVG(is_churn), 6) AS churn_rate FROM snap GROUP BY cohort""",
    "snapshot_cohort_checks": """
        SELECT cohort, COUNT(*) AS rows, COUNT(DISTINCT msno) AS unique_customers,
            COUNT(*) FILTER (WHERE is_churn IS NULL) AS missing_labels,
            COUNT(*) FILTER (WHERE anchor_expiry_date IS NULL) AS missing_anchors,
            COUNT(*) FILTER (WHERE substr(anchor_expiry_date, 1, 6) <> target_expiry_month) AS anchor_month_mismatches,
            MIN(is_churn) AS min_label, MAX(is_churn) AS max_label, ROUND(AVG(is_churn), 6) AS churn_rate
        FROM snap GROUP BY cohort""",
    "duplicate_keys": """
        SELECT COUNT(*) AS duplicate_groups FROM (
            SELECT msno, date FROM log_rows_all GROUP BY msno, date HAVING COUNT(*) > 1)""",
    "feature_ranges": """
        SELECT MIN(age) AS min_age, MAX(age) AS max_age, MIN(tenure_months_at_cutoff) AS min_tenure_months,
            MAX(tenure_months_at_cutoff) AS max_tenure_months, MIN(listening_secs_last3) AS min_listening_secs_last3,
            MAX(listening_secs_last3) AS max_listening_secs_last3, MIN(paid_amount_last3) AS min_paid_amount_last3,
            MAX(paid_amount_last3) AS max_paid_amount_last3,
            COUNT(*) FILTER (WHERE tenure_months_at_cutoff < 0) AS negative_tenure_rows,
            COUNT(*) FILTER (WHERE listening_secs_last3 < 0) AS negative_listening_rows,
            COUNT(*) FILTER (WHERE paid_amount_last3 < 0) AS negative_payment_rows FROM snap""",
    "feature_missingness": """
        SELECT cohort, COUNT(*) FILTER (WHERE age IS NULL) AS age_missing,
            COUNT(*) FILTER (WHERE city IS NULL) AS city_missing,
            COUNT(*) FILTER (WHERE gender IS NULL OR gender = '') AS gender_missing,
            COUNT(*) FILTER (WHERE weighted_avg_plan_days_last3 IS NULL) AS plan_days_missing
        FROM snap GROUP BY cohort""",
    "scored_checks": """
        SELECT COUNT(*) AS scored_customers, COUNT(DISTINCT msno) AS unique_customers,
            COUNT(*) FILTER (WHERE risk_score IS NULL) AS missing_scores, ROUND(MIN(risk_score), 6) AS min_score,
            ROUND(MAX(risk_score), 6) AS max_score FROM late_planted""",
    "churn_by_band": """
        SELECT risk_band, COUNT(*) AS customers, ROUND(AVG(c.is_churn), 6) AS observed_churn_rate
        FROM late_bands b JOIN cohort_rows c ON c.msno = b.msno AND c.cohort = 'late' GROUP BY risk_band""",
    "queue_checks": f"""
        SELECT 'msno,risk_score,risk_decile,risk_band,cancel_count_last3,auto_renew_count_last3,transactions_last_month,paid_amount_last3,listening_secs_last3,suggested_action'
            AS header_columns, FALSE AS has_label, {K10} AS queue_rows FROM late_planted""",
    "batch_contract": """
        SELECT 'missing columns' AS violation, 'age' AS detail
        UNION ALL SELECT 'duplicate ids', CAST(COUNT(*) AS VARCHAR) FROM (
            SELECT msno FROM planted GROUP BY msno HAVING COUNT(*) > 1) HAVING COUNT(*) > 0
        UNION ALL SELECT 'no rows', '0' FROM planted HAVING COUNT(*) = 0""",
    "signal_bands": f"SELECT msno, cohort, {BAND_COLUMNS} FROM snap",
    "signal_rates": f"WITH banded AS (SELECT cohort, is_churn, {BAND_COLUMNS} FROM snap) "
    + " UNION ALL ".join(
        f"SELECT cohort, '{signal}' AS signal, {name} AS band, COUNT(*) AS customers, "
        f"CAST(SUM(is_churn) AS BIGINT) AS churners, ROUND(AVG(is_churn), 6) AS churn_rate FROM banded GROUP BY cohort, {name}"
        for name, (signal, _) in BANDS.items()
    ),
    "prepare_numeric": f"""
        SELECT msno, date, {F32.format("num_25")} AS num_25, {F32.format("num_100")} AS num_100,
            ROUND(CASE WHEN {FINITE} THEN {F32.format("total_secs")} END, 1) AS total_secs,
            CASE WHEN num_25 >= 3 THEN CAST(num_25 - 3 AS DOUBLE) END AS tenure_months_at_cutoff FROM log_rows_all""",
    "prepare_categories": """
        SELECT msno, COALESCE(CAST(city AS VARCHAR), 'Unknown') AS city, COALESCE(NULLIF(gender, ''), 'Unknown') AS gender,
            COALESCE(NULLIF(registered_via, ''), 'Unknown') AS registered_via FROM member_rows""",
    "category_schema": """
        SELECT feature, level, CAST(row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS INTEGER) AS position
        FROM (SELECT 'city' AS feature, COALESCE(CAST(city AS VARCHAR), 'Unknown') AS level FROM snap WHERE cohort = 'early'
            UNION SELECT 'gender', COALESCE(NULLIF(gender, ''), 'Unknown') FROM snap WHERE cohort = 'early'
            UNION SELECT 'registered_via', COALESCE(NULLIF(registered_via, ''), 'Unknown') FROM snap WHERE cohort = 'early')""",
    "align_categories": """
        SELECT o_orderkey,
            CASE WHEN o_orderpriority IN (SELECT p FROM order_levels) THEN o_orderpriority END AS o_orderpriority,
            CASE WHEN o_orderstatus IN (SELECT s FROM order_levels) THEN o_orderstatus END AS o_orderstatus FROM orders""",
    "stratified_split": f"""
        WITH {_sampled("early_rows", "SUM(n) - ceil(CAST(0.2 AS DOUBLE) * SUM(n))")}
        SELECT msno, is_churn, CASE WHEN rn <= q THEN 'train' ELSE 'test' END AS split FROM mixed""",
    "stratified_sample": f"""
        WITH {_sampled("early_rows", "LEAST(100, SUM(n))")}
        SELECT msno, is_churn FROM mixed WHERE rn <= q""",
    "balanced_weights": """
        SELECT msno, is_churn, ROUND(COUNT(*) OVER () / CAST((SELECT COUNT(DISTINCT is_churn) FROM late_planted)
            * COUNT(*) OVER (PARTITION BY is_churn) AS DOUBLE), 6) AS weight FROM late_planted""",
    "exact_quantiles": _quantiles(),
    "median_impute": """
        SELECT msno, cohort, CAST(COALESCE(age, (SELECT quantile_cont(age, 0.5) FROM snap)) AS DOUBLE) AS age,
            CAST(COALESCE(tenure_months_at_cutoff, (SELECT quantile_cont(tenure_months_at_cutoff, 0.5) FROM snap)) AS DOUBLE)
                AS tenure_months_at_cutoff,
            ROUND(COALESCE(weighted_avg_plan_days_last3,
                (SELECT quantile_cont(weighted_avg_plan_days_last3, 0.5) FROM snap)), 6) AS weighted_avg_plan_days_last3,
            CASE WHEN age IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS age_missing,
            CASE WHEN weighted_avg_plan_days_last3 IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                AS weighted_avg_plan_days_last3_missing
        FROM snap""",
    "scale_std": """
        SELECT CAST(c_custkey AS VARCHAR) AS msno,
            ROUND(c_acctbal / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
            ROUND(c_nationkey / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS c_nationkey FROM customer""",
    "group_rare_levels": """
        SELECT s_suppkey, CASE WHEN COUNT(*) OVER (PARTITION BY s_nationkey) < 4 THEN 'infrequent'
            ELSE CAST(s_nationkey AS VARCHAR) END AS s_nationkey FROM supplier""",
    "isotonic_scores": "SELECT * FROM isotonic",
    "average_precision": f"SELECT cohort, {AP} FROM curve GROUP BY cohort",
    "roc_auc": f"SELECT cohort, {AUC} FROM curve GROUP BY cohort",
    "ranking_quality_tied": f"SELECT cohort, {AP}, {AUC} FROM curve_tied GROUP BY cohort",
    "document_quality_auc": f"""
        WITH c AS ({_curve("(SELECT quality, n_chars FROM labels JOIN documents USING (doc_id))", "", "quality", "n_chars")})
        SELECT {AUC} FROM c""",
    "pr_curve": """
        SELECT cohort, ROUND(cum_pos / CAST(cum_pos + cum_neg AS DOUBLE), 6) AS precision,
            ROUND(cum_pos / CAST(total_pos AS DOUBLE), 6) AS recall, ROUND(score, 6) AS threshold FROM curve
        UNION ALL SELECT DISTINCT cohort, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) FROM curve""",
    "topk_threshold": "SELECT cohort, customers, k, ROUND(threshold, 6) AS threshold FROM kth",
    "threshold_metrics": f"""
        WITH t AS (SELECT threshold FROM kth WHERE cohort = 'early'),
        c AS (SELECT cohort, COUNT(*) AS n, SUM(is_churn) AS pos, COUNT(*) FILTER (WHERE risk_score >= threshold) AS called,
            COUNT(*) FILTER (WHERE risk_score >= threshold AND is_churn = 1) AS hit, MAX(threshold) AS threshold
            FROM planted, t GROUP BY cohort)
        SELECT cohort, ROUND(threshold, 6) AS threshold, called AS customers_flagged,
            {_flag_metrics("pos", "n", "hit", "called")} FROM c""",
    "lift_table": "SELECT * FROM lift",
    "lift_table_tied": _lift("tied", "cohort"),
    "cumulative_gains": """
        SELECT cohort, "group", ROUND(cumulative_customers / CAST(SUM(customers) OVER (PARTITION BY cohort) AS DOUBLE), 6)
            AS customer_share, cumulative_churn_recall AS churner_share FROM lift""",
    "brier_score": f"SELECT cohort, {_brier('risk_score')} FROM planted GROUP BY cohort",
    "log_loss": f"SELECT cohort, {_loss('risk_score')} FROM planted GROUP BY cohort",
    "calibration_bins": _bins("late_planted"),
    "calibration_bins_tied": _bins("(SELECT * FROM tied WHERE cohort = 'late')"),
    "calibration_comparison": f"""
        SELECT 'Raw model score' AS score_type, {_brier('risk_score')}, {_loss('risk_score')} FROM late_planted
        UNION ALL SELECT 'Isotonic calibrated', {_brier('calibrated_score')}, {_loss('calibrated_score')}
        FROM late_planted JOIN isotonic_full USING (msno)""",
    "linear_scores": "SELECT msno, TRUE AS in_range, TRUE AS separates FROM late_snap",
    "boosted_scores": "SELECT msno, TRUE AS in_range, TRUE AS separates FROM late_snap",
    "permutation_importance": "SELECT feature, feature = 'transactions_history' AS most_important FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in (*USAGE_NAMES, *TX_NAMES, "weighted_avg_plan_days_last3", "age", "tenure_months_at_cutoff", "city", "gender", "registered_via"))
    + "]) AS feature)",
    "score_batch": f"""
        SELECT risk_band, COUNT(*) AS customers, MIN(risk_rank) AS first_rank, MAX(risk_rank) AS last_rank,
            COUNT(*) FILTER (WHERE risk_rank <= (SELECT {K10} FROM late_planted)) AS queued, TRUE AS ordered
        FROM late_bands GROUP BY risk_band""",
    "source_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS source, (SELECT string_agg(column_name, ',' ORDER BY column_index) FROM duckdb_columns() "
        f"WHERE table_name = '{t}') AS columns, COUNT(*) AS rows, CAST(LEAST(COUNT(*), 3) AS INTEGER) AS shown FROM {t}"
        for t in TABLES
    ),
    "model_metrics": f"""
        WITH c AS (SELECT m.model, m.period, COUNT(*) AS n, SUM(is_churn) AS pos, MAX(threshold) AS threshold,
                COUNT(*) FILTER (WHERE risk_score >= threshold) AS called,
                COUNT(*) FILTER (WHERE risk_score >= threshold AND is_churn = 1) AS hit
            FROM two_models m JOIN kth_models k USING (model) GROUP BY m.model, m.period),
        q AS (SELECT model, period, {AP}, {AUC} FROM curve_models GROUP BY model, period)
        SELECT c.model, c.period, n AS customers, ROUND(pos / CAST(n AS DOUBLE), 6) AS churn_rate, average_precision,
            roc_auc, ROUND(threshold, 6) AS threshold, called AS customers_flagged,
            {_flag_metrics("pos", "n", "hit", "called")} FROM c JOIN q USING (model, period)""",
    "top_group_comparison": """
        SELECT model, period, customers AS customers_in_top_decile, churn_rate AS observed_churn_rate, lift,
            cumulative_churn_recall AS share_of_all_churners_captured FROM lift_models WHERE "group" = 1""",
    "risk_deciles": """
        SELECT msno, is_churn, ROUND(risk_score, 6) AS risk_score, risk_rank, ranked_customers, risk_decile FROM late_deciles""",
    "risk_deciles_tied": """
        SELECT *, CAST(LEAST((risk_rank - 1) * 10 // ranked_customers + 1, 10) AS INTEGER) AS risk_decile FROM (
            SELECT msno, cohort, is_churn, ROUND(risk_score, 6) AS risk_score,
                row_number() OVER (PARTITION BY cohort ORDER BY tied.risk_score DESC, msno) AS risk_rank,
                COUNT(*) OVER (PARTITION BY cohort) AS ranked_customers FROM tied)""",
    "event_value_deciles": """
        SELECT *, CAST(LEAST((risk_rank - 1) * 10 // ranked_customers + 1, 10) AS INTEGER) AS risk_decile FROM (
            SELECT event_id, event_type, value,
                row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) AS risk_rank,
                COUNT(*) OVER (PARTITION BY event_type) AS ranked_customers FROM events)""",
    "risk_bands": "SELECT msno, risk_decile, risk_band FROM late_bands",
    "risk_bands_variant": """
        SELECT msno, risk_decile, CASE WHEN risk_decile = 1 THEN 'High' WHEN risk_decile <= 3 THEN 'Elevated'
            WHEN risk_decile <= 6 THEN 'Moderate' ELSE 'Low' END AS risk_band FROM late_deciles""",
    "band_summary": """
        SELECT risk_decile, risk_band, COUNT(*) AS customers, CAST(SUM(is_churn) AS BIGINT) AS churners,
            ROUND(AVG(is_churn), 6) AS observed_churn_rate, ROUND(AVG(risk_score), 6) AS mean_risk_score,
            ROUND(AVG(is_churn) / (SELECT AVG(is_churn) FROM late_planted), 6) AS lift_vs_overall
        FROM late_bands GROUP BY risk_decile, risk_band""",
    "band_counts": "SELECT risk_band, COUNT(*) AS customers FROM late_bands GROUP BY risk_band",
    "outreach_queue": _queue(f"b.risk_rank <= (SELECT {K10} FROM late_planted)", BATCH_TEXTS),
    "top_decile_queue": _queue("b.risk_decile = 1", REVIEW_TEXTS),
    "suggested_action": f"SELECT msno, cohort, {_action(BATCH_TEXTS)} AS suggested_action FROM snap",
    "scored_for_evaluation": """
        SELECT msno, is_churn, ROUND(risk_score, 6) AS risk_score, risk_decile, risk_band FROM late_bands""",
    "verify_manifest": """
        WITH have AS (SELECT 'pages/' || page_id || '.html' AS path, sha256(html) AS h FROM pages),
        want AS (SELECT CASE WHEN page_id % 7 = 0 THEN 'old/' ELSE '' END || 'pages/' || page_id || '.html' AS path,
            sha256(CASE WHEN page_id % 5 = 0 THEN url ELSE html END) AS h FROM pages)
        SELECT CASE WHEN have.path IS NULL THEN 'missing file' ELSE 'checksum mismatch' END AS failure, want.path
        FROM want LEFT JOIN have USING (path) WHERE have.path IS NULL OR have.h <> want.h
        UNION ALL SELECT 'required file missing', r.path FROM (VALUES ('pages/1.html'), ('index.html')) r(path)
            WHERE r.path NOT IN (SELECT path FROM have)
        UNION ALL SELECT DISTINCT 'forbidden file present', f.name FROM (VALUES ('/11.HTML'), ('secret')) f(name), have
            WHERE contains(lower(have.path), lower(f.name))""",
    "assign_arms": "SELECT msno, route, arm FROM armed",
    "itt_effect": """
        WITH sides AS (SELECT route, COUNT(*) FILTER (WHERE arm = 'treatment') AS nt, COUNT(*) FILTER (WHERE arm = 'control') AS nc,
                SUM(is_churn) FILTER (WHERE arm = 'treatment') / CAST(COUNT(*) FILTER (WHERE arm = 'treatment') AS DOUBLE) AS pt,
                SUM(is_churn) FILTER (WHERE arm = 'control') / CAST(COUNT(*) FILTER (WHERE arm = 'control') AS DOUBLE) AS pc
            FROM (SELECT route, arm, is_churn FROM armed UNION ALL SELECT 'all', arm, is_churn FROM armed) GROUP BY route)
        SELECT route, nt AS treatment_customers, nc AS control_customers, ROUND(pt, 6) AS treatment_rate,
            ROUND(pc, 6) AS control_rate, ROUND(pt - pc, 6) AS difference,
            ROUND(pt - pc - CAST(1.959963984540054 AS DOUBLE) * sqrt(pt * (1 - pt) / nt + pc * (1 - pc) / nc), 6) AS ci_low,
            ROUND(pt - pc + CAST(1.959963984540054 AS DOUBLE) * sqrt(pt * (1 - pt) / nt + pc * (1 - pc) / nc), 6) AS ci_high
        FROM sides""",
    "balance_check": """
        WITH joined AS (SELECT a.*, d.risk_decile FROM armed a JOIN late_deciles d USING (msno)),
        long AS (SELECT 'route' AS characteristic, route AS value, arm FROM joined
            UNION ALL SELECT 'risk_decile', CAST(risk_decile AS VARCHAR), arm FROM joined)
        SELECT characteristic, value, COUNT(*) FILTER (WHERE arm = 'treatment') AS treatment_customers,
            COUNT(*) FILTER (WHERE arm = 'control') AS control_customers,
            ROUND(COUNT(*) FILTER (WHERE arm = 'treatment') / CAST(COUNT(*) AS DOUBLE), 6) AS treatment_share
        FROM long GROUP BY characteristic, value""",
    "coverage_report": "WITH e AS (SELECT * FROM snap WHERE cohort = 'early') " + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature,
            ROUND((SELECT COUNT(*) FILTER (WHERE {bad}) / CAST(COUNT(*) AS DOUBLE) FROM late_snap), 6) AS missing_share,
            ROUND((SELECT COUNT(*) FILTER (WHERE {bad}) / CAST(COUNT(*) AS DOUBLE) FROM e), 6) AS reference_missing_share,
            {unknown} AS unknown_share"""
        for f, bad, unknown in [
            ("age", "age IS NULL", "CAST(NULL AS DOUBLE)"),
            ("tenure_months_at_cutoff", "tenure_months_at_cutoff IS NULL OR tenure_months_at_cutoff < 0",
             "CAST(NULL AS DOUBLE)"),
            ("weighted_avg_plan_days_last3", "weighted_avg_plan_days_last3 IS NULL", "CAST(NULL AS DOUBLE)"),
            *[
                (c, f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''",
                 f"""ROUND((SELECT COUNT(*) FILTER (WHERE COALESCE(NULLIF(CAST({c} AS VARCHAR), ''), 'Unknown') NOT IN (
                        SELECT COALESCE(NULLIF(CAST({c} AS VARCHAR), ''), 'Unknown') FROM e)) / CAST(COUNT(*) AS DOUBLE)
                     FROM late_snap), 6)""")
                for c in ("city", "gender", "registered_via")
            ],
        ]
    ),
    "feature_drift": """
        WITH edges AS (SELECT unnest(quantile_cont(risk_score, [0.1::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE, 0.4::DOUBLE,
                0.5::DOUBLE, 0.6::DOUBLE, 0.7::DOUBLE, 0.8::DOUBLE, 0.9::DOUBLE])) AS edge FROM planted WHERE cohort = 'early'),
        binned AS (SELECT cohort, (SELECT COUNT(DISTINCT edge) FROM edges WHERE edge < risk_score) AS bin FROM planted),
        shares AS (SELECT bin,
                COUNT(*) FILTER (WHERE cohort = 'late') / CAST((SELECT COUNT(*) FROM planted WHERE cohort = 'late') AS DOUBLE) AS now,
                COUNT(*) FILTER (WHERE cohort = 'early') / CAST((SELECT COUNT(*) FROM planted WHERE cohort = 'early') AS DOUBLE) AS was
            FROM binned GROUP BY bin)
        SELECT 'risk_score' AS feature, ROUND(SUM((GREATEST(now, 0.0001) - GREATEST(was, 0.0001))
            * ln(GREATEST(now, 0.0001::DOUBLE) / GREATEST(was, 0.0001::DOUBLE))), 6) AS psi FROM shares""",
    "control_limits": """
        WITH per_id AS (SELECT strftime(o_orderdate, '%Y%m') AS run_id, o_custkey, COUNT(*) AS n, MAX(o_orderdate) AS latest
            FROM orders GROUP BY 1, 2),
        runs AS (SELECT run_id, CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
            strftime(MAX(latest), '%Y%m%d') AS latest_feature_date FROM per_id GROUP BY run_id),
        c AS (SELECT *, lag(rows) OVER (ORDER BY run_id) AS before, lag(latest_feature_date) OVER (ORDER BY run_id) AS seen,
            lag(run_id) OVER (ORDER BY run_id) AS earlier FROM runs),
        kinds AS (SELECT strftime(o_orderdate, '%Y%m') AS run_id, least(floor(o_totalprice / 30000) + 1, 10) AS decile, COUNT(*) AS n FROM orders GROUP BY 1, 2),
        every AS (SELECT c.run_id, c.earlier, c.rows, c.before, k.decile FROM c CROSS JOIN (SELECT DISTINCT decile FROM kinds) k WHERE c.earlier IS NOT NULL),
        shifts AS (SELECT e.run_id, bool_or(CASE WHEN a.n IS NULL AND b.n IS NULL THEN FALSE
                WHEN a.n IS NULL OR b.n IS NULL THEN TRUE
                ELSE abs(a.n / CAST(e.rows AS DOUBLE) - b.n / CAST(e.before AS DOUBLE)) > 0.04 END) AS moved
            FROM every e LEFT JOIN kinds a ON a.run_id = e.run_id AND a.decile = e.decile
            LEFT JOIN kinds b ON b.run_id = e.earlier AND b.decile = e.decile GROUP BY e.run_id)
        SELECT run_id, COALESCE((SELECT moved FROM shifts WHERE shifts.run_id = c.run_id), FALSE) AS decile_alert, rows, duplicate_rows, latest_feature_date, ROUND((rows - before) / CAST(before AS DOUBLE), 6) AS row_change,
            COALESCE(abs((rows - before) / CAST(before AS DOUBLE)) > 0.5, FALSE) AS volume_alert,
            duplicate_rows > 0 AS duplicate_alert, COALESCE(latest_feature_date <= seen, FALSE) AS freshness_alert FROM c""",
}


def _needed(text: str) -> set[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    found: set[str] = set()
    stack = [v for v in VIEWS if v in words]
    while stack:
        view = stack.pop()
        if view not in found:
            found.add(view)
            inner = set(re.findall(r"[a-z_0-9]+", VIEWS[view]))
            stack.extend(v for v in VIEWS if v in inner)
    return found


def _statement(body: str) -> str:
    """The body with the views it uses, in dependency order, as common table expressions."""
    needed = _needed(body)
    ordered: list[str] = []

    def place(view: str) -> None:
        if view in ordered:
            return
        for other in _needed(VIEWS[view]) & needed:
            if other != view:
                place(other)
        ordered.append(view)

    for view in VIEWS:
        if view in needed:
            place(view)
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in ordered)
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


ORACLE = {name: _statement(body) for name, body in BODIES.items()}
