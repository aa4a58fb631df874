"""SQL (DuckDB dialect) building blocks for the oracles.

These are written from the fixture *definitions* (survey §2.12), not from the Spark
code: the point of an oracle is to be an independent second implementation.
"""

from __future__ import annotations

T0 = "TIMESTAMP '2001-01-01 00:00:00'"


def r4(x: str) -> str:
    """Half-up rounding to 4 digits, computed in IEEE doubles."""
    return f"(floor(CAST({x} AS DOUBLE) * 10000.0 + 0.5) / 10000.0)"


def r6(x: str) -> str:
    """Half-up rounding to 6 digits, computed in IEEE doubles."""
    return f"(floor(CAST({x} AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0)"


def hash32(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT)"


def split_case(key: str) -> str:
    """70 % train, 20 % validate, 10 % test of the 32-bit hash with seed 42."""
    h = hash32(key, "42")
    return f"(CASE WHEN {h} < 3006477107 THEN 'train' WHEN {h} < 3865470566 THEN 'validate' ELSE 'test' END)"


_SVC = [("online_security", "STANDARD"), ("online_backup", "PROMO"), ("device_protection", "SMALL"),
        ("tech_support", "LARGE"), ("streaming_tv", "ECONOMY"), ("streaming_movies", "MEDIUM")]
SERVICES = [s for s, _ in _SVC]

SUBSCRIBERS = f"""
s_oagg AS (
  SELECT o_custkey,
         CAST(count(CASE WHEN o_orderdate < {T0} THEN 1 END) AS DOUBLE) AS tenure,
         max(CASE WHEN o_orderdate < {T0} THEN o_totalprice END) AS monthly_charges,
         sum(CASE WHEN o_orderdate < {T0} THEN o_totalprice END) AS total,
         count(CASE WHEN o_orderdate >= {T0} THEN 1 END) AS later
  FROM orders GROUP BY o_custkey),
s_lagg AS (
  SELECT o.o_custkey,
         {", ".join(f"sum(CASE WHEN p.p_type = '{pt}' THEN l.l_quantity END) AS {s}" for s, pt in _SVC)}
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN part p ON l.l_partkey = p.p_partkey
  WHERE o.o_orderdate < {T0}
  GROUP BY o.o_custkey),
subscribers AS (
  SELECT c.c_custkey AS customer_id, {T0} AS transaction_ts,
         CAST(c.c_nationkey % 3 AS BIGINT) AS senior_citizen,
         a.tenure, a.monthly_charges,
         CASE WHEN a.total IS NULL THEN ' ' ELSE CAST(CAST(a.total AS DECIMAL(18,2)) AS VARCHAR) END AS total_charges,
         {", ".join(f"CASE WHEN g.{s} > 150 THEN 'Yes' WHEN g.{s} IS NOT NULL THEN 'No' END AS {s}" for s in SERVICES)},
         c.c_mktsegment AS contract,
         CASE WHEN coalesce(a.later, 0) > 0 THEN 'No' ELSE 'Yes' END AS churn
  FROM customer c LEFT JOIN s_oagg a ON c.c_custkey = a.o_custkey
       LEFT JOIN s_lagg g ON c.c_custkey = g.o_custkey)"""

CHURN_FEATURES = """
churn_features AS (
  SELECT customer_id, transaction_ts,
         CASE CAST(senior_citizen AS VARCHAR) WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' END AS senior_citizen,
         coalesce(tenure, 0.0) AS tenure,
         coalesce(monthly_charges, 0.0) AS monthly_charges,
         coalesce(CASE WHEN trim(total_charges) = '' THEN 0.0 ELSE TRY_CAST(total_charges AS DOUBLE) END, 0.0)
           AS total_charges,
         """ + ", ".join(SERVICES) + """, contract,
         CAST(""" + " + ".join(f"(CASE WHEN {s} = 'Yes' THEN 1 ELSE 0 END)" for s in SERVICES) + """ AS BIGINT)
           AS num_optional_services
  FROM subscribers)"""

CHURN_LABELS = f"""
churn_labels AS (
  SELECT customer_id, transaction_ts, churn, {split_case('customer_id')} AS split FROM subscribers)"""

MONTHLY = """
m_per AS (
  SELECT o_custkey AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
         count(*) AS n_orders, sum(o_totalprice) AS spend
  FROM orders GROUP BY 1, 2),
monthly_features AS (
  SELECT customer_id, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS feature_ts,
         CAST(sum(n_orders) OVER (PARTITION BY customer_id ORDER BY m
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_orders,
         sum(spend) OVER (PARTITION BY customer_id ORDER BY m
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_spend
  FROM m_per)"""

PIT = """
pit_labels AS (SELECT event_id, user_id, ts, value AS amount FROM events WHERE event_type = 'purchase'),
pit_features AS (SELECT user_id, ts AS view_ts, event_id AS view_event_id, value AS view_value
                 FROM events WHERE event_type = 'view')"""

PREDICTIONS = f"""
predictions AS (
  SELECT d.doc_id, least(CAST(d.n_chars AS DOUBLE) / 5000.0, 1.0) AS score,
         CASE WHEN least(CAST(d.n_chars AS DOUBLE) / 5000.0, 1.0) > 0.5 THEN 1 ELSE 0 END AS prediction,
         l.quality AS label, {split_case('d.doc_id')} AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

MODEL_INFO = """
model_info AS (
  SELECT event_type AS model_name, user_id % 5 AS model_version, value / 500.0 AS f1_score,
         ts AS validation_timestamp, event_id FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


PRICE_INCREASE = ("CAST(CASE WHEN {t} > 0 THEN {m} - {tot} / {t} WHEN {t} IS NOT NULL THEN 0.0 END AS FLOAT)")


def price_increase(m: str, t: str, tot: str) -> str:
    return PRICE_INCREASE.format(m=m, t=t, tot=tot)


def choice_sql(key: str, salt: str, values, weights=None) -> str:
    """SQL twin of the synthetic weighted choice (same md5 thresholds)."""
    weights = weights or [1.0] * len(values)
    total = float(sum(weights))
    h = hash32(key, salt)
    arms, acc = [], 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w
        arms.append(f"WHEN {h} < {int(acc / total * 2**32)} THEN '{v}'")
    return f"(CASE {' '.join(arms)} ELSE '{values[-1]}' END)"


def steps_sql(key: str, salt: str, lo: float, hi: float, step: float, dtype: str = "DOUBLE") -> str:
    n = int(round((hi - lo) / step)) + 1
    return f"CAST({lo} + ({hash32(key, salt)} % {n}) * {step} AS {dtype})"


PROFILE_TABLE_ROWS = """
profile_rows AS (
  SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
         event_type AS model_id, count(*) AS count,
         floor(floor(sum(value) * 1000000.0 + 0.5) / 1000000.0 / count(value) * 1000000.0 + 0.5) / 1000000.0 AS avg_value
  FROM events GROUP BY 1, 2, 3)"""


def template_sql(key: str, salt: str, pattern: str) -> str:
    parts = []
    for i, ch in enumerate(pattern):
        if ch not in "dA":
            parts.append(f"'{ch}'")
            continue
        byte = f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}:{i // 16}'), {2 * (i % 16) + 1}, 2))::INTEGER)"
        parts.append(f"CAST({byte} % 10 AS VARCHAR)" if ch == "d" else f"chr(65 + {byte} % 26)")
    return "(" + " || ".join(parts) + ")"


def time_steps_sql(key: str, salt: str, begin_epoch: int, end_epoch: int, step: int) -> str:
    n = (end_epoch - begin_epoch) // step + 1
    return f"make_timestamp(CAST(({begin_epoch} + ({hash32(key, salt)} % {n}) * {step}) AS BIGINT) * 1000000)"
