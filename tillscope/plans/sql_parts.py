"""Common table expressions that the comparison queries share (DuckDB dialect)."""

TXN = """txn AS (SELECT event_id AS transaction_id, user_id AS customer_id, ts AS "timestamp", value AS amount,
  event_type AS category, CAST(event_type = 'error' AS INT) AS is_fraud, epoch_us(ts) AS t FROM events)"""

PURCHASES = """purchases AS (SELECT o_custkey AS customer_id, o_orderdate AS date, o_totalprice AS amount,
  o_orderkey AS transaction_id FROM orders)"""


def rfm_of(source: str, name: str = "rfm") -> str:
    return f"""{name}_ref AS (SELECT max(date) + INTERVAL 1 DAY AS ref_at FROM {source}),
{name} AS (SELECT customer_id,
  CAST(floor((epoch_us(max(ref_at)) - epoch_us(max(date))) / 86400000000.0) AS BIGINT) AS recency,
  CAST(count(*) AS BIGINT) AS frequency, sum(amount) AS monetary FROM {source}, {name}_ref GROUP BY customer_id)"""


def scores_of(source: str, name: str = "scored") -> str:
    def position(column: str) -> str:
        return (
            f"greatest(1, ((row_number() OVER (ORDER BY {column}, customer_id) - 1) * 5 + greatest(count(*) OVER () - 2, 0))"
            f" // greatest(count(*) OVER () - 1, 1))"
        )

    return f"""{name}_q AS (SELECT list_sort(list_distinct(quantile_cont(recency, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM {source}),
{name} AS (SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
  r_score + f_score + m_score AS rfm_total FROM (SELECT r.*,
  CAST(5 - len(list_filter(e[2:len(e) - 1], lambda x: x < recency)) AS BIGINT) AS r_score,
  CAST({position('frequency')} AS BIGINT) AS f_score, CAST({position('monetary')} AS BIGINT) AS m_score
  FROM {source} r, {name}_q))"""


def segments_of(source: str, name: str = "segs") -> str:
    return f"""{name} AS (SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
  WHEN f_score >= 4 THEN 'Loyal Customers' WHEN r_score >= 4 AND f_score >= 2 THEN 'Potential Loyalists'
  WHEN r_score >= 4 THEN 'Recent Customers' WHEN r_score >= 3 AND m_score >= 2 THEN 'Promising'
  WHEN r_score >= 2 AND f_score >= 2 THEN 'Need Attention' WHEN r_score >= 2 THEN 'About to Sleep'
  WHEN f_score >= 3 THEN 'At Risk' ELSE 'Hibernating' END AS segment FROM {source})"""


SEGS = ",\n".join([PURCHASES, rfm_of("purchases"), scores_of("rfm"), segments_of("scored")])


def long_of(source: str, keep: str, columns: list[str], name: str = "long") -> str:
    parts = [f"SELECT {keep}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns]
    return f"{name} AS ({' UNION ALL '.join(parts)})"
