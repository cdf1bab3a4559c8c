"""SQL text of the adapters, used by the oracle queries (DuckDB dialect,
which is also valid Spark SQL for these statements)."""

from __future__ import annotations

PANEL = """
SELECT Store, Date, Sales, Customers, Open, Promo,
       CASE WHEN EXTRACT(month FROM Date) = 1  AND EXTRACT(day FROM Date) = 1         THEN 'a'
            WHEN EXTRACT(month FROM Date) = 4  AND EXTRACT(day FROM Date) IN (10, 11) THEN 'b'
            WHEN EXTRACT(month FROM Date) = 12 AND EXTRACT(day FROM Date) IN (25, 26) THEN 'c'
            ELSE '0' END AS StateHoliday,
       CASE WHEN EXTRACT(month FROM Date) = 7 + Store % 2 THEN 1 ELSE 0 END AS SchoolHoliday
FROM (
  SELECT CAST(l_suppkey + 1 AS BIGINT) AS Store,
         CAST(l_shipdate AS DATE) AS Date,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Sales,
         COUNT(DISTINCT l_orderkey) AS Customers,
         MAX(CASE WHEN l_linestatus = 'O' OR l_returnflag <> 'R' THEN 1 ELSE 0 END) AS Open,
         MAX(CASE WHEN l_discount >= 0.06 THEN 1 ELSE 0 END) AS Promo
  FROM lineitem GROUP BY 1, 2
) p
"""

STORE = """
SELECT CAST(s_suppkey + 1 AS BIGINT) AS Store,
       CASE s_nationkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'd' END AS StoreType,
       CASE s_nationkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS Assortment,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS CompetitionDistance,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 1 + s_suppkey % 12 END AS CompetitionOpenSinceMonth,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 1993 + s_suppkey % 8 END AS CompetitionOpenSinceYear,
       CAST(s_suppkey % 2 AS INT) AS Promo2,
       CASE WHEN s_suppkey % 2 = 1 THEN 1 + s_suppkey % 52 END AS Promo2SinceWeek,
       CASE WHEN s_suppkey % 2 = 1 THEN 1994 + s_suppkey % 5 END AS Promo2SinceYear,
       CASE WHEN s_suppkey % 2 = 1 THEN 'Jan,Apr,Jul,Oct' END AS PromoInterval
FROM supplier
"""

PREDICTIONS = """
SELECT p.*,
       COALESCE(LAG(Sales, 1) OVER w, 0) AS sales_lag_1, COALESCE(LAG(Sales, 7) OVER w, 0) AS sales_lag_7,
       CASE WHEN COUNT(Sales) OVER (PARTITION BY Store ORDER BY Date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
            THEN AVG(Sales) OVER (PARTITION BY Store ORDER BY Date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) ELSE 0 END AS prediction
FROM sales_panel p WINDOW w AS (PARTITION BY Store ORDER BY Date)
"""

REQUESTS = """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, 'POST' AS method,
       CASE WHEN user_id % 10 = 0 THEN '/health' ELSE '/predict' END AS path,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, value / 100.0 AS latency_seconds
FROM events
"""

CTES = {
    "sales_panel": PANEL,
    "store_dim": STORE,
    "naive_predictions": PREDICTIONS,
    "request_log": REQUESTS,
}
# naive_predictions reads sales_panel.
DEPENDS = {"naive_predictions": ["sales_panel"]}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the adapter CTEs it needs (dependencies first),
    then any ``extra`` CTEs in the given order."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n].strip()})" for n in ordered]
    parts += [f"{k} AS ({v.strip()})" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
