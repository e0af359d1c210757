"""A repeatable dirty copy of the order table: every defect follows from the order key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inject(
    df: DataFrame, key: str, customer: str, amount: str, status: str, date: str
) -> DataFrame:
    """Missing customers (1 in 20), negative amounts (1 in 101), amounts off by one (1 in 50), unknown
    status (1 in 199), dates 30 years late (1 in 127) and repeated rows (1 in 33).

    `expected_amount` keeps the amount as it was. No random numbers: a second run, and the
    checking database, make the same rows.
    """
    k = F.col(key)
    changed = df.withColumns(
        {
            "expected_amount": F.col(amount),
            customer: F.when(k % 20 != 0, F.col(customer)),
            amount: F.when(k % 101 == 0, -F.col(amount))
            .when(k % 50 == 7, F.col(amount) + 1)
            .otherwise(F.col(amount)),
            status: F.when(k % 199 == 3, "INVALID").otherwise(F.col(status)),
            date: F.when(k % 127 == 5, F.add_months(F.col(date), 360)).otherwise(F.col(date)),
        }
    )
    return changed.unionByName(changed.where(k % 33 == 0))


DIRTY_SQL = """SELECT order_id, CASE WHEN order_id % 20 <> 0 THEN customer_id END AS customer_id,
    CASE WHEN order_id % 127 = 5 THEN CAST(order_date + INTERVAL 30 YEAR AS DATE) ELSE order_date END AS order_date,
    CASE WHEN order_id % 101 = 0 THEN -total_amount WHEN order_id % 50 = 7 THEN total_amount + 1
      ELSE total_amount END AS total_amount, payment_method,
    CASE WHEN order_id % 199 = 3 THEN 'INVALID' ELSE status END AS status, partner_source,
    total_amount AS expected_amount FROM o"""
DIRTY_SQL = f"x1 AS ({DIRTY_SQL}), x AS (SELECT * FROM x1 UNION ALL SELECT * FROM x1 WHERE order_id % 33 = 0)"
