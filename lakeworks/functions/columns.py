"""Column expressions shared by the jobs. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_date(column: Column | str, formats: Iterable[str]) -> Column:
    """First format that fits; text that fits none gives null instead of an error."""
    text = as_column(column)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(*tries)


def category_key(product_id: Column | str, per_category: int = 500) -> Column:
    """`CAT_nn` from the number in a product id, `per_category` numbers to a category."""
    digits = F.regexp_extract(as_column(product_id).cast("string"), r"(\d+)$", 1)
    number = digits.try_cast("int")
    return F.concat(F.lit("CAT_"), F.lpad(F.ceil(number / per_category).cast("string"), 2, "0"))


def band(column: Column | str, bounds: Sequence[tuple[float, str]], above: str, missing: str) -> Column:
    """Label of the first bound the value lies below; nulls get a label of their own."""
    value = as_column(column)
    out = F.when(value.isNull(), missing)
    for bound, label in bounds:
        out = out.when(value < bound, label)
    return out.otherwise(above)


# Bounds and labels of the ticket, quantity and churn bands.
TICKET_BANDS = ((50, "Baixo"), (200, "Medio"), (500, "Alto"))
TICKET_ABOVE, TICKET_MISSING = "Premium", "Indefinido"
QUANTITY_BANDS = ((2, "1 unidade"), (4, "2-3 unidades"), (6, "4-5 unidades"))
QUANTITY_ABOVE = "6+ unidades"
SEGMENTS = ("Em Risco", "VIP", "Gold", "Silver", "Bronze", "Outros")


def ticket_band(amount: Column | str, scale: float = 1.0) -> Column:
    """Price band of an order; `scale` stretches the bounds to other currencies."""
    bounds = [(b * scale, label) for b, label in TICKET_BANDS]
    return band(amount, bounds, TICKET_ABOVE, TICKET_MISSING)


def quantity_band(quantity: Column | str) -> Column:
    return band(quantity, QUANTITY_BANDS, QUANTITY_ABOVE, TICKET_MISSING)


def churn_risk(days_since_last: Column | str) -> Column:
    """Over 90 days high, 30 to 90 medium, below 30 low; no purchase at all is its own case."""
    days = as_column(days_since_last)
    return (
        F.when(days.isNull(), "none").when(days > 90, "high").when(days >= 30, "medium").otherwise("low")
    )


def customer_segment(spent: Column | str, orders: Column | str, days: Column | str, scale: float = 1.0) -> Column:
    """Segment by spending, number of orders and recency; being at risk outranks the rest."""
    spent, orders, days = (F.coalesce(as_column(c), F.lit(0)) for c in (spent, orders, days))
    risk, vip, gold, silver, bronze, other = SEGMENTS
    return (
        F.when(days > 90, risk)
        .when((spent > 5000 * scale) & (orders >= 20) & (days < 30), vip)
        .when((spent > 2000 * scale) & (orders >= 10) & (days < 60), gold)
        .when((spent > 500 * scale) & (orders >= 5), silver)
        .when((spent > 100 * scale) | (orders >= 2), bronze)
        .otherwise(other)
    )


def change_percent(now: Column | str, before: Column | str) -> Column:
    """Change against the value before, in percent; null where that is null or zero."""
    now, before = as_column(now), as_column(before)
    return F.try_divide(now - before, before) * 100


def exact_round(column: Column | str, digits: int = 2) -> Column:
    """Round half up through a decimal, so that binary noise does not decide the last digit."""
    return F.round(as_column(column).cast("decimal(18,6)"), digits).cast("double")


def bucket_of(columns: Sequence[Column | str], buckets: int) -> Column:
    """A repeatable bucket number from the row's own values (never from a random number)."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
