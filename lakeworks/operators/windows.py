"""Per-customer sequences: trends, running totals, churn and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.functions.columns import change_percent, churn_risk, customer_segment
from lakeworks.operators.aggregates import customer_360
from lakeworks.operators.skew import By, Cut, neighbours, ranked, running, skew_join
from lakeworks.runtime import money

ORDER = (By("order_date"), By("order_id"))


def top_per_group(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows whose value is among the n highest values of the key, with `place`; ties are kept, and rows
    without a key are a group too.

    The n values are found over distinct (key, value) pairs, where each task passes on n rows
    per key; the rows themselves then join them on (key, value).
    """
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(value))
    values = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    places = values.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)
    places = places.withColumn("place", F.col("place").cast("long"))
    return skew_join(df, places, [*keys, value], null_safe=True)


def top_overall(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value is among the n highest values of the frame, ties kept, with `place`.

    Only the n values are ranked in one task, never the rows.
    """
    values = df.select(value).where(F.col(value).isNotNull()).distinct()
    top = values.orderBy(F.desc(value)).limit(n)
    place = F.row_number().over(Window.orderBy(F.desc(value))).cast("long")
    return df.join(F.broadcast(top.withColumn("place", place)), value)


def last_rows(df: DataFrame, keys: Sequence[str], by: Sequence[By], n: int) -> DataFrame:
    """The last n rows of each key, `recency` 1 being the newest; tasks pass on n rows per key."""
    newest = Window.partitionBy(*keys).orderBy(*[By(b.name, not b.desc).order for b in by])
    return df.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)


def trend(df: DataFrame, amount: str = "total_amount", cut: Cut | None = None) -> DataFrame:
    """Per order: previous and next amount, days since the previous order, change in value and
    in percent."""
    out = neighbours(
        df, ["customer_id"], ORDER,
        back={
            "previous_amount": lambda w: F.lag(amount, 1).over(w),
            "previous_date": lambda w: F.lag("order_date", 1).over(w),
        },
        ahead={"next_amount": lambda w: F.lead(amount, 1).over(w)},
        cut=cut,
    )
    return out.withColumns(
        {
            "difference": F.col(amount) - F.col("previous_amount"),
            "change_percent": change_percent(amount, "previous_amount"),
            "days_since_previous": F.datediff("order_date", "previous_date").cast("long"),
        }
    )


def running_totals(df: DataFrame, amount: str = "total_amount", cut: Cut | None = None) -> DataFrame:
    """Per order: running value, orders and mean of its customer."""
    out = running(
        df, ["customer_id"], ORDER,
        {"_value": money(amount), "running_orders": F.lit(1).cast("long")}, cut,
    )
    value = F.col("_value").cast("double")
    return out.withColumns(
        {"running_value": value, "running_mean": F.try_divide(value, "running_orders")}
    ).drop("_value")


def moving_mean(df: DataFrame, rows: int, amount: str = "total_amount", cut: Cut | None = None) -> DataFrame:
    """Mean over the current and the `rows` - 1 orders before it."""
    frame = lambda w: w.rowsBetween(-(rows - 1), Window.currentRow)
    out = neighbours(
        df, ["customer_id"], ORDER,
        back={
            "_value": lambda w: F.sum(money(amount)).over(frame(w)),
            "window_orders": lambda w: F.count(amount).over(frame(w)),
        },
        reach=rows - 1, cut=cut,
    )
    return out.withColumn(
        "moving_mean", F.try_divide(F.col("_value").cast("double"), "window_orders")
    ).drop("_value")


def remaining(df: DataFrame, amount: str = "total_amount", cut: Cut | None = None) -> DataFrame:
    """Value from the current order to the last one of its customer (a frame that looks ahead):
    the running sum in the reverse order."""
    back = [By(b.name, not b.desc) for b in ORDER]
    out = running(df, ["customer_id"], back, {"_value": money(amount)}, cut)
    return out.withColumn("remaining_value", F.col("_value").cast("double")).drop("_value")


def day_range(df: DataFrame, keys: Sequence[str], date: str, days: int, amount: str) -> DataFrame:
    """Per key and day: the day's value and the value of that day and the `days` before it.

    Rows are added up per day first, so a window holds at most one row per calendar day,
    however many rows the key has.
    """
    daily = df.groupBy(*keys, date).agg(F.sum(money(amount)).alias("_value"), F.count("*").alias("orders"))
    span = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-days, 0)
    return daily.select(
        *keys, date, "orders",
        F.col("_value").cast("double").alias("day_value"),
        F.sum("_value").over(span).cast("double").alias("range_value"),
    )


def quartiles(df: DataFrame, by: Sequence[By], tiles: int = 4, keys: Sequence[str] = (), cut: Cut | None = None) -> DataFrame:
    """`tile` as ntile gives it and `percent_rank`, from exact places over any number of rows."""
    out = ranked(df, keys, by, cut)
    place, rows = F.col("row_number") - 1, F.col("group_rows")
    size, longer = F.floor(rows / tiles), rows % tiles
    in_long = longer * (size + 1)
    tile = F.when(place < in_long, F.floor(place / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(place - in_long, size))
    )
    return out.withColumns(
        {
            "tile": (tile + 1).cast("long"),
            "percent_rank": F.coalesce(
                F.try_divide((F.col("rank") - 1).cast("double"), rows - 1), F.lit(0.0)
            ),
        }
    ).drop("row_number", "rank", "dense_rank", "group_rows")


def first_crossing(df: DataFrame, mark: float, amount: str = "total_amount", cut: Cut | None = None) -> DataFrame:
    """The first order of each customer at which the running value reaches the mark."""
    reached = running_totals(df, amount, cut).where(F.col("running_value") >= mark)
    when = F.struct("order_date", "order_id")
    row = F.min_by(F.struct("order_date", "order_id", "running_value", "running_orders"), when)
    return reached.groupBy("customer_id").agg(row.alias("_row")).select("customer_id", "_row.*")


def churn_by_decline(
    df: DataFrame, last: int = 3, drop: float = -30.0, amount: str = "total_amount", cut: Cut | None = None
) -> DataFrame:
    """Mean percent change over the last orders of each customer; below `drop` is at risk."""
    recent = last_rows(trend(df, amount, cut), ["customer_id"], ORDER, last)
    change = F.col("change_percent").cast("decimal(18,6)")
    return (
        recent.where(F.col("change_percent").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.try_divide(F.sum(change).cast("double"), F.count("*").cast("double")).alias("mean_change"),
            F.count("*").alias("orders_seen"),
            F.sum(money(amount)).cast("double").alias("recent_value"),
        )
        .withColumn("at_risk", F.col("mean_change") < drop)
    )


def churn_by_recency(df: DataFrame, as_of: str) -> DataFrame:
    """Customers, mean ticket and value per risk band, by days since the last order."""
    per_customer = customer_360(df).withColumn(
        "days", F.datediff(F.lit(as_of).cast("date"), "last_purchase")
    )
    return (
        per_customer.groupBy(churn_risk("days").alias("risk"))
        .agg(
            F.count("*").alias("customers"),
            F.sum("total_orders").alias("orders"),
            F.sum(money("lifetime_value")).cast("double").alias("value"),
        )
        .withColumn("avg_ticket", F.try_divide("value", "orders"))
    )


def segments(df: DataFrame, as_of: str, scale: float = 1.0) -> DataFrame:
    """One row per customer with its segment."""
    days = F.datediff(F.lit(as_of).cast("date"), "last_purchase")
    return customer_360(df).withColumn("days", days).withColumn(
        "segment", customer_segment("lifetime_value", "total_orders", "days", scale)
    )


def segment_report(per_customer: DataFrame) -> DataFrame:
    """Customers, percent of customers and mean ticket per segment."""
    sums = per_customer.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.sum("total_orders").alias("_orders"),
        F.sum(money("lifetime_value")).cast("double").alias("_value"),
    )
    everyone = per_customer.agg(F.count("*")).scalar()
    return sums.select(
        "segment", "customers",
        (F.col("customers") * 100.0 / everyone).alias("percent"),
        F.try_divide("_value", "_orders").alias("avg_ticket"),
    )
