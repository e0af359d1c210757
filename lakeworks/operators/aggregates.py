"""Grouped reports. Every one is a partial aggregate before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.positions import overall_percentiles
from lakeworks.operators.skew import By, Cut, ranked, running, same_keys, with_group_totals
from lakeworks.runtime import mean, money, total


def revenue_report(df: DataFrame, keys: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Revenue, orders and mean ticket per group."""
    return df.groupBy(*keys).agg(
        total(amount).alias("revenue"),
        F.count("*").alias("orders"),
        mean(amount).alias("avg_ticket"),
    )


def revenue_base(df: DataFrame, keys: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Exact sums per group of all the keys, from which `revenue_report_from` makes the reports by some of them."""
    return df.groupBy(*keys).agg(
        F.sum(money(amount)).alias("_total"), F.count("*").alias("_orders"), F.count(amount).alias("_priced")
    )


def revenue_report_from(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`revenue_report` by some keys (or what follows from them) of a `revenue_base`, without another pass over the rows."""
    revenue = F.sum("_total").cast("double")
    return base.groupBy(*keys).agg(
        revenue.alias("revenue"),
        F.sum("_orders").alias("orders"),
        F.try_divide(revenue, F.sum("_priced").cast("double")).alias("avg_ticket"),
    )


def panel(df: DataFrame, amount: str, customer: str) -> DataFrame:
    """The whole frame in one row."""
    return df.agg(
        F.count("*").alias("orders"),
        F.count_distinct(customer).alias("customers"),
        total(amount).alias("revenue"),
        mean(amount).alias("avg_ticket"),
        F.min(amount).alias("min_ticket"),
        F.max(amount).alias("max_ticket"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def share_in_group(
    df: DataFrame, group: Sequence[str], part: Sequence[str], amount: str
) -> DataFrame:
    """Value per (group, part) and its percent of the group; rows without a group are one.

    Sums are joined with the sums of the groups, so a group may have any number of parts.
    """
    sums = df.groupBy(*group, *part).agg(F.sum(money(amount)).alias("_value"), F.count("*").alias("orders"))
    whole = F.col("_whole")
    return with_group_totals(sums, group, {"_whole": F.sum("_value")}).select(
        *group, *part, "orders",
        F.col("_value").cast("double").alias("revenue"),
        (F.try_divide(F.col("_value").cast("double"), whole.cast("double")) * 100).alias("percent"),
    )


def mode_of(df: DataFrame, group: Sequence[str], column: str, name: str) -> DataFrame:
    """Most frequent value per group, the smaller value on ties; nulls count as a value.

    The window runs over the counts and keeps one row, so each task sends one row per group.
    """
    counts = df.groupBy(*group, column).agg(F.count("*").alias(f"{name}_count"))
    best = Window.partitionBy(*group).orderBy(F.desc(f"{name}_count"), F.asc_nulls_last(column))
    first = counts.withColumn("_place", F.row_number().over(best)).where("_place = 1")
    return first.select(*group, F.col(column).alias(name), f"{name}_count")


def executive_report(df: DataFrame, group: str, amount: str, customer: str, method: str) -> DataFrame:
    """Revenue, orders, customers, mean ticket and dominant method per group."""
    figures = df.groupBy(group).agg(
        total(amount).alias("revenue"),
        F.count("*").alias("orders"),
        F.count_distinct(customer).alias("customers"),
        mean(amount).alias("avg_ticket"),
    )
    return figures.join(mode_of(df, [group], method, "top_method"), group, "left")


def top_k(df: DataFrame, by: Sequence[By], k: int) -> DataFrame:
    """First k rows in the order: each task keeps k rows, then one merge of those."""
    return df.orderBy(*[b.order for b in by]).limit(k)


def customer_360(df: DataFrame, amount: str = "total_amount", channel: str = "partner_source") -> DataFrame:
    """Lifetime value, orders, first and last purchase and channels per customer."""
    return df.groupBy("customer_id").agg(
        total(amount).alias("lifetime_value"),
        F.count("*").alias("total_orders"),
        F.min("order_date").alias("first_purchase"),
        F.max("order_date").alias("last_purchase"),
        F.count_distinct(channel).alias("num_channels"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, min and max per column, one pass, one row per column."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def percentiles(
    df: DataFrame,
    column: str,
    shares: Sequence[float],
    keys: Sequence[str] = (),
    cut: Cut | None = None,
) -> DataFrame:
    """Exact percentiles, interpolated between neighbouring values, per key or over all rows.

    Equal values are counted first; the running count of the distinct values (skew-safe, so no
    group is sorted in one task) tells which value sits at each position. Over all rows histograms that are
    refined around the wanted positions do.
    """
    keys = list(keys)
    if not keys:
        return overall_percentiles(df, column, shares)
    values = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_x"))
    counts = values.groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    placed = running(counts, keys, [By("_x")], {"_upto": F.col("_n")}, cut)
    sizes = values.groupBy(*keys).agg(F.count("*").alias("_rows"))
    sizes = sizes.alias("z")
    placed = placed.alias("p").join(sizes, same_keys("p", "z", keys)).select("p.*", "z._rows")
    first, end = F.col("_upto") - F.col("_n"), F.col("_upto")
    picks, finals = [], []
    for i, share in enumerate(shares):
        position = F.lit(float(share)) * (F.col("_rows") - 1)
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (first <= index) & (index < end)
            picks.append(F.max(F.when(here, F.col("_x"))).alias(f"_{side}{i}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_f{i}"))
        finals.append(
            (F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
            .alias(f"p{round(share * 100)}")
        )
    return placed.groupBy(*keys).agg(*picks).select(*keys, *finals)


def concentration(
    df: DataFrame, group: str, member: str, amount: str, top: int
) -> DataFrame:
    """Share of all value held by the `top` members of each group (ties at the end included)."""
    sums = df.groupBy(group, member).agg(F.sum(money(amount)).alias("_value"))
    places = ranked(sums, [group], [By("_value", desc=True), By(member)])
    held = F.sum(F.when(F.col("dense_rank") <= top, F.col("_value"))).cast("double")
    return places.agg(
        F.count_if(F.col("dense_rank") <= top).alias("top_members"),
        held.alias("top_value"),
        F.sum("_value").cast("double").alias("all_value"),
    ).withColumn("percent", F.try_divide(F.col("top_value") * 100, F.col("all_value")))


def duplicate_impact(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], amount: str) -> DataFrame:
    """Revenue, rows and mean ticket with and without repeated keys, and the inflation.

    Per key only the sum, the count and the kept amount are needed, so one aggregate does.
    """
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.sum(money(amount)).alias("_all"),
        F.min_by(money(amount), F.struct(*order)).alias("_kept"),
    )
    out = per_key.agg(
        F.sum("_n").alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.sum("_all").cast("double").alias("revenue_before"),
        F.sum("_kept").cast("double").alias("revenue_after"),
    )
    return out.withColumns(
        {
            "ticket_before": F.try_divide("revenue_before", "rows_before"),
            "ticket_after": F.try_divide("revenue_after", "rows_after"),
            "inflation_percent": F.try_divide(
                (F.col("revenue_before") - F.col("revenue_after")) * 100, "revenue_after"
            ),
        }
    )


def partition_advice(df: DataFrame, date_column: str) -> DataFrame:
    """Partitions and mean rows per partition by day, month and year, with advice.

    Days are counted first; months and years add up those counts.
    """
    # Row counts per partition between the recommendations.
    small, daily, monthly = 1_000, 100_000, 1_000_000
    days = df.groupBy(F.col(date_column).cast("date").alias("_day")).agg(F.count("*").alias("_n"))
    grains = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
    labels = [
        F.struct(F.lit(g).alias("grain"), F.date_format("_day", f).alias("label"), F.col("_n"))
        for g, f in grains.items()
    ]
    each = days.select(F.inline(F.array(*labels))).groupBy("grain", "label").agg(F.sum("_n").alias("_n"))
    stats = each.groupBy("grain").agg(
        F.count("*").alias("partitions"),
        F.try_divide(F.sum("_n").cast("double"), F.count("*").cast("double")).alias("mean_rows"),
        F.min("_n").alias("min_rows"),
        F.max("_n").alias("max_rows"),
    )
    rows = F.col("mean_rows")
    advice = (
        F.when(rows < small, "coarser")
        .when(rows <= daily, "fits daily data")
        .when(rows <= monthly, "fits monthly data")
        .otherwise("finer")
    )
    return stats.withColumn("advice", advice)

