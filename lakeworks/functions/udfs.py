"""Python functions on Spark columns, beside their native twins.

The native forms in `columns.py` are what the jobs use. These show the same rules as Arrow-fed
Python functions, for rules that cannot be written as column expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions.columns import SEGMENTS, TICKET_ABOVE, TICKET_BANDS, TICKET_MISSING


def ticket_band_udf(scale: float = 1.0):
    """Row function over Arrow batches; `scale` is closed over and shipped with the function."""

    @F.udf(returnType=T.StringType(), useArrow=True)
    def classify(amount):
        if amount is None:
            return TICKET_MISSING
        for bound, label in TICKET_BANDS:
            if amount < bound * scale:
                return label
        return TICKET_ABOVE

    return classify


def ticket_band_pandas(scale: float = 1.0):
    """Whole-batch function: one numpy pass per Arrow batch."""
    bounds = np.array([b for b, _ in TICKET_BANDS]) * scale
    labels = np.array([label for _, label in TICKET_BANDS] + [TICKET_ABOVE], dtype=object)

    @F.pandas_udf(T.StringType())
    def classify(amount: pd.Series) -> pd.Series:
        place = np.searchsorted(bounds, amount.fillna(0).to_numpy(), side="right")
        return pd.Series(labels[place]).where(amount.notna().to_numpy(), TICKET_MISSING)

    return classify


def segment_udf(scale: float = 1.0):
    """Segment from three columns at once."""
    risk, vip, gold, silver, bronze, other = SEGMENTS

    @F.udf(returnType=T.StringType(), useArrow=True)
    def classify(spent, orders, days):
        spent, orders, days = spent or 0, orders or 0, days or 0
        if days > 90:
            return risk
        if spent > 5000 * scale and orders >= 20 and days < 30:
            return vip
        if spent > 2000 * scale and orders >= 10 and days < 60:
            return gold
        if spent > 500 * scale and orders >= 5:
            return silver
        return bronze if spent > 100 * scale or orders >= 2 else other

    return classify


def lookup_udf(spark, mapping: dict[str, str], default: str):
    """Lookup in a small dictionary sent once per executor as a broadcast variable."""
    shared = spark.sparkContext.broadcast(mapping)

    @F.udf(returnType=T.StringType(), useArrow=True)
    def find(key):
        return shared.value.get(key, default)

    return find


def lookup_native(column: Column | str, mapping: dict[str, str], default: str) -> Column:
    """The same lookup as a literal map inside the plan."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), F.lit(default))


def count_differences(df: DataFrame, one: str, other: str) -> DataFrame:
    """Rows, and rows on which two columns differ (nulls compare equal)."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col(one).eqNullSafe(F.col(other))).alias("different"),
    )
