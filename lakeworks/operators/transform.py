"""Row and column shaping: alignment to a schema, renaming, deduplication, samples, introspection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions.columns import bucket_of


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Bring a frame to a schema: cast what is there (null where a value does not fit), add what
    is missing as typed null, drop the rest, in the order of the schema."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in target
        ]
    )


def keep_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that the frame has."""
    return df.select(*[c for c in wanted if c in df.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column some frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalise(df: DataFrame, names: Mapping[str, str], target: T.StructType, **derived: Column) -> DataFrame:
    """Rename to the common names, add derived columns, align to the target."""
    return align(df.withColumnsRenamed(dict(names)).withColumns(derived), target)


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: str = "last"
) -> DataFrame:
    """The row of each key that is last (or first) in the order.

    An aggregate, not a window: every task first reduces its own rows, so a key of any size, or
    a group of identical copies, sends one row per task through the shuffle.
    """
    pick = {"last": F.max_by, "first": F.min_by}[keep]
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def count_copies(df: DataFrame, name: str = "copies") -> DataFrame:
    """Distinct rows with the number of times each occurs: nothing is lost, copies take no room."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(name))


def hash_sample(df: DataFrame, keys: Sequence[str], one_in: int, pick: int = 0) -> DataFrame:
    """A sample by key: the same keys are chosen in every run and in every table."""
    return df.where(bucket_of(keys, one_in) == pick)


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Columns of a schema as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema)]
    return spark.createDataFrame(rows, "position long, column string, type string, nullable boolean")


def compare_schemas(spark: SparkSession, left: T.StructType, right: T.StructType) -> DataFrame:
    """Columns of two schemas side by side: same, other type, only left, only right."""
    a = schema_frame(spark, left).select("column", F.col("type").alias("left_type"))
    b = schema_frame(spark, right).select("column", F.col("type").alias("right_type"))
    state = (
        F.when(F.col("left_type").isNull(), "only right")
        .when(F.col("right_type").isNull(), "only left")
        .when(F.col("left_type") != F.col("right_type"), "other type")
        .otherwise("same")
    )
    return a.join(b, "column", "full").withColumn("state", state)


def null_comparison(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Per source and column: type, rows and nulls; one pass over each source."""
    parts = []
    for source, df in frames.items():
        cells = [
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count("*").alias("rows"),
                F.count_if(F.col(f.name).isNull()).alias("nulls"),
            )
            for f in df.schema
        ]
        wide = df.agg(F.array(*cells).alias("cells"))
        parts.append(wide.select(F.lit(source).alias("source"), F.inline("cells")))
    return union_all(parts)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as `explain` prints it."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def plan_contains(df: DataFrame, *nodes: str) -> bool:
    text = plan_text(df)
    return all(n in text for n in nodes)
