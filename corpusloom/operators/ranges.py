"""Tables in an order, dealt into ranges of it that are worked on side by side.

The cuts come from Spark's own sample of the order, so the table is written once and every later step
reads the same ranges.  Rows of one key are spread too: what decides between them is where they were read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources import files


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: what was nondeterministic is fixed now."""
    spark = rows.sparkSession
    folder = files.work_folder(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def ranged(rows: DataFrame, order: list[str], part_rows: int) -> DataFrame:
    """``row`` (the columns of ``rows`` as a struct), ``part`` (range number, in the order; nulls first) and
    ``pos`` (place within the order: comparable in a range); a range has about ``part_rows`` rows."""
    parts = max(1, -(-rows.count() // part_rows))
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("tie"))
    keys = [*(f"k{i}" for i in range(len(order))), "tie"]
    sorted_rows = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return stored(sorted_rows.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "ranges")


def running(dealt: DataFrame, size: str) -> DataFrame:
    """A ``ranged`` table with ``offset``: the sum of ``size`` (a column of ``row``) before each row.  Only
    the totals of ranges meet in one place."""
    value = F.coalesce(F.col(f"row.`{size}`"), F.lit(0)).cast("bigint")
    totals = dealt.groupBy("part").agg(F.sum(value).alias("total"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(F.broadcast(before), "part").select("row", "part", "pos", (F.col("own") + F.col("before")).cast("bigint").alias("offset"))  # one row a range
