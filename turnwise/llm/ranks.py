"""Positions of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from turnwise.operators.scan import lookup_join
from turnwise.session import landed

_IN_PART = 33  # bits that monotonically_increasing_id leaves to the row within its partition


def rank_rows(df: DataFrame, group: str, order: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pos`` and ``size``, groups with ``size``): 0-based positions without gaps.

    ``group`` has no nulls; ``order`` may have, which come first. Rows are dealt by ranges of
    (group, order) and written once, so a group with a third of all rows is spread over as many
    partitions as it fills, and rows that are equal in all of these are spread too. A partition
    then adds to the order of its own rows the number of the group's rows before it, which is one
    narrow row per partition and group.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(group).asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie").asc()]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    rows = landed(df.sparkSession, rows, f"{label}-sorted")
    part = F.shiftright("_at", _IN_PART)
    counts = rows.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = landed(df.sparkSession, counts.select(
        group, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"),
        F.sum("_n").over(of_group).alias("size")), f"{label}-starts")
    placed = lookup_join(rows.withColumn("_part", part), starts, [group, "_part"], how="inner")
    return (placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"),
            starts.groupBy(group).agg(F.max("size").alias("size")))
