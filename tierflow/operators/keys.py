"""Sequential ids for rows that lack one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def assign_sequential_ids(
    df: DataFrame, id_col: str, order_by: list[str], taken: DataFrame | None = None
) -> DataFrame:
    """Fill NULL ids with the numbers after the largest id, in the given total order.

    The largest id is that of ``taken``, a table ``df`` is part of, if one is given. Ids may be text: they
    count as numbers, and text that is none does not count.

    Rows to number are range-partitioned and sorted, written once to the shared folder with their
    partition and position, and shifted by the counts of the partitions before. No task sees more
    than its own range, and a lost executor does not change numbers already given.
    """
    spark = df.sparkSession
    dtype = df.schema[id_col].dataType
    missing = df.filter(F.col(id_col).isNull()).repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    path = scratch_path(spark, "ids")
    # monotonically_increasing_id holds the partition in its upper bits and the row position below.
    row = F.monotonically_increasing_id()
    missing.select(
        "*",
        F.shiftright(row, 33).alias("_part"),
        row.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    ).write.parquet(path)
    placed = spark.read.parquet(path)

    # One row per partition of the range shuffle: bounded by the partition count, not by the data.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    top = (df if taken is None else taken).agg(F.coalesce(F.max(F.col(id_col).try_cast("bigint")), F.lit(0)).alias("_top"))

    number = top.scalar() + F.col("_offset") + F.col("_pos") + 1
    numbered = placed.join(F.broadcast(offsets), "_part")
    filled = numbered.withColumn(id_col, number.cast(dtype)).select(*df.columns)
    return df.filter(F.col(id_col).isNotNull()).unionByName(filled)
