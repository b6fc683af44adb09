"""Numbers for all rows in an order, without one task that sees them all."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def numbered(df: DataFrame, order: list[str], name: str, *, partitions: int | None = None) -> DataFrame:
    """`df` with the place of each row in the order of the columns `order`, from 1, as `name`.

    Two passes: rows are sorted in ranges, one task each, and stored with their place in the range;
    then the sizes of the ranges, one number a task, give where each range starts. Equal rows get
    numbers side by side, so that numbers do not depend on partitions, retries or repeated loads
    if `order` tells all other rows apart. Rows equal in all of `order` stand in one range.
    """
    spark = df.sparkSession
    columns = [F.col(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    # The id of a row is its partition in the upper bits and its place there in the lower 33.
    rows = stored(
        ranged.sortWithinPartitions(*columns).select(
            F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")
        ),
        "numbered",
    ).select("row", F.shiftright("id", 33).alias("block"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place"))
    sizes = rows.groupBy("block").count().orderBy("block").collect()
    starts = accumulate([0] + [row["count"] for row in sizes])
    offsets = spark.createDataFrame(
        [(row["block"], start) for row, start in zip(sizes, starts)], "block bigint, start bigint"
    )
    return rows.join(F.broadcast(offsets), "block").select(
        "row.*", (F.col("start") + F.col("place") + 1).alias(name)
    )
