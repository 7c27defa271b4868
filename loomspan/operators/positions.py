"""Global row numbers without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomspan.session import persisted


def ordinals(df: DataFrame, order: list[Column | str], label: str = "ordinals", name: str = "ordinal") -> DataFrame:
    """Adds `name` (0, 1, ...) in the total order of `order`.

    Rows are range-partitioned, sorted and written with their partition and
    place in it; the counts of the partitions, one number each, give every
    partition its start.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    sorted_ = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = persisted(sorted_.withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND((1 << 33) - 1)), label)
    starts, total = [], 0
    for part, count in sorted(stored.groupBy("_part").count().collect()):
        starts.append((part, total))
        total += count
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    joined = stored.join(F.broadcast(offsets), "_part")  # one row per partition
    return joined.withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
