"""Running numbers over all rows of a table, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.plans.storage import scratch_path

_PLACE_BITS = 33   # of monotonically_increasing_id: the row's place in its partition


def running_number(df: DataFrame, order, name: str) -> DataFrame:
    """``df`` with each row's place (int, from 1) in ``order``, which should tell
    all rows apart.

    Rows are range-partitioned and sorted by partition, and written with their
    place in it; the partitions' counts, one number each, give every
    partition's offset."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("_place", F.monotonically_increasing_id()).write.parquet(path))
    schema = df.schema.add("_place", "long")
    rows = spark.read.schema(schema).parquet(path).withColumns({
        "_part": F.shiftright("_place", _PLACE_BITS), "_in": F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)})
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    table = spark.createDataFrame(offsets, "_part long, _offset long")
    return (rows.join(F.broadcast(table), "_part")
            .withColumn(name, (F.col("_offset") + F.col("_in") + 1).cast("int"))
            .select(*df.columns, name))
