"""Order as part of the result: a position for every row, by a distributed sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmura.session import scratch_dir


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with each row's place in the order, from 1 on.

    Rows are dealt out by ranges of the order, sorted where they lie and written; a row's place is its
    number in its part plus the sizes of the parts before. Only those sizes, one a part, meet in
    one task. Equal rows of the order fall into one part, so an order should end with what tells rows apart.
    """
    part, row, first = "_part", "_row", "_first"
    path = scratch_dir(df.sparkSession, "ordered")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select(
        "*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(row)
    ).write.parquet(path)
    numbered = df.sparkSession.read.parquet(path)
    sizes = numbered.groupBy(part).agg(F.count("*").alias("_size"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(first))
    return numbered.join(F.broadcast(offsets), part).select(
        *df.columns, (F.col(first) + F.col(row) + 1).alias(name)
    )
