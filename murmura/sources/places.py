"""Rows of stored files named by their place, so that many can be left out without moving a text.

A place is a file and a row's number in it. Which places are wanted is found on narrow columns; of these a bitmap
for each file is sent to the tasks that read it, a bit a row, and no whole row crosses an exchange. Only a frame that
is read straight from Parquet files knows its places; others have to bring the columns of ``places`` with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one bitmap, and its bytes (Spark's own).
_BITS = 32_768
# Bitmaps that may be sent to the rows: half a billion rows.
MOST_BYTES = 64 << 20
FILE, AT = "_file", "_at"


def places() -> list[Column]:
    """A row's file and its number there, for the select on a frame of stored rows."""
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT)]


def fit(files: int, rows: int) -> bool:
    """True when the bitmaps of so many files and rows are small enough to be sent."""
    return files * (_BITS // 8) + rows // 8 <= MOST_BYTES


def without(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The stored rows that are not at the named places."""
    return _marked(rows, named).where("NOT _named").select(*rows.columns)


def only(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The stored rows at the named places."""
    return _marked(rows, named).where("_named").select(*rows.columns)


def _marked(rows: DataFrame, named: DataFrame) -> DataFrame:
    number = F.col(AT) + 1  # Spark's bitmaps count from 1
    bitmaps = named.groupBy(FILE, F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )
    placed = rows if AT in rows.columns else rows.select("*", *places())
    placed = placed.withColumn("_bucket", F.bitmap_bucket_number(number))
    bit = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, (bit % 8).cast("int")) == 1
    return placed.join(F.broadcast(bitmaps), [FILE, "_bucket"], "left").withColumn(
        "_named", F.coalesce(held, F.lit(False))
    )
