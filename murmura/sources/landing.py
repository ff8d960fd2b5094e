"""The landing folder: JSON lines in, one object per line."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.functions.measures import counter
from murmura.schemas import API_RECORD, CORRUPT, COUNTERS, LANDED


# A file's age never keeps it out of the stream.
ANY_AGE = "36500d"
# Fixed value: times are landed in full, with their zone.
LANDED_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# How lines are written. Readers tell a compressed file by its name, so plain files may lie beside.
LANDED_AS = {"timestampFormat": LANDED_TIME, "compression": "gzip"}


def _line_reader(reader, schema: T.StructType):
    return (
        reader.schema(schema)
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Flat raw messages. A line that cannot be read is a row with ``_corrupt_record``."""
    return _typed(_line_reader(spark.read, LANDED).json(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Nested service records."""
    records = _line_reader(spark.read, API_RECORD).json(path)
    metrics = F.struct(*[counter(F.col(f"public_metrics.{c}")).alias(c) for c in COUNTERS])
    return records.withColumn("public_metrics", metrics)


def _typed(lines: DataFrame) -> DataFrame:
    return lines.withColumns({c: counter(F.col(c)) for c in COUNTERS})


def stream_messages(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, archive: str | None = None
) -> DataFrame:
    """New landing files as a stream of raw messages, whatever their age.

    With ``archive``, files that were read move there (outside the landing folder), so
    that listing the folder and remembering its files stay cheap.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", ANY_AGE)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _typed(_line_reader(reader, LANDED).json(folder))


def content_name(spark: SparkSession, path: str) -> str:
    """A name for the files of a path out of their names, sizes and times; reads none of them."""
    row = (
        spark.read.format("binaryFile").load(path)
        .select(F.xxhash64("path", "modificationTime", "length").alias("h"))
        .agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.pmod("h", F.lit(1_000_003))).alias("s"))
        .first()
    )
    return f"{row['n']}-{(row['x'] or 0) & (2**64 - 1):016x}-{row['s'] or 0:x}"


def land_messages(messages: DataFrame, folder: str) -> None:
    """Append messages to the landing folder as compressed JSON lines.

    One task reads a whole compressed file; a large frame should have several partitions a core.
    """
    messages.write.mode("append").options(**LANDED_AS).json(folder)


def land_in_one_file(messages: DataFrame, folder: str) -> None:
    """Append messages to the landing folder as one compressed file that many tasks write.

    Each task compresses its own rows; gzip files one after the other are one gzip file. Readers see nothing of it
    until it is whole.
    """
    spark, name = messages.sparkSession, uuid.uuid4().hex
    path, io = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.hadoop.io.IOUtils
    conf = spark._jsc.hadoopConfiguration()
    parts, whole = path(f"{folder}/_parts-{name}"), path(f"{folder}/_whole-{name}")
    messages.write.options(**LANDED_AS).json(parts.toString())
    files = parts.getFileSystem(conf)
    out = files.create(whole)
    try:
        for found in sorted((f.getPath() for f in files.listStatus(parts)), key=lambda p: p.getName()):
            if found.getName().startswith("part-"):
                part = files.open(found)
                try:
                    io.copyBytes(part, out, conf, False)
                finally:
                    part.close()
    finally:
        out.close()
    files.rename(whole, path(f"{folder}/part-{name}.json.gz"))
    files.delete(parts, True)


def exists(spark: SparkSession, path: str) -> bool:
    """True when something lies at a path or matches a glob; asks the file system, runs no query."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where))


def if_present(read, spark: SparkSession | None = None, path: str | None = None) -> DataFrame | None:
    """The frame ``read()`` gives, or None when its path does not exist.

    With ``path`` that is looked up first, so that a missing one is no failed query in the logs.
    """
    if path is not None and not exists(spark, path):
        return None
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_file_time(spark: SparkSession, folder: str) -> DataFrame:
    """One row with the newest file's modification time; lists files, reads none."""
    files = if_present(lambda: spark.read.format("binaryFile").load(folder), spark, folder)
    if files is None:
        return spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS newest")
    return files.agg(F.max("modificationTime").alias("newest"))
