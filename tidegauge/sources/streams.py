"""Where observations come from: text files, logger files, message queues, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import broadcast_up_to, materialise

LINES = T.StructType([T.StructField("seq", T.LongType()), T.StructField("line", T.StringType())])


def lines_of(spark: SparkSession, lines: list[str]) -> DataFrame:
    """A bounded collection, in order."""
    return spark.createDataFrame(list(enumerate(lines)), LINES)


#: Splits of files that go to every executor at most.
BROADCAST_SPLITS = 1_000_000


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as (seq, line): file after file by name, and in a file by place. Empty lines count but aren't returned.

    The lines of each split of a file are numbered where they are read; the counts of the splits, in order, make up for the rest.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")
    )
    splits = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))  # a row a split
    placed = materialise(splits.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), "splits")
    return lines.join(broadcast_up_to(placed, BROADCAST_SPLITS), ["file", "block"]).select((F.col("n") + F.col("shift")).alias("seq"), "line").filter("line <> ''")


#: Partitions of a topic that one order of arrival tells apart.
TOPIC_PARTITIONS = 1 << 16


def queue_lines(spark: SparkSession, servers: str, topic: str, streaming: bool = True) -> DataFrame:
    """A message queue's topic as (seq, line); needs Spark's Kafka connector on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return queued(reader.load())


def queued(messages: DataFrame) -> DataFrame:
    """(seq, line) of messages with partition, offset and value. seq is unique, in order of arrival within a partition, and follows the offset over all."""
    return messages.select((F.col("offset") * TOPIC_PARTITIONS + F.col("partition")).alias("seq"), F.col("value").cast("string").alias("line"))


def file_stream(spark: SparkSession, folder: str, schema: str | T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


#: Lines of a logger's file before its readings: one about the logger, three of headings, the first of which names the columns.
LOGGER_HEAD = 4


def logger_file(spark: SparkSession, path: str) -> DataFrame:
    """Loggers' `.dat` files, wide, as (site, sensor, time, value, seq). Each file has its own site and columns."""
    whole = spark.read.text(path).select(F.split(F.regexp_replace("value", '"', ""), ",").alias("r"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    first = Window.partitionBy("file").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = whole.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("n")))  # a logger's file is one task's work, as it is where it is read
    headed = rows.withColumns({"site": F.first("r").over(first)[0], "names": F.max(F.when(F.col("line") == 2, F.col("r"))).over(first)}).filter(F.col("line") > LOGGER_HEAD)
    time = F.element_at("r", F.array_position("names", F.lit("TIMESTAMP")).cast("int"))
    each = headed.select("site", time.alias("time"), (F.col("line") - 1).cast("long").alias("seq"), F.explode(F.arrays_zip(F.transform("names", F.trim).alias("sensor"), F.col("r").alias("value"))).alias("o"))
    return each.select(F.trim("site").alias("site"), "o.sensor", "time", F.trim("o.value").alias("value"), "seq").filter("sensor <> 'TIMESTAMP'")
