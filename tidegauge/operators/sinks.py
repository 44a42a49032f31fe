"""Tables that observations, outcomes and events end in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.vocab import SERIES
from tidegauge.session import drop, materialise

OUTCOME_KEY = [*SERIES, "t_ms", "qualifier"]


def latest(rows: DataFrame, key: Sequence[str] = tuple(OUTCOME_KEY), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Of rows with equal key the one that arrived last: what an upsert by primary key leaves."""
    by = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("place", F.row_number().over(by)).filter("place = 1").drop("place")


def write_partitioned(rows: DataFrame, path: str, mode: str = "append") -> None:
    """By year and month, sorted by series and time within a file, so that readers prune folders and skip row groups."""
    dealt = rows.repartition("year", "month", F.pmod(F.xxhash64(*SERIES), F.lit(16)))
    dealt.sortWithinPartitions(*SERIES, "t_ms").write.mode(mode).partitionBy("year", "month").parquet(path)


def upsert(rows: DataFrame, path: str, key: Sequence[str] = tuple(OUTCOME_KEY), order: Sequence[str] = ("seq",)) -> None:
    """Into a partitioned table: months that `rows` touches are rewritten from the old rows and the new, others stay.

    What a month will hold is written to scratch first and stays there until the table has it. A failure while tasks write
    leaves the table as it was; one while the months are moved into place may leave some old and some missing.
    """
    spark = rows.sparkSession
    months = rows.select("year", "month").distinct()
    try:
        old = spark.read.parquet(path).join(months, ["year", "month"], "left_semi").select(*rows.columns)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = rows.limit(0)  # the first write
    merged = materialise(latest(old.unionByName(rows), key, order).select(*rows.columns), "upsert")
    dealt = merged.repartition("year", "month", F.pmod(F.xxhash64(*key), F.lit(16))).sortWithinPartitions(*key)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    drop(merged)


def fan_out(sinks: dict[str, Callable[[DataFrame], DataFrame]], folder: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each part of a batch to its own table below the folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        for name, part in sinks.items():
            part(batch).write.mode("append").parquet(f"{folder}/{name}")
        batch.unpersist()

    return write
