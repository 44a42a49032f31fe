"""Checks of single observations, and of each against those that arrived before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import vocab
from tidegauge.functions.vocab import SERIES

KEEP = ["seq", *SERIES, "year", "month", "t_ms"]


def verdict(passes: Column) -> Column:
    return F.when(passes, vocab.PASS).otherwise(vocab.FAIL)


def null_check(obs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One outcome an observation: has it a value of its kind? keep: further columns that stay."""
    has = F.when(F.col("obs_type") == "category", F.col("category_value").isNotNull()).otherwise(F.col("value").isNotNull())
    return obs.select(*KEEP, *keep, F.lit(vocab.NULL_CHECK).alias("qualifier"), verdict(has).alias("qualitative"))


def running_max(rows: DataFrame, what: str, name: str, chunk: int = 1_000_000) -> DataFrame:
    """Adds `name`, the greatest `what` among the rows of the series that arrived earlier, by seq and arrival; null if there is none.

    A series is cut into chunks of arrival numbers, each a window of its own, and the maxima of whole chunks make up for
    the rest: no series is one task's work.
    """
    by_arrival = Window.partitionBy(*SERIES, "chunk").orderBy("seq", "arrival").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("chunk", F.floor(F.col("seq") / chunk))
    ends = own.groupBy(*SERIES, "chunk").agg(F.max(what).alias("end"))
    before = ends.select(*SERIES, "chunk", F.max("end").over(Window.partitionBy(*SERIES).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    return own.withColumn("here", F.max(what).over(by_arrival)).join(before, [*SERIES, "chunk"]).withColumn(name, F.greatest("here", "before")).drop("chunk", "here", "before")


def _with_latest(obs: DataFrame, tie: str | None, chunk: int) -> DataFrame:
    return running_max(obs.withColumn("arrival", F.col(tie) if tie else F.col("t_ms")), "t_ms", "latest", chunk)


def order_outcomes(seen: DataFrame) -> DataFrame:
    distance = F.abs(F.col("t_ms") - F.col("latest"))
    in_order = F.col("latest").isNull() | (F.col("t_ms") > F.col("latest"))
    quantity = F.when(F.col("latest").isNull(), 0).when(in_order, -distance).otherwise(distance)
    return seen.select(*KEEP, F.lit(vocab.ORDER_CHECK).alias("qualifier"), verdict(in_order).alias("qualitative"), quantity.cast("double").alias("quantitative"))


def order_check(obs: DataFrame, tie: str | None = None, chunk: int = 1_000_000) -> DataFrame:
    """Later than all that arrived before? quantitative: milliseconds from the latest, negative where in order, 0 for the first."""
    return order_outcomes(_with_latest(obs, tie, chunk))


def spacing_outcomes(seen: DataFrame, series_meta: DataFrame) -> DataFrame:
    limits = series_meta.filter("intended_spacing_ms is not null").select(*SERIES, "intended_spacing_ms")
    timed = seen.join(limits, SERIES)
    distance = F.abs(F.col("t_ms") - F.col("latest"))
    close = F.col("latest").isNull() | (distance <= F.col("intended_spacing_ms"))
    quantity = F.when(F.col("latest").isNull(), 0).when(close, -distance).otherwise(distance)
    return timed.select(*KEEP, F.lit(vocab.SPACING_CHECK).alias("qualifier"), verdict(close).alias("qualitative"), quantity.cast("double").alias("quantitative"))


def spacing_check(obs: DataFrame, series_meta: DataFrame, tie: str | None = None, chunk: int = 1_000_000) -> DataFrame:
    """Within the intended spacing of the latest before it? Only for series that have one."""
    return spacing_outcomes(_with_latest(obs, tie, chunk), series_meta)


def default_identity(obs: DataFrame, meta_check: DataFrame) -> DataFrame:
    """A pass for each identity check of the feature, until a metadata record says otherwise."""
    checks = meta_check.filter("kind = 'identity'").select("feature", "name")
    return obs.join(checks, "feature").select(*KEEP, F.concat(F.lit(vocab.META_IDENTITY), "name").alias("qualifier"), F.lit(vocab.PASS).alias("qualitative"))


def default_value(obs: DataFrame, meta_check: DataFrame, qc_test: DataFrame) -> DataFrame:
    """A pass for both bounds of each test of each kind of metadata value of the feature."""
    tests = qc_test.filter("scope = 'meta' and check = 'range'").select("feature", F.col("observableproperty").alias("name"), "test")
    kinds = meta_check.filter("kind = 'value'").select("feature", "name")
    rows = obs.join(kinds, "feature").join(tests, ["feature", "name"]).withColumn("bound", F.explode(F.array(F.lit("min"), F.lit("max"))))
    qualifier = F.concat(F.lit(vocab.META_VALUE), "name", F.lit("/"), "test", F.lit("/"), "bound")
    return rows.select(*KEEP, qualifier.alias("qualifier"), F.lit(vocab.PASS).alias("qualitative"), F.lit(0.0).alias("quantitative"))
