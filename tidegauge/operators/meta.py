"""Checks of metadata records, whose outcomes hold for an interval of all series they affect."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import vocab
from tidegauge.functions.vocab import SERIES
from tidegauge.operators.threshold import apply_bounds

AFFECTED = [f"a_{c}" for c in SERIES]


def _affected(meta_affected: DataFrame, kind: str) -> DataFrame:
    return meta_affected.filter(F.col("kind") == kind).select("feature", F.col("name").alias("data_type"), *AFFECTED)


def identity_outcomes(records: DataFrame, meta_affected: DataFrame) -> DataFrame:
    """Each record fails every series on its list from start to end."""
    joined = records.join(_affected(meta_affected, "identity"), ["feature", "data_type"])
    series = [F.col(f"a_{c}").alias(c) for c in SERIES]
    return joined.select("seq", *series, "start_ms", "end_ms", F.concat(F.lit(vocab.META_IDENTITY), "data_type").alias("qualifier"), F.lit(vocab.FAIL).alias("qualitative"))


def value_outcomes(records: DataFrame, meta_affected: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    """Failures only, of the value against the bounds at the middle of the interval, for every affected series."""
    middle = F.col("start_ms") + F.floor((F.col("end_ms") - F.col("start_ms")) / 2)
    tested = records.select(
        "seq", "feature", F.lit("meta").alias("procedure"), F.col("data_type").alias("observableproperty"), "data_type", "start_ms", "end_ms", F.col("value").try_cast("double").alias("tested"), middle.alias("instant")
    )
    failed = apply_bounds(tested, qc_test, qc_bound, "range", F.concat(F.lit(vocab.META_VALUE), "data_type", F.lit("/")), scope="meta").filter(F.col("qualitative") == vocab.FAIL)
    failed = failed.drop("procedure", "observableproperty").join(_affected(meta_affected, "value"), ["feature", "data_type"])
    series = [F.col(f"a_{c}").alias(c) for c in SERIES]
    return failed.select("seq", *series, "start_ms", "end_ms", "qualifier", "qualitative", "quantitative")


DAY = 86_400_000


def apply_intervals(outcomes: DataFrame, intervals: DataFrame) -> DataFrame:
    """Stored outcomes, failed where an interval outcome of the same series and qualifier covers their time.

    Intervals are cut at midnight and united where they overlap, so each outcome meets one at most in a single left join
    on series, qualifier and day.
    """
    own = intervals.select(*SERIES, "qualifier", "start_ms", "end_ms", F.explode(F.sequence(F.floor(F.col("start_ms") / DAY), F.floor(F.col("end_ms") / DAY))).alias("day"))
    cut = own.select(*SERIES, "qualifier", "day", F.greatest("start_ms", F.col("day") * DAY).alias("start_ms"), F.least("end_ms", F.col("day") * DAY + DAY - 1).alias("end_ms"))
    in_order = Window.partitionBy(*SERIES, "qualifier", "day").orderBy("start_ms", "end_ms")
    apart = cut.withColumn("new", F.coalesce(F.col("start_ms") > F.max("end_ms").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int"))
    united = apart.withColumn("part", F.sum("new").over(in_order)).groupBy(*SERIES, "qualifier", "day", "part").agg(F.min("start_ms").alias("from_ms"), F.max("end_ms").alias("to_ms"))
    rows = outcomes.withColumn("day", F.floor(F.col("t_ms") / DAY))
    same = [rows[c].eqNullSafe(united[c]) for c in [*SERIES, "qualifier", "day"]]
    met = rows.join(united.withColumn("covers", F.lit(True)), [*same, rows["t_ms"].between(united["from_ms"], united["to_ms"])], "left")
    return met.select(*(F.when(F.col("covers"), vocab.FAIL).otherwise(rows[c]).alias(c) if c == "qualitative" else rows[c] for c in outcomes.columns))
