"""Checks of values against bounds: range, step, spike, variance. One join with the bounds serves them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import vocab
from tidegauge.functions.text import time_key
from tidegauge.functions.vocab import SERIES
from tidegauge.operators.along import around, window
from tidegauge.operators.logic import KEEP, verdict

HOURS = {"1h": 1, "12h": 12, "24h": 24}


def apply_bounds(rows: DataFrame, qc_test: DataFrame, qc_bound: DataFrame, check: str, prefix: Column, window: str = "", scope: str = "obs") -> DataFrame:
    """Adds qualifier, qualitative, quantitative for each bound of each test that applies at `instant` to `tested`.

    quantitative is how far the value is beyond the bound; it fails if that is above zero. Not a number never fails.
    """
    keys = [F.col("scope") == scope, F.col("check") == check, F.col("window") == window]
    tests, bounds = qc_test, qc_bound
    for condition in keys:
        tests, bounds = tests.filter(condition), bounds.filter(condition)
    tests = tests.select(*SERIES, "test", "resolution")
    bounds = bounds.select(*SERIES, "test", "time_key", "bound", "threshold")
    timed = rows.join(tests, SERIES).withColumn("time_key", time_key(F.col("resolution"), F.col("instant")))
    beyond = F.when(F.col("bound") == "min", F.col("threshold") - F.col("tested")).otherwise(F.col("tested") - F.col("threshold"))
    out = timed.join(bounds, [*SERIES, "test", "time_key"]).withColumn("quantitative", beyond)
    fails = (F.col("quantitative") > 0) & ~F.isnan("quantitative")
    qualifier = F.concat(prefix, F.lit(f"{window}/" if window else ""), "test", F.lit("/"), "bound")
    return out.withColumn("qualifier", qualifier).withColumn("qualitative", verdict(~fails)).drop("resolution", "time_key", "threshold")


def _outcomes(bounded: DataFrame) -> DataFrame:
    return bounded.select(*KEEP, "qualifier", "qualitative", "quantitative")


def numeric(obs: DataFrame) -> DataFrame:
    """What the checks of values look at."""
    return obs.filter("value is not null").select(*KEEP, "value", *(c for c in obs.columns if c == "tie"))


def range_check(obs: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    rows = numeric(obs).withColumn("tested", F.col("value")).withColumn("instant", F.col("t_ms"))
    return _outcomes(apply_bounds(rows, qc_test, qc_bound, "range", F.lit(vocab.RANGE)))


def _neighbours(obs: DataFrame, before: int) -> DataFrame:
    """Structs of ROW: each row and those so many before it, in order of arrival, as n0 (itself), n1, ..."""
    rows, this = numeric(obs), F.struct(*ROW)
    order = ("seq", *(["tie"] if "tie" in rows.columns else []))
    return around(rows, {f"n{i}": F.lag(this, i).over(window(order)) if i else this for i in range(before + 1)}, order, before, 0)


ROW = ["t_ms", "seq", "value", "year", "month"]


def step_outcomes(pairs: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    """pairs: structs of ROW, `a` the row that arrived before `b`."""
    tested = pairs.select(*SERIES, "a", "b", F.abs(F.col("a.value") - F.col("b.value")).alias("tested"), F.least("a.t_ms", "b.t_ms").alias("instant"))
    bounded = apply_bounds(tested, qc_test, qc_bound, "step", F.lit(vocab.STEP))
    each = bounded.withColumn("one", F.explode(F.array("a", "b")))
    return each.select("one.seq", *SERIES, "one.year", "one.month", "one.t_ms", "qualifier", "qualitative", "quantitative")


def delta_step(obs: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    """The distance of two neighbours in arrival, with an outcome for both; bounds are those at the older one's time."""
    pairs = _neighbours(obs, 1).select(*SERIES, F.col("n1").alias("a"), F.col("n0").alias("b")).filter("a is not null")
    return step_outcomes(pairs, qc_test, qc_bound)


def spike_outcomes(threes: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    """threes: structs of ROW in order of arrival, `first`, `a`, `b`."""
    s = F.array_sort(F.array("first", "a", "b"))
    a, m, b = (F.col("s")[i] for i in range(3))
    bend = F.abs(a["value"] - m["value"]) + F.abs(m["value"] - b["value"]) - F.abs(a["value"] - b["value"])
    own = threes.select(*SERIES, "first", s.alias("s"))
    tested = own.select(m["seq"].alias("seq"), *SERIES, m["year"].alias("year"), m["month"].alias("month"), m["t_ms"].alias("t_ms"), bend.alias("tested"), F.col("first.t_ms").alias("instant"))
    return _outcomes(apply_bounds(tested, qc_test, qc_bound, "spike", F.lit(vocab.SPIKE)))


def delta_spike(obs: DataFrame, qc_test: DataFrame, qc_bound: DataFrame) -> DataFrame:
    """By how much the way over the middle one of three neighbours is longer than the direct one; an outcome for the middle one by time, with the bounds at the time of the first that arrived."""
    threes = _neighbours(obs, 2).select(*SERIES, F.col("n2").alias("first"), F.col("n1").alias("a"), F.col("n0").alias("b")).filter("first is not null")
    return spike_outcomes(threes, qc_test, qc_bound)


def sigma_check(obs: DataFrame, qc_test: DataFrame, qc_bound: DataFrame, window: str) -> DataFrame:
    """The variance of a tumbling window, with an outcome for each observation in it; bounds are those at the window's centre."""
    size = HOURS[window] * 3_600_000
    rows = numeric(obs).withColumn("window_start", F.col("t_ms") - F.pmod("t_ms", F.lit(size)))
    # aggregated before it shuffles; the variance of a single value is 0
    spread = rows.groupBy(*SERIES, "window_start").agg(F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("tested"))
    spread = spread.withColumn("instant", F.col("window_start") + size // 2)
    bounded = apply_bounds(spread, qc_test, qc_bound, "sigma", F.lit(vocab.SIGMA), window)
    return rows.join(bounded, [*SERIES, "window_start"]).select(*KEEP, "qualifier", "qualitative", "quantitative")
