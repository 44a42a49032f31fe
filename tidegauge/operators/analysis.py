"""Bounds from data, rolling statistics, weighted forecasts, and eccentricity (TEDA)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import utc
from tidegauge.functions.vocab import SERIES
from tidegauge.operators.along import BLOCK_ROWS, BY_TIME, CHUNK_MS, around, so_far, window
from tidegauge.sources.registry import WINDOWS

HOUR = 3_600_000


# --- bounds ----------------------------------------------------------------------------------


def series_statistics(obs: DataFrame, digits: int = 0) -> DataFrame:
    return obs.filter("value is not null").groupBy(*SERIES).agg(F.round(F.avg("value"), digits).alias("mean"), F.round(F.stddev_samp("value"), digits).alias("sd"))


def bounds_from_data(obs: DataFrame, test: str = "static", digits: int = 0) -> DataFrame:
    """Rows like those of the registry's bounds: range, step, spike and sigma, from mean and standard deviation, which are rounded first."""
    m, s = F.col("mean"), F.col("sd")

    def rows(check: str, window: str, low: Column, high: Column) -> list[Column]:
        return [F.struct(F.lit(check).alias("check"), F.lit(window).alias("window"), F.lit(b).alias("bound"), x.cast("double").alias("threshold")) for b, x in (("min", low), ("max", high))]

    every = rows("range", "", m - 0.25 * s, m + s) + rows("step", "", 0.25 * s, 0.75 * s) + rows("spike", "", 0.25 * s, 0.75 * s)
    for window in WINDOWS:
        every += rows("sigma", window, F.pow(0.2 * s, F.lit(2.0)), F.pow(0.75 * s, F.lit(2.0)))
    out = series_statistics(obs, digits).select(*SERIES, F.explode(F.array(*every)).alias("o"))
    return out.select(F.lit("obs").alias("scope"), *SERIES, "o.check", "o.window", F.lit(test).alias("test"), "o.bound", F.lit("").alias("time_key"), "o.threshold")


def sensors(obs: DataFrame) -> DataFrame:
    """The sensors of each site that have observations."""
    return obs.select("feature", "procedure").distinct()


# --- rolling ---------------------------------------------------------------------------------


def clean(obs: DataFrame) -> DataFrame:
    """Values there are, once each, with their year, day of year and hour."""
    at = utc(F.col("t_ms"))
    return obs.filter("value is not null").withColumns({"year": F.year(at), "day": F.dayofyear(at), "hour": F.hour(at)}).dropDuplicates([*SERIES, "t_ms", "value"])


def rolling(obs: DataFrame, widths: Sequence[int], block: int = BLOCK_ROWS) -> DataFrame:
    """For each width (an even one is made odd): min, max and standard deviation over the rows around each; null where some are missing."""
    columns: dict[str, Column] = {}
    for width in widths:
        half = width // 2
        w = window(BY_TIME, -half, half)
        whole = F.count("value").over(w) == 2 * half + 1
        for name, f in (("min", F.min), ("max", F.max), ("sd", F.stddev_samp)):
            columns[f"{name}_{width}"] = F.when(whole, f("value").over(w))
    reach = max((w // 2 for w in widths), default=0)
    seen = around(obs.filter("value is not null").select("seq", *SERIES, "t_ms", "value"), columns, BY_TIME, reach, reach, block)
    return seen.select("seq", *SERIES, "t_ms", "value", *columns)


def step_at(obs: DataFrame, distance: int, block: int = BLOCK_ROWS) -> DataFrame:
    """The value so many rows on, less this one."""
    rows = obs.filter("value is not null").select("seq", *SERIES, "t_ms", "value")
    seen = around(rows, {"step": F.lead("value", distance).over(window(BY_TIME)) - F.col("value")}, BY_TIME, max(0, -distance), max(0, distance), block)
    return seen.select("seq", *SERIES, "t_ms", "step")


def weighted_forecast(history: DataFrame, targets: DataFrame, hours: int = 2, days: int = 7, year_width: float = 1.0, day_width: float = 3.0, hour_width: float = 1.0) -> DataFrame:
    """The mean of a series' values near the same hour and day of year (both wrap around), weighted by exp(-(distance / width)^2) of year, day and hour.

    Weights depend on year, day and hour alone, so the history is summed by these slots before anything meets, and of
    the targets only the distinct slots ask: both sides meet in an equi-join on series, day and hour, for which each slot
    asks every day and hour in reach.
    """
    own = clean(history).groupBy(*SERIES, F.col("year").alias("h_year"), (F.col("day") - 1).alias("d"), F.col("hour").alias("h")).agg(F.sum("value").alias("sum"), F.count("value").alias("n"))
    at = utc(F.col("t_ms"))
    slot = ["year", "day", "hour"]
    wanted = targets.select(*SERIES, "t_ms", F.year(at).alias("year"), (F.dayofyear(at) - 1).alias("day"), F.hour(at).alias("hour")).distinct()
    asked = wanted.select(*SERIES, *slot).distinct()
    asked = asked.withColumn("dd", F.explode(F.sequence(F.lit(-days), F.lit(days)))).withColumn("dh", F.explode(F.sequence(F.lit(-hours), F.lit(hours))))
    asked = asked.withColumns({"d": F.pmod(F.col("day") + F.col("dd"), F.lit(366)).cast("int"), "h": F.pmod(F.col("hour") + F.col("dh"), F.lit(24)).cast("int")})
    near = asked.join(own, [*SERIES, "d", "h"])

    def weight(distance: Column, width: float) -> Column:
        return F.exp(-F.pow(distance / width, F.lit(2.0)))

    w = weight(F.col("year") - F.col("h_year"), year_width) * weight(F.col("dd"), day_width) * weight(F.col("dh"), hour_width)
    summed = near.withColumn("w", w).groupBy(*SERIES, *slot).agg((F.sum(F.col("w") * F.col("sum")) / F.sum(F.col("w") * F.col("n"))).alias("forecast"), F.sum("n").alias("neighbours"))
    return wanted.join(summed, [*SERIES, *slot]).select(*SERIES, "t_ms", "forecast", "neighbours")


# --- eccentricity ----------------------------------------------------------------------------


#: Parts of a series, by value, that one window ranks.
SPLITS = 64


def teda_batch(obs: DataFrame) -> DataFrame:
    """Of each value among all of its series: eccentricity 2 * sum |x - y| / sum of all such sums, typicality, their normal forms, and the threshold 1 / k.

    Sums of distances come from sorted prefix sums, so no pair is formed; approximate quantiles of a series cut it for
    these, and have no part in the result.
    """
    rows = obs.filter("value is not null")
    series = rows.groupBy(*SERIES).agg(F.count("value").alias("k"), F.sum("value").alias("all"), F.percentile_approx("value", [i / SPLITS for i in range(1, SPLITS)], 1000).alias("cuts"))
    placed = rows.join(series, SERIES)
    chunk = F.size(F.filter("cuts", lambda c: c < F.col("value")))
    ranked = so_far(placed, {"i": F.lit(1), "below": F.col("value")}, chunk, ["value", "t_ms", "seq"]).drop("cuts")
    x, i, k = F.col("value"), F.col("i"), F.col("k")
    summed = ranked.withColumn("distance", (2 * i - k) * x + F.col("all") - 2 * F.col("below"))
    totals = summed.groupBy(*SERIES).agg(F.sum("distance").alias("total"))
    summed = summed.join(totals, SERIES)
    ecc = F.when((k > 1) & (F.col("total") > 0), 2 * F.col("distance") / F.nullif("total", F.lit(0.0)))
    return summed.select("seq", *SERIES, "t_ms", "value", ecc.alias("eccentricity"), (1 - ecc).alias("typicality"), (ecc / 2).alias("norm_eccentricity"), F.when(k > 2, (1 - ecc) / F.nullif(k - 2, F.lit(0))).alias("norm_typicality"), (F.lit(1.0) / k).alias("threshold"))


def _moments(rows: DataFrame, value: str, chunk_ms: int) -> DataFrame:
    """Adds k, mu and var: number, mean and variance of the values so far, by time; summed as distances from the mean of the series, which loses no digits."""
    centre = rows.groupBy(*SERIES).agg(F.avg(value).alias("centre"))
    own = rows.join(centre, SERIES).withColumn("off", F.col(value) - F.col("centre"))
    summed = so_far(own, {"k": F.lit(1).cast("long"), "s": F.col("off"), "ss": F.col("off") * F.col("off")}, F.floor(F.col("t_ms") / chunk_ms), ["t_ms", "seq"])
    off_mu = F.col("s") / F.col("k")
    return summed.withColumns({"mu": F.col("centre") + off_mu, "var": F.greatest(F.lit(0.0), F.col("ss") / F.col("k") - off_mu * off_mu)}).drop("centre", "off", "s", "ss")


def teda_2016(obs: DataFrame, value: str = "value", m: float = 2.0, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Recursive eccentricity 1/k + (mean - x)^2 / (k * variance) over the values so far, in closed form; null for the first and where all are equal. outlier: half of it is over (m^2 + 1) / (2k)."""
    seen = _moments(obs.filter(F.col(value).isNotNull()), value, chunk_ms=chunk_ms)
    k = F.col("k")
    ecc = F.when((k > 1) & (F.col("var") > TINY), 1.0 / k + F.pow(F.col("mu") - F.col(value), F.lit(2.0)) / F.nullif(k * F.col("var"), F.lit(0.0)))
    return seen.select("seq", *SERIES, "t_ms", F.col(value).alias("value"), k, ecc.alias("eccentricity"), (ecc / 2 > (m * m + 1) / (2 * k)).alias("outlier"))


#: A variance of so little is that of equal values, but for rounding.
TINY = 1e-12


def teda_2014(obs: DataFrame, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Recursive eccentricity by accumulated proximity: pi = (x - mu)^2 + X - mu^2 = (x - mu)^2 + variance, 2 * pi / sum of pi so far; null for the first."""
    seen = _moments(obs.filter("value is not null"), "value", chunk_ms=chunk_ms).withColumn("pi", F.pow(F.col("value") - F.col("mu"), F.lit(2.0)) + F.col("var"))
    summed = so_far(seen, {"sum_pi": F.col("pi")}, F.floor(F.col("t_ms") / chunk_ms), ["t_ms", "seq"])
    ecc = F.when((F.col("k") > 1) & (F.col("sum_pi") > TINY), 2 * F.col("pi") / F.nullif("sum_pi", F.lit(0.0)))
    return summed.select("seq", *SERIES, "t_ms", "value", "k", ecc.alias("eccentricity"))


def teda_delta(obs: DataFrame, gap_ms: int = HOUR, block: int = BLOCK_ROWS) -> DataFrame:
    """Eccentricity of the steps between values exactly a gap apart."""
    w = window(BY_TIME)
    rows = obs.filter("value is not null").select("seq", *SERIES, "t_ms", "value")
    steps = around(rows, {"before": F.lag("value").over(w), "gap": F.col("t_ms") - F.lag("t_ms").over(w)}, BY_TIME, 1, 0, block)
    return teda_2016(steps.filter(F.col("gap") == gap_ms).withColumn("step", F.col("before") - F.col("value")), "step")


def teda_sigma(obs: DataFrame, n: int, tumbling: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """Eccentricity of the variance over n rows around each (tumbling: of every (n-1)th such window)."""
    half = n // 2
    w = window(BY_TIME, -half, half)
    rows = obs.filter("value is not null").select("seq", *SERIES, "t_ms", "value")
    varied = around(rows, {"whole": F.count("value").over(w) == 2 * half + 1, "variance": F.var_samp("value").over(w)}, BY_TIME, half, half, block).filter("whole")
    if tumbling:
        varied = varied.filter(F.pmod(F.col("place") - half - 1, F.lit(max(1, n - 1))) == 0)
    return teda_2016(varied, "variance")
