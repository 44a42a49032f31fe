"""Events: what outcomes add up to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import vocab
from tidegauge.functions.text import utc
from tidegauge.functions.vocab import SERIES
from tidegauge.operators.logic import running_max

#: Length and slide of the windows, by label.
SLIDING = {"1h": ("1 hour", "30 minutes"), "12h": ("12 hours", "6 hours"), "24h": ("24 hours", "12 hours")}
EVENT = [*SERIES, "event", "start_ms", "end_ms"]


def failed(outcomes: DataFrame, qualifier: str) -> DataFrame:
    return outcomes.filter((F.col("qualifier") == qualifier) & (F.col("qualitative") == vocab.FAIL))


def null_aggregate(outcomes: DataFrame, null_limit: DataFrame, window: str, watermark: str | None = None) -> DataFrame:
    """Sliding windows with at least the series' limit of missing values. Failures only reach the windows, and counts only the shuffle.

    On a stream, with a watermark: rows later than that are dropped, and a window is returned when it has passed.
    """
    length, slide = SLIDING[window]
    limits = null_limit.filter((F.col("kind") == "aggregate") & (F.col("window") == window)).select(*SERIES, "n")
    nulls = failed(outcomes, vocab.NULL_CHECK).withColumn("at", utc(F.col("t_ms")))
    if watermark:
        nulls = nulls.withWatermark("at", watermark)
    counted = nulls.groupBy(*SERIES, F.window("at", length, slide).alias("w")).agg(F.count(F.lit(1)).alias("nulls"))
    found = counted.join(limits, SERIES).filter("nulls >= n")
    return found.select(*SERIES, F.lit(f"{vocab.EVENT_NULL_AGGREGATE}{window}").alias("event"), F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"))


def null_consecutive(outcomes: DataFrame, series_meta: DataFrame, null_limit: DataFrame, mode: str = "reference", tie: str | None = None, chunk: int = 1_000_000) -> DataFrame:
    """Runs of missing values, in order of arrival, each within 1.5 intended spacings of the one before.

    mode "reference": the run's state stands still after an alert, so a long run alerts again once it has gone beyond
    reach of the alert, and the very first run of a series starts its count at 0. mode "per_run": one event a run, when
    it reaches the limit. A run without a gap is folded in one row; runs are apart.
    """
    spacing = series_meta.filter("intended_spacing_ms is not null").select(*SERIES, "intended_spacing_ms")
    limits = null_limit.filter("kind = 'consecutive'").select(*SERIES, "n")
    nulls = failed(outcomes, vocab.NULL_CHECK).withColumn("arrival", F.col(tie) if tie else F.lit(0).cast("long"))
    nulls = nulls.join(spacing, SERIES).join(limits, SERIES)  # without either there is no event
    if mode == "per_run":
        return _runs(nulls)
    # a null out of reach of all before it starts anew, whatever the state was: between such nulls the fold is cut
    seen = running_max(nulls.select("seq", "arrival", *SERIES, "t_ms", "intended_spacing_ms", "n"), "t_ms", "latest", chunk)
    starts = F.col("latest").isNull() | (F.col("t_ms") - F.col("latest") > 1.5 * F.col("intended_spacing_ms"))
    marked = running_max(seen.withColumn("mark", F.when(starts, F.struct("seq", "arrival"))), "mark", "last_mark", chunk)
    cut = marked.withColumn("part", F.coalesce("mark", "last_mark"))
    grouped = cut.groupBy(*SERIES, "part").agg(
        F.array_sort(F.collect_list(F.struct("seq", "arrival", "t_ms"))).alias("nulls"), F.max(F.col("latest").isNull()).alias("is_first"), F.first("intended_spacing_ms").alias("spacing"), F.first("n").alias("n")
    )
    state = "named_struct('last', {t}, 'n', {n}, 'alerted', {a}, 'events', {e})"
    start = state.format(t="CAST(NULL AS BIGINT)", n="0", a="false", e="CAST(array() AS ARRAY<BIGINT>)")
    step = (
        "CASE WHEN s.last IS NULL THEN " + state.format(t="x.t_ms", n="IF(is_first, 0, 1)", a="false", e="s.events")
        + " WHEN x.t_ms - s.last > 1.5 * spacing THEN " + state.format(t="x.t_ms", n="1", a="false", e="s.events")
        + " WHEN s.alerted THEN s"
        + " WHEN s.n + 1 >= n THEN " + state.format(t="x.t_ms", n="s.n + 1", a="true", e="concat(s.events, array(x.t_ms))")
        + " ELSE " + state.format(t="x.t_ms", n="s.n + 1", a="false", e="s.events") + " END"
    )
    folded = grouped.select(*SERIES, F.expr(f"explode(aggregate(nulls, {start}, (s, x) -> {step}, s -> s.events))").alias("start_ms"))
    return folded.select(*SERIES, F.lit(vocab.EVENT_NULL_CONSECUTIVE).alias("event"), "start_ms", F.col("start_ms").alias("end_ms"))


def _runs(nulls: DataFrame) -> DataFrame:
    by_arrival = Window.partitionBy(*SERIES).orderBy("seq", "arrival")
    breaks = (F.col("t_ms") - F.lag("t_ms").over(by_arrival)) > 1.5 * F.col("intended_spacing_ms")
    runs = nulls.withColumn("breaks", F.coalesce(breaks, F.lit(True)).cast("int")).withColumn("run", F.sum("breaks").over(by_arrival))
    placed = runs.withColumn("place", F.row_number().over(Window.partitionBy(*SERIES, "run").orderBy("seq", "arrival")))
    return placed.filter("place = n").select(*SERIES, F.lit(vocab.EVENT_NULL_CONSECUTIVE).alias("event"), F.col("t_ms").alias("start_ms"), F.col("t_ms").alias("end_ms"))


def _instants(outcomes: DataFrame, qualifier: str, event: str) -> DataFrame:
    return failed(outcomes, qualifier).select(*SERIES, F.lit(event).alias("event"), F.col("t_ms").alias("start_ms"), F.col("t_ms").alias("end_ms"))


def order_events(outcomes: DataFrame) -> DataFrame:
    return _instants(outcomes, vocab.ORDER_CHECK, vocab.EVENT_ORDER)


def spacing_events(outcomes: DataFrame) -> DataFrame:
    return _instants(outcomes, vocab.SPACING_CHECK, vocab.EVENT_SPACING)
