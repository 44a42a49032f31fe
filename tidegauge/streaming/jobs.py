"""The operators on streams.

What has no state is the batch operator itself. Windows by time take a watermark. What
depends on the order of arrival keeps, for each series, as much as the batch window looks
back (the latest time; two rows; the state of a run) and hands it on from one batch to
the next; the outcomes then come from the same expressions as in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegauge.functions import vocab
from tidegauge.functions.text import utc
from tidegauge.functions.vocab import SERIES
from tidegauge.operators import derive, events, logic, threshold
from tidegauge.sources.registry import Registry

KEY = "feature string, procedure string, observableproperty string"
STRUCT = "struct<t_ms: bigint, seq: bigint, value: double, year: int, month: int>"


def keyed_fold(rows: DataFrame, output: str, state: str, step: Callable[[tuple, tuple | None], tuple[list[dict[str, Any]], tuple]]) -> DataFrame:
    """For each row of a series, in order of `seq` within a batch: step(row, state) gives rows and the next state. step must be importable or a closure over plain values."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.get if held.exists else None
        out: list[dict[str, Any]] = []
        for row in pd.concat(list(batches)).sort_values("seq").itertuples(index=False):
            new, now = step(row, now)
            out += new
        if now is not None:
            held.update(now)
        if out:
            yield pd.DataFrame([dict(zip(SERIES, key, strict=True)) | x for x in out])

    return rows.groupBy(*SERIES).applyInPandasWithState(run, f"{KEY}, {output}", state, "append", GroupStateTimeout.NoTimeout)


def _plain(value: Any) -> Any:
    return None if pd.isna(value) else value


def with_latest(obs: DataFrame) -> DataFrame:
    """Rows with `latest`, the latest time of their series before them."""

    def step(row, state):
        latest = state[0] if state else None
        out = {"seq": row.seq, "year": row.year, "month": row.month, "t_ms": row.t_ms, "latest": latest}
        return [out], (row.t_ms if latest is None else max(latest, row.t_ms),)

    return keyed_fold(obs.select(*logic.KEEP), "seq long, year int, month int, t_ms long, latest long", "latest long", step)


def order_check(obs: DataFrame) -> DataFrame:
    return logic.order_outcomes(with_latest(obs))


def spacing_check(obs: DataFrame, registry: Registry) -> DataFrame:
    return logic.spacing_outcomes(with_latest(obs), registry.series_meta)


def neighbours(obs: DataFrame) -> DataFrame:
    """Structs of the last rows of a series at each: first (two before), a (before), b; null where there are none."""

    def step(row, state):
        b = (row.t_ms, row.seq, row.value, row.year, row.month)
        held = [tuple(x) for x in (state[0] if state else [])]
        first, a = ([None, None] + held)[-2:]
        return [{"first": first, "a": a, "b": b}], ([*held, b][-2:],)

    rows = threshold.numeric(obs).select(*SERIES, *threshold.ROW)
    return keyed_fold(rows, f"first {STRUCT}, a {STRUCT}, b {STRUCT}", f"last array<{STRUCT}>", step)


def delta_step(obs: DataFrame, registry: Registry) -> DataFrame:
    return threshold.step_outcomes(neighbours(obs).filter("a is not null").drop("first"), registry.qc_test, registry.qc_bound)


def delta_spike(obs: DataFrame, registry: Registry) -> DataFrame:
    """A query of its own beside delta_step(): a stream has one state of this kind."""
    return threshold.spike_outcomes(neighbours(obs).filter("first is not null"), registry.qc_test, registry.qc_bound)


def null_consecutive(outcomes: DataFrame, registry: Registry) -> DataFrame:
    """The fold of events.null_consecutive() in its reference mode."""

    def step(row, state):
        last, n, alerted = state if state else (None, 0, False)
        spacing, limit = _plain(row.intended_spacing_ms), _plain(row.n)
        if last is None:
            return [], (row.t_ms, 0, False)
        if spacing is None:
            return [], state
        if row.t_ms - last > 1.5 * spacing:
            return [], (row.t_ms, 1, False)
        if limit is None:
            return [], (row.t_ms, 0, False)
        if alerted:
            return [], state
        if n + 1 >= limit:
            return [{"start_ms": row.t_ms}], (row.t_ms, n + 1, True)
        return [], (row.t_ms, n + 1, False)

    spacing = registry.series_meta.select(*SERIES, "intended_spacing_ms")
    limits = registry.null_limit.filter("kind = 'consecutive'").select(*SERIES, "n")
    nulls = events.failed(outcomes, vocab.NULL_CHECK).select("seq", *SERIES, "t_ms").join(spacing, SERIES, "left").join(limits, SERIES, "left")
    found = keyed_fold(nulls, "start_ms long", "last long, n int, alerted boolean", step)
    return found.select(*SERIES, F.lit(vocab.EVENT_NULL_CONSECUTIVE).alias("event"), "start_ms", F.col("start_ms").alias("end_ms"))


def sigma_check(obs: DataFrame, registry: Registry, window: str, watermark: str = "0 seconds") -> DataFrame:
    """threshold.sigma_check() on a stream: the window's rows are kept with its variance and returned when it has passed."""
    hours = threshold.HOURS[window]
    rows = threshold.numeric(obs).withColumn("at", utc(F.col("t_ms"))).withWatermark("at", watermark)
    grouped = rows.groupBy(*SERIES, F.window("at", f"{hours} hours").alias("w")).agg(
        F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("tested"), F.collect_list(F.struct("seq", "year", "month", "t_ms")).alias("rows")
    )
    spread = grouped.withColumn("instant", F.unix_millis("w.start") + hours * 1_800_000)
    bounded = threshold.apply_bounds(spread, registry.qc_test, registry.qc_bound, "sigma", F.lit(vocab.SIGMA), window)
    each = bounded.withColumn("one", F.explode("rows"))
    return each.select("one.seq", *SERIES, "one.year", "one.month", "one.t_ms", "qualifier", "qualitative", "quantitative")


def lake_products(obs: DataFrame, registry: Registry, watermark: str = "4 hours", window: str = "2 hours") -> DataFrame:
    """derive.lake_products() on a stream: an instant's profile is complete, and its products returned, when the window it lies in is older than all disorder allowed for; what is later than that is dropped."""
    rows = derive.layers(obs, registry.series_meta).withColumn("at", utc(F.col("t_ms"))).withWatermark("at", watermark)
    return derive.products_of(derive.profiles(rows, F.window("at", window), "t_ms"))


def write_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to Parquet; once: all there is, then stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
