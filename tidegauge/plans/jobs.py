"""The jobs, as plans over tables: what queues carried between them is one lazy plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidegauge.functions.vocab import JOB_DERIVED, JOB_THRESHOLD, MODEL_DELTA, MODEL_LAKE, MODEL_RANGE, MODEL_SIGMA
from tidegauge.operators import derive, events, logic, meta, parse, route, threshold
from tidegauge.sources.registry import WINDOWS, Registry


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def semantic_stamp(lines: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """Observations, and lines for quarantine."""
    good, bad = parse.split_parsed(parse.parse_raw(lines, registry.sensor_map))
    return parse.stamp(good), bad


def logic_block(obs: DataFrame, registry: Registry) -> DataFrame:
    """All outcomes of the checks of single observations and of arrival."""
    return union(
        logic.null_check(obs),
        logic.order_check(obs),
        logic.spacing_check(obs, registry.series_meta),
        logic.default_identity(obs, registry.meta_check),
        logic.default_value(obs, registry.meta_check, registry.qc_test),
    )


def threshold_block(obs: DataFrame, registry: Registry) -> DataFrame:
    """All outcomes of the checks of values, for the series that are routed to each."""
    own = lambda model: route.for_job(obs, registry.route, JOB_THRESHOLD, model)
    tests, bounds = registry.qc_test, registry.qc_bound
    delta = own(MODEL_DELTA)
    return union(
        threshold.range_check(own(MODEL_RANGE), tests, bounds),
        threshold.delta_step(delta, tests, bounds),
        threshold.delta_spike(delta, tests, bounds),
        *(threshold.sigma_check(own(MODEL_SIGMA), tests, bounds, w) for w in WINDOWS),
    )


def meta_block(lines: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """Interval outcomes of metadata records, and lines for quarantine."""
    values, identities, bad = parse.split_meta(parse.parse_meta(lines))
    return union(meta.identity_outcomes(identities, registry.meta_affected), meta.value_outcomes(values, registry.meta_affected, registry.qc_test, registry.qc_bound)), bad


def event_block(outcomes: DataFrame, registry: Registry) -> DataFrame:
    return union(
        *(events.null_aggregate(outcomes, registry.null_limit, w) for w in WINDOWS),
        events.null_consecutive(outcomes, registry.series_meta, registry.null_limit),
        events.order_events(outcomes),
        events.spacing_events(outcomes),
    )


def derived_block(obs: DataFrame, registry: Registry) -> DataFrame:
    return derive.lake_products(route.for_job(obs, registry.route, JOB_DERIVED, MODEL_LAKE), registry.series_meta)
