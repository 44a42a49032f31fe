"""The registry of metadata and thresholds: key-value text, read once into typed tables.

Every lookup of a record becomes an equi-join with one of these. They are as long as
the list of sensors and thresholds; prepared() writes them once and marks those of a
checked length for broadcast, so that a lookup moves no observation.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import broadcast_up_to, materialise

#: Rows of a registry table that go to every executor at most.
BROADCAST_ROWS = 1_000_000
WINDOWS = ("1h", "12h", "24h")


@dataclass
class Registry:
    sensor_map: DataFrame  # site, sensor, feature, procedure, observableproperty, obs_type
    series_meta: DataFrame  # feature, procedure, observableproperty, intended_spacing_ms, depth
    route: DataFrame  # feature, procedure, observableproperty, job, model, key
    meta_check: DataFrame  # feature, kind (identity, value), name
    meta_affected: DataFrame  # feature, kind, name, a_feature, a_procedure, a_observableproperty
    qc_test: DataFrame  # scope (obs, meta), feature, procedure, observableproperty, check, window, test, test_seq, resolution
    qc_bound: DataFrame  # scope, feature, procedure, observableproperty, check, window, test, bound (min, max), time_key, threshold
    null_limit: DataFrame  # feature, procedure, observableproperty, kind (aggregate, consecutive), window, n


SCHEMAS = {
    "sensor_map": "site string, sensor string, feature string, procedure string, observableproperty string, obs_type string",
    "series_meta": "feature string, procedure string, observableproperty string, intended_spacing_ms long, depth int",
    "route": "feature string, procedure string, observableproperty string, job string, model string, key string",
    "meta_check": "feature string, kind string, name string",
    "meta_affected": "feature string, kind string, name string, a_feature string, a_procedure string, a_observableproperty string",
    "qc_test": "scope string, feature string, procedure string, observableproperty string, check string, window string, test string, test_seq int, resolution string",
    "qc_bound": "scope string, feature string, procedure string, observableproperty string, check string, window string, test string, bound string, time_key string, threshold double",
    "null_limit": "feature string, procedure string, observableproperty string, kind string, window string, n int",
}


def from_rows(spark: SparkSession, **rows: list[tuple]) -> Registry:
    """From literal rows; a table that isn't given is empty."""
    return Registry(**{f.name: spark.createDataFrame(rows.get(f.name, []), SCHEMAS[f.name]) for f in fields(Registry)})


def prepared(registry: Registry, rows: int = BROADCAST_ROWS) -> Registry:
    """Each table written in the scratch folder and, if it has at most so many rows, marked for broadcast; a longer one is left to the planner, which then knows its size."""
    return Registry(**{f.name: broadcast_up_to(materialise(getattr(registry, f.name).coalesce(1), f.name), rows) for f in fields(Registry)})


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) from lines `SET key value`."""
    lines = spark.read.text(path)
    pattern = r"^\s*SET\s+(\S+)\s+(.*\S)\s*$"
    return lines.filter(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("key"), F.regexp_extract("value", pattern, 2).alias("value"))


def read_protocol(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) from a dump in the store's own protocol: *3, $3, SET, $n, key, $n, value, a line each."""
    whole = spark.read.text(path, wholetext=True)
    entry = F.explode(F.split(F.regexp_replace("value", "\r", ""), r"(?m)^\*3\n")).alias("entry")
    parts = F.split("entry", "\n")
    at = [F.try_element_at(parts, F.lit(i)) for i in (2, 4, 6)]
    return whole.select(entry).select(at[0].alias("command"), at[1].alias("key"), at[2].alias("value")).filter("command = 'SET'").drop("command")


def _items(value: Column) -> Column:
    return F.split(value, "::")


def _series(parts: Column) -> list[Column]:
    return [F.element_at(parts, i + 1).alias(n) for i, n in enumerate(("feature", "procedure", "observableproperty"))]


def from_entries(entries: DataFrame) -> Registry:
    """Typed tables from (key, value)."""
    parts = F.split("key", "::")
    own = entries.select("key", "value", parts.alias("p"), F.size(parts).alias("n"))

    def at(i: int) -> Column:
        return F.try_element_at(F.col("p"), F.lit(i))

    sensors = own.filter((F.col("n") == 3) & at(3).isin("feature", "procedure", "observableproperty", "observationtype"))

    def pick(name: str) -> Column:
        return F.max(F.when(at(3) == name, F.col("value")))

    sensor_map = (
        sensors.groupBy(at(1).alias("site"), at(2).alias("sensor"))
        .agg(pick("feature").alias("feature"), pick("procedure").alias("procedure"), pick("observableproperty").alias("observableproperty"), pick("observationtype").alias("obs_type"))
        .filter("feature is not null and procedure is not null and observableproperty is not null and obs_type is not null")
    )
    of_series = own.filter((F.col("n") >= 4) & (at(2) != "meta"))
    meta_rows = of_series.filter((F.col("n") == 4) & at(4).isin("intendedspacing", "depth"))
    series_meta = meta_rows.groupBy(*_series(F.col("p"))).agg(
        F.max(F.when(at(4) == "intendedspacing", F.col("value").try_cast("long"))).alias("intended_spacing_ms"), F.max(F.when(at(4) == "depth", F.col("value").try_cast("int"))).alias("depth")
    )
    routed = of_series.filter((F.col("n") == 4) & (at(4) == "routing")).select(*_series(F.col("p")), F.explode(_items(F.col("value"))).alias("item"))
    hop = F.split("item", ",")
    route = routed.filter(F.size(hop) == 3).select("feature", "procedure", "observableproperty", hop[0].alias("job"), hop[1].alias("model"), hop[2].alias("key"))

    of_meta = own.filter(at(2) == "meta")
    meta_check = of_meta.filter(F.col("n") == 3).select(at(1).alias("feature"), at(3).alias("kind"), F.explode(_items(F.col("value"))).alias("name"))
    listed = of_meta.filter(F.col("n") == 4).select(at(1).alias("feature"), at(3).alias("kind"), at(4).alias("name"), F.explode(_items(F.col("value"))).alias("item"))
    triple = F.split("item", ",")
    meta_affected = listed.filter(F.size(triple) == 3).select("feature", "kind", "name", triple[0].alias("a_feature"), triple[1].alias("a_procedure"), triple[2].alias("a_observableproperty"))

    # thresholds: a head that names the series or kind of metadata, then the check, then (sigma) the window, then the test
    scoped = own.select(
        "value",
        F.when(at(2) == "meta", "meta").otherwise("obs").alias("scope"),
        at(1).alias("feature"),
        F.when(at(2) == "meta", "meta").otherwise(at(2)).alias("procedure"),
        F.when(at(2) == "meta", at(4)).otherwise(at(3)).alias("observableproperty"),
        F.when(at(2) == "meta", F.slice("p", 5, F.greatest(F.lit(0), F.col("n") - 4))).otherwise(F.slice("p", 4, F.greatest(F.lit(0), F.col("n") - 3))).alias("rest"),
    ).filter(F.try_element_at("rest", F.lit(1)) == "thresholds")
    kind = F.try_element_at(F.col("rest"), F.lit(2))
    check = F.when(kind == "delta", F.try_element_at("rest", F.lit(3))).otherwise(kind)
    tail = F.when(kind == "delta", F.slice("rest", 4, F.size("rest"))).otherwise(F.slice("rest", 3, F.size("rest")))
    bounds = scoped.filter(kind.isin("range", "sigma", "delta")).select("scope", "feature", "procedure", "observableproperty", check.alias("check"), tail.alias("tail"), "value")
    names = bounds.filter(F.size("tail") == 0).select("scope", "feature", "procedure", "observableproperty", "check", F.posexplode(_items(F.col("value"))).alias("test_seq", "test"))
    inner = bounds.select(
        "scope", "feature", "procedure", "observableproperty", "check",
        F.when(F.col("check") == "sigma", F.try_element_at("tail", F.lit(1))).otherwise("").alias("window"),
        F.when(F.col("check") == "sigma", F.slice("tail", 2, F.size("tail"))).otherwise(F.col("tail")).alias("tail"), "value",
    )
    keys = ["scope", "feature", "procedure", "observableproperty", "check"]
    resolutions = inner.filter(F.size("tail") == 1).select(*keys, "window", F.col("tail")[0].alias("test"), F.col("value").alias("resolution"))
    qc_test = names.join(resolutions, [*keys, "test"]).select(*keys, "window", "test", "test_seq", "resolution")
    qc_bound = inner.filter((F.size("tail") >= 2) & F.col("tail")[1].isin("min", "max")).select(
        *keys, "window", F.col("tail")[0].alias("test"), F.col("tail")[1].alias("bound"), F.coalesce(F.try_element_at("tail", F.lit(3)), F.lit("")).alias("time_key"), F.col("value").try_cast("double").alias("threshold")
    )
    limits = scoped.filter(kind == "null")
    which = F.try_element_at(F.col("rest"), F.lit(3))
    null_limit = limits.select("feature", "procedure", "observableproperty", which.alias("kind"), F.coalesce(F.try_element_at("rest", F.lit(4)), F.lit("")).alias("window"), F.col("value").try_cast("int").alias("n"))
    return Registry(sensor_map, series_meta, route, meta_check, meta_affected, qc_test, qc_bound, null_limit)
