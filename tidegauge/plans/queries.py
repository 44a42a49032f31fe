"""The operators as queries over the table `events`, each with SQL that gives the same rows.

Observations are made from events in a way that both engines can say: ten sites with a
sensor for each type of event are 50 series; every seventh event and every tenth day
from the fifth have no value; every eleventh event arrives 40 places late.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import vocab
from tidegauge.functions.vocab import SERIES
from tidegauge.operators import analysis, derive, events, logic, meta, parse, route, sinks, threshold
from tidegauge.sources.registry import SCHEMAS, WINDOWS, Registry, from_entries, prepared, read_protocol
from tidegauge.session import materialise, scratch_folder

TYPES = {"click": (0.78, 154.20), "error": (0.73, 142.00), "purchase": (0.51, 133.68), "signup": (0.66, 148.33), "view": (0.37, 143.56)}
SITES = [f"site{i}" for i in range(10)]
SPACING = 4 * 3_600_000
LIMITS = [("aggregate", "1h", 2), ("aggregate", "12h", 3), ("aggregate", "24h", 4), ("consecutive", "", 3)]
#: check, window, test, resolution, time keys, bounds (None: by type).
TESTS = [
    ("range", "", "static", "single", [""], None),
    ("range", "", "hourly", "hour", [f"2024-01-{d:02d}T{h:02d}" for d in (3, 4, 12) for h in range(24)], (5.0, 100.0)),
    ("range", "", "daily", "day", [f"2024-01-{d:02d}" for d in (2, 9, 16)], (10.0, 90.0)),
    ("range", "", "monthly", "month", ["2024-01"], (2.0, 140.0)),
    ("step", "", "static", "single", [""], (0.0, 60.0)),
    ("step", "", "daily", "day", [f"2024-01-{d:02d}" for d in (3, 10)], (1.0, 40.0)),
    ("spike", "", "static", "single", [""], (0.0, 40.0)),
    *(("sigma", w, "static", "single", [""], (1.0, 2500.0)) for w in WINDOWS),
    ("sigma", "24h", "daily", "day", [f"2024-01-{d:02d}" for d in (3, 4, 6)], (100.0, 900.0)),
]
CHECKS = ["maintenance", "cleaning"]
KINDS = ["battery", "wifi"]
#: Tests of metadata records.
META_TESTS = [("battery", "static", "single", "", 10.0, 80.0), ("battery", "daily", "day", "2024-01-03", 20.0, 60.0), ("wifi", "static", "single", "", 5.0, 120.0)]


def _series() -> list[tuple[str, str, str, str]]:
    return [(site, f"{site}-{kind}", kind, kind) for site in SITES for kind in TYPES]


def registry_rows() -> dict[str, list[tuple]]:
    series = [s[:3] for s in _series()]
    tests, bounds = [], []
    for s in series:
        for i, (check, window, test, resolution, keys, limits) in enumerate(TESTS):
            tests.append(("obs", *s, check, window, test, i, resolution))
            low, high = limits or TYPES[s[2]]
            bounds += [("obs", *s, check, window, test, b, k, x) for k in keys for b, x in (("min", low), ("max", high))]
    for site in SITES:
        for i, (kind, test, resolution, key, low, high) in enumerate(META_TESTS):
            tests.append(("meta", site, "meta", kind, "range", "", test, i, resolution))
            bounds += [("meta", site, "meta", kind, "range", "", test, b, key, x) for b, x in (("min", low), ("max", high))]
    return {
        "sensor_map": [(site, kind, *s, "numeric") for (site, _, kind, _), s in zip(_series(), series, strict=True)],
        "series_meta": [(*s, SPACING, None) for s in series],
        "route": [(*s, "threshold", f"model-{s[2]}", s[0]) for s in series if s[2] != "error"] + [(*s, "derived", "lake", s[0]) for s in series if s[0] < "site5"],
        "meta_check": [(site, "identity", c) for site in SITES for c in CHECKS] + [(site, "value", k) for site in SITES for k in KINDS],
        "meta_affected": [(s[0], kind, name, *s) for s in series for kind, names in (("identity", CHECKS[:1]), ("value", KINDS)) for name in names if s[2] in ("click", "view")],
        "qc_test": tests,
        "qc_bound": bounds,
        "null_limit": [(*s, *limit) for s in series for limit in LIMITS],
    }


ROWS = registry_rows()


def registry_entries() -> list[tuple[str, str]]:
    """ROWS as the keys and values of a registry's text."""
    joined: dict[str, list[str]] = {}
    single: dict[str, str] = {}

    def add(key: str, item: str) -> None:
        if item not in joined.setdefault(key, []):
            joined[key].append(item)

    for site, sensor, *ids in ROWS["sensor_map"]:
        single |= {f"{site}::{sensor}::{n}": x for n, x in zip(("feature", "procedure", "observableproperty", "observationtype"), ids, strict=True)}
    for f, p, o, spacing, _ in ROWS["series_meta"]:
        single[f"{f}::{p}::{o}::intendedspacing"] = str(spacing)
    for f, p, o, *hop in ROWS["route"]:
        add(f"{f}::{p}::{o}::routing", ",".join(hop))
    for site, kind, name in ROWS["meta_check"]:
        add(f"{site}::meta::{kind}", name)
    for site, kind, name, *series in ROWS["meta_affected"]:
        add(f"{site}::meta::{kind}::{name}", ",".join(series))

    def base(scope: str, f: str, p: str, o: str, check: str) -> str:
        head = f"{f}::meta::value::{o}" if scope == "meta" else f"{f}::{p}::{o}"
        return f"{head}::thresholds::{'delta::' if check in ('step', 'spike') else ''}{check}"

    for *series, window, test, _, resolution in ROWS["qc_test"]:
        add(base(*series), test)
        single["::".join(x for x in (base(*series), window, test) if x)] = resolution
    for *series, window, test, bound, key, limit in ROWS["qc_bound"]:
        single["::".join(x for x in (base(*series), window, test, bound, key) if x)] = repr(limit)
    for f, p, o, kind, window, n in ROWS["null_limit"]:
        single["::".join(x for x in (f"{f}::{p}::{o}::thresholds::null::{kind}", window) if x)] = str(n)
    return [*single.items(), *((k, "::".join(v)) for k, v in joined.items())]


_registries: dict[str, Registry] = {}


def registry(spark: SparkSession) -> Registry:
    """Read from its entries and written once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _registries:
        entries = materialise(spark.createDataFrame(registry_entries(), "key string, value string").coalesce(1), "entries")
        _registries[app] = prepared(from_entries(entries))
    return _registries[app]


def _sql_value(x: object) -> str:
    return "NULL" if x is None else repr(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"


def _table_sql(name: str) -> str:
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    kinds = [{"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}[c.split()[1]] for c in SCHEMAS[name].split(", ")]
    rows = ", ".join("(" + ", ".join(map(_sql_value, r)) + ")" for r in ROWS[name])
    names = [f'"{c}"' for c in columns]
    casts = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds, strict=True))
    return f"{name} AS (SELECT {casts} FROM (VALUES {rows}) AS t({', '.join(names)}))"


# --- observations ----------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # years, days and hours are those of UTC
    t_ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value", t_ms.alias("t_ms"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    site = F.concat(F.lit("site"), (F.col("user_id") % 10).cast("string"))
    at = F.timestamp_millis("t_ms")
    gone = (F.col("event_id") % 7 == 0) | (F.day(at) % 10 == 5)
    return e.select(
        (F.col("event_id") + F.when(F.col("event_id") % 11 == 0, 40).otherwise(0)).alias("seq"),
        F.col("event_id").alias("tie"),
        site.alias("feature"),
        F.concat(site, F.lit("-"), "event_type").alias("procedure"),
        F.col("event_type").alias("observableproperty"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        "t_ms",
        F.lit("numeric").alias("obs_type"),
        F.lit(None).cast("string").alias("category_value"),
        F.when(~gone, F.col("value")).alias("value"),
    )


OBS_SQL = """raw_events AS (SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) // 1000 AS t_ms FROM events),
obs AS (
    SELECT event_id + CASE WHEN event_id % 11 = 0 THEN 40 ELSE 0 END AS seq, event_id AS tie,
        'site' || CAST(user_id % 10 AS VARCHAR) AS feature, 'site' || CAST(user_id % 10 AS VARCHAR) || '-' || event_type AS procedure, event_type AS observableproperty,
        CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, t_ms,
        CASE WHEN event_id % 7 = 0 OR day(ts) % 10 = 5 THEN NULL ELSE value END AS value
    FROM raw_events
)"""
TIME_SQL = "make_timestamp({0} * 1000)"
KEY = "feature, procedure, observableproperty"
ARRIVAL = f"PARTITION BY {KEY} ORDER BY seq, tie"
BY_TIME = f"PARTITION BY {KEY} ORDER BY t_ms, seq"
BASE_COLUMNS = f"seq, {KEY}, year, month, t_ms"


def _with(body: str, *tables: str, more: str = "") -> str:
    parts = [OBS_SQL, *map(_table_sql, tables)] + ([more] if more else [])
    return f"WITH {', '.join(parts)} {body}"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- parsing ---------------------------------------------------------------------------------

RAW_LINE = """CASE event_id % 13
    WHEN 0 THEN {site} || ',' || event_type || ',' || {t} || ','
    WHEN 1 THEN {site} || ',' || event_type
    WHEN 2 THEN {site} || ',none,' || {t} || ',' || {v}
    WHEN 3 THEN {site} || ',' || event_type || ',x' || {t} || ',' || {v}
    WHEN 4 THEN {site} || ',' || event_type || ',' || {t} || ',NotAValue'
    WHEN 5 THEN {site} || ',' || event_type || ',' || {t} || ',word'
    WHEN 6 THEN {site} || ',' || event_type || ',' || {t} || ',' || {v} || ',a=1::b=2'
    WHEN 7 THEN {site} || ',' || event_type || ',' || {t} || ',' || {v} || ',a=1::b'
    WHEN 8 THEN ',' || event_type || ',' || {t} || ',' || {v}
    ELSE {site} || ',' || event_type || ',' || {t} || ',' || {v} END"""
PARTS = {"site": "'site' || CAST(user_id % 10 AS {s})", "t": "CAST(t_ms AS {s})", "v": "CAST(CAST(floor(value) AS BIGINT) AS {s})"}
META_LINE = """CASE event_id % 6
    WHEN 0 THEN {site} || ',battery,' || {t} || ',' || {t}
    WHEN 1 THEN {site} || ',,' || {t} || ',' || {t} || ',' || {v}
    WHEN 2 THEN {site} || ',battery,then,' || {t} || ',' || {v}
    WHEN 3 THEN {site} || ',maintenance,' || {t} || ',' || {t} || ',NotAValue'
    WHEN 4 THEN {site} || ',battery,' || {t} || ',' || {t} || ',high'
    ELSE {site} || ',battery,' || {t} || ',' || {t} || ',' || {v} END"""


def _line(template: str, string: str) -> str:
    return template.format(**{k: f"({v.format(s=string)})" for k, v in PARTS.items()})


def raw_lines(spark: SparkSession, sf_dir: str, template: str = RAW_LINE) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.expr(_line(template, "STRING")).alias("line"))


def _lines_sql(template: str) -> str:
    return f"lines AS (SELECT event_id AS seq, {_line(template, 'VARCHAR')} AS line FROM raw_events), cut AS (SELECT *, string_split(regexp_replace(line, ',+$', ''), ',') AS p FROM lines)"


PARSED_SQL = (
    _lines_sql(RAW_LINE)
    + """, judged AS (SELECT cut.*, s.feature, s.procedure, s.observableproperty, s.obs_type,
    CASE WHEN len(p) NOT IN (4, 5) OR list_contains(p, '') THEN 'Malformed observation tuple.'
        WHEN s.site IS NULL THEN 'Registry lookup failed.'
        WHEN NOT regexp_full_match(p[3], '[+-]?[0-9]+') THEN 'Incorrect time representation.'
        WHEN p[4] <> 'NotAValue' AND TRY_CAST(p[4] AS DOUBLE) IS NULL THEN 'Observation type from registry not matched.'
        WHEN len(p) = 5 AND len(list_filter(string_split(p[5], '::'), lambda x: len(string_split(x, '=')) <> 2)) > 0 THEN 'Metadata is not correctly formatted.'
        ELSE 'Parsed OK.' END AS parse_message
    FROM cut LEFT JOIN sensor_map s ON s.site = p[1] AND s.sensor = p[2]),
parsed AS (SELECT seq, CASE WHEN parse_message = 'Parsed OK.' THEN concat_ws(',', feature, procedure, observableproperty, p[3], p[4], p[5]) ELSE line END AS observation,
    CASE WHEN parse_message = 'Parsed OK.' THEN obs_type ELSE 'Unknown' END AS observation_type, parse_message = 'Parsed OK.' AS parse_ok, parse_message, p, feature, procedure, observableproperty FROM judged)"""
)


@query("parse_raw", _with("SELECT seq, observation, observation_type, parse_ok, parse_message FROM parsed", "sensor_map", more=PARSED_SQL))
def parse_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_raw(raw_lines(spark, sf_dir), registry(spark).sensor_map)


@query("parse_split", _with("SELECT parse_ok, parse_message, count(*) AS n FROM parsed GROUP BY ALL", "sensor_map", more=PARSED_SQL))
def parse_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = parse.split_parsed(parse_raw(spark, sf_dir))
    return good.unionByName(bad).groupBy("parse_ok", "parse_message").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stamp",
    _with(
        """SELECT seq, feature, procedure, observableproperty, CAST(year(make_timestamp(CAST(p[3] AS BIGINT) * 1000)) AS INTEGER) AS year, CAST(month(make_timestamp(CAST(p[3] AS BIGINT) * 1000)) AS INTEGER) AS month,
        CAST(p[3] AS BIGINT) AS t_ms, CAST(p[3] AS BIGINT) AS t_end_ms, TRY_CAST(p[4] AS DOUBLE) AS value, 'Raw' AS status, CASE WHEN len(p) = 5 THEN '2' END AS b FROM parsed WHERE parse_ok""",
        "sensor_map",
        more=PARSED_SQL,
    ),
)
def stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.stamp(parse_raw(spark, sf_dir)).select(*logic.KEEP, "t_end_ms", "value", "status", F.col("parameters")["b"].alias("b"))


META_PARSED_SQL = (
    _lines_sql(META_LINE)
    + """, judged AS (SELECT *, CASE WHEN len(p) <> 5 THEN 'Parse failed.  Malformed CSV, missing columns.'
        WHEN list_contains(p, '') THEN 'Parse failed.  Missing values, check all columns for values.'
        WHEN NOT regexp_full_match(p[3], '[+-]?[0-9]+') OR NOT regexp_full_match(p[4], '[+-]?[0-9]+') THEN 'Parse failed.  Start and/or End time are malformed.'
        WHEN p[5] <> 'NotAValue' AND TRY_CAST(p[5] AS DOUBLE) IS NULL THEN 'Parse failed.  Value is not numeric or correct text value.'
        ELSE 'Parsed OK.' END AS parse_message FROM cut),
parsed AS (SELECT seq, CASE WHEN parse_message = 'Parsed OK.' THEN p[1] WHEN len(p) = 5 THEN array_to_string(p, '::') || ':endOfMalformedContents' ELSE line || ':::endOfMalformedContents' END AS feature,
    CASE WHEN parse_message = 'Parsed OK.' THEN p[2] ELSE 'unknown' END AS data_type, CASE WHEN parse_message = 'Parsed OK.' THEN CAST(p[3] AS BIGINT) END AS start_ms, CASE WHEN parse_message = 'Parsed OK.' THEN CAST(p[4] AS BIGINT) END AS end_ms,
    CASE WHEN parse_message = 'Parsed OK.' THEN p[5] ELSE 'unknown' END AS value, parse_message = 'Parsed OK.' AS parse_ok, parse_message FROM judged)"""
)


@query("parse_meta", _with("SELECT * FROM parsed", more=META_PARSED_SQL))
def parse_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_meta(raw_lines(spark, sf_dir, META_LINE))


@query("meta_split", _with("SELECT CASE WHEN NOT parse_ok THEN 'failed' WHEN value = 'NotAValue' THEN 'identity' ELSE 'value' END AS branch, count(*) AS n FROM parsed GROUP BY ALL", more=META_PARSED_SQL))
def meta_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    values, identities, bad = parse.split_meta(parse_meta(spark, sf_dir))
    parts = [df.select(F.lit(n).alias("branch")) for n, df in (("value", values), ("identity", identities), ("failed", bad))]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


# --- logic -----------------------------------------------------------------------------------

NULL_SQL = f"SELECT {BASE_COLUMNS}, '{vocab.NULL_CHECK}' AS qualifier, CASE WHEN value IS NOT NULL THEN '{vocab.PASS}' ELSE '{vocab.FAIL}' END AS qualitative"


@query("null_check", _with(f"{NULL_SQL} FROM obs"))
def null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logic.null_check(observations(spark, sf_dir))


LATEST_SQL = f"seen AS (SELECT *, max(t_ms) OVER ({ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM obs)"
ORDER_SQL = f"""SELECT {BASE_COLUMNS}, '{vocab.ORDER_CHECK}' AS qualifier, CASE WHEN latest IS NULL OR t_ms > latest THEN '{vocab.PASS}' ELSE '{vocab.FAIL}' END AS qualitative,
    CAST(CASE WHEN latest IS NULL THEN 0 WHEN t_ms > latest THEN -abs(t_ms - latest) ELSE abs(t_ms - latest) END AS DOUBLE) AS quantitative FROM seen"""
SPACING_SQL = f"""SELECT {BASE_COLUMNS}, '{vocab.SPACING_CHECK}' AS qualifier, CASE WHEN latest IS NULL OR abs(t_ms - latest) <= {SPACING} THEN '{vocab.PASS}' ELSE '{vocab.FAIL}' END AS qualitative,
    CAST(CASE WHEN latest IS NULL THEN 0 WHEN abs(t_ms - latest) <= {SPACING} THEN -abs(t_ms - latest) ELSE abs(t_ms - latest) END AS DOUBLE) AS quantitative FROM seen"""


@query("order_check", _with(ORDER_SQL, more=LATEST_SQL))
def order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logic.order_check(observations(spark, sf_dir), tie="tie")


@query("spacing_check", _with(SPACING_SQL, more=LATEST_SQL))
def spacing_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logic.spacing_check(observations(spark, sf_dir), registry(spark).series_meta, tie="tie")


@query("default_identity", _with(f"SELECT {BASE_COLUMNS}, '{vocab.META_IDENTITY}' || name AS qualifier, '{vocab.PASS}' AS qualitative FROM obs JOIN meta_check USING (feature) WHERE kind = 'identity'", "meta_check"))
def default_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logic.default_identity(observations(spark, sf_dir), registry(spark).meta_check)


@query(
    "default_value",
    _with(
        f"""SELECT {", ".join("o." + c for c in BASE_COLUMNS.split(", "))}, '{vocab.META_VALUE}' || name || '/' || test || '/' || b AS qualifier, '{vocab.PASS}' AS qualitative, CAST(0 AS DOUBLE) AS quantitative
        FROM obs o JOIN meta_check m ON o.feature = m.feature AND m.kind = 'value' JOIN qc_test q ON q.scope = 'meta' AND q.feature = m.feature AND q.observableproperty = m.name CROSS JOIN (VALUES ('min'), ('max')) AS bb(b)""",
        "meta_check",
        "qc_test",
    ),
)
def default_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return logic.default_value(observations(spark, sf_dir), r.meta_check, r.qc_test)


# --- thresholds ------------------------------------------------------------------------------


def _bounds_sql(rows: str, check: str, prefix: str, window: str = "", scope: str = "obs") -> str:
    """rows: a table with tested and instant."""
    at = "make_timestamp(r.instant * 1000)"
    key = f"""CASE q.resolution WHEN 'single' THEN '' WHEN 'hour' THEN strftime(CASE WHEN minute({at}) <= 30 THEN {at} ELSE {at} + INTERVAL 1 HOUR END, '%Y-%m-%dT%H')
        WHEN 'day' THEN strftime({at}, '%Y-%m-%d') WHEN 'month' THEN strftime({at}, '%Y-%m') END"""
    beyond = "CASE b.bound WHEN 'min' THEN b.threshold - r.tested ELSE r.tested - b.threshold END"
    return f"""SELECT r.*, {prefix} || '{window + "/" if window else ""}' || b.test || '/' || b.bound AS qualifier, CASE WHEN {beyond} > 0 AND NOT isnan({beyond}) THEN '{vocab.FAIL}' ELSE '{vocab.PASS}' END AS qualitative, round({beyond}, 6) AS quantitative
        FROM {rows} r JOIN qc_test q ON q.scope = '{scope}' AND q."check" = '{check}' AND q."window" = '{window}' AND q.feature = r.feature AND q.procedure = r.procedure AND q.observableproperty = r.observableproperty
        JOIN qc_bound b ON b.scope = q.scope AND b.feature = q.feature AND b.procedure = q.procedure AND b.observableproperty = q.observableproperty AND b."check" = q."check" AND b."window" = q."window" AND b.test = q.test AND b.time_key = {key}"""


NUMBERS = "numbers AS (SELECT * FROM obs WHERE value IS NOT NULL)"
OUTCOME_COLUMNS = f"{BASE_COLUMNS}, qualifier, qualitative, quantitative"
RANGE_SQL = f"{NUMBERS}, tested AS (SELECT *, value AS tested, t_ms AS instant FROM numbers), bounded AS ({_bounds_sql('tested', 'range', repr(vocab.RANGE))})"


def _range(test: str) -> None:
    @query(f"range_{test}", _with(f"SELECT {OUTCOME_COLUMNS} FROM bounded WHERE qualifier LIKE '%/{test}/%'", "qc_test", "qc_bound", more=RANGE_SQL))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = registry(spark)
        return rounded(threshold.range_check(observations(spark, sf_dir), r.qc_test.filter(F.col("test") == test), r.qc_bound), "quantitative")


for _test in ("static", "hourly", "daily", "monthly"):
    _range(_test)


def _sigma(window: str) -> None:
    size = threshold.HOURS[window] * 3_600_000
    more = f"""{NUMBERS}, spread AS (SELECT {KEY}, t_ms - t_ms % {size} AS window_start, coalesce(var_samp(value), 0) AS tested FROM numbers GROUP BY ALL),
        tested AS (SELECT *, window_start + {size // 2} AS instant FROM spread), bounded AS ({_bounds_sql("tested", "sigma", repr(vocab.SIGMA), window)})"""
    columns = ", ".join("n." + c for c in BASE_COLUMNS.split(", "))
    body = f"SELECT {columns}, qualifier, qualitative, quantitative FROM bounded b JOIN numbers n ON n.feature = b.feature AND n.procedure = b.procedure AND n.observableproperty = b.observableproperty AND n.t_ms - n.t_ms % {size} = b.window_start"

    @query(f"sigma_{window}", _with(body, "qc_test", "qc_bound", more=more))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = registry(spark)
        return rounded(threshold.sigma_check(observations(spark, sf_dir), r.qc_test, r.qc_bound, window), "quantitative")


for _window in WINDOWS:
    _sigma(_window)

STEP_SQL = f"""{NUMBERS}, pairs AS (SELECT *, lag(value) OVER w AS pv, lag(t_ms) OVER w AS pt, lag(seq) OVER w AS ps, lag(year) OVER w AS py, lag(month) OVER w AS pm FROM numbers WINDOW w AS ({ARRIVAL})),
    tested AS (SELECT *, abs(value - pv) AS tested, least(t_ms, pt) AS instant FROM pairs WHERE pt IS NOT NULL), bounded AS ({_bounds_sql("tested", "step", repr(vocab.STEP))})"""


@query("delta_step", _with(f"SELECT {OUTCOME_COLUMNS} FROM bounded UNION ALL SELECT ps AS seq, {KEY}, py AS year, pm AS month, pt AS t_ms, qualifier, qualitative, quantitative FROM bounded", "qc_test", "qc_bound", more=STEP_SQL))
def delta_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return rounded(threshold.delta_step(observations(spark, sf_dir), r.qc_test, r.qc_bound), "quantitative")


SPIKE_SQL = f"""{NUMBERS}, three AS (SELECT {KEY}, lag(t_ms, 2) OVER w AS instant, list_sort([
        {{'t_ms': lag(t_ms, 2) OVER w, 'seq': lag(seq, 2) OVER w, 'value': lag(value, 2) OVER w, 'year': lag(year, 2) OVER w, 'month': lag(month, 2) OVER w}},
        {{'t_ms': lag(t_ms) OVER w, 'seq': lag(seq) OVER w, 'value': lag(value) OVER w, 'year': lag(year) OVER w, 'month': lag(month) OVER w}},
        {{'t_ms': t_ms, 'seq': seq, 'value': value, 'year': year, 'month': month}}]) AS s FROM numbers WINDOW w AS ({ARRIVAL})),
    tested AS (SELECT {KEY}, instant, s[2].seq AS seq, s[2].t_ms AS t_ms, s[2].year AS year, s[2].month AS month, abs(s[1].value - s[2].value) + abs(s[2].value - s[3].value) - abs(s[1].value - s[3].value) AS tested FROM three WHERE instant IS NOT NULL),
    bounded AS ({_bounds_sql("tested", "spike", repr(vocab.SPIKE))})"""


@query("delta_spike", _with(f"SELECT {OUTCOME_COLUMNS} FROM bounded", "qc_test", "qc_bound", more=SPIKE_SQL))
def delta_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return rounded(threshold.delta_spike(observations(spark, sf_dir), r.qc_test, r.qc_bound), "quantitative")


# --- metadata --------------------------------------------------------------------------------


#: How long a metadata record holds.
HOLDS = 600_000


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a record of its site as well."""
    e = _events(spark, sf_dir)
    site = F.concat(F.lit("site"), (F.col("user_id") % 10).cast("string"))
    kind = F.when(F.col("event_id") % 2 == 0, "battery").otherwise("wifi")
    return e.select(F.col("event_id").alias("seq"), site.alias("feature"), kind.alias("data_type"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + HOLDS).alias("end_ms"), "value")


RECORDS_SQL = f"""records AS (SELECT event_id AS seq, 'site' || CAST(user_id % 10 AS VARCHAR) AS feature, CASE WHEN event_id % 2 = 0 THEN 'battery' ELSE 'wifi' END AS data_type,
    t_ms AS start_ms, t_ms + {HOLDS} AS end_ms, value FROM raw_events)"""
IDENTITY_SQL = f"""identities AS (SELECT r.seq, a_feature AS feature, a_procedure AS procedure, a_observableproperty AS observableproperty, start_ms, end_ms, '{vocab.META_IDENTITY}' || name AS qualifier, '{vocab.FAIL}' AS qualitative
    FROM records r JOIN meta_affected m ON m.feature = r.feature AND m.kind = 'identity' AND m.name = CASE WHEN r.data_type = 'battery' THEN 'maintenance' ELSE 'cleaning' END)"""


def _identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.identity_outcomes(records(spark, sf_dir).withColumn("data_type", F.when(F.col("data_type") == "battery", "maintenance").otherwise("cleaning")), registry(spark).meta_affected)


@query("meta_identity", _with("SELECT * FROM identities", "meta_affected", more=f"{RECORDS_SQL}, {IDENTITY_SQL}"))
def meta_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identities(spark, sf_dir)


META_VALUE_SQL = f"""{RECORDS_SQL}, tested AS (SELECT seq, feature, 'meta' AS procedure, data_type AS observableproperty, data_type, start_ms, end_ms, value AS tested, start_ms + (end_ms - start_ms) // 2 AS instant FROM records),
    bounded AS ({_bounds_sql("tested", "range", f"'{vocab.META_VALUE}' || r.data_type || '/'", scope="meta")})"""


@query(
    "meta_value",
    _with(
        f"""SELECT b.seq, a_feature AS feature, a_procedure AS procedure, a_observableproperty AS observableproperty, start_ms, end_ms, qualifier, qualitative, quantitative
        FROM bounded b JOIN meta_affected m ON m.feature = b.feature AND m.kind = 'value' AND m.name = b.data_type WHERE qualitative = '{vocab.FAIL}'""",
        "meta_affected",
        "qc_test",
        "qc_bound",
        more=META_VALUE_SQL,
    ),
)
def meta_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return rounded(meta.value_outcomes(records(spark, sf_dir), r.meta_affected, r.qc_test, r.qc_bound), "quantitative")


@query(
    "meta_apply",
    _with(
        f"""SELECT {BASE_COLUMNS}, qualifier, CASE WHEN EXISTS (SELECT 1 FROM identities i WHERE i.feature = d.feature AND i.procedure = d.procedure AND i.observableproperty = d.observableproperty AND i.qualifier = d.qualifier AND d.t_ms BETWEEN i.start_ms AND i.end_ms)
        THEN '{vocab.FAIL}' ELSE '{vocab.PASS}' END AS qualitative FROM defaults d""",
        "meta_affected",
        "meta_check",
        more=f"{RECORDS_SQL}, {IDENTITY_SQL}, defaults AS (SELECT obs.*, '{vocab.META_IDENTITY}' || name AS qualifier FROM obs JOIN meta_check USING (feature) WHERE kind = 'identity')",
    ),
)
def meta_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.apply_intervals(default_identity(spark, sf_dir), _identities(spark, sf_dir))


# --- events ----------------------------------------------------------------------------------


def _null_events(window: str) -> None:
    hours = threshold.HOURS[window]
    size = hours * 3_600_000
    slide = size // 2
    limit = next(n for k, w, n in LIMITS if k == "aggregate" and w == window)
    more = f"""starts AS (SELECT {KEY}, unnest([t_ms - t_ms % {slide}, t_ms - t_ms % {slide} - {slide}]) AS start_ms FROM obs WHERE value IS NULL)"""
    body = f"SELECT {KEY}, '{vocab.EVENT_NULL_AGGREGATE}{window}' AS event, start_ms, start_ms + {size} AS end_ms FROM starts GROUP BY ALL HAVING count(*) >= {limit}"

    @query(f"null_events_{window}", _with(body, more=more))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return events.null_aggregate(null_check(spark, sf_dir), registry(spark).null_limit, window)


for _window in WINDOWS:
    _null_events(_window)

FOLD_SQL = f"""nulls AS (SELECT {KEY}, t_ms, row_number() OVER ({ARRIVAL}) AS i FROM obs WHERE value IS NULL),
fold AS (
    SELECT {KEY}, i, t_ms AS last, 0 AS n, false AS alerted, false AS fired, t_ms FROM nulls WHERE i = 1
    UNION ALL
    SELECT x.feature, x.procedure, x.observableproperty, x.i,
        CASE WHEN x.t_ms - f.last <= 1.5 * {SPACING} AND f.alerted THEN f.last ELSE x.t_ms END,
        CASE WHEN x.t_ms - f.last > 1.5 * {SPACING} THEN 1 WHEN f.alerted THEN f.n ELSE f.n + 1 END,
        x.t_ms - f.last <= 1.5 * {SPACING} AND (f.alerted OR f.n + 1 >= 3),
        x.t_ms - f.last <= 1.5 * {SPACING} AND NOT f.alerted AND f.n + 1 >= 3, x.t_ms
    FROM fold f JOIN nulls x ON x.feature = f.feature AND x.procedure = f.procedure AND x.observableproperty = f.observableproperty AND x.i = f.i + 1
)"""


@query("consecutive_nulls", _with(f"SELECT {KEY}, '{vocab.EVENT_NULL_CONSECUTIVE}' AS event, t_ms AS start_ms, t_ms AS end_ms FROM fold WHERE fired", more=FOLD_SQL).replace("WITH ", "WITH RECURSIVE ", 1))
def consecutive_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return events.null_consecutive(logic.null_check(observations(spark, sf_dir), keep=["tie"]), r.series_meta, r.null_limit, tie="tie")


RUNS_SQL = f"""nulls AS (SELECT *, coalesce(t_ms - lag(t_ms) OVER ({ARRIVAL}) > 1.5 * {SPACING}, true) AS breaks FROM obs WHERE value IS NULL),
runs AS (SELECT *, sum(CAST(breaks AS INTEGER)) OVER ({ARRIVAL}) AS run FROM nulls), placed AS (SELECT *, row_number() OVER (PARTITION BY {KEY}, run ORDER BY seq, tie) AS place FROM runs)"""


@query("consecutive_null_runs", _with(f"SELECT {KEY}, '{vocab.EVENT_NULL_CONSECUTIVE}' AS event, t_ms AS start_ms, t_ms AS end_ms FROM placed WHERE place = 3", more=RUNS_SQL))
def consecutive_null_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark)
    return events.null_consecutive(logic.null_check(observations(spark, sf_dir), keep=["tie"]), r.series_meta, r.null_limit, mode="per_run", tie="tie")


@query("order_events", _with(f"SELECT {KEY}, '{vocab.EVENT_ORDER}' AS event, t_ms AS start_ms, t_ms AS end_ms FROM ({ORDER_SQL}) WHERE qualitative = '{vocab.FAIL}'", more=LATEST_SQL))
def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.order_events(order_check(spark, sf_dir))


@query("spacing_events", _with(f"SELECT {KEY}, '{vocab.EVENT_SPACING}' AS event, t_ms AS start_ms, t_ms AS end_ms FROM ({SPACING_SQL}) WHERE qualitative = '{vocab.FAIL}'", more=LATEST_SQL))
def spacing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.spacing_events(spacing_check(spark, sf_dir))


# --- registry, texts, queues ------------------------------------------------------------------


def _registry(name: str) -> None:
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ") if c != "test_seq int"]  # ROWS numbers tests over all checks
    key = ", ".join(f'"{c}"' for c in columns)

    @query(f"registry_{name}", f"WITH {_table_sql(name)} SELECT DISTINCT {key} FROM {name}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(registry(spark), name).select(*columns)


for _name in ("sensor_map", "route", "qc_test", "qc_bound", "null_limit"):
    _registry(_name)


@query("registry_protocol", f"WITH {', '.join(map(_table_sql, ('meta_check', 'meta_affected')))} SELECT 'check' AS part, feature, kind, name, '' AS a_procedure FROM meta_check UNION ALL SELECT 'affected', feature, kind, name, a_procedure FROM meta_affected")
def registry_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "".join(f"*3\n$3\nSET\n${len(k)}\n{k}\n${len(v)}\n{v}\n" for k, v in registry_entries())
    path = f"{scratch_folder(spark)}/protocol-{uuid.uuid4().hex}"
    spark.createDataFrame([(text,)], "value string").write.text(path)
    r = from_entries(read_protocol(spark, path))
    checks = r.meta_check.select(F.lit("check").alias("part"), "feature", "kind", "name", F.lit("").alias("a_procedure"))
    return checks.union(r.meta_affected.select(F.lit("affected"), "feature", "kind", "name", "a_procedure"))


@query(
    "observation_text",
    _with(
        """SELECT seq, concat_ws('::', feature, procedure, observableproperty, CAST(year(moment) AS VARCHAR), CAST(month(moment) AS VARCHAR), p[3], p[3], CASE WHEN p[4] = 'NotAValue' THEN p[4] ELSE CAST(CAST(p[4] AS DOUBLE) AS VARCHAR) END,
        '0', '0.0', 'Raw', 'SemanticStamp', 'NA', '', 'NA', CASE WHEN len(p) = 5 THEN replace(replace(p[5], '::', ','), '=', ' -> ') ELSE 'NA' END) AS line FROM (SELECT *, make_timestamp(CAST(p[3] AS BIGINT) * 1000) AS moment FROM parsed WHERE parse_ok)""",
        "sensor_map",
        more=PARSED_SQL,
    ),
)
def observation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.observation_text(parse.stamp(parse_raw(spark, sf_dir)))


@query("event_text", _with(f"SELECT concat_ws(',', {KEY}, '{vocab.EVENT_ORDER}', CAST(t_ms AS VARCHAR), CAST(t_ms AS VARCHAR)) AS line FROM ({ORDER_SQL}) WHERE qualitative = '{vocab.FAIL}'", more=LATEST_SQL))
def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.event_text(order_events(spark, sf_dir))


@query("outcome_text", _with(f"SELECT {KEY}, year, month, t_ms, qualifier, qualitative, quantitative FROM ({SPACING_SQL})", more=LATEST_SQL))
def outcome_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To text and back."""
    return parse.parse_outcomes(parse.outcome_text(spacing_check(spark, sf_dir)))


QUEUES_SQL = f"""SELECT 'raw-observations-malformed' AS queue, count(*) AS n, sum(seq) AS seqs FROM parsed WHERE NOT parse_ok UNION ALL SELECT 'observation-persist', count(*), sum(seq) FROM parsed WHERE parse_ok
    UNION ALL SELECT 'observation-routing', count(*), sum(seq) FROM parsed WHERE parse_ok AND p[4] <> 'NotAValue'"""


@query("queues", _with(QUEUES_SQL, "sensor_map", more=PARSED_SQL))
def queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each queue that a batch of raw lines feeds, written and read again."""
    folder = f"{scratch_folder(spark)}/queues-{uuid.uuid4().hex}"
    good = lambda parsed: parse.stamp(parsed)
    sinks.fan_out(
        {
            "raw-observations-malformed": lambda parsed: parse.split_parsed(parsed)[1],
            "observation-persist": good,
            "observation-routing": lambda parsed: good(parsed).filter("value is not null"),
        },
        folder,
    )(parse_raw(spark, sf_dir), 0)
    names = ["raw-observations-malformed", "observation-persist", "observation-routing"]
    parts = [spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("queue"), F.count(F.lit(1)).alias("n"), F.sum("seq").cast("decimal(38,0)").alias("seqs")) for n in names]
    return parts[0].union(parts[1]).union(parts[2])


@query("json_field", "SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events_table.select(F.col("event_id").alias("seq"), F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("sensors", _with("SELECT DISTINCT feature, procedure FROM obs"))
def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.sensors(observations(spark, sf_dir))


# --- lake --------------------------------------------------------------------------------------

DEPTHS = [1, 2, 4, 7, 10, 13, 16, 19, 22, 25, 30, 35]


def profiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Observations of a thermistor for each depth and site, colder with depth but for some noise, every two hours; and their depths."""
    e = _events(spark, sf_dir)
    site = F.concat(F.lit("site"), (F.col("user_id") % 10).cast("string"))
    size = 2 * 3_600_000
    place = (F.col("event_id") % len(DEPTHS)).cast("int")
    own = e.select(site.alias("feature"), (F.col("t_ms") - F.pmod("t_ms", F.lit(size))).alias("t_ms"), place.alias("place"), F.col("value"))
    means = own.groupBy("feature", "t_ms", "place").agg(F.round(22 - 1.4 * F.col("place") + F.avg("value") % 3, 3).alias("value"))
    sensor = F.concat(F.lit("t"), F.col("place").cast("string"))
    obs = means.select("feature", sensor.alias("procedure"), F.lit("temperature").alias("observableproperty"), "t_ms", "value")
    series = [(s, f"t{i}", "temperature", None, d) for s in SITES for i, d in enumerate(DEPTHS)]
    return obs, spark.createDataFrame(series, SCHEMAS["series_meta"])


PROFILE_SQL = f"""layers AS (SELECT 'site' || CAST(user_id % 10 AS VARCHAR) AS feature, t_ms - t_ms % 7200000 AS t_ms, event_id % 12 AS place, avg(value) AS v FROM raw_events GROUP BY ALL),
deep AS (SELECT feature, t_ms, CAST({DEPTHS}[place + 1] AS DOUBLE) AS z, round(22 - 1.4 * place + v % 3, 3) AS t FROM layers),
dense AS (SELECT feature, t_ms, z, 1000 * (1 - (t + 288.9414) * (t - 3.9863) * (t - 3.9863) / (508929.2 * (t + 68.12963))) AS rho FROM deep),
next AS (SELECT *, lead(z) OVER w AS below, lead(rho) OVER w AS rho_below, max(z) OVER (PARTITION BY feature, t_ms) AS deepest FROM dense WINDOW w AS (PARTITION BY feature, t_ms ORDER BY z)),
steps AS (SELECT *, (rho_below - rho) / (below - z) AS g, (z + below) / 2 AS mid, row_number() OVER (PARTITION BY feature, t_ms ORDER BY z) AS i FROM next WHERE below IS NOT NULL),
near AS (SELECT *, lag(g) OVER w AS up_g, lag(z) OVER w AS up_z, lag(mid) OVER w AS up_mid, lead(g) OVER w AS down_g, lead(mid) OVER w AS down_mid, row_number() OVER (PARTITION BY feature, t_ms ORDER BY g DESC, i) AS place FROM steps WINDOW w AS (PARTITION BY feature, t_ms ORDER BY i)),
peak AS (SELECT *, CASE WHEN g - up_g > 0 THEN (z - up_z) / (g - up_g) END AS upper, CASE WHEN g - down_g > 0 THEN (below - z) / (g - down_g) END AS lower FROM near WHERE place = 1),
line AS (SELECT *, coalesce((below * lower + z * upper) / (lower + upper), mid) AS thermo FROM peak),
marked AS (SELECT *, thermo >= mid AS beyond, CASE WHEN thermo >= mid THEN down_g ELSE up_g END AS other_g, CASE WHEN thermo >= mid THEN down_mid ELSE up_mid END AS other_mid FROM line),
center AS (SELECT feature, t_ms, i AS k, z, below, mid, rho, g, deepest, thermo, beyond, coalesce(g + (other_g - g) * (thermo - mid) / nullif(other_mid - mid, 0), g) AS thermo_g FROM marked),
ways AS (SELECT c.feature, c.t_ms, c.thermo, c.thermo_g, c.deepest, s.g, s.mid, s.i, CASE WHEN s.i <= CASE WHEN c.beyond THEN c.k ELSE c.k - 1 END THEN 'up' ELSE 'down' END AS way FROM center c JOIN steps s USING (feature, t_ms)),
walked AS (SELECT *, count(*) FILTER (g < 0.1) OVER (PARTITION BY feature, t_ms, way ORDER BY CASE way WHEN 'up' THEN -i ELSE i END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS under_before FROM ways),
reached AS (SELECT feature, t_ms, way, bool_or(g < 0.1) AS found FROM ways GROUP BY ALL),
points AS (SELECT feature, t_ms, way, g, mid AS z FROM walked WHERE coalesce(under_before, 0) = 0 UNION ALL SELECT c.feature, c.t_ms, w.way, c.thermo_g, c.thermo FROM center c CROSS JOIN (VALUES ('up'), ('down')) AS w(way)),
sides AS (SELECT feature, t_ms, way, max({{'g': g, 'z': z}}) FILTER (g <= 0.1) AS a, min({{'g': g, 'z': z}}) FILTER (g > 0.1) AS b FROM points GROUP BY ALL),
edges AS (SELECT c.feature, c.t_ms, w.way, CASE WHEN c.thermo_g <= 0.1 THEN c.thermo WHEN r.found THEN s.a.z + (s.b.z - s.a.z) * (0.1 - s.a.g) / (s.b.g - s.a.g) WHEN w.way = 'up' THEN f.mid ELSE c.deepest END AS z
    FROM center c CROSS JOIN (VALUES ('up'), ('down')) AS w(way) LEFT JOIN reached r ON r.feature = c.feature AND r.t_ms = c.t_ms AND r.way = w.way LEFT JOIN sides s ON s.feature = c.feature AND s.t_ms = c.t_ms AND s.way = w.way
    JOIN steps f ON f.feature = c.feature AND f.t_ms = c.t_ms AND f.i = 1),
products AS (SELECT feature, 'BUOYFREQ' AS product, t_ms, 9.81 / rho * g AS value FROM center UNION ALL SELECT feature, 'THERMODEPTH', t_ms, mid FROM center
    UNION ALL SELECT feature, CASE way WHEN 'up' THEN 'METADEPTHTOP' ELSE 'METADEPTHBOTTOM' END, t_ms, z FROM edges)"""


@query("lake_products", _with("SELECT feature, product, t_ms, round(value, 6) AS value FROM products", more=PROFILE_SQL))
def lake_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, depths = profiles(spark, sf_dir)
    return rounded(derive.lake_products(obs, depths), "value")


@query("feedback", _with("SELECT feature, product, CAST(t_ms AS VARCHAR) AS t, round(value, 6) AS value FROM products", more=PROFILE_SQL))
def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as raw lines, and read again as such."""
    p = F.split("line", ",")
    return derive.feedback_lines(lake_products(spark, sf_dir)).select(p[0].alias("feature"), p[1].alias("product"), p[2].alias("t"), p[3].cast("double").alias("value"))


# --- routes, products, sinks -----------------------------------------------------------------


@query("inject_routes", _with(f"SELECT seq, {KEY}, t_ms, n_routes, first_job FROM obs JOIN (SELECT {KEY}, count(*) AS n_routes, min(job) AS first_job FROM route GROUP BY ALL) USING ({KEY})", "route"))
def inject_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route.inject_routes(observations(spark, sf_dir), registry(spark).route)
    return routed.select("seq", *SERIES, "t_ms", F.size("routes").cast("long").alias("n_routes"), F.col("routes")[0]["job"].alias("first_job"))


def _route(job: str) -> None:
    @query(f"route_{job}", _with(f"SELECT seq, {KEY}, t_ms, value FROM obs o WHERE EXISTS (SELECT 1 FROM route r WHERE r.job = '{job}' AND r.feature = o.feature AND r.procedure = o.procedure)", "route"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return route.for_job(observations(spark, sf_dir), registry(spark).route, job).select("seq", *SERIES, "t_ms", "value")


for _job in ("threshold", "derived"):
    _route(_job)


@query("route_model", _with(f"SELECT seq, {KEY}, t_ms, value FROM obs o WHERE EXISTS (SELECT 1 FROM route r WHERE r.job = 'threshold' AND r.model = 'model-click' AND r.feature = o.feature AND r.procedure = o.procedure)", "route"))
def route_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.for_job(observations(spark, sf_dir), registry(spark).route, "threshold", "model-click").select("seq", *SERIES, "t_ms", "value")


@query("latest_outcome", _with(f"SELECT {BASE_COLUMNS}, value FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}, t_ms - t_ms % 86400000 ORDER BY seq DESC, tie DESC) AS place FROM obs) WHERE place = 1"))
def latest_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = observations(spark, sf_dir).withColumn("day", F.col("t_ms") - F.pmod("t_ms", F.lit(86_400_000)))
    return sinks.latest(daily, [*SERIES, "day"], ["seq", "tie"]).select(*logic.KEEP, "value")


def _periodic(name: str, hours: int) -> None:
    size = hours * 3_600_000
    body = f"SELECT {KEY}, t_ms - t_ms % {size} AS start_ms, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS greatest, count(value) AS n FROM obs WHERE value IS NOT NULL GROUP BY ALL"

    @query(name, _with(body))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(derive.periodic(observations(spark, sf_dir), hours), "mean")


_periodic("hourly_mean", 1)
_periodic("daily_mean", 24)

# --- analysis --------------------------------------------------------------------------------


@query(
    "bounds_from_data",
    _with(
        f"""SELECT 'obs' AS scope, {KEY}, c AS "check", w AS "window", 'static' AS test, b AS bound, '' AS time_key,
        round(CASE WHEN c = 'range' AND b = 'min' THEN mean - 0.25 * sd WHEN c = 'range' THEN mean + sd WHEN c = 'sigma' AND b = 'min' THEN pow(0.2 * sd, 2) WHEN c = 'sigma' THEN pow(0.75 * sd, 2) WHEN b = 'min' THEN 0.25 * sd ELSE 0.75 * sd END, 6) AS threshold
        FROM stats CROSS JOIN (VALUES ('range', ''), ('step', ''), ('spike', ''), ('sigma', '1h'), ('sigma', '12h'), ('sigma', '24h')) AS cc(c, w) CROSS JOIN (VALUES ('min'), ('max')) AS bb(b)""",
        more=f"stats AS (SELECT {KEY}, round(avg(value), 0) AS mean, round(stddev_samp(value), 0) AS sd FROM obs WHERE value IS NOT NULL GROUP BY ALL)",
    ),
)
def bounds_from_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.bounds_from_data(observations(spark, sf_dir)), "threshold")


@query("clean", _with(f"SELECT {KEY}, t_ms, value, CAST(year(make_timestamp(t_ms * 1000)) AS INTEGER) AS year, CAST(dayofyear(make_timestamp(t_ms * 1000)) AS INTEGER) AS day, CAST(hour(make_timestamp(t_ms * 1000)) AS INTEGER) AS hour FROM numbers GROUP BY ALL", more=NUMBERS))
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.clean(observations(spark, sf_dir)).select(*SERIES, "t_ms", "value", "year", "day", "hour")


def _rolling_sql(width: int) -> str:
    half = width // 2
    w = f"({BY_TIME} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    return ", ".join(f"CASE WHEN count(value) OVER {w} = {2 * half + 1} THEN round({f}(value) OVER {w}, 6) END AS {n}_{width}" for n, f in (("min", "min"), ("max", "max"), ("sd", "stddev_samp")))


@query("rolling", _with(f"SELECT seq, {KEY}, t_ms, value, {_rolling_sql(5)}, {_rolling_sql(14)} FROM numbers", more=NUMBERS))
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.rolling(observations(spark, sf_dir), [5, 14]), *(f"{n}_{w}" for n in ("min", "max", "sd") for w in (5, 14)))


WIDTHS = [15, 30, 45, 60, 90, 120, 180]


@query("rolling_widths", _with(f"SELECT seq, {KEY}, t_ms, value, {', '.join(map(_rolling_sql, WIDTHS))} FROM numbers", more=NUMBERS))
def rolling_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.rolling(observations(spark, sf_dir), WIDTHS), *(f"{n}_{w}" for n in ("min", "max", "sd") for w in WIDTHS))


@query("step_d", _with(f"SELECT seq, {KEY}, t_ms, round(lead(value, 3) OVER ({BY_TIME}) - value, 6) AS step FROM numbers", more=NUMBERS))
def step_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.step_at(observations(spark, sf_dir), 3), "step")


@query(
    "weighted_forecast",
    _with(
        f"""SELECT {KEY}, t_ms, round(sum(w * value) / sum(w), 6) AS forecast, count(*) AS neighbours FROM near GROUP BY {KEY}, t_ms""",
        more=f"""{NUMBERS}, own AS (SELECT DISTINCT {KEY}, t_ms AS ht, value, year AS h_year, dayofyear(make_timestamp(t_ms * 1000)) - 1 AS d, hour(make_timestamp(t_ms * 1000)) AS h FROM numbers),
        asked AS (SELECT DISTINCT {KEY}, t_ms, year, dayofyear(make_timestamp(t_ms * 1000)) - 1 AS d0, hour(make_timestamp(t_ms * 1000)) AS h0 FROM obs WHERE value IS NULL),
        near AS (SELECT a.*, o.value, exp(-pow(a.year - o.h_year, 2)) * exp(-pow(dd / 3.0, 2)) * exp(-pow(dh / 1.0, 2)) AS w FROM asked a CROSS JOIN range(-7, 8) AS x(dd) CROSS JOIN range(-2, 3) AS y(dh)
            JOIN own o USING ({KEY}) WHERE o.d = (d0 + dd + 366) % 366 AND o.h = (h0 + dh + 24) % 24)""",
    ),
)
def weighted_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    return rounded(analysis.weighted_forecast(obs, obs.filter("value is null")), "forecast")


TEDA_COLUMNS = f"seq, {KEY}, t_ms, value"


@query(
    "teda_batch",
    _with(
        f"""SELECT {TEDA_COLUMNS}, round(CASE WHEN k > 1 AND total > 0 THEN 2 * dist / total END, 6) AS eccentricity, round(CASE WHEN k > 1 AND total > 0 THEN 1 - 2 * dist / total END, 6) AS typicality,
        round(CASE WHEN k > 1 AND total > 0 THEN dist / total END, 6) AS norm_eccentricity, round(CASE WHEN k > 2 AND total > 0 THEN (1 - 2 * dist / total) / (k - 2) END, 6) AS norm_typicality, round(1.0 / k, 6) AS threshold
        FROM (SELECT *, sum(dist) OVER (PARTITION BY {KEY}) AS total FROM dists)""",
        more=f"{NUMBERS}, dists AS (SELECT a.seq, a.feature, a.procedure, a.observableproperty, a.t_ms, a.value, sum(abs(a.value - b.value)) AS dist, count(*) AS k FROM numbers a JOIN numbers b ON a.feature = b.feature AND a.procedure = b.procedure AND a.observableproperty = b.observableproperty GROUP BY ALL)",
    ),
)
def teda_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.teda_batch(observations(spark, sf_dir)), "eccentricity", "typicality", "norm_eccentricity", "norm_typicality", "threshold")


def _teda_sql(rows: str, value: str = "value") -> str:
    w = f"({BY_TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ecc = f"CASE WHEN k > 1 AND var > 0 THEN 1.0 / k + pow(mu - {value}, 2) / (k * var) END"
    return f"""SELECT seq, {KEY}, t_ms, round({value}, 6) AS value, k, round({ecc}, 6) AS eccentricity, {ecc} / 2 > 5.0 / (2 * k) AS outlier
        FROM (SELECT *, count({value}) OVER {w} AS k, avg({value}) OVER {w} AS mu, var_pop({value}) OVER {w} AS var FROM {rows})"""


@query("teda_2016", _with(_teda_sql("numbers"), more=NUMBERS))
def teda_2016(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.teda_2016(observations(spark, sf_dir)), "value", "eccentricity")


@query(
    "teda_2014",
    _with(
        f"""SELECT {TEDA_COLUMNS}, k, round(CASE WHEN k > 1 AND sum_pi > 0 THEN 2 * pi_ / sum_pi END, 6) AS eccentricity
        FROM (SELECT *, sum(pi_) OVER ({BY_TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sum_pi FROM (SELECT *, pow(value - mu, 2) + sq - mu * mu AS pi_
        FROM (SELECT *, count(value) OVER w AS k, avg(value) OVER w AS mu, avg(value * value) OVER w AS sq FROM numbers WINDOW w AS ({BY_TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))""",
        more=NUMBERS,
    ),
)
def teda_2014(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis.teda_2014(observations(spark, sf_dir)), "eccentricity")


DELTA_GAP = 600_000


@query("teda_delta", _with(_teda_sql("steps", "step"), more=f"{NUMBERS}, slots AS (SELECT * REPLACE (t_ms - t_ms % {DELTA_GAP} AS t_ms) FROM numbers), steps AS (SELECT * FROM (SELECT *, lag(value) OVER ({BY_TIME}) - value AS step, t_ms - lag(t_ms) OVER ({BY_TIME}) AS gap FROM slots) WHERE gap = {6 * DELTA_GAP})"))
def teda_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = observations(spark, sf_dir).withColumn("t_ms", F.col("t_ms") - F.pmod("t_ms", F.lit(DELTA_GAP)))
    return rounded(analysis.teda_delta(slots, 6 * DELTA_GAP), "value", "eccentricity")


SIGMA_ROWS = f"({BY_TIME} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


def _teda_sigma(name: str, tumbling: bool) -> None:
    more = f"{NUMBERS}, varied AS (SELECT * FROM (SELECT *, count(value) OVER {SIGMA_ROWS} AS c, var_samp(value) OVER {SIGMA_ROWS} AS variance, row_number() OVER ({BY_TIME}) AS i FROM numbers) WHERE c = 5{' AND (i - 3) % 4 = 0' if tumbling else ''})"

    @query(name, _with(_teda_sql("varied", "variance"), more=more))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(analysis.teda_sigma(observations(spark, sf_dir), 5, tumbling), "value", "eccentricity")


_teda_sigma("teda_sigma", False)
_teda_sigma("teda_sigma_tumbling", True)
