"""Outcomes of the small inputs, which were worked out by hand."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidegauge.functions import vocab
from tidegauge.operators import analysis, derive, events, logic, meta, parse, route, sinks, threshold
from tidegauge.plans import jobs
from tidegauge.session import scratch_folder
from tidegauge.sources import registry as reg
from tidegauge.sources.streams import lines_of, logger_file, queued, text_lines


@pytest.fixture(scope="module")
def registry(spark):
    return reg.from_entries(spark.createDataFrame(fx.entries(), "key string, value string").cache())


def observed(spark, registry, lines):
    return jobs.semantic_stamp(lines_of(spark, lines), registry)[0]


def tally(df):
    return Counter((r.qualifier.rsplit("/qc/")[-1], r.qualitative == vocab.FAIL) for r in df.collect())


def test_registry_from_text_and_protocol(spark, tmp_path):
    (tmp_path / "r.txt").write_text("SET a::b::feature x\n\nSET a::b::procedure y\nSET a::b::observableproperty z\nSET a::b::observationtype numeric\n")
    (tmp_path / "r.redis").write_text("".join(f"*3\r\n$3\r\nSET\r\n${len(k)}\r\n{k}\r\n${len(v)}\r\n{v}\r\n" for k, v in fx.entries()))
    assert reg.from_entries(reg.read_text(spark, str(tmp_path / "r.txt"))).sensor_map.collect() == [("a", "b", "x", "y", "z", "numeric")]
    assert Counter(map(tuple, reg.read_protocol(spark, str(tmp_path / "r.redis")).collect())) == Counter(fx.entries())


def test_parse(spark, registry):
    parsed = parse.parse_raw(lines_of(spark, fx.STAMP), registry.sensor_map)
    assert Counter(r.parse_message for r in parsed.collect()) == {
        "Parsed OK.": 6, "Malformed observation tuple.": 5, "Registry lookup failed.": 2, "Incorrect time representation.": 1, "Observation type from registry not matched.": 1, "Metadata is not correctly formatted.": 1,
    }
    rows = parse.stamp(parsed).collect()
    assert len(rows) == 6 and {(r.year, r.month, r.t_end_ms - r.t_ms) for r in rows} == {(2016, 8, 0)}
    assert [r.parameters for r in rows if r.parameters] == [{"valueA": "1", "valueB": "2", "valueC": "3"}]


def test_repeated_parameter_keeps_the_last(spark, registry):
    rows = observed(spark, registry, ["SBAS,PRT1,1471219200000,1,a=1::a=2"]).collect()
    assert rows[0].parameters == {"a": "2"}


def test_null_order_spacing(spark, registry):
    assert tally(logic.null_check(observed(spark, registry, fx.NULLS))) == {("null/value", False): 3, ("null/value", True): 3}
    rows = logic.order_check(observed(spark, registry, fx.ORDER)).collect()
    assert sorted(r.quantitative for r in rows) == [-100000.0] * 7 + [0.0, 400000.0, 500000.0, 600000.0]
    by_chunks = logic.order_check(observed(spark, registry, fx.ORDER), chunk=3).collect()
    assert sorted(map(tuple, by_chunks)) == sorted(map(tuple, rows))
    rows = logic.spacing_check(observed(spark, registry, fx.SPACING), registry.series_meta).collect()
    assert sorted(r.quantitative for r in rows) == [-240000.0] * 5 + [0.0, 480000.0, 480000.0]


def test_defaults(spark, registry):
    obs = observed(spark, registry, ["SBAS,PRT1,1471219200000,1", "SBAS,PRT2,1471219200000,1", "NBAS,PRT1,1471219200000,1"])
    assert logic.default_identity(obs, registry.meta_check).count() == 6
    assert logic.default_value(obs, registry.meta_check, registry.qc_test).count() == 20


def test_range(spark, registry):
    got = tally(threshold.range_check(observed(spark, registry, fx.RANGE), registry.qc_test, registry.qc_bound))
    assert got == {
        ("range/static/min", False): 29, ("range/static/min", True): 3, ("range/static/max", False): 30, ("range/static/max", True): 2, ("range/hourlyTL/min", False): 1, ("range/hourlyTL/max", True): 1,
        ("range/dailyTL/min", False): 4, ("range/dailyTL/min", True): 2, ("range/dailyTL/max", False): 3, ("range/dailyTL/max", True): 3, ("range/monthlyTL/min", False): 31, ("range/monthlyTL/min", True): 1,
        ("range/monthlyTL/max", False): 30, ("range/monthlyTL/max", True): 2,
    }


def test_delta(spark, registry):
    obs = observed(spark, registry, fx.DELTA)
    spike = threshold.delta_spike(obs, registry.qc_test, registry.qc_bound).collect()
    assert len(spike) == 60
    assert Counter(r.quantitative for r in spike if r.qualitative == vocab.FAIL) == {13: 4, 7: 1, 9: 1, 11: 1, 49: 1, 133: 1}
    step = threshold.delta_step(obs, registry.qc_test, registry.qc_bound).collect()
    assert len(step) == 124
    assert Counter(r.quantitative for r in step if r.qualitative == vocab.FAIL) == {1: 6, 17: 2, 19: 2, 59: 2, 61: 2}


def test_sigma(spark, registry):
    obs = observed(spark, registry, fx.SIGMA)
    fails = {w: tally(threshold.sigma_check(obs, registry.qc_test, registry.qc_bound, w)) for w in reg.WINDOWS}
    assert all(sum(c.values()) == 64 for c in fails.values())
    assert {w: sum(n for (_, f), n in c.items() if f) for w, c in fails.items()} == {"1h": 0, "12h": 2, "24h": 3}


def test_not_a_number_never_fails(spark, registry):
    assert tally(threshold.range_check(observed(spark, registry, ["SBAS,PRT1,1,NaN"]), registry.qc_test, registry.qc_bound)) == {("range/static/min", False): 1, ("range/static/max", False): 1}


def test_meta(spark, registry):
    parsed = parse.parse_meta(lines_of(spark, fx.META)).cache()
    assert Counter(r.parse_message.removeprefix("Parse failed.  ") for r in parsed.collect()) == {
        "Parsed OK.": 9, "Missing values, check all columns for values.": 4, "Start and/or End time are malformed.": 1, "Malformed CSV, missing columns.": 3,
    }
    values, identities, _ = parse.split_meta(parsed)
    assert meta.identity_outcomes(identities, registry.meta_affected).count() == 2
    found = meta.value_outcomes(values, registry.meta_affected, registry.qc_test, registry.qc_bound).collect()
    assert Counter(r.qualifier.split("/range/")[1] for r in found) == {
        "battery/static/min": 2, "battery/static/max": 2, "battery/hourlybattery/min": 4, "battery/dailybattery/min": 4, "battery/monthlybattery/min": 4, "cabling/static/min": 1,
    }
    assert Counter(r.quantitative for r in found)[3.5] == 6 and Counter(r.quantitative for r in found)[5.0] == 6


def test_events(spark, registry):
    obs = observed(spark, registry, fx.events())
    found = jobs.event_block(jobs.logic_block(obs, registry), registry).collect()
    assert Counter(r.event.split("/event/")[1] for r in found) == {"timing/spacing": 39, "timing/order": 1, "null/aggregate/1h": 2, "null/aggregate/12h": 9, "null/aggregate/24h": 5, "null/consecutive": 2}
    assert sorted(r.start_ms for r in found if "consecutive" in r.event) == [1372486060000, 1372487210000]
    once = events.null_consecutive(logic.null_check(obs), registry.series_meta, registry.null_limit, mode="per_run").collect()
    assert [r.start_ms for r in once] == [1372486060000, 1372487210000]


def test_routes(spark, registry):
    obs = observed(spark, registry, fx.LAKE_LINES)
    assert {len(r.routes) for r in route.inject_routes(obs, registry.route).collect()} == {1, 4}
    assert route.for_job(obs, registry.route, "threshold").count() == 1 and route.for_job(obs, registry.route, "derived").count() == 12
    assert jobs.threshold_block(obs, registry).count() > 0


def test_lake(spark, registry):
    found = {r["product"]: r.value for r in jobs.derived_block(observed(spark, registry, fx.LAKE_LINES), registry).collect()}
    assert found["BUOYFREQ"] == pytest.approx(0.001384711, rel=1e-6) and found["THERMODEPTH"] == 5.5
    assert found["METADEPTHTOP"] == pytest.approx(5.52431, abs=1e-4) and found["METADEPTHBOTTOM"] == pytest.approx(6.802273, abs=1e-4)
    lines = derive.feedback_lines(derive.lake_products(observed(spark, registry, fx.LAKE_LINES), registry.series_meta))
    assert all(r.line.count(",") == 3 for r in lines.collect())


def test_empty_input(spark, registry):
    obs = observed(spark, registry, [])
    assert jobs.logic_block(obs, registry).count() == jobs.threshold_block(obs, registry).count() == jobs.derived_block(obs, registry).count() == 0
    assert jobs.meta_block(lines_of(spark, []), registry)[0].count() == 0


def test_text_round_trip_and_upsert(spark, registry, tmp_path):
    rows = threshold.delta_step(observed(spark, registry, fx.DELTA), registry.qc_test, registry.qc_bound)
    back = parse.parse_outcomes(parse.outcome_text(rows))
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.select(*parse.OUTCOME_FIELDS).collect()))
    path = str(tmp_path / "outcomes")
    sinks.upsert(rows, path)
    n = spark.read.parquet(path).count()
    assert n == 64
    new = rows.filter(F.col("t_ms") < fx.DAY + 5 * 14_400_000)
    sinks.upsert(new.withColumns({"quantitative": F.lit(-999.0), "seq": F.lit(10**6).cast("long")}), path)
    table = spark.read.parquet(path)
    assert table.count() == n and table.filter("quantitative = -999").count() == new.select(*sinks.OUTCOME_KEY).distinct().count()
    assert not list(Path(scratch_folder(spark).removeprefix("file://")).glob("upsert-*"))
    files = set(map(str, (tmp_path / "outcomes").glob("year=*/month=*/*.parquet")))
    later = rows.limit(1).withColumns({"year": F.lit(2031), "month": F.lit(1)})
    sinks.upsert(later, path)
    assert files < set(map(str, (tmp_path / "outcomes").glob("year=*/month=*/*.parquet"))) and spark.read.parquet(path).count() == n + 1
    sinks.write_partitioned(rows, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == rows.count()


def test_logger_file(spark, tmp_path):
    (tmp_path / "x.dat").write_text('"SBAS","log","c","","","","",""\n"TIMESTAMP","A","B"\n"TS","C","C"\n"","Avg","Avg"\n"2016-01-01 00:00:00",1.5,2\n"2016-01-01 01:00:00",3,"NAN"\n')
    rows = logger_file(spark, str(tmp_path / "x.dat")).collect()
    assert [(r.site, r.sensor, r.value) for r in rows] == [("SBAS", "A", "1.5"), ("SBAS", "B", "2"), ("SBAS", "A", "3"), ("SBAS", "B", "NAN")]
    (tmp_path / "y.dat").write_text('"NBAS","log"\n"TIMESTAMP","Q"\n"TS","C"\n"","Avg"\n"2016-01-01 00:00:00",7\n')
    rows = logger_file(spark, str(tmp_path / "*.dat")).filter("site = 'NBAS'").collect()
    assert [(r.sensor, r.time, r.value) for r in rows] == [("Q", "2016-01-01 00:00:00", "7")]


def test_lines_keep_the_order_of_files_and_places(spark, tmp_path):
    """Of two files the larger one comes last by name, and is read in several splits."""
    (tmp_path / "a.txt").write_text("a0\n\na1\n")
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = sorted(map(tuple, text_lines(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert rows == [(0, "a0"), (2, "a1"), *((3 + i, f"b{i}") for i in range(2000))]


def test_queue_numbers_are_unique_and_in_order(spark):
    messages = spark.createDataFrame([(p, o, b"x") for p in range(3) for o in range(4)], "partition int, offset long, value binary")
    seqs = [r.seq for r in queued(messages).collect()]
    assert len(set(seqs)) == 12 and all(sorted(own) == own for own in (seqs[i : i + 4] for i in (0, 4, 8)))


def test_consecutive_nulls_by_parts_equal_the_fold(spark, registry):
    """Random gaps, against the rules one null at a time."""
    import random

    rng = random.Random(4)
    t, times = 1372424400000, []
    for _ in range(400):
        t += rng.choice([-300_000, 0, 60_000, 240_000, 240_000, 240_000, 350_000, 370_000, 900_000])
        times.append(t)
    last, n, alerted, expected = None, 0, False, []
    for t in times:
        if last is None:
            last, n = t, 0
        elif t - last > 360_000:
            last, n, alerted = t, 1, False
        elif not alerted:
            last, n, alerted = t, n + 1, n + 1 >= 3
            expected += [t] * alerted
    outcomes = logic.null_check(observed(spark, registry, [f"SBAS,PRT1,{t},NotAValue" for t in times]))
    for chunk in (7, 1_000_000):
        assert sorted(r.start_ms for r in events.null_consecutive(outcomes, registry.series_meta, registry.null_limit, chunk=chunk).collect()) == sorted(expected)


def test_intervals_that_overlap_fail_an_outcome_once(spark):
    day = 86_400_000
    key = ("f", "p", "o")
    outcomes = spark.createDataFrame([(i, *key, t, "q", vocab.PASS) for i, t in enumerate([0, 5, 10, 11, day - 1, day, day + 7, 3 * day])], "seq long, feature string, procedure string, observableproperty string, t_ms long, qualifier string, qualitative string")
    intervals = spark.createDataFrame([(*key, a, b, "q") for a, b in [(5, 10), (6, 8), (7, 9), (5, 5), (day - 1, day + 7), (9, 10)]] + [(*key, 0, 4 * day, "other")], "feature string, procedure string, observableproperty string, start_ms long, end_ms long, qualifier string")
    got = meta.apply_intervals(outcomes, intervals)
    assert got.columns == outcomes.columns and sorted((r.seq, r.qualitative == vocab.FAIL) for r in got.collect()) == [(0, False), (1, True), (2, True), (3, False), (4, True), (5, True), (6, True), (7, False)]


def test_chunks_of_running_sums_change_nothing(spark):
    from tidegauge.operators import analysis

    rows = [(i, "f", "p", "o", i * 1000, float((i * 37) % 23)) for i in range(200)]
    obs = spark.createDataFrame(rows, "seq long, feature string, procedure string, observableproperty string, t_ms long, value double")
    for f in (analysis.teda_2016, analysis.teda_2014):
        whole, cut = ({r.seq: (r.k, r.eccentricity) for r in f(obs, chunk_ms=c).collect()} for c in (10**9, 7000))
        assert all(whole[i][0] == cut[i][0] == i + 1 and (whole[i][1] is None) == (cut[i][1] is None) == (i == 0) and (i == 0 or whole[i][1] == pytest.approx(cut[i][1], rel=1e-9)) for i in whole)


def test_blocks_of_a_series_change_nothing(spark):
    """Rows copied between blocks of three rows give what one block gives, also where a series is shorter than the window."""
    rng = random.Random(5)
    rows = [(i, f, "p", "o", rng.randrange(40) * 1000, None if i % 7 == 0 else rng.random()) for i, f in enumerate(["a"] * 60 + ["b"] * 2)]
    obs = spark.createDataFrame(rows, "seq long, feature string, procedure string, observableproperty string, t_ms long, value double")
    for f, *args in ((analysis.rolling, [5, 14]), (analysis.step_at, 3), (analysis.step_at, -2), (analysis.teda_sigma, 5), (analysis.teda_sigma, 5, True), (analysis.teda_delta, 1000)):
        whole, cut = (sorted(map(tuple, f(obs, *args, block=b).collect()), key=str) for b in (1 << 16, 3))
        assert len(whole) == len(cut) and all(x == pytest.approx(y, nan_ok=True) if isinstance(x, float) else x == y for r, q in zip(whole, cut) for x, y in zip(r, q))
    by_time = sorted((r for r in rows if r[1] == "a" and r[5] is not None), key=lambda r: (r[4], r[0]))
    steps = {r.seq: r.step for r in analysis.step_at(obs, 3, block=4).filter("feature = 'a'").collect()}
    assert steps == {r[0]: by_time[i + 3][5] - r[5] if i + 3 < len(by_time) else None for i, r in enumerate(by_time)}


def test_a_prepared_registry_moves_no_observations(spark, registry):
    own = reg.prepared(registry)
    obs = observed(spark, own, fx.RANGE)
    plan = threshold.range_check(obs, own.qc_test, own.qc_bound)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_text_of_observations_and_events(spark, registry):
    rows = [r.line for r in parse.observation_text(observed(spark, registry, ["SBAS,PRT1,1471219200000,22.45,a=1::b=2", "SBAS,PRT1,1471219200000,NotAValue"])).collect()]
    assert rows == ["southbasin::prtone::temperature::2016::8::1471219200000::1471219200000::22.45::0::0.0::Raw::SemanticStamp::NA::::NA::a -> 1,b -> 2", "southbasin::prtone::temperature::2016::8::1471219200000::1471219200000::NotAValue::0::0.0::Raw::SemanticStamp::NA::::NA::NA"]
    found = events.order_events(logic.order_check(observed(spark, registry, fx.ORDER)))
    assert all(r.line.split(",")[3:] == [vocab.EVENT_ORDER, str(t), str(t)] for r in parse.event_text(found).collect() for t in [r.line.split(",")[4]])
