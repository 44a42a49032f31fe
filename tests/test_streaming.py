"""A stream replayed in small batches gives what the batch gives."""

from collections import Counter

import pytest

from tests import fixtures as fx
from tests.test_observations import observed, registry  # noqa: F401
from tidegauge.operators import events, logic, threshold
from tidegauge.sources.streams import file_stream
from tidegauge.streaming import jobs


@pytest.fixture
def replay(spark, tmp_path):
    def run(rows, make, size=7):
        folder, n = tmp_path / "in", 0
        whole = rows.orderBy("seq").collect()
        for at in range(0, len(whole), size):
            spark.createDataFrame(whole[at : at + size], rows.schema).coalesce(1).write.parquet(str(folder / f"{n:03d}"))
            n += 1
        stream = file_stream(spark, str(folder / "*"), rows.schema, files_per_batch=1)
        jobs.write_to(make(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(180)
        return Counter(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))

    return run


def test_order(spark, registry, replay):  # noqa: F811
    obs = observed(spark, registry, fx.ORDER)
    assert replay(obs, jobs.order_check) == Counter(map(tuple, logic.order_check(obs).collect()))


@pytest.mark.parametrize("name", ["delta_step", "delta_spike"])
def test_delta(spark, registry, replay, name):  # noqa: F811
    obs = observed(spark, registry, fx.DELTA)
    batch = getattr(threshold, name)(obs, registry.qc_test, registry.qc_bound)
    assert replay(obs, lambda s: getattr(jobs, name)(s, registry), 10) == Counter(map(tuple, batch.collect()))


def test_consecutive_nulls(spark, registry, replay):  # noqa: F811
    nulls = logic.null_check(observed(spark, registry, fx.events()))
    assert replay(nulls, lambda s: jobs.null_consecutive(s, registry), 12) == Counter(map(tuple, events.null_consecutive(nulls, registry.series_meta, registry.null_limit).collect()))


def test_windows_that_have_passed(spark, registry, replay):  # noqa: F811
    lines = fx.events() + ["SBAS,PRT1,1375000000000,NotAValue"]
    nulls = logic.null_check(observed(spark, registry, lines))
    batch = events.null_aggregate(nulls, registry.null_limit, "12h").filter("end_ms < 1375000000000")
    assert replay(nulls, lambda s: events.null_aggregate(s, registry.null_limit, "12h", watermark="1 day"), 60) == Counter(map(tuple, batch.collect()))


def test_sigma(spark, registry, replay):  # noqa: F811
    obs = observed(spark, registry, [*fx.SIGMA, "SBAS,PRT1,1480000000000,1"])
    batch = threshold.sigma_check(obs, registry.qc_test, registry.qc_bound, "24h").filter("t_ms < 1480000000000")
    assert replay(obs, lambda s: jobs.sigma_check(s, registry, "24h"), 40) == Counter(map(tuple, batch.collect()))


def test_late_rows_are_dropped(spark, registry, replay):  # noqa: F811
    """A window that has passed takes no more rows: three nulls, a later day, then three that would have been an event."""
    hour, start = 3_600_000, 1372424400000
    times = [start, start + 1000, start + 2000, start + 48 * hour, start + 49 * hour, start + 50 * hour, start + 3000, start + 4000, start + 5000, start + 96 * hour, start + 97 * hour, start + 98 * hour]
    nulls = logic.null_check(observed(spark, registry, [f"SBAS,PRT1,{t},NotAValue" for t in times]))
    found = replay(nulls, lambda s: events.null_aggregate(s, registry.null_limit, "1h", watermark="2 hours"), 3)
    counted = events.null_aggregate(nulls.filter("seq < 3"), registry.null_limit, "1h").collect()
    assert found == Counter(map(tuple, counted)) and counted


def test_lake(spark, registry, replay):  # noqa: F811
    """Rows of an instant up to four hours late are part of its profile."""
    from tidegauge.operators import derive

    lines = [x.replace("1372417200000", str(t)) for t in (1372417200000, 1372420800000) for x in fx.LAKE_LINES]
    lines = [*lines[1:20], "SBAS,PRT1,1372426800000,15", lines[0], *lines[20:], "SBAS,PRT1,1372700000000,15", "SBAS,PRT1,1372700000001,15"]
    obs = observed(spark, registry, lines)
    batch = derive.lake_products(obs, registry.series_meta)
    assert replay(obs, lambda s: jobs.lake_products(s, registry), 5) == Counter(map(tuple, batch.collect())) and batch.count() == 8


def test_fan_out_writes_a_table_for_each_queue(spark, registry, tmp_path):  # noqa: F811
    from tidegauge.operators import parse, sinks
    from tidegauge.sources.streams import lines_of

    (tmp_path / "in").mkdir()
    lines_of(spark, fx.STAMP).write.parquet(str(tmp_path / "in" / "one"))
    stream = file_stream(spark, str(tmp_path / "in" / "*"), "seq long, line string")
    parsed = parse.parse_raw(stream, registry.sensor_map)
    sink = sinks.fan_out({"observation-persist": lambda b: parse.stamp(b), "raw-observations-malformed": lambda b: parse.split_parsed(b)[1]}, str(tmp_path / "out"))
    parsed.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(180)
    assert spark.read.parquet(str(tmp_path / "out/observation-persist")).count() == 6
    assert spark.read.parquet(str(tmp_path / "out/raw-observations-malformed")).count() == 10
