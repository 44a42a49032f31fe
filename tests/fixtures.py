"""Small inputs whose outcomes are known: a lake platform with twelve sensors, and registry entries as key and value."""

DAY = 1470056400000
SERIES = "southbasin::{}::temperature"
NAMES = "one two three four five six seven eight nine ten eleven twelve".split()
DEPTHS = [1, 2, 4, 7, 10, 13, 16, 19, 22, 25, 30, 35]
LAKE = "http://placeholder.catalogue.ceh.ac.uk/derived/lake-analyzer"
QC = "http://placeholder.catalogue.ceh.ac.uk/qc/"


def entries() -> list[tuple[str, str]]:
    out = []
    for i, name in enumerate(NAMES):
        sensor, key = f"SBAS::PRT{i + 1}", SERIES.format(f"prt{name}")
        out += [(f"{sensor}::feature", "southbasin"), (f"{sensor}::procedure", f"prt{name}"), (f"{sensor}::observableproperty", "temperature"), (f"{sensor}::observationtype", "numeric")]
        out += [(f"{key}::depth", str(DEPTHS[i]))]
        routes = [f"threshold,{QC}{m},southbasin::prt{name}" for m in ()] + [f"derived,{LAKE},southbasin"]
        if name == "one":
            routes = [f"threshold,{QC}{m},x" for m in ("range", "sigma", "delta")] + routes
        out += [(f"{key}::routing", "::".join(routes))]
    one = SERIES.format("prtone")
    out += [(f"{one}::intendedspacing", "240000")]
    affected = "southbasin,prtone,temperature"
    both = f"{affected}::southbasin,prttwo,temperature"
    out += [("southbasin::meta::identity", "maintenance::cleaning::reset"), ("southbasin::meta::identity::maintenance", both)]
    out += [("southbasin::meta::value", "battery::wifi::network::sdcard::cabling"), ("southbasin::meta::value::battery", both)]
    out += [(f"southbasin::meta::value::{k}", affected) for k in ("network", "sdcard", "cabling")]

    def bounds(base: str, tests: list[tuple[str, str, str, float | None, float | None]]) -> list[tuple[str, str]]:
        rows = []
        for test, resolution, key, low, high in tests:
            rows += [(f"{base}::{test}", resolution)]
            rows += [(f"{base}::{test}::{b}{'::' + key if key else ''}", f"{x:g}") for b, x in (("min", low), ("max", high)) if x is not None]
        return rows

    battery = "southbasin::meta::value::battery::thresholds::range"
    out += [(battery, "static::hourlybattery::dailybattery::monthlybattery")]
    out += bounds(battery, [("static", "single", "", 10, 14), ("hourlybattery", "hour", "2016-08-01T12", 14, 31), ("dailybattery", "day", "2016-08-01", 14, 31), ("monthlybattery", "month", "2016-08", 14, 31)])
    cabling = "southbasin::meta::value::cabling::thresholds::range"
    out += [(cabling, "static"), *bounds(cabling, [("static", "single", "", 12, None)])]
    own = f"{one}::thresholds::range"
    out += [(own, "static::hourlyTL::dailyTL::monthlyTL")]
    out += bounds(own, [("static", "single", "", 10, 120), ("hourlyTL", "hour", "2016-08-02T09", 10, 30), ("dailyTL", "day", "2016-08-03", 45, 45), ("monthlyTL", "month", "2016-08", 5, 120)])
    sigma = f"{one}::thresholds::sigma"
    out += [(sigma, "static")]
    for window, low, high in (("1h", 0, 1), ("12h", 1, 2), ("24h", 2, 4)):
        out += bounds(f"{sigma}::{window}", [("static", "single", "", low, high)])
    for kind, high in (("step", 10), ("spike", 5)):
        out += [(f"{one}::thresholds::delta::{kind}", "static"), *bounds(f"{one}::thresholds::delta::{kind}", [("static", "single", "", 0, high)])]
    nulls = f"{one}::thresholds::null"
    return [*out, (f"{nulls}::consecutive", "3"), (f"{nulls}::aggregate::1h", "3"), (f"{nulls}::aggregate::12h", "5"), (f"{nulls}::aggregate::24h", "10")]


def series(values: dict[int, float], n: int, base) -> list[str]:
    return [f"SBAS,PRT1,{DAY + 14_400_000 * i},{values.get(i, base(i))}" for i in range(n)]


RANGE = series({5: 31}, 32, lambda i: 1 + 4 * i)
DELTA = series({3: 14, 9: 20, 15: 26, 17: 25, 21: 50, 23: 32, 29: 100}, 32, lambda i: i + 1)
SIGMA = series({}, 32, lambda i: i + 1)
ORDER = [f"SBAS,PRT1,{1471219200000 + 100000 * k},1" for k in (0, 1, 2, 3, 4, 5, 6, 2, 1, 0, 7)]
SPACING = [f"SBAS,PRT1,{1452427440000 + 240000 * k},1" for k in (0, 1, 3, 5, 6, 7, 8, 9)] + ["SBAS,PRT2,1452427440000,1", "SBAS,PRT2,1452427680000,1"]
NULLS = [f"SBAS,PRT1,{1471219200000 + i},{v}" for i, v in enumerate(("1", "NotAValue", "2", "3", "NotAValue", "NotAValue"))]


def events() -> list[str]:
    hour = 3_600_000
    first = [1372424400000 + hour * i for i in range(18)]
    first[8] = 1372446600000
    rows = [(t, "NotAValue") for t in first] + [(1372485830000 + 230_000 * i, "34" if i == 3 else "NotAValue") for i in range(8)]
    rows += [(1372518000000 + hour * i, "NotAValue") for i in range(22)]
    return [f"SBAS,PRT1,{t},{v}" for t, v in rows]


STAMP = [
    ",PRT1,1471219200000,34.3", "SBAS,,1471219200000,34.3", "SBAS,PRT1,,34.3", "SBAS,PRT1,1471219200000,", "SBAS,PRT1,1471219200000,34.3,123", "SBAS,PRT1,1471219200000",
    "SBAS,PRT123,1471219200000,34.3", "NBAS,PRT1,1471219200000,34.3", "SBAS,PRT1,2007-01-01T00:00:00,34.3", "SBAS,PRT1,1471219200000,NotAValue", "SBAS,PRT1,1471219200000,NotAValue",
    "SBAS,PRT1,1471219200000,22.45", "SBAS,PRT1,1471219200000,22.41", "SBAS,PRT1,1471219200000,22.42", "SBAS,PRT1,1471219200000,22.43,valueA=1::valueB=2::valueC=3", "SBAS,PRT1,1471219200000,Blue Moth",
]
SPAN = "1470050400000,1470057600000"
META = [
    f"southbasin,battery,{SPAN},15", "southbasin,battery,2017-01-01T00:00:00+0000,1470057600000,15", f",battery,{SPAN},10.5", "southbasin,,1452427440000,1470057600000,10.5", "southbasin,battery,,1470057600000,10.5",
    "southbasin,battery,1470050400000,,10.5", f"southbasin,battery,{SPAN},", f"southbasin,battery,{SPAN},10.5,10.2", f"southbasin,battery,{SPAN}", f"southbasin,battery,{SPAN},10.5", f"southbasin,maintenance,{SPAN},NotAValue",
    f"southbasin,maintenance_no_affected,{SPAN},NotAValue", f"southbasin,battery,{SPAN},9", *(f"southbasin,{k},{SPAN},10.5" for k in ("wifi", "network", "sdcard", "cabling")),
]
PROFILE = [16.05365, 16.06409, 16.09060, 13.19981, 12.05359, 10.91482, 10.03103, 9.10167, 8.88400, 8.54495, 8.45575, 8.41193]
LAKE_LINES = [f"SBAS,PRT{i + 1},1372417200000,{v:.5f}" for i, v in enumerate(PROFILE)]
