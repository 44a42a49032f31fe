"""Derived products: lake physics from temperature profiles, and hourly and daily means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.vocab import SERIES

GRAVITY = 9.81
#: kg/m3 a metre: where the metalimnion begins and ends.
META_SLOPE = 0.1


def water_density(t: Column) -> Column:
    """Of fresh water, kg/m3, by temperature in degrees Celsius."""
    return 1000 * (1 - (t + 288.9414) * (t - 3.9863) * (t - 3.9863) / (508929.2 * (t + 68.12963)))


def _at_slope(points: Column, slope: float) -> Column:
    """The depth at which points (g, z), in order of g, reach the slope."""
    a = F.element_at(F.array_sort(F.filter(points, lambda x: x["g"] <= slope)), -1)
    b = F.array_sort(F.filter(points, lambda x: x["g"] > slope))[0]
    return a["z"] + (b["z"] - a["z"]) * (slope - a["g"]) / (b["g"] - a["g"])


def layers(obs: DataFrame, series_meta: DataFrame) -> DataFrame:
    """Values with the depth of their series."""
    depths = series_meta.filter("depth is not null").select(*SERIES, "depth")
    return obs.filter("value is not null").join(depths, SERIES)


def profiles(rows: DataFrame, *instant: str | Column) -> DataFrame:
    """Of layers, all values of a feature at an instant in order of depth. instant: what tells instants apart, t_ms among it."""
    points = F.struct(F.col("depth").cast("double").alias("z"), F.col("value").alias("t"))
    return rows.groupBy("feature", *instant).agg(F.array_sort(F.collect_list(points)).alias("p")).filter(F.size("p") >= 2)


def lake_products(obs: DataFrame, series_meta: DataFrame, slope: float = META_SLOPE) -> DataFrame:
    return products_of(profiles(layers(obs, series_meta), "t_ms"), slope)


def products_of(profile: DataFrame, slope: float = META_SLOPE) -> DataFrame:
    """(feature, product, t_ms, value) for each profile of a feature at an instant.

    BUOYFREQ: squared buoyancy frequency of the steepest interval. THERMODEPTH: the middle of that interval.
    METADEPTHTOP and METADEPTHBOTTOM, by the published method: gradients stand at the middles of intervals, with one
    more point at the thermocline weighted by the gradients beside it; going up (down) from there to the first gradient
    under the slope, the depth is interpolated at the slope over the points passed, in order of gradient. Where none is
    under it, the first middle (the last depth). CENTREBUOY isn't here: what is published of it doesn't determine its
    values.
    """
    dense = profile.select("feature", "t_ms", F.transform("p", lambda x: F.struct(x["z"].alias("z"), water_density(x["t"]).alias("rho"))).alias("p"))
    interval = F.zip_with(
        F.slice("p", 1, F.size("p") - 1),
        F.slice("p", 2, F.size("p") - 1),
        lambda a, b: F.struct(((b["rho"] - a["rho"]) / (b["z"] - a["z"])).alias("g"), ((a["z"] + b["z"]) / 2).alias("z"), a["z"].alias("above"), b["z"].alias("below"), a["rho"].alias("rho")),
    )
    steps = dense.select("feature", "t_ms", interval.alias("s"), F.element_at("p", -1)["z"].alias("deepest"))
    gradients = F.transform("s", lambda x: x["g"])
    k = F.array_position(gradients, F.array_max(gradients)).cast("int")
    peak = steps.withColumn("k", k)
    peak = peak.withColumns({"here": F.element_at("s", F.col("k")), "up": F.when(F.col("k") > 1, F.get("s", F.col("k") - 2)), "down": F.get("s", F.col("k"))})
    rise, fall = F.col("here.g") - F.col("up.g"), F.col("here.g") - F.col("down.g")
    upper = F.when(rise > 0, (F.col("here.above") - F.col("up.above")) / F.nullif(rise, F.lit(0.0)))
    lower = F.when(fall > 0, (F.col("here.below") - F.col("here.above")) / F.nullif(fall, F.lit(0.0)))
    weighted = (F.col("here.below") * lower + F.col("here.above") * upper) / (lower + upper)
    peak = peak.withColumn("thermo", F.coalesce(weighted, F.col("here.z")))
    beyond = F.col("thermo") >= F.col("here.z")
    other = F.when(beyond, F.col("down")).otherwise(F.col("up"))
    thermo_g = F.coalesce(F.col("here.g") + (other["g"] - F.col("here.g")) * (F.col("thermo") - F.col("here.z")) / F.nullif(other["z"] - F.col("here.z"), F.lit(0.0)), F.col("here.g"))
    middles = F.transform("s", lambda x: F.struct(x["g"].alias("g"), x["z"].alias("z")))
    peak = peak.withColumns({"m": middles, "thermo_g": thermo_g, "n_up": F.when(beyond, F.col("k")).otherwise(F.col("k") - 1)})

    def boundary(outwards: Column, default: Column) -> Column:
        place = F.array_position(F.transform(outwards, lambda x: x["g"] < slope), F.lit(True)).cast("int")
        passed = F.concat(F.array(F.struct(F.col("thermo_g").alias("g"), F.col("thermo").alias("z"))), F.slice(outwards, 1, place))
        return F.when(F.col("thermo_g") <= slope, F.col("thermo")).when(place > 0, _at_slope(passed, slope)).otherwise(default)

    top = boundary(F.reverse(F.slice("m", 1, F.col("n_up"))), F.col("m")[0]["z"])
    bottom = boundary(F.slice("m", F.col("n_up") + 1, F.size("m")), F.col("deepest"))
    named = {"BUOYFREQ": GRAVITY / F.col("here.rho") * F.col("here.g"), "THERMODEPTH": F.col("here.z"), "METADEPTHTOP": top, "METADEPTHBOTTOM": bottom}
    products = F.array(*(F.struct(F.lit(n).alias("product"), v.alias("value")) for n, v in named.items()))
    return peak.select("feature", "t_ms", F.explode(products).alias("o")).select("feature", "o.product", "t_ms", "o.value")


def feedback_lines(products: DataFrame) -> DataFrame:
    """Products as raw observations: feature,product,epoch ms,value."""
    return products.select(F.concat_ws(",", "feature", "product", F.col("t_ms").cast("string"), F.col("value").cast("string")).alias("line"))


def periodic(obs: DataFrame, hours: int) -> DataFrame:
    """Mean, least, greatest and number of values by series and period of whole hours."""
    size = hours * 3_600_000
    start = F.col("t_ms") - F.pmod("t_ms", F.lit(size))
    return obs.filter("value is not null").groupBy(*SERIES, start.alias("start_ms")).agg(F.avg("value").alias("mean"), F.min("value").alias("least"), F.max("value").alias("greatest"), F.count("value").alias("n"))
