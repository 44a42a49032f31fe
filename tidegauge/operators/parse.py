"""Text to typed records: observations, metadata records, outcomes; and the semantic stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import as_double, as_long, field, fields, utc
from tidegauge.functions.vocab import NOT_A_VALUE


def parse_raw(lines: DataFrame, sensor_map: DataFrame) -> DataFrame:
    """(seq, line) to seq, observation, observation_type, parse_ok, parse_message.

    site,sensor,epoch ms,value[,k=v::k=v]. A line that parses is rewritten with the ids that the registry has
    for its site and sensor. Of several faults, the message names the first in the order below.
    """
    p = fields(F.col("line"))
    n = F.size(p)
    cut = lines.select("seq", "line", p.alias("p"), n.alias("n"), field(p, 0).alias("site"), field(p, 1).alias("sensor"), field(p, 2).alias("t"), field(p, 3).alias("v"), field(p, 4).alias("extra"))
    known = sensor_map.withColumn("known", F.lit(True))
    joined = cut.join(known, ["site", "sensor"], "left")
    v, kind = F.col("v"), F.col("obs_type")
    whole = F.col("n").isin(4, 5) & ~F.exists("p", lambda x: x == "")
    value_ok = (v == NOT_A_VALUE) | (kind.isin("numeric", "count") & as_double(v).isNotNull()) | (kind == "category")
    extra_ok = F.col("extra").isNull() | F.forall(F.split("extra", "::"), lambda x: F.size(F.split(x, "=")) == 2)
    message = (
        F.when(~whole, "Malformed observation tuple.")
        .when(F.col("known").isNull(), "Registry lookup failed.")
        .when(as_long(F.col("t")).isNull(), "Incorrect time representation.")
        .when(~F.coalesce(value_ok, F.lit(False)), "Observation type from registry not matched.")
        .when(~extra_ok, "Metadata is not correctly formatted.")
        .otherwise("Parsed OK.")
    )
    ok = message == "Parsed OK."
    rewritten = F.concat_ws(",", "feature", "procedure", "observableproperty", "t", "v", "extra")
    return joined.select(
        "seq", F.when(ok, rewritten).otherwise(F.col("line")).alias("observation"), F.when(ok, kind).otherwise("Unknown").alias("observation_type"), ok.alias("parse_ok"), message.alias("parse_message")
    )


def parse_meta(lines: DataFrame) -> DataFrame:
    """(seq, line) to seq, feature, data_type, start_ms, end_ms, value, parse_ok, parse_message: feature,type,start,end,value.

    A record that fails keeps its text, with a mark at the end, in place of the feature.
    """
    p = fields(F.col("line"))
    start, end, value = as_long(field(p, 2)), as_long(field(p, 3)), field(p, 4)
    columns_ok = F.size(p) == 5
    message = (
        F.when(~columns_ok, "Parse failed.  Malformed CSV, missing columns.")
        .when(F.exists(p, lambda x: x == ""), "Parse failed.  Missing values, check all columns for values.")
        .when(start.isNull() | end.isNull(), "Parse failed.  Start and/or End time are malformed.")
        .when((value != NOT_A_VALUE) & as_double(value).isNull(), "Parse failed.  Value is not numeric or correct text value.")
        .otherwise("Parsed OK.")
    )
    ok = message == "Parsed OK."
    text = F.concat(F.when(columns_ok, F.concat_ws("::", p)).otherwise(F.concat("line", F.lit("::"))), F.lit(":endOfMalformedContents"))
    return lines.select(
        "seq",
        F.when(ok, field(p, 0)).otherwise(text).alias("feature"),
        F.when(ok, field(p, 1)).otherwise("unknown").alias("data_type"),
        F.when(ok, start).alias("start_ms"),
        F.when(ok, end).alias("end_ms"),
        F.when(ok, value).otherwise("unknown").alias("value"),
        ok.alias("parse_ok"),
        message.alias("parse_message"),
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What parsed, and what goes to quarantine."""
    return parsed.filter("parse_ok"), parsed.filter("not parse_ok")


def split_meta(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records with a value, records without one (identities), and what failed."""
    good, bad = split_parsed(parsed)
    return good.filter(F.col("value") != NOT_A_VALUE), good.filter(F.col("value") == NOT_A_VALUE), bad


def stamp(parsed: DataFrame, strict: bool = True) -> DataFrame:
    """Parsed observations to full records. strict: a category's missing value stays the text that marks it, else it is null."""
    p = fields(F.col("observation"))
    t, v = as_long(field(p, 3)), field(p, 4)
    category = F.when(F.col("observation_type") == "category", v if strict else F.when(v != NOT_A_VALUE, v))
    numeric = F.when(F.col("observation_type") != "category", F.when(v != NOT_A_VALUE, as_double(v)))
    pairs = F.split(field(p, 5), "::")
    # of repeated keys the last one counts
    own = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: F.split(y, "=")[0] == F.split(x, "=")[0]))
    parameters = F.map_from_entries(F.transform(own, lambda x: F.struct(F.split(x, "=")[0], F.split(x, "=")[1])))
    return parsed.filter("parse_ok").select(
        "seq",
        field(p, 0).alias("feature"),
        field(p, 1).alias("procedure"),
        field(p, 2).alias("observableproperty"),
        F.year(utc(t)).alias("year"),
        F.month(utc(t)).alias("month"),
        t.alias("t_ms"),
        t.alias("t_end_ms"),
        F.col("observation_type").alias("obs_type"),
        category.alias("category_value"),
        numeric.alias("value"),
        F.lit(0).alias("quality"),
        F.lit(0.0).alias("accuracy"),
        F.lit("Raw").alias("status"),
        F.lit("SemanticStamp").alias("processing"),
        F.lit(None).cast("string").alias("uncertml"),
        F.lit("").alias("comment"),
        F.lit(None).cast("string").alias("location"),
        F.when(field(p, 5).isNotNull(), parameters).alias("parameters"),
    )


OUTCOME_FIELDS = ["feature", "procedure", "observableproperty", "year", "month", "t_ms", "qualifier", "qualitative", "quantitative"]


def outcome_text(outcomes: DataFrame) -> DataFrame:
    """Outcomes as one text column, fields joined by `::`."""
    return outcomes.select(F.concat_ws("::", *(F.col(c).cast("string") for c in OUTCOME_FIELDS if c in outcomes.columns)).alias("line"))


def observation_text(obs: DataFrame) -> DataFrame:
    """Observations as one text column, fields joined by `::`; what is missing reads NA, a missing value as the mark for it."""
    value = F.when(F.col("obs_type") == "category", F.col("category_value")).otherwise(F.col("value").cast("string"))
    pairs = F.concat_ws(",", F.transform(F.map_entries("parameters"), lambda x: F.concat(x["key"], F.lit(" -> "), x["value"])))
    or_na = lambda c: F.coalesce(F.col(c), F.lit("NA"))
    texts = ["feature", "procedure", "observableproperty", F.col("year").cast("string"), F.col("month").cast("string"), F.col("t_ms").cast("string"), F.col("t_end_ms").cast("string"), F.coalesce(value, F.lit(NOT_A_VALUE))]
    texts += [F.col("quality").cast("string"), F.col("accuracy").cast("string"), "status", "processing", or_na("uncertml"), F.coalesce("comment", F.lit("")), or_na("location"), F.when(F.col("parameters").isNull(), "NA").otherwise(pairs)]
    return obs.select("seq", F.concat_ws("::", *texts).alias("line"))


def event_text(found: DataFrame) -> DataFrame:
    """Events as one text column, fields joined by commas."""
    return found.select(F.concat_ws(",", "feature", "procedure", "observableproperty", "event", F.col("start_ms").cast("string"), F.col("end_ms").cast("string")).alias("line"))


def parse_outcomes(lines: DataFrame) -> DataFrame:
    """The reverse; quantitative is null for eight fields."""
    p = F.split("line", "::")
    kinds = {"year": "int", "month": "int", "t_ms": "long", "quantitative": "double"}
    return lines.select(*(field(p, i).try_cast(kinds.get(c, "string")).alias(c) for i, c in enumerate(OUTCOME_FIELDS)))
