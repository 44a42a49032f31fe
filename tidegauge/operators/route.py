"""Where observations go next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.vocab import SERIES


def inject_routes(obs: DataFrame, route: DataFrame) -> DataFrame:
    """Adds routes, an array of (job, model, key); observations with none go."""
    listed = route.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct("job", "model", "key"))).alias("routes"))
    return obs.join(listed, SERIES)


def for_job(obs: DataFrame, route: DataFrame, job: str, model: str | None = None) -> DataFrame:
    """Observations that some route sends to the job (and model)."""
    own = route.filter((F.col("job") == job) if model is None else (F.col("job") == job) & (F.col("model") == model))
    return obs.join(own.select(*SERIES).distinct(), SERIES, "left_semi")
