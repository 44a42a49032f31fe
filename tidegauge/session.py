"""What every job needs from its session: a shared scratch folder, and its own code on the executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()
_folders: dict[str, str] = {}
#: Bytes of a batch of rows that goes to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, however the driver came to import it, and batches of bounded size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if str(spark.conf.get(key)).rstrip("b") == str(64 << 20):  # Spark's default: nobody chose another
        spark.conf.set(key, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    target = os.path.join(tempfile.mkdtemp(), "tidegauge.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(os.path.join(_ROOT, "tidegauge")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, _ROOT))
    spark.sparkContext.addPyFile(target)


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir. Where that is unset, a local one, on one machine (tests); on a cluster that is an error."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not shared:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            shared = "file://" + tempfile.mkdtemp(prefix="tidegauge-")
        _folders[app] = f"{shared.rstrip('/')}/tidegauge-{app}"
        atexit.register(clear_scratch, spark)
    return _folders[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back, so that a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def drop(*tables: DataFrame | None) -> None:
    """Delete tables that materialise() returned, when all that was made of them is written."""
    for table in tables:
        path = getattr(table, "scratch_path", None)
        if path:
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most so many rows, which are counted; else as it is, for a join that shuffles. df: a written table of narrow rows."""
    return F.broadcast(df) if df.count() <= rows else df


def clear_scratch(spark: SparkSession) -> None:
    """Delete what materialise() has written; also runs when the driver exits."""
    folder = _folders.pop(spark.sparkContext.applicationId, None) if spark.sparkContext._jsc else None
    if folder is None:
        return
    try:
        _delete(spark, folder)
    except Exception:  # the JVM may be gone at exit; the folder then goes with the cluster's own clean-up
        pass
