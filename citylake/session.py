"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Every instant in the data model is UTC; local wall clocks are TIMESTAMP_NTZ.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# City tables take a hundred times their size in files when their rows are sorted: a scan task reads so much at most.
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def bound_scans(spark: SparkSession) -> SparkSession:
    """Scan tasks of SPLIT_BYTES of files at most, so that what a task sorts does not grow with the table.

    By itself Spark packs files up to a core's share of a table. Smaller splits that a session asks for stay.
    """
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLIT)) > SPLIT_BYTES:
        spark.conf.set(SPLIT, str(SPLIT_BYTES))
    return spark


def build_session(app_name: str = "citylake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the runtime settings; `conf` keys use `__` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, "spark.ui.enabled": "false"}.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return bound_scans(configure(builder.getOrCreate()))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: `spark.checkpoint.dir`; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="citylake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scratch: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application below the shared one; it is removed when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/citylake-{spark.sparkContext.applicationId}"
    if folder not in _scratch:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(place)
        files.deleteOnExit(place)
        _scratch.add(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path for intermediate rows that nothing else uses; it lasts as long as the application."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
