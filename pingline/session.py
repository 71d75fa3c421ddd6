"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # par_hour=04 must stay the text "04"
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a rerun of one period replaces that period only
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # only matters for small shuffles: keep the cores busy when each task
    # writes many small period folders
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # one key may hold a third of the rows: let AQE split its partition, even
    # where that costs one more exchange further up
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# can only be chosen when the session is built
STATIC_CONF = {
    # recording the Python call site of every column costs more than planning the query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings the operators rely on into a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "pingline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_ROOTS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``, or below the
    warehouse, which executors share too, where that is unset. The application's folder is
    deleted when its JVM ends, as lazy results may read from it until then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    mine = f"{root.rstrip('/')}/pingline/{spark.sparkContext.applicationId}"
    if mine not in _ROOTS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(mine)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _ROOTS.add(mine)
    return f"{mine}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once however often it
    is used, and safe when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
