"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import pickle
import re
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Settings the operators need for right results or for the intended plans.
# All of them can be changed on a running session.
RUNTIME_SETTINGS = {
    # Files that Spark measures are compressed; rows in memory are several times as large.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Stamps are stored and compared in UTC; local time is always derived.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (series, chunk, ts) may keep rows that are already laid out by
    # (series, chunk), so the windows before and after need no new exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

# Only read when a session starts: no call-site lookup for every column expression.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    Functions sent to Python workers carry their code, so executors need no
    installed copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules["meterloom"])
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "meterloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session and apply the runtime settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


class Shared:
    """A broadcast that carries the code of its classes too, as executors have no copy of this package."""

    def __init__(self, spark: SparkSession, value):
        cloudpickle.register_pickle_by_value(sys.modules["meterloom"])
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._sent.value)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` if the cluster names one.

    Only in a session on one machine, where nothing is set, a new temporary folder is made;
    it goes when Python ends.  On a cluster an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meterloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def stage_folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def clear_stages(spark: SparkSession) -> None:
    """Delete all staged tables of this application; results that read them are no longer valid."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives later joins true sizes.
    All tables of an application share one folder; see :func:`clear_stages`.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
