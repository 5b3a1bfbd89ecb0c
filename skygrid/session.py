"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import skygrid

# The few Python functions run by tasks travel with the job, so that executors need no copy of this
# package.
cloudpickle.register_pickle_by_value(skygrid)

#: Runtime settings every job relies on. All can be changed on a live session.
RUNTIME_CONF = {
    # Forecast times are wall-clock values without a zone; UTC keeps them as they are.
    "spark.sql.session.timeZone": "UTC",
    # Writing one snapshot must replace that snapshot only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Times without a zone are read as timestamps, so that no cast stands between a filter and the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Jobs end in written tables, so shuffle files are of no use once a query has run; a query run again
    # finds them missing and shuffles once more.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skygrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


#: Own folders of sessions that name none, by application id.
_OWN_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or one set on the context.

    Only a local master, whose tasks run in this very process, may do with a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = context.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="skygrid-")
        root = _OWN_ROOTS[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
