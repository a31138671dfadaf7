"""Session helpers: building a session, the shared scratch folder, conf overrides."""
from __future__ import annotations

import contextlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "starforge", **conf: str) -> SparkSession:
    """Session with the settings this library assumes (UTC, AQE on, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set (HDFS/S3/ABFS...). Only when it is
    unset (local tests) do we create one under the local temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(HDFS, S3, ABFS...); dimension keys are checkpointed there")
        configured = tempfile.mkdtemp(prefix="starforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/starforge/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's application, once.

    Workers import its modules by name; without this they find them only where the package is installed or
    on their path.  The archive is written to the shared scratch folder, from which Spark hands it out.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join("starforge", os.path.relpath(path, root)))
    fs, target = hadoop_fs(spark, f"{scratch_path(spark, 'package')}/starforge.zip")
    stream = fs.create(target, False)
    stream.write(bytearray(buffer.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(str(fs.makeQualified(target).toString()))
    _SHIPPED.add(app)


@contextlib.contextmanager
def conf_override(spark: SparkSession, values: dict[str, str]):
    """Temporarily set session confs (restored afterwards)."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path`` (works for file:, hdfs:, s3a: ...)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath
