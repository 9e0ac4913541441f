"""Sessions with the settings that the package's results rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Time zone and map semantics belong to the results; the others let Spark adapt to size and skew at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "millrace", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


BUILT: dict[tuple, object] = {}


def once(spark: SparkSession, source: str, name: str, build: Callable[[str], object]):
    """What build(path) makes from a source's files, kept for the application until one of them has another size or time."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listStatus(hadoop)
    state = tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))
    key = (spark.sparkContext.applicationId, source, name)
    if key not in BUILT or BUILT[key][0] != state:
        BUILT[key] = (state, build(work_path(spark, name)))
    return BUILT[key][1]
