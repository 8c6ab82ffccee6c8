"""Session helper and lineage cutting in the cluster's shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "siltworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators rely on; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset (tests, local mode)."""
    sc = spark.sparkContext
    set_to = sc._jsc.sc().getCheckpointDir()
    if set_to.isDefined():
        return set_to.get()
    conf = sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="siltworks-")
    sc.setCheckpointDir(conf)
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage cut, real sizes known to the planner."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _remove_stored() -> None:
    for spark, path in _written:
        try:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
            p = hadoop.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            return


atexit.register(_remove_stored)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, for row-wise Python work over an input that arrives as fewer splits than there are cores.

    Large inputs have more splits than cores and are left as they are, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 > cores else df.repartition(cores)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once, so that they find it wherever the driver was started."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="siltworks-code-"), "siltworks.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("siltworks", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
