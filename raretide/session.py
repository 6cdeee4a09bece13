"""Session helpers.

Library code never creates its own session; it takes the caller's.  ``get_spark`` is for tests, the
bench and the command line.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session (the
shared folder a cluster names) and only sets a scratch folder when it is unset on a local master, as in tests.
``written`` cuts lineage with a table in that folder.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "raretide") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("RARETIDE_SESSION_TZ", "UTC"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RARETIDE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir`` or the context's checkpoint folder).

    Only a local master, where driver and executors are one process, gets a scratch folder if neither is set; on a
    cluster a machine-local folder would lose data, so that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="raretide-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder; the driver removes it when it ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/raretide-{uuid.uuid4().hex}-{name}"
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(hadoop).deleteOnExit(folder)
    return path


# Parquet without dictionaries, for tables of many doubles that seldom repeat: looking each one up takes most of the time of writing them.
PLAIN = {"parquet.enable.dictionary": "false"}


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet (``options`` of the writer) in the shared folder and read it back: lineage ends there, a lost executor costs
    nothing but a second read, and readers prune columns."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
