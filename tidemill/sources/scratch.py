"""What driver and executors share: a folder for what a query writes and reads again, and this package."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in spark.checkpoint.dir. Where that is unset a folder of our own will do on a single machine, and a cluster is an error."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemill-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidemill/{uuid.uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete paths through Spark's own file systems."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def send(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemill_sent", False):
        return
    root = Path(__file__).resolve().parents[2]
    name = f"{tempfile.mkdtemp(prefix='tidemill-')}/tidemill_package.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted((root / "tidemill").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(name)
    sc._tidemill_sent = True
