"""Session set-up: the settings the library relies on, and the package itself on every executor."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_OWN: dict[str, str] = {}

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one of our own only on a single machine that names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="spark-stage-")
    return _OWN[app]


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in the shared folder and read back, so that it is made once and a lost executor costs a re-read."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_mark(spark: SparkSession, path: str) -> str | None:
    """Names, sizes and times of the files at a path, as one text; none if there is nothing."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return None
    return "|".join(sorted(f"{x.getPath()},{x.getLen()},{x.getModificationTime()}" for x in system.listStatus(place)))


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, once an application, so that workers can import its functions.

    Arrow batches end at 4 MB unless the session says otherwise, so that 10,000 long texts aren't held at once on both sides.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, "4m")
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="spark-ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*")):
                if path.suffix in (".py", ".csv", ".json") and "__pycache__" not in path.parts:
                    out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
    return spark
