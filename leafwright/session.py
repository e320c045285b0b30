"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "leafwright", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so that no worker needs it on its path.

    The archive lies in the shared folder, where every executor can fetch it at any time.
    """
    sc = spark.sparkContext
    if getattr(sc, "_leafwright_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, files in os.walk(home):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(home)))
    to = f"{shared_dir(spark, 'package')}/leafwright_package.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(to)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(to)
    sc._leafwright_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that all executors see, deleted when the driver's process ends.

    It lies under ``spark.checkpoint.dir``, or where the session's checkpoint folder was set. Only a local master
    without that setting gets a temporary folder; on a cluster, whose executors would each write to a folder of
    their own machine, it is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="leafwright-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not _FOLDERS:
        atexit.register(_clear)
    _FOLDERS.append((spark, path))
    return path


_FOLDERS: list[tuple[SparkSession, str]] = []


def _clear() -> None:
    """Delete the folders of this process whose session still runs; what remains is the cluster's to clean up."""
    for spark, path in _FOLDERS:
        try:
            delete(spark, path)
        except Exception:  # the session has been stopped, and with it the way to its file system
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def through_disk(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back, so later uses neither recompute nor depend on executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_tag(spark: SparkSession, folder: str, tag: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result kept under a tag: read if it was written whole before, else made, written and read.

    A write that broke off has no success mark and is made again.
    """
    path = f"{folder.rstrip('/')}/{tag}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
