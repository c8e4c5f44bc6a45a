"""Spark session settings, the shared folder of a cluster, and tables cut from their lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loomwork")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master may go without that setting; it then gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors, once in a session, so that they need no installation.

    The archive is written to the shared folder. Where that is no file system of the driver, the package has to be
    installed, or given with ``--py-files``.
    """
    sc = spark.sparkContext
    folder = shared_folder(spark)
    if sc.applicationId in _shipped or not folder.startswith(("file:", "/")):
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    archive = Path("/" + folder.removeprefix("file:").lstrip("/")) / f"code-{uuid.uuid4().hex}" / f"{root.name}.zip"
    archive.parent.mkdir(parents=True)
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """The rows of ``df`` as a table written to the shared folder.

    They are computed once, a lost executor costs no rework, and later plans know the table's size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, name: str = "cut") -> tuple[DataFrame, int]:
    """The same, with the number of its rows, which the tasks that write them count."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get.get("n", 0)


def wide(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by hash of ``keys`` in as many partitions as shuffles have.

    For rows that are few bytes but much work, which adaptive execution would gather in one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
