"""Session helpers: a local session for tests, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "retentia", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A single-machine session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, for clusters and folders where it is not installed.

    The archive goes through Spark's own file distribution, once per session.
    """
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="retentia-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: what ``spark.checkpoint.dir`` names.

    Only a local session without that setting falls back to a temporary folder; on a cluster a
    machine-local path would be lost with its machine, so the missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="retentia-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder by whatever file system its path names; a missing one is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables below the shared folder; frames that still read them fail from then on."""
    for name in ("retentia", "retentia-llm"):
        delete_path(spark, f"{shared_dir(spark)}/{name}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/retentia/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: for a result that several readers share.

    Runs one job. The readers start from files, so neither a lost executor nor a second reader runs the
    steps before it again, and the table's real size is known when joins are planned.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
