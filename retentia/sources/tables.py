"""The parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fingerprint(spark: SparkSession, folder: str, names: tuple[str, ...]) -> str:
    """Sizes and times of the tables' files: another text whenever one of them was written anew."""
    out = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        out += sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files)
    return "|".join(out)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
