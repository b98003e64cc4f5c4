"""Model versions, aliases and runs as append-only tables; the latest row wins.

Several writers may work at once. A writer claims a number by creating a file that must not exist yet: of two that try the same
number one succeeds and the other takes the next. Each row is a commit of its own, a folder that no other writer
touches. A writer that dies between claim and commit leaves a number without a row, never a number with two.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from pathlib import Path
from urllib.parse import quote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHAMPION = "champion"
VERSIONS_SCHEMA = "model_name string, version bigint, run_id string, path string, created_at timestamp"
ALIASES_SCHEMA = "model_name string, alias string, version bigint, step bigint, moved_at timestamp"
RUNS_SCHEMA = "run_id string, experiment string, run_name string, params map<string,string>, metrics map<string,double>, logged_at timestamp"


def latest_versions(versions: DataFrame, name: str = "model_name", version: str = "version") -> DataFrame:
    """(name, latest): the highest version as a number, so that 10 comes after 9."""
    return versions.groupBy(name).agg(F.max(F.col(version).cast("bigint")).alias("latest"))


def alias_targets(aliases: DataFrame, alias: str = CHAMPION, name: str = "model_name", step: str = "step") -> DataFrame:
    """(name, version) the alias points to now. A name without the alias has no row."""
    moved = aliases.where(F.col("alias") == alias)
    return moved.groupBy(name).agg(F.max_by("version", step).alias("version"))


class Registry:
    """The three tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, name: str, rows: list[tuple], schema: str, stamp: str) -> None:
        columns = [c for c in schema.split(", ") if not c.startswith(f"{stamp} ")]
        df = self.spark.createDataFrame(rows, ", ".join(columns)).withColumn(stamp, F.current_timestamp())
        df.coalesce(1).write.parquet(f"{self.folder}/{name}/{uuid.uuid4().hex}")

    def _claim(self, kind: str, name: str, number: int) -> int:
        """The first number from ``number`` on that no writer has claimed, claimed."""
        while not self._create(f"{self.folder}/claims/{kind}/{quote(name, safe='')}/{number}"):
            number += 1
        return number

    def _create(self, path: str) -> bool:
        """Create an empty file; False if it is there already. The file system decides between writers."""
        parts = urlparse(path)
        if parts.scheme in ("", "file"):
            file = Path(parts.path)
            file.parent.mkdir(parents=True, exist_ok=True)
            try:
                file.touch(exist_ok=False)
            except FileExistsError:
                return False
            return True
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            files.create(at, False).close()
        except Py4JJavaError:
            if not files.exists(at):
                raise
            return False
        return True

    def versions(self) -> DataFrame:
        return self._table("versions", VERSIONS_SCHEMA)

    def aliases(self) -> DataFrame:
        return self._table("aliases", ALIASES_SCHEMA)

    def runs(self) -> DataFrame:
        return self._table("runs", RUNS_SCHEMA)

    def register(self, model: str, run_id: str, path: str) -> int:
        version = self._claim("versions", model, (self.latest(model) or 0) + 1)
        self._append("versions", [(model, version, run_id, path)], VERSIONS_SCHEMA, "created_at")
        return version

    def latest(self, model: str) -> int | None:
        row = latest_versions(self.versions().where(F.col("model_name") == model)).first()
        return row["latest"] if row else None

    def champion(self, model: str, alias: str = CHAMPION) -> int | None:
        """The version the alias names, or None before the first promotion."""
        row = alias_targets(self.aliases().where(F.col("model_name") == model), alias).first()
        return row["version"] if row else None

    def version_path(self, model: str, version: int) -> str:
        row = self.versions().where((F.col("model_name") == model) & (F.col("version") == version)).first()
        if row is None:
            raise LookupError(f"{model} has no version {version}")
        return row["path"]

    def promote(self, model: str, version: int, alias: str = CHAMPION) -> None:
        last = self.aliases().where((F.col("model_name") == model) & (F.col("alias") == alias)).agg(F.max("step")).first()[0]
        step = self._claim("aliases", f"{model}/{alias}", (last or 0) + 1)
        self._append("aliases", [(model, alias, version, step)], ALIASES_SCHEMA, "moved_at")

    def log_run(self, experiment: str, run_name: str, params: Mapping[str, object], metrics: Mapping[str, float | None]) -> str:
        run_id = uuid.uuid4().hex
        row = (
            run_id,
            experiment,
            run_name,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None},
        )
        self._append("runs", [row], RUNS_SCHEMA, "logged_at")
        return run_id
