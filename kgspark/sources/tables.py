"""Table layer (S2-S10): one folder per table under a base path, with committed versions.

Reads are lazy DataFrames (column pruning and predicates reach the Parquet scan); nothing is collected. A write puts
its rows into a new version folder and commits it last by creating one empty file in the table's ``_versions`` folder,
named ``<number>-<o or a>-<id>``; creating a file is atomic on any file system, and nothing is renamed. A table is its
last version that overwrites (``o``) and those appended (``a``) after it. So a step may overwrite a table that it reads
(Q10), a job or driver lost at any point leaves the old version or the new one, and a reader that has begun keeps its
files: the versions before the last overwrite are deleted only by the overwrite after it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import real_sizes


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there. A storage error is not an absent path: it raises."""
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project/cast to a schema; a missing column becomes a typed NULL."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


class TableStore:
    """Named tables under ``base_path`` (the reference's intermediate dataset)."""

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base_path = base_path.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base_path}/{name}"

    def _committed(self, name: str) -> list[str]:
        """Names of all committed versions, oldest first."""
        fs, marks = _fs(self.spark, self.path(name) + "/_versions")
        if not fs.exists(marks):
            return []
        return sorted(f.getPath().getName() for f in fs.listStatus(marks))

    @staticmethod
    def _current(versions: list[str]) -> list[str]:
        """The versions that make up the table now."""
        last = max((i for i, v in enumerate(versions) if v.split("-")[1] == "o"), default=0)
        return versions[last:]

    # S5
    def exists(self, name: str) -> bool:
        return bool(self._committed(name))

    # S2 / S3 / S4
    def read(self, name: str, columns: list[str] | None = None, where: str | None = None,
             schema: T.StructType | None = None) -> DataFrame:
        versions = self._current(self._committed(name))
        if not versions:
            if schema is None:
                raise FileNotFoundError(f"table {name} does not exist and no schema given")
            df = self.spark.createDataFrame([], schema)
        else:
            df = self.spark.read.parquet(*[f"{self.path(name)}/{v}" for v in versions])
        if where:
            df = df.where(where)
        if columns:
            df = df.select(*columns)
        return df

    # S6 / S7
    def write(self, df: DataFrame, name: str, schema: T.StructType | None = None,
              mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
        if schema is not None:
            df = conform(df, schema)
        version = self.stage(df, name, mode, partition_by)
        self.publish(name, version)
        return f"{self.path(name)}/{version}"

    def stage(self, df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
        """Write the rows of a version that no reader sees before it is published."""
        before = self._committed(name)
        number = int(before[-1].split("-")[0]) + 1 if before else 1
        version = f"{number:08d}-{'a' if mode == 'append' else 'o'}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("errorifexists").option("compression", "zstd")
        with real_sizes(self.spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path(name)}/{version}")
        return version

    def staged(self, name: str, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(name)}/{version}")

    def publish(self, name: str, version: str) -> None:
        before = self._committed(name)
        self._commit(name, version)
        if version.split("-")[1] != "a":
            self._forget(name, before[:len(before) - len(self._current(before))])

    def _commit(self, name: str, version: str) -> None:
        fs, mark = _fs(self.spark, f"{self.path(name)}/_versions/{version}")
        fs.create(mark, False).close()

    def _forget(self, name: str, versions: list[str]) -> None:
        """Delete versions that were superseded before the last one: the mark first, so none is read in part; and
        what writes that were cut off before them left."""
        for v in versions:
            fs, mark = _fs(self.spark, f"{self.path(name)}/_versions/{v}")
            fs.delete(mark, False)
        known = set(self._committed(name))
        fs, folder = _fs(self.spark, self.path(name))
        oldest = min(known)
        for f in fs.listStatus(folder):
            v = f.getPath().getName()
            if v != "_versions" and v not in known and v < oldest:
                fs.delete(f.getPath(), True)

    def drop(self, name: str) -> None:
        """Delete a table that is only handed from one job to the next."""
        fs, folder = _fs(self.spark, self.path(name))
        fs.delete(folder, True)

    def append(self, df: DataFrame, name: str, schema: T.StructType | None = None) -> str:
        return self.write(df, name, schema, mode="append")

    # S8
    def sql(self, query: str, tables: list[str]) -> DataFrame:
        for t in tables:
            self.read(t).createOrReplaceTempView(t)
        return self.spark.sql(query)

    # S9
    def row_count(self, name: str) -> DataFrame:
        """One-row DataFrame ``cnt`` (an aggregate, not a driver loop)."""
        return self.read(name).agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))

    # S10
    def write_request_table(self, df: DataFrame, name: str, key_cols: list[str]) -> str:
        out = df.select(*[F.col(k).cast("string").alias(k) for k in key_cols],
                        F.col("request").cast("string").alias("request"))
        return self.write(out, name)
