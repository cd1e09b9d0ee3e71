"""SparkSession construction and the shared checkpoint location.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
file system path the cluster names). Only when it is unset -- local tests and
benchmarks -- do we fall back to a fresh folder of our own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "kgspark") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KGSPARK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers as a zip, once per application: they may run on machines that do not
    have the driver's folders."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="kgspark-package-"), "kgspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a private one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Local runs only: the cluster always provides spark.checkpoint.dir.
        conf_dir = tempfile.mkdtemp(prefix="kgspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


#: Bytes of a row in memory for a byte of it in the files of ``cut_lineage``, about: ids that are close or repeat take one
#: to six bytes there, and 40 to 80 with their row in a join.
FILE_FACTOR = 12


@contextmanager
def real_sizes(spark: SparkSession):
    """Queries that run inside judge tables by their size in memory: a table whose files are under the limit of broadcasts
    is many times as large on the driver, which builds what is sent."""
    key = "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(max(float(before), FILE_FACTOR)))
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing reads any more: it does when the driver's JVM collects their handles,
    which by itself may come much later than the end of a step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Survives executor loss like a reliable checkpoint, and -- unlike
    ``Dataset.checkpoint`` -- the re-read plan carries real file-size statistics, so
    loops do not inherit compounding size estimates and broadcast decisions stay
    based on measured sizes. Never a local checkpoint.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/kgspark-tables/{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    with real_sizes(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    found._kgspark_path = path
    return found


class Scope:
    """Tables that ``cut_lineage`` wrote during a call (see ``table_scope``)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def _delete(self, path: str) -> None:
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)

    def drop(self, table: DataFrame) -> None:
        """Delete a table that nothing reads any more, such as the state before the last round."""
        path = getattr(table, "_kgspark_path", None)
        if path in self.paths:
            self.paths.remove(path)
            self._delete(path)

    def keep(self, table: DataFrame) -> DataFrame:
        """Hand a table on to the caller (and to the caller's scope)."""
        path = getattr(table, "_kgspark_path", None)
        if path in self.paths:
            self.paths.remove(path)
            outer = _SCOPES[_SCOPES.index(self) - 1] if _SCOPES.index(self) else None
            if outer is not None:
                outer.paths.append(path)
        return table

    def close(self) -> None:
        for path in self.paths:
            self._delete(path)


_SCOPES: list[Scope] = []


@contextmanager
def table_scope(spark: SparkSession):
    """Tables that ``cut_lineage`` writes inside are deleted at the end, but for those that are kept.

    What is kept is a whole table in the shared folder, so a lost executor never needs a deleted one."""
    scope = Scope(spark)
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        scope.close()
        _SCOPES.remove(scope)
