"""The few folder calls upkeep needs, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DONE_MARK = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system named, for readers outside the JVM."""
    system, at = _open(spark, path)
    return system.makeQualified(at).toString()


def child_folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    system, at = _open(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def make(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it."""
    system, at = _open(spark, path)
    system.mkdirs(at)


def is_done(spark: SparkSession, path: str) -> bool:
    """A job finished writing this folder."""
    system, at = _open(spark, f"{path}/{DONE_MARK}")
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder and all below it."""
    system, at = _open(spark, path)
    return system.delete(at, True)


def newest_version(spark: SparkSession, path: str) -> int:
    """The highest finished ``version=N`` folder, -1 if there is none."""
    done = [int(name.removeprefix("version=")) for name in child_folders(spark, path, "version=")
            if is_done(spark, f"{path}/{name}")]
    return max(done, default=-1)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The table a path holds now."""
    return spark.read.parquet(f"{path}/version={newest_version(spark, path)}")


def write_next(df: DataFrame, path: str) -> int:
    """Replace the table a path holds: readers of the present version are not disturbed, also when ``df`` is one."""
    version = newest_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version
