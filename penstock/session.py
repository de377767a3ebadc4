"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Partition counts stay with AQE: it
# coalesces small shuffle partitions and splits skewed ones, so nothing here
# fixes a number that would be wrong at another data size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on (time zone) or plans rely on (AQE)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(name: str, cores: str | int = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Noting the call site of every column expression costs more than small queries run.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def conf(spark: SparkSession, settings: Mapping[str, str | int]) -> Iterator[None]:
    """Runtime settings for the jobs started inside; the former values return afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on
    a cluster a missing setting is an error, because a machine-local folder
    would not survive (or even be seen by) the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="penstock-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_swept: set[str] = set()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared root; every run gets its own.

    All folders of an application lie below one of its own, which is removed
    when the Python process that made them ends while the session still lives.
    """
    application = spark.sparkContext.applicationId
    mine = f"{shared_root(spark)}/penstock-{application}"
    if application not in _swept:
        _swept.add(application)
        atexit.register(_sweep, spark, mine)
    return f"{mine}/{purpose}-{uuid.uuid4().hex}"


def _sweep(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        from penstock.sources import folders
        folders.remove(spark, path)
