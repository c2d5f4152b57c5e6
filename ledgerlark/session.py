"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Streaming state on disk with incremental checkpoints, not on the heap; keyed state works with no other store.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes; wide projections are faster unfused than interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    **STATE_CONF,
}


def build_session(app_name: str = "ledgerlark", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with ``conf`` inside the block, as it was afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local master may run without the setting; then a folder on this machine is as good. On a
    cluster the setting is required, since a machine-local folder would lose data with its executor.
    """
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getConf().get("spark.checkpoint.dir")
              or spark.sparkContext.getCheckpointDir())
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside the block are dropped at its end, but for those written with ``keep``.

    Only for blocks whose result no longer reads them: one that is written itself, or values on the driver.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.pop()
        jvm = spark.sparkContext._jvm
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and survives executors.

    ``keep`` leaves the table to the scope around the innermost one.
    """
    path = scratch_path(df.sparkSession, name)
    scopes = _open_scopes[:-1] if keep else _open_scopes
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
