"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "annoflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the library relies on.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as given.  Only when it is unset (local runs, tests) a private folder is
    created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="annoflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


#: Rows of a stored file.  Readers pack files into tasks by bytes and a charge for each file, and compressed bytes say little of
#: the rows: with few rows a file, a task gets a bounded number of them however well they compress.
FILE_ROWS = 10_000


#: Shuffle files go when the action that wrote them ends.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A block whose stored frames go when it ends: disk holds what is in use, not all that was ever stored.

    :func:`stage` stores into the innermost block of its thread, :meth:`stage` into this one, :meth:`leave` into the one around it;
    outside of all, frames stay until the driver ends.  In a block shuffle files go with their action, not when the driver collects its garbage; an action on the same
    frame writes them again.
    """

    _open = threading.local()

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    @classmethod
    def blocks(cls) -> list[Scratch]:
        if not hasattr(cls._open, "blocks"):
            cls._open.blocks = []
        return cls._open.blocks

    def __enter__(self) -> Scratch:
        self._cleanup = self._spark.conf.get(_SHUFFLE_CLEANUP, None)
        self._spark.conf.set(_SHUFFLE_CLEANUP, "true")
        self.blocks().append(self)
        return self

    def __exit__(self, *error) -> None:
        self.blocks().remove(self)
        conf = self._spark.conf
        conf.unset(_SHUFFLE_CLEANUP) if self._cleanup is None else conf.set(_SHUFFLE_CLEANUP, self._cleanup)
        for path in self._paths:
            hadoop = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            fs = hadoop.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(hadoop, True)
            fs.cancelDeleteOnExit(hadoop)

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """As :func:`stage`, kept until this block ends."""
        path = shared_folder(df.sparkSession, label)
        self._paths.append(path)
        return _stored(df, path)

    def leave(self, df: DataFrame, label: str) -> DataFrame:
        """As :func:`stage`, for the block around this one."""
        outside = self.blocks()[:self.blocks().index(self)]
        return outside[-1].stage(df, label) if outside else _stored(df, shared_folder(df.sparkSession, label))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once, however often it is read, and
    readers take only the columns they need.  A lost executor repeats nothing that lies before it."""
    blocks = Scratch.blocks()
    return blocks[-1].stage(df, label) if blocks else _stored(df, shared_folder(df.sparkSession, label))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
