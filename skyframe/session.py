"""Session construction and the shared scratch folder.

Every job in the package runs on a plain ``SparkSession``. The settings
below are the ones the operators rely on: UTC session time (all epoch and
stamp arithmetic assumes it), ANSI mode (Spark 4 default) and adaptive
query execution so partition counts and skewed joins are re-planned at
run time instead of being hand-tuned per scale factor.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles a method of more bytes, it would be interpreted for every row
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "skyframe", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the SQL settings the operators assume to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, BASE_CONF[k])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster and points at
    shared storage; we only read it, and refuse to go on without it: a
    folder of this machine would not be seen by the executors. On a local
    master (tests) a fresh folder is created once and registered.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="skyframe-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder; a
    ``lasting`` one outlives ``scratch_scope``."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    (_SCRATCH if lasting else getattr(_SCOPE, "paths", _SCRATCH)).append(path)
    return path


_SCRATCH: list[str] = []
_SCOPE = threading.local()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its plan runs once,
    however many branches and retries read it afterwards."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, paths: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder whose table nothing reads any more."""
    _drop(spark, [path])


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder handed out so far (results read from
    them must be consumed or written elsewhere first); the number deleted.
    Long sessions call it between jobs; a cluster's checkpoint folder is
    otherwise cleaned with the application."""
    return _drop(spark, _SCRATCH)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes the scratch folders that this thread was handed out inside the
    block. For jobs whose result is written elsewhere before the block ends."""
    outer, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        _drop(spark, _SCOPE.paths)
        if outer is None:
            del _SCOPE.paths
        else:
            _SCOPE.paths = outer
