"""Session settings, shared scratch space and plan-size estimates."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for; applied by ``build_session`` only.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even if that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}

# temporary scratch folders of local-mode sessions, by application
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app_name: str = "sparkmart", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the session's ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a temporary folder; on a cluster an
    unset folder is an error, because executors could not see a driver-local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="sparkmart-")
    return _LOCAL_ROOTS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the scratch root, removed when the application ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    return path


_SCOPE = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders that this thread makes inside, as soon as it leaves: for steps of an endless run.

    What is built inside must have been written or read to the end by then.
    """
    outer, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        for path in _SCOPE.paths:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
        _SCOPE.paths = outer


def side_by_side(*actions: Callable) -> list:
    """What the actions return; they run at the same time, at most four, and their scratch folders belong to the scope of the caller."""
    paths = getattr(_SCOPE, "paths", None)

    def run(action: Callable):
        _SCOPE.paths = paths
        return action()

    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(run, actions))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's own size estimate of a plan; ``None`` if the session does not expose it."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate to the shared scratch folder and go on from there.

    For a result that several branches of a later plan read: they then scan it (only the columns
    they need) instead of computing it again, and a lost executor costs no recomputation.
    """
    path = f"{scratch_dir(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
