"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
_LOCAL_ROOTS: dict[str, str] = {}
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = 8_000


def get_session(app: str = "tallycart", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_in_parts(spark: SparkSession) -> None:
    """Let Spark generate no method beyond what the JVM compiles.

    The JVM only interprets a method of more than 8,000 bytes. A projection or aggregate over
    many columns makes a longer one, and then takes several times as long; below the
    limit Spark generates several short methods instead.
    """
    if int(spark.conf.get(METHOD_LIMIT, "65535")) > METHOD_BYTES:
        spark.conf.set(METHOD_LIMIT, str(METHOD_BYTES))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder. On a cluster such a folder would be visible to one machine only.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tallycart-")
    return _LOCAL_ROOTS[app]


def set_checkpoints(spark: SparkSession) -> None:
    """Let Spark's own checkpoints, as of boosted trees, go to the shared folder too."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


def drop_scratch(spark: SparkSession) -> None:
    """Delete the stored tables of this application. Frames that read them end with it."""
    folder = f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table and go on from the table.

    Used where a table is read twice (fit, then transform): the second read is a
    pruned columnar scan instead of a repeat of the joins, and a lost executor
    costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Driver calls that run at one time, each with its own jobs and cached rows.
AT_ONCE = 4


def at_once(
    spark: SparkSession, fn: Callable[..., T], calls: list[tuple], most: int = AT_ONCE
) -> list[T]:
    """Run independent driver calls in at most ``most`` threads, so that their jobs overlap."""
    if len(calls) < 2:
        return [fn(*args) for args in calls]
    run = inheritable_thread_target(spark)(fn)
    with ThreadPoolExecutor(min(most, len(calls))) as pool:
        return [f.result() for f in [pool.submit(run, *args) for args in calls]]


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage several tables at once: their short last stages overlap."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    stored = at_once(spark, stage, [(df, name) for name, df in tables.items()])
    return dict(zip(tables, stored))
