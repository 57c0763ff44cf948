"""Spark session settings used by the engine."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job relies on: UTC wall clock, ANSI casts (errors surface, try_* functions handle
# bad input explicitly), adaptive execution for shuffle sizing / skew, dynamic partition overwrite
# for partition-scoped snapshot replacement.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide report schemas and the pricing chain generate Java methods above HotSpot's 8000-byte
    # JIT limit; without this flag those run interpreted. (Cluster admins' options stay in
    # spark.{driver,executor}.defaultJavaOptions, which Spark prepends.)
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, app: str = "adspark", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is always read from the
    session. Only when it is unset in local mode (tests) a private scratch folder is created; on a
    cluster a machine-local folder would lose data, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="adspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "adspark", name)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session's settings changed inside the block, then as before."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_released(spark: SparkSession):
    """A block whose queries give back their shuffle files when they end. Otherwise these stay until the
    driver collects garbage, so a job of many steps holds the files of all of them at once."""
    return session_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def kept_table(df: DataFrame, name: str = "plan") -> DataFrame:
    """``df`` written once to a Parquet table in the shared checkpoint folder: it cuts the lineage, and a
    step that needs some columns reads only these. Columns without a type are left out and put back."""
    spark, void = df.sparkSession, [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    stored = df.drop(*void)
    with shuffles_released(spark):
        stored.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(stored.schema).parquet(path)
    return found.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns])
