"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def build_session(app: str = "starloom", **conf: str) -> SparkSession:
    """A session with the settings the library counts on; ``conf`` overrides them.

    Nothing here sizes the cluster: master, memory and ``spark.checkpoint.dir`` come from spark-submit.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Unset is accepted in local mode only, where one temporary folder serves the whole application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="starloom-")
    return _local_root[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; it does not exist yet."""
    return f"{shared_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage, keeps the columns prunable, and fixes values such as partition ids that a recomputed
    plan could assign differently.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
