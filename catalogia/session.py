"""Session settings and lineage cuts."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app="catalogia", master=None, **conf) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only where that is unset and the session runs locally (tests) is a temporary one chosen, once
    per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="catalogia-checkpoint-")
    return _local[context.applicationId]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder that the cluster names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder, so that its readers fetch only the columns they use."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
