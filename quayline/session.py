"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job runs with. The time zone is semantic (it decides which day a timestamp falls on), so it is a
#: parameter of ``build_session``. Shuffle partitions start high and are merged by adaptive execution, which also
#: splits skewed join partitions, even where that costs one more shuffle above the join.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.files.openCostInBytes": str(4 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

_scratch: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, time_zone: str = "UTC",
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` wins over them. Without ``master`` the submit command decides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.sql.session.timeZone": time_zone, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder stands in only for a local session that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _scratch:
        _scratch[context.applicationId] = tempfile.mkdtemp(prefix="quayline-")
    return _scratch[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/quayline-{uuid.uuid4().hex}/{name}"


# What the DataFrame API does not offer is asked for here, and nowhere else.


def finished_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders of a glob pattern that carry Spark's success marker; raises where markers are switched off."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    if not conf.getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True):
        raise RuntimeError("tables need mapreduce.fileoutputcommitter.marksuccessfuljobs, which is off")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    return [f.getPath().getParent().toString() for f in path.getFileSystem(conf).globStatus(path) or []]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate is below its own broadcast threshold; yes where no planner can be asked."""
    if not hasattr(df, "_jdf"):
        return True
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= int(conf.autoBroadcastJoinThreshold())


def stream_id(batch: DataFrame) -> str | None:
    """The id of the streaming query whose batch this is; it belongs to the checkpoint and outlives restarts."""
    return batch.sparkSession._jsparkSession.sparkContext().getLocalProperty("sql.streaming.queryId")
