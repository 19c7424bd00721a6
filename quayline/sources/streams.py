"""Message streams: one text column ``value`` (and ``partition`` and ``offset`` from a topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: how many messages of a topic one batch takes at most.
MAX_OFFSETS_PER_TRIGGER = 100_000


def topic_stream(spark: SparkSession, servers: str, topic: str, select: str = "CAST(value AS STRING) AS value",
                 max_offsets: int = MAX_OFFSETS_PER_TRIGGER, tasks: int | None = None, **options: str) -> DataFrame:
    """A topic as a stream; needs the Kafka connector on the class path.

    A batch is read by ``tasks`` tasks (by default as many as run at a time), however few partitions the topic has.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("maxOffsetsPerTrigger", str(max_offsets))
            .option("minPartitions", str(tasks or spark.sparkContext.defaultParallelism))
            .options(**options)
            .load()
            .selectExpr(select, "partition", "offset"))


def file_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Text files, a message per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table, a folder or a single file, as a stream of its rows."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder) if _is_file(spark, path) else reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """Whether the path itself is the one file that a scan of it reads."""
    files = spark.read.parquet(path).inputFiles()
    return [f.rstrip("/").rpartition("/")[2] for f in files] == [path.rstrip("/").rpartition("/")[2]]


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines sent over a socket, for trying things out; nothing can be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
