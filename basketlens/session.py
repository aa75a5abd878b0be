"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows of a file, and limits on what one task reads, where a task's rows stay in memory as objects.
FILE_ROWS = 500_000
SHORT_SPLITS = {"spark.sql.files.maxPartitionBytes": "16000000", "spark.sql.files.openCostInBytes": "4000000"}

_LOCAL_DIRS: dict[str, str] = {}
#: Folders behind the tables that ``materialise`` gave, and lists that record new ones.
_FOLDERS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_RECORDS: list[list[str]] = []


def get_spark(app: str = "basketlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Sizing (executors, memory, shuffle partitions) belongs to the deployment;
    only semantics and adaptive execution are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Reports group by up to some hundred thousand products; the default fast
        # map of 65536 groups per task sends most of those rows to the slow one.
        .config("spark.sql.codegen.aggregate.fastHashMap.capacityBit", "20")
        # Window and distinct state outgrows the heap on real streams.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for local masters, where driver and
    executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="basketlens-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def spread_out(df):
    """``df`` in a partition per core at least; inputs that already have as many keep them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def short_splits(spark: SparkSession, batch: int = 0) -> Iterator[None]:
    """Reads planned meanwhile give a task 16 MB at most, and four files at most, however small.

    ``batch`` bounds the rows read at once, for rows of megabytes. The session's
    own settings come back afterwards.
    """
    wanted = SHORT_SPLITS | ({"spark.sql.parquet.columnarReaderBatchSize": str(batch)} if batch else {})
    before = {name: spark.conf.get(name) for name in wanted}
    for name, size in wanted.items():
        spark.conf.set(name, size)
    try:
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def materialise(df, name: str, partition_by: list[str] | None = None, spread: bool = False, file_rows: int = 0):
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with files that outlive executors, so that iterative
    consumers neither recompute the plan nor lose it with a node. ``spread``
    cuts a small input into a file per core, for consumers whose work per row
    is large; inputs that already have more partitions keep them. ``file_rows``
    bounds the rows of a file, for consumers that hold a task's rows as objects.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if spread:
        df = spread_out(df)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    for record in _RECORDS:
        record.append(path)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of the shared folder, if they are still there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def forget(*tables) -> None:
    """Delete tables that ``materialise`` gave, once what follows from them is written itself."""
    for table in tables:
        delete_folders(table.sparkSession, [_FOLDERS.pop(table)])


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Folders that ``materialise`` writes meanwhile."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.remove(paths)
