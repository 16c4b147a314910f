"""Session defaults and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ebbline", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only where that is unset (laptops) a folder below the warehouse, which executors share too; on a
    cluster whose warehouse is a folder of one machine this is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/_shared"


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder and continue from the written copy.

    Used where one frame feeds many later jobs (resampling, folds, boosting rounds): a lost
    executor then costs a re-read, never a recomputation of the feature joins.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Whether a query's shuffle files go as soon as it has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a columnar table in the shared folder and read it back.

    Cheaper than a checkpoint where later steps read few of the columns, and its size is known
    to the planner.  The folder goes when the application ends.  The shuffle files behind it go once it
    is written: nothing reads them again, and else they stay until the driver collects garbage.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    table = spark.read.schema(df.schema).parquet(folder)
    table._written = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        path = table._written
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bounded(table: DataFrame, most_mb: int = 16) -> DataFrame:
    """A written ``table``, with a broadcast hint if its plan says that it is small.

    For joins of a large table with keys found in it: few keys must not make Spark shuffle the
    large side.  Beyond the bound the join is left to Spark.  Statistics of files are compressed
    sizes, so the bound leaves room for several times as much.
    """
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return table.hint("broadcast") if size <= most_mb << 20 else table
