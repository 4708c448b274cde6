"""Session settings and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_SETTLED: list[str] = []


def session(app: str = "assayspark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with runtime re-planning, skew splitting and UTC time; `settings` win over defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, read from `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own. On a cluster the
    setting is required: a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder is None:
        known = sc.getCheckpointDir()
        if known:
            return known
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="assayspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def released(spark: SparkSession):
    """What is written inside gives its shuffle files back at once: the written table is what later steps read."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settle(df: DataFrame, name: str = "settled", **options: str) -> DataFrame:
    """Write the table to the shared folder once and read it from there.

    What is used several times is then computed once, in one pass, and survives lost executors. `options` go to the writer.
    """
    path = new_path(df.sparkSession, name)
    with released(df.sparkSession):
        df.write.options(**options).parquet(path)
    _SETTLED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> bool:
    """Remove an intermediate folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def forget_settled(spark: SparkSession) -> int:
    """Remove the tables this session settled; results that still read them must be computed before."""
    removed = 0
    while _SETTLED:
        removed += discard(spark, _SETTLED.pop())
    return removed


def numbered(ordered: DataFrame, into: str) -> DataFrame:
    """A sorted table with the place of each row, from 0. Rows are counted per task of the sort, so no task gets them all."""
    rows = settle(ordered.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_task", F.shiftright("_at", 33))
    tasks = rows.groupBy("_task").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    tasks = tasks.select("_task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"))
    return rows.join(tasks, "_task").withColumn(into, F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")


def placed(rows: DataFrame, key: str, partitions: int = 16) -> DataFrame:
    """Rows for repeated passes, dealt and ordered by a hash of the key: the same partitions on any cluster.

    Samplers that draw per partition, as the bagging of trees does, then draw alike wherever they run.
    """
    place = F.xxhash64(F.col(key).cast("string"))
    return rows.repartition(partitions, place).sortWithinPartitions(place, key)
