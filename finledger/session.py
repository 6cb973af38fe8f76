"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "finledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; any of them can be overridden by ``conf``.

    Shuffle partitions are left to adaptive execution: it starts from a generous number and merges small ones, so
    one setting serves a laptop and a large cluster.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A join whose measured build partitions are small hashes them instead of sorting both sides.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        # Upper case by the JVM: the same for Latin text, at a fraction of the cost per row.
        "spark.sql.icu.caseMappings.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see: ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors are threads of the driver (``local``, as in tests) gets a temporary
    folder; on a cluster a folder of the driver's machine would lose what the executors write, so that is an error.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="finledger-"))
    return context.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables; it is removed when the application ends."""
    path = f"{shared_dir(spark)}/finledger-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.mkdirs(place):
        system.deleteOnExit(place)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table."""
    return f"{run_dir(spark)}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str = "stage", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, optionally laid out by a column of few values.

    Used where a result feeds several branches or a lineage grows long. The written table survives the loss of
    executors and gives the planner real sizes: a small one is broadcast because it was measured to be small.
    """
    path = work_path(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))


def quoted(name: str) -> str:
    """A column's name as it is, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def stored_by(df: DataFrame, keys: list[str], name: str = "table", buckets: int | None = None) -> DataFrame:
    """Write ``df`` laid out by ``keys`` and read it back: rows of equal keys are in one bucket, and Spark knows it.

    Windows, aggregations and distinct rows whose keys include ``keys`` then need no exchange, however often the table is
    read. Each bucket is one file, sorted by the keys; there are as many as shuffle partitions unless ``buckets`` says
    otherwise. The table is known to this session by a name of its own and lies in the shared folder.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(count, *keys).write.bucketBy(count, *keys).sortBy(*keys)
    dealt.option("path", work_path(spark, table)).saveAsTable(table)
    return spark.table(table)
