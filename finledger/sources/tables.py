"""Writing tables: append by year, publish a new version, replace parts, export, and the check after a write."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.schema import LOAD_LOG
from finledger.session import materialise


def append_by_year(df: DataFrame, path: str, year: str) -> None:
    """Append to a table laid out by year.

    Rows of a year are brought together first, so that files stay few; the rebalance splits a year that is too large
    for one task, where a plain repartition would not.
    """
    df.hint("rebalance", year).write.mode("append").partitionBy(year).parquet(path)


CURRENT = "_atual"


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    place, system = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def parts(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the current version of a published table; none where nothing was published."""
    place, system = _folder(spark, f"{path}/{CURRENT}")
    if not system.exists(place):
        return []
    stream = system.open(place)
    try:
        return [line for line in stream.readUTF().split("\n") if line]
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Make ``folders`` the current version, in one step: the pointer is written beside the old one and takes its name."""
    beside, system = _folder(spark, f"{path}/{CURRENT}-{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    stream.writeUTF("\n".join(folders))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, hadoop.Path(f"{path}/{CURRENT}"), options)


def publish(df: DataFrame, path: str, approved: Callable[[DataFrame], bool] | None = None, by: str | None = None) -> bool:
    """Write a table as a new version of ``path`` and make it the current one; tells whether it was.

    The version is written once, in a folder of its own; ``approved`` judges what was written, and only then the pointer
    moves. A write that fails, or a table that is refused, leaves the old version as it is, and readers of the old
    version keep its files (``forget``). ``published`` reads; ``by`` lays the version out by a column of few values.
    """
    spark, version = df.sparkSession, f"versao={uuid.uuid4().hex}"
    (df.write if by is None else df.write.partitionBy(by)).parquet(f"{path}/{version}")
    if approved is not None and not approved(spark.read.schema(df.schema).parquet(f"{path}/{version}")):
        place, system = _folder(spark, path)
        system.delete(_folder(spark, f"{path}/{version}")[0], True)
        if not _children(spark, path):
            system.delete(place, False)
        return False
    _point(spark, path, _version_parts(spark, path, version, by))
    return True


def _version_parts(spark: SparkSession, path: str, version: str, by: str | None) -> list[str]:
    if by is None:
        return [version]
    return [f"{version}/{name}" for name in _children(spark, f"{path}/{version}") if name.startswith(f"{by}=")]


def replace_parts(df: DataFrame, path: str, by: str, values: list) -> None:
    """Replace the parts of a published table that have ``values`` in the column ``by`` with the rows of ``df``, which
    has no others. Parts that are not named are neither read nor written; all change in one step."""
    spark, version = df.sparkSession, f"versao={uuid.uuid4().hex}"
    df.write.partitionBy(by).parquet(f"{path}/{version}")
    gone = {f"{by}={v}" for v in values}
    kept = [p for p in parts(spark, path) if p.rsplit("/", 1)[-1] not in gone]
    _point(spark, path, kept + _version_parts(spark, path, version, by))


def published(spark: SparkSession, path: str, schema: T.StructType, by: str | None = None, values: list | None = None) -> DataFrame:
    """The current version of a published table, or its parts with ``values`` in the column ``by``."""
    folders = parts(spark, path)
    if values is not None:
        wanted = {f"{by}={v}" for v in values}
        folders = [f for f in folders if f.rsplit("/", 1)[-1] in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([f for f in schema.fields if f.name != by])
    df = spark.read.schema(stored).parquet(*[f"{path}/{f}" for f in folders])
    if by is None:
        return df
    value = F.regexp_extract("_metadata.file_path", f"/{by}=([^/]*)/[^/]*$", 1).cast(schema[by].dataType)
    return df.select("*", value.alias(by)).select(*schema.names)


def forget(spark: SparkSession, path: str) -> int:
    """Remove the versions that the current one does not use, and what broken writes left; tells how many. For a time
    when no reader holds an older version."""
    used = {p.split("/", 1)[0] for p in parts(spark, path)}
    old = [n for n in _children(spark, path) if n.startswith("versao=") and n not in used or n.startswith(f"{CURRENT}-")]
    for name in old:
        place, system = _folder(spark, f"{path}/{name}")
        system.delete(place, True)
    return len(old)


def rebuild_table(df: DataFrame, name: str) -> None:
    """Rebuild a table under its name: the rows are written to a folder of their own, and then the name moves to it.

    While the columns stay the same the table is there all the time; a write that fails leaves it as it was.
    """
    spark = df.sparkSession
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).schema == spark.read.parquet(path).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path, "parquet")


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def written_rows(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Write, read back, and compare row counts per key: nothing lost, nothing doubled.

    The table is computed once, into a staging table: what is written is what was counted.
    """
    spark = df.sparkSession
    values = materialise(df, "staged")
    before = values.groupBy(*keys).agg(F.count("*").alias("ESPERADO"))
    publish(values, path)
    after = published(spark, path, df.schema).groupBy(*keys).agg(F.count("*").alias("GRAVADO"))
    both = before.join(after, keys, "full")
    return both.withColumn("CONFERE", F.coalesce(F.col("ESPERADO") == F.col("GRAVADO"), F.lit(False)))


def load_events(staged: DataFrame, table: str, level: str = "INFO") -> DataFrame:
    """Load-log rows of a staged table: one per source file with its row count."""
    counted = staged.groupBy("metadata_arquivo_origem").agg(F.count("*").alias("n"))
    year = F.regexp_extract("metadata_arquivo_origem", r"(\d{4})", 1)
    return counted.select(
        F.xxhash64("metadata_arquivo_origem", F.current_timestamp()).alias("log_id"),
        F.current_timestamp().alias("data_execucao"),
        F.lit(level).alias("nivel_log"),
        year.try_cast("int").alias("ano_referencia"),
        F.col("metadata_arquivo_origem").alias("arquivo_origem"),
        F.lit(table).alias("tabela_destino"),
        F.format_string("Carga OK: %d linhas.", F.col("n")).alias("mensagem"),
        F.lit(False).alias("schema_drift_detectado"),
    ).to(T.StructType(LOAD_LOG.fields))


def append_log(events: DataFrame, path: str, load: str | None = None) -> None:
    """Add the events of a load to the log; a load that is repeated under its name replaces its own events."""
    name = load or uuid.uuid4().hex
    events.coalesce(1).write.mode("overwrite").parquet(f"{path}/carga={name}")


def read_log(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """All events, or those of other loads than ``without``; a log that does not exist yet has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], LOAD_LOG)
    kept = spark.read.schema(T.StructType([*LOAD_LOG.fields, T.StructField("carga", T.StringType())])).parquet(path)
    kept = kept if without is None else kept.filter(F.col("carga") != without)
    return kept.select(*LOAD_LOG.names)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table whose loads may have added columns, with all of them; None where nothing was written yet."""
    if not exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no load has had a row so far
            return None
        raise


def log_counts(log: DataFrame) -> DataFrame:
    """Events per destination and level, with the rows they report."""
    rows = F.regexp_extract("mensagem", r"(\d+) linhas", 1).try_cast("bigint")
    return log.groupBy("tabela_destino", "nivel_log").agg(
        F.count("*").alias("EVENTOS"), F.coalesce(F.sum(rows), F.lit(0)).alias("LINHAS")
    )
