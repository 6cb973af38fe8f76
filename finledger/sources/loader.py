"""The intake loop: archives that are not loaded yet, their members by name into the table, and what the log says."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finledger.schema import LOAD_LOG
from finledger.session import materialise
from finledger.sources import extracts, members, ranges, tables

DONE = "Processamento do arquivo finalizado."
ORIGIN = ["metadata_arquivo_origem", "metadata_membro", "metadata_data_carga"]


def unloaded(files: DataFrame, log: DataFrame) -> DataFrame:
    """Archives (``path``) without a successful load in the log."""
    done = log.filter((F.col("nivel_log") == "SUCCESS") & F.col("mensagem").startswith(DONE.rstrip(".")))
    names = files.withColumn("arquivo", F.substring_index("path", "/", -1))
    return names.join(done.select(F.col("arquivo_origem").alias("arquivo")).distinct(), "arquivo", "left_anti")


def member_events(events: DataFrame, drift: DataFrame, table: str) -> DataFrame:
    """Log rows of a load: INFO for a loaded member with its rows and whether its header drifted, ERROR and WARNING for
    what could not be used, and SUCCESS for an archive without any of these."""
    drifted = drift.select("arquivo", "membro").distinct().withColumn("drift", F.lit(True))
    seen = events.join(drifted, ["arquivo", "membro"], "left").withColumn("drift", F.coalesce("drift", F.lit(False)))
    loaded = F.format_string("Carga OK: %d linhas.", F.col("LINHAS"))
    rows = seen.select(
        "arquivo",
        F.col("nivel").alias("nivel_log"),
        F.when(F.col("nivel") == "INFO", loaded).otherwise(F.col("mensagem")).alias("mensagem"),
        "drift",
        "membro",
    )
    sound = seen.groupBy("arquivo").agg(F.bool_and(F.col("nivel") == "INFO").alias("ok"), F.bool_or("drift").alias("d"))
    finished = sound.filter("ok").select(
        "arquivo", F.lit("SUCCESS").alias("nivel_log"), F.lit(DONE).alias("mensagem"), F.col("d").alias("drift"),
        F.lit(None).cast("string").alias("membro"),
    )
    return rows.unionByName(finished).select(
        F.xxhash64("arquivo", "membro", "nivel_log", F.current_timestamp()).alias("log_id"),
        F.current_timestamp().alias("data_execucao"),
        "nivel_log",
        F.regexp_extract("arquivo", r"(\d{4})", 1).try_cast("int").alias("ano_referencia"),
        F.col("arquivo").alias("arquivo_origem"),
        F.when(F.col("membro").isNull(), F.lit(table)).otherwise(F.concat(F.lit(f"{table}:"), "membro")).alias("tabela_destino"),
        "mensagem",
        F.col("drift").alias("schema_drift_detectado"),
    ).to(LOAD_LOG)


def _names(drift: DataFrame) -> list[str]:
    """Added columns by name, in one spelling."""
    new = drift.filter("SITUACAO = 'NOVA'").groupBy(F.lower("COLUNA").alias("l")).agg(F.min("COLUNA").alias("COLUNA"))
    return [r["COLUNA"] for r in new.orderBy("l").collect()]


def _staged(files: DataFrame, known: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Staged rows and events of the archives, the drift of the sound members against the table, and the columns that
    they add. What a damaged member seems to add is no column."""
    spark = files.sparkSession
    one = files.select("path").first()
    if one is None or ranges.reachable(spark, one["path"]):
        staged = members.staged(members.planned(files), known)
    else:
        content = spark.read.format("binaryFile").load([r["path"] for r in files.select("path").collect()])
        blocks = materialise(extracts.expand_archives(content), "blocks")
        names = F.transform(F.split("cabecalho", ranges.SEPARATOR), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
        headers = blocks.filter("nivel = 'INFO'").select("arquivo", "membro", names.alias("colunas")).distinct()
        staged = members.from_blocks(blocks, known, _names(members.drift(headers, known, columns)))
    drift = materialise(members.drift(members.headers_of(staged), known, columns), "drift")
    return staged, drift, _names(drift)


def load_files(files: DataFrame, target: str, log_path: str, columns: list[str], table: str, load: str | None = None) -> DataFrame:
    """Load the archives of ``files`` (``path``) that the log does not have as finished; returns the logged events.

    Columns are bound by name. What a member adds to the table's columns is appended to the table and logged as drift;
    earlier rows have NULL there (``tables.read_table``). Rows are laid out by archive and replace what an earlier
    attempt at that archive wrote. The rows found in the table must be as many as the members gave; only then are the
    events logged, all of a ``load`` together and in place of those of an earlier attempt at it. So whatever breaks off
    between table and log, the archive is tried again and nothing is lost or doubled.
    """
    spark = files.sparkSession
    todo = materialise(unloaded(files, tables.read_log(spark, log_path, without=load)).select("path"), "todo")
    held = tables.read_table(spark, target)
    known = [*columns, *([c for c in held.columns if c not in columns and c not in ORIGIN] if held is not None else [])]
    staged, drift, added = _staged(todo, known, columns)
    counted = Observation()
    rows = members.rows_of(staged, added).withColumn("metadata_data_carga", F.current_timestamp())
    rows = rows.observe(counted, F.count("*").alias("n"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("metadata_arquivo_origem").parquet(target)
    events = members.events_of(staged)
    said = events.filter("nivel = 'INFO'").agg(F.coalesce(F.sum("LINHAS"), F.lit(0))).first()[0]
    stored = _stored(spark, target, events)
    if not said == counted.get["n"] == stored:
        raise RuntimeError(f"{said} rows were read, {counted.get['n']} written and {stored} are in the table: nothing is logged")
    logged = materialise(member_events(events, drift, table), "events")
    tables.append_log(logged, log_path, load)
    return logged


def _stored(spark: SparkSession, target: str, events: DataFrame) -> int:
    """Rows of the table that come from the archives just loaded."""
    held = tables.read_table(spark, target)
    if held is None:
        return 0
    loaded = events.filter("LINHAS > 0").select(F.col("arquivo").alias("metadata_arquivo_origem")).distinct()
    return held.join(loaded, "metadata_arquivo_origem", "left_semi").count()


def load_archives(spark: SparkSession, folder: str, target: str, log_path: str, columns: list[str], table: str) -> DataFrame:
    """Load the archives that lie in ``folder`` now (``load_files``). An archive with a damaged member loads its other
    members and is tried again next time."""
    return load_files(ranges.listed(spark, folder, "*.zip"), target, log_path, columns, table)
