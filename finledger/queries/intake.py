"""Registered queries over intake: extracts written from the ledger by Spark, read back, staged and logged."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.plans import lake, ledger
from finledger.queries.report import report
from finledger.session import work_path
from finledger.sources import catalog, extracts, loader, members, ranges, tables
from finledger.streaming.intake import stage_new_files

RAW = S.RAW_COLUMNS


def _text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines as the text of an extract, with the file each one belongs to."""
    lines = lake.raw_lines(spark, sf)
    file_name = F.concat(F.col("TABLE_NAME"), F.lit("_"), F.year("DT_REFER").cast("string"), F.lit(".csv"))
    return lines.select(*[F.col(c).cast("string").alias(c) for c in RAW], file_name.alias("ARQUIVO"))


def _staged_totals(staged: DataFrame, *keys: str) -> DataFrame:
    value = F.col("VL_CONTA").try_cast(S.MONEY)
    totals = staged.groupBy(*keys).agg(F.count("*").alias("LINHAS"), F.sum(value).alias("TOTAL"))
    return report(totals, ["TOTAL"])


def scan_delimited(spark, sf):
    """All lines written as semicolon-separated text files, read back by the delimited scan, summed per company."""
    path = work_path(spark, "extracts")
    written = _text_lines(spark, sf).select(*RAW)
    written.write.option("sep", extracts.SEPARATOR).option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return _staged_totals(extracts.read_delimited(spark, path, RAW), "CNPJ_CIA", "ORDEM_EXERC")


DAMAGED = "dfp_cia_aberta_dra_con"
# Lines of an archive at least, where a task has as many: members of some thousand lines, not of some hundred.
ARCHIVE_LINES = 1 << 16


def _container(members: list[tuple[str, pd.DataFrame]], damage: bool = False) -> bytes:
    """An archive of delimited members; with ``damage`` a byte of each member's data is wrong."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, rows in members:
            columns = list(rows.columns)
            if "_bpp_" in name:
                rows = rows[columns[::-1]]
            if "_dre_" in name:
                rows = rows.assign(NOVA_COLUNA="x")
            text = rows.to_csv(sep=extracts.SEPARATOR, index=False, lineterminator="\n")
            archive.writestr(name, text.encode("cp1252", errors="replace"))
        middles = [i.header_offset + 30 + len(i.filename) + i.compress_size // 2 for i in archive.infolist()]
    content = bytearray(buffer.getvalue())
    for middle in middles if damage else []:
        content[middle] ^= 0xFF
    return bytes(content)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together until they have the lines of an archive."""
    held, lines = [], 0
    for batch in batches:
        held, lines = [*held, batch], lines + len(batch)
        if lines >= ARCHIVE_LINES:
            yield pd.concat(held, ignore_index=True)
            held, lines = [], 0
    if lines:
        yield pd.concat(held, ignore_index=True)


def _write_archives(spark: SparkSession, sf: str, folder: str, damaged: bool) -> None:
    """Archives in the shared folder, one for some Arrow batches of lines, one member per table and year.

    Some members have their columns in another order, some have one more. With ``damaged`` the members of one table are
    in archives of their own, with bad data, and there are archives without members. A repeated task overwrites its files.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, place = FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(_gathered(batches)):
            members = [(name, rows[RAW]) for name, rows in batch.groupby("ARQUIVO")]
            bad = [m for m in members if damaged and m[0].startswith(DAMAGED)]
            archives = {"dfp": _container([m for m in members if m not in bad] if bad else members)}
            if damaged:
                archives |= {"vazio": _container([]), "ruim": _container(bad, damage=True)}
            for kind, content in archives.items():
                with system.open_output_stream(f"{place}/{kind}_{part}_{number}.zip") as out:
                    out.write(content)
            yield pd.DataFrame({"archives": [len(archives)]})

    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    _text_lines(spark, sf).mapInPandas(write, "archives int").agg(F.sum("archives")).collect()


def _planned(spark, sf) -> DataFrame:
    folder = work_path(spark, "archives")
    _write_archives(spark, sf, folder, damaged=False)
    return members.planned(ranges.listed(spark, folder, "*.zip"))


def scan_archive(spark, sf):
    """All lines packed into archives of several members, read back and parsed by name, summed per member and company."""
    return _staged_totals(members.rows_of(members.staged(_planned(spark, sf), RAW)), "metadata_membro", "CNPJ_CIA")


def archive_events(spark, sf):
    """Rows per archive member, as the load log reports them."""
    events = members.events_of(members.staged(_planned(spark, sf), RAW))
    return events.groupBy("membro", "nivel").agg(F.sum("LINHAS").alias("LINHAS"))


def header_drift(spark, sf):
    """Members whose header adds or lacks columns."""
    return members.drift(members.with_headers(_planned(spark, sf)), RAW, RAW).select("membro", "COLUNA", "SITUACAO").distinct()


def intake_loop(spark, sf):
    """Archives loaded twice over: lines by level and member in the log, and lines in the table.

    Lines that the second run loaded again would count twice.
    """
    folder, target, log = (work_path(spark, n) for n in ("archives", "bronze", "log"))
    _write_archives(spark, sf, folder, damaged=True)
    for _ in range(2):
        loader.load_archives(spark, folder, target, log, RAW, "dfp")
    lines = F.coalesce(F.regexp_extract("mensagem", r"(\d+) linhas", 1).try_cast("bigint"), F.lit(0))
    logged = tables.read_log(spark, log).groupBy("nivel_log", "tabela_destino").agg(
        F.bool_or("schema_drift_detectado").alias("schema_drift_detectado"), F.sum(lines).alias("LINHAS")
    )
    loaded = tables.read_table(spark, target).groupBy(F.concat(F.lit("dfp:"), "metadata_membro").alias("tabela_destino")).agg(
        F.count("*").alias("LINHAS")
    )
    return logged.unionByName(
        loaded.select(F.lit("TABELA").alias("nivel_log"), "tabela_destino", F.lit(None).cast("boolean").alias("schema_drift_detectado"), "LINHAS")
    )


def source_catalog(spark, sf):
    """Files to expect for the fiscal years of the ledger."""
    years = lake.raw_lines(spark, sf).select(F.year("DT_REFER").alias("ANO")).distinct()
    return catalog.expected_files(years)


def derive_table_name(spark, sf):
    lines = _text_lines(spark, sf)
    year = F.regexp_extract("ARQUIVO", r"_(\d{4})\.csv$", 1).cast("int")
    named = lines.select(
        "ARQUIVO", catalog.table_name(F.upper("ARQUIVO"), year, F.lit("dfp_cia_aberta")).alias("TABELA")
    )
    return named.groupBy("ARQUIVO", "TABELA").agg(F.count("*").alias("LINHAS"))


def stage_text(spark, sf):
    """Staged lines per source file: all columns text, lineage filled, nothing turned into the text 'nan'."""
    staged = extracts.stage_as_text(_text_lines(spark, sf), F.col("ARQUIVO"))
    return staged.groupBy("metadata_arquivo_origem").agg(
        F.count("*").alias("LINHAS"),
        F.count("metadata_data_carga").alias("COM_DATA"),
        F.count_if(F.col("VL_CONTA") == "nan").alias("TEXTO_NAN"),
        F.count_distinct("CD_CONTA").alias("CONTAS"),
    )


def schema_drift(spark, sf):
    """What the lineitem extract adds to, and lacks of, the columns known from orders."""
    known = ledger.read_table(spark, sf, "orders").columns
    return catalog.schema_drift(known, ledger.read_table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"))


def _event_log(spark, sf) -> DataFrame:
    """The events table read as a load log: an error is an error, a purchase a finished file."""
    events = ledger.read_table(spark, sf, "events")
    year = F.lit(1990) + F.col("user_id") % 20
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "purchase", "SUCCESS")
        .when(F.col("event_type") == "signup", "WARNING")
        .otherwise("INFO")
    )
    message = F.when(level == "SUCCESS", F.lit("Processamento do arquivo finalizado.")).otherwise(
        F.concat(F.lit("Carga OK: "), (F.col("event_id") % 1000).cast("string"), F.lit(" linhas."))
    )
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("ts").alias("data_execucao"),
        level.alias("nivel_log"),
        year.cast("int").alias("ano_referencia"),
        F.concat(F.lit("dfp_cia_aberta_"), year.cast("string"), F.lit(".zip")).alias("arquivo_origem"),
        F.concat(F.lit("tabela_"), F.col("event_type")).alias("tabela_destino"),
        message.alias("mensagem"),
        (F.col("event_id") % 7 == 0).alias("schema_drift_detectado"),
    )


def load_log_counts(spark, sf):
    return tables.log_counts(_event_log(spark, sf))


def pending_files(spark, sf):
    years = lake.raw_lines(spark, sf).select(F.year("DT_REFER").alias("ANO")).distinct()
    return catalog.pending_files(catalog.expected_files(years), _event_log(spark, sf))


LAKE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def lake_profile(spark, sf):
    return catalog.profile(catalog.parquet_files(spark, {n: f"{sf}/{n}.parquet" for n in LAKE}))


def lake_rows(spark, sf):
    """The part of the profile that does not depend on how files are laid out."""
    return lake_profile(spark, sf).filter("TABELA IS NOT NULL").select("TABELA", "LINHAS")


def lake_total(spark, sf):
    """Rows of the whole lake and of its largest tables."""
    files = catalog.parquet_files(spark, {n: f"{sf}/{n}.parquet" for n in LAKE})
    top = catalog.profile(files, top=15)
    return top.select(F.coalesce("TABELA", F.lit("TOTAL")).alias("TABELA"), "LINHAS")


def load_events(spark, sf):
    """Lines appended by year and logged per source file: what the log says was loaded."""
    path = work_path(spark, "bronze")
    raw = _text_lines(spark, sf)
    staged = extracts.stage_as_text(raw, F.col("ARQUIVO")).withColumn("ANO", F.substring("DT_REFER", 1, 4).cast("int"))
    tables.append_by_year(staged, path, "ANO")
    log_path = work_path(spark, "log")
    tables.append_log(tables.load_events(spark.read.parquet(path), "dfp"), log_path)
    log = tables.read_log(spark, log_path)
    return log.select("nivel_log", "ano_referencia", "arquivo_origem", "tabela_destino", "mensagem")


def stream_intake(spark, sf):
    """The lineitem file taken in by a file stream, staged as text, counted per source file and line number."""
    base = work_path(spark, "stream")
    items = ledger.read_table(spark, sf, "lineitem")
    stage_new_files(spark, sf, items.schema, f"{base}/staged", f"{base}/checkpoint", glob="lineitem.parquet")
    staged = spark.read.parquet(f"{base}/staged")
    return staged.groupBy("metadata_arquivo_origem", "l_linenumber").agg(
        F.count("*").alias("LINHAS"), F.count_distinct("l_suppkey").alias("EMPRESAS")
    )


QUERIES = {
    f.__name__: f
    for f in [
        scan_delimited, scan_archive, archive_events, header_drift, intake_loop, source_catalog, derive_table_name, stage_text, schema_drift,
        load_log_counts, pending_files, lake_profile, lake_rows, lake_total, load_events, stream_intake,
    ]
}
