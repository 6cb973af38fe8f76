"""Reading filing extracts: delimited files, and archives of delimited files."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.sources import ranges
from finledger.sources.ranges import SEPARATOR, column_names

# Characters that windows-1252 has at bytes 0x80-0x9F, where latin-1 has control characters.
_CODES = [i for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_CONTROLS = "".join(chr(i) for i in _CODES)
_WINDOWS = bytes(_CODES).decode("cp1252")

CORRUPT = "_linha_bruta"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _field_count(line: Column) -> Column:
    """Fields of a raw line; separators inside quotes do not count."""
    unquoted = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(SEPARATOR), F.lit(""))) + 1


def drop_overlong(df: DataFrame, columns: int) -> DataFrame:
    """Lines with more fields than the header are dropped; short ones stay, padded with NULL (trap T1)."""
    return df.filter(F.col(CORRUPT).isNull() | (_field_count(F.col(CORRUPT)) <= columns)).drop(CORRUPT)


def _from_latin1(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.translate(c, _CONTROLS, _WINDOWS) for c in strings})


def by_name(df: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of a table whose header has ``names``; those it lacks are NULL."""
    there = [F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in columns]
    return df.select(*there, *[c for c in df.columns if c not in names])


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(caminho, cabecalho): the first line of every file, for stores that only Spark reads: all splits are scanned."""
    lines = spark.read.option("encoding", "ISO-8859-1").text(path).select(
        F.col("_metadata.file_path").alias("caminho"),
        F.col("_metadata.file_block_start").alias("inicio"),
        F.monotonically_increasing_id().alias("ordem"),
        "value",
    )
    first = lines.filter("inicio = 0").groupBy("caminho").agg(F.min_by("value", "ordem").alias("cabecalho"))
    return _from_latin1(first)


def read_delimited(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """Semicolon-separated windows-1252 files as text columns, with the source file name.

    Columns are bound by the name in each file's header, in whatever order; unknown ones are left to ``header_drift``,
    missing ones are NULL. Ranges of the files are read in tasks, each byte once; files in a store that only Spark's
    readers reach are read by those.
    """
    if ranges.reachable(spark, path):
        return ranges.read_ranges(spark, path, columns)
    return read_by_header(spark, path, columns)


def read_by_header(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The same rows by Spark's reader. Files of one header are read together: the few headers and the list of files,
    which the driver lists in any case, decide that. The reader decodes latin-1, which every Spark accepts, and the few
    characters that differ are mapped back."""
    grouped = file_headers(spark, path).groupBy("cabecalho").agg(F.collect_list("caminho").alias("c")).collect()
    out = None
    for row in grouped:
        names = column_names(row["cabecalho"])
        schema = T.StructType([*text_schema(names).fields, T.StructField(CORRUPT, T.StringType())])
        raw = (
            spark.read.schema(schema)
            .option("sep", SEPARATOR)
            .option("header", True)
            .option("encoding", "ISO-8859-1")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv([unquote(c) for c in row["c"]])
            .select("*", F.col("_metadata.file_name").alias("metadata_arquivo_origem"))
        )
        part = by_name(drop_overlong(raw, len(names)), names, columns)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], text_schema([*columns, "metadata_arquivo_origem"]))
    return _from_latin1(out)


def header_drift(headers: DataFrame, columns: list[str]) -> DataFrame:
    """Added (``NOVA``) and missing (``AUSENTE``) column names of each header line (column ``cabecalho``)."""
    names = F.transform(F.split("cabecalho", SEPARATOR), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    known = F.array(*map(F.lit, columns))
    tag = lambda values, state: F.transform(
        values, lambda c: F.struct(c.alias("COLUNA"), F.lit(state).alias("SITUACAO"))
    )
    changes = F.concat(tag(F.array_except(names, known), "NOVA"), tag(F.array_except(known, names), "AUSENTE"))
    return headers.select("*", F.inline(changes))


BLOCKS = "arquivo string, membro string, nivel string, mensagem string, cabecalho string, bloco string"
_BLOCK = 1 << 20


def _sound(archive: zipfile.ZipFile, member: str) -> str | None:
    """What is wrong with a member, read to its end; its checksum is known only there."""
    try:
        with archive.open(member) as handle:
            while handle.read(_BLOCK):
                pass
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError) as error:
        return str(error)
    return None


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(*row: str | None) -> pd.DataFrame:
        return pd.DataFrame([row], columns=["arquivo", "membro", "nivel", "mensagem", "cabecalho", "bloco"])

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            name = path.rsplit("/", 1)[-1]
            try:
                archive = zipfile.ZipFile(io.BytesIO(content))
                members = [m for m in archive.namelist() if m.lower().endswith(".csv")]
            except (zipfile.BadZipFile, zlib.error, EOFError, OSError):
                yield frame(name, None, "ERROR", "Arquivo corrompido ou não é um ZIP válido.", None, None)
                continue
            if not members:
                yield frame(name, None, "WARNING", "Zip vazio.", None, None)
            for member in members:
                fault = _sound(archive, member)
                if fault is not None:
                    yield frame(name, member, "ERROR", f"Membro corrompido: {fault}", None, None)
                    continue
                with archive.open(member) as handle:
                    text = io.TextIOWrapper(handle, encoding="cp1252", errors="replace", newline="\n")
                    header, rest, sent = text.readline().rstrip("\r\n"), "", False
                    while part := text.read(_BLOCK):
                        rest += part
                        end = rest.rfind("\n")
                        if end >= 0:
                            yield frame(name, member, "INFO", None, header, rest[:end])
                            rest, sent = rest[end + 1 :], True
                    if rest or not sent:
                        yield frame(name, member, "INFO", None, header, rest or None)


def expand_archives(files: DataFrame) -> DataFrame:
    """Blocks of whole lines of every delimited member of every archive, with the member's header.

    ``files`` has the shape of the ``binaryFile`` source (``path``, ``content``): an archive is one row of it, so it must
    stay below 2 GB, and one task's work. Python only opens the container, one block at a time; lines and fields are
    split by the JVM. A damaged archive or member and an empty archive are one event each and none of their rows; the
    other members go on.
    """
    return files.select("path", "content").mapInPandas(_expand, BLOCKS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return expand_archives(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path))


def parse_members(blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Fields of the expanded blocks by the names of each member's header, under the bad-line rule of the file reader.

    ``blocks`` should be a stored table: the few distinct headers are read from it first, then one pass parses each
    header's lines.
    """
    usable = blocks.filter("nivel = 'INFO' AND bloco IS NOT NULL")
    out = None
    for row in usable.select("cabecalho").distinct().collect():
        names = column_names(row["cabecalho"])
        schema = ", ".join([f"`{c}` string" for c in names] + [f"{CORRUPT} string"])
        options = {"sep": SEPARATOR, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        lines = usable.filter(F.col("cabecalho") == row["cabecalho"]).select(
            F.col("arquivo").alias("metadata_arquivo_origem"),
            F.col("membro").alias("metadata_membro"),
            F.explode(F.split("bloco", "\r?\n")).alias("linha"),
        )
        parsed = lines.filter("linha <> ''").select(
            "metadata_arquivo_origem", "metadata_membro", F.from_csv("linha", schema, options).alias("_f")
        )
        flat = parsed.select("metadata_arquivo_origem", "metadata_membro", "_f.*")
        part = by_name(drop_overlong(flat, len(names)), names, columns)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = blocks.sparkSession.createDataFrame([], text_schema([*columns, "metadata_arquivo_origem", "metadata_membro"]))
    return out


def archive_events(blocks: DataFrame) -> DataFrame:
    """Load-log events of an expansion: lines per member, and the archives and members that could not be used."""
    lines = F.when(F.col("bloco").isNotNull(), F.size(F.filter(F.split("bloco", "\r?\n"), lambda x: x != ""))).otherwise(0)
    return blocks.groupBy("arquivo", "membro", "nivel", "mensagem").agg(F.sum(lines).alias("LINHAS"))


def stage_as_text(df: DataFrame, source: Column) -> DataFrame:
    """All columns as text, plus load time and source file. A missing value stays NULL."""
    text = [F.col(c).cast("string").alias(c) for c in df.columns]
    return df.select(
        *text, F.current_timestamp().alias("metadata_data_carga"), source.alias("metadata_arquivo_origem")
    )
