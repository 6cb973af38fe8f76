"""Files listed by Spark, and byte ranges of them read inside tasks."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = ";"
ENCODING = "cp1252"
READ = 1 << 20
# Names that Hadoop's connectors have for stores that Arrow knows by another.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs"}


def opened(path: str) -> pa.NativeFile:
    """A file of any store that Arrow reaches, for reading at any place. ``path`` is as Spark lists it, not escaped."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + (rest if colon else path).lstrip("/"))
    store, _, place = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{store}/")
    return system.open_input_file(f"{root.rstrip('/')}/{place}")


def listed(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """(path, length) of the files of a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").cast("long").alias("length"))


def reachable(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether tasks can read ranges of this path. Some stores only Spark's own readers reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    uri = hadoop.Path(path if isinstance(path, str) else path[0]).toUri()
    if uri.getScheme() is None:
        uri = hadoop.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration())
    if uri.getScheme() == "file":
        return True
    try:
        fs.FileSystem.from_uri(f"{_SCHEMES.get(uri.getScheme(), uri.getScheme())}://{uri.getAuthority() or ''}/")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def column_names(header: str) -> list[str]:
    """Column names of a header line; an empty name, or one repeated in any case, is replaced by its position."""
    names = [c.strip().strip('"') for c in header.lstrip("\ufeff").rstrip("\r\n").split(SEPARATOR)]
    lower = [c.lower() for c in names]
    return [c if c and c.lower() not in lower[:i] else f"_c{i}" for i, c in enumerate(names)]


def header_text(line: bytes) -> str:
    return line.removeprefix(b"\xef\xbb\xbf").decode(ENCODING, "replace").rstrip("\r\n")


def header_names(line: bytes) -> list[str]:
    return column_names(header_text(line))


def whole_lines(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The same bytes in blocks that end with a line."""
    rest = b""
    for chunk in chunks:
        end = chunk.rfind(b"\n") + 1
        if end:
            yield rest + chunk[:end] if rest else chunk[:end]
            rest = chunk[end:]
        else:
            rest += chunk
    if rest:
        yield rest


def _by_line(lines: list[str], names: list[str], columns: list[str]) -> pa.Table:
    """Lines parsed one by one: too long ones are dropped, short ones padded, blank ones no rows."""
    rows = [r for line in lines if line.strip() for r in csv.reader([line.rstrip("\r")], delimiter=SEPARATOR)]
    rows = [r + [""] * (len(names) - len(r)) for r in rows if len(r) <= len(names)]
    at = {c: names.index(c) for c in columns if c in names}
    return pa.table({c: pa.array([r[at[c]] or None for r in rows] if c in at else [None] * len(rows), pa.string()) for c in columns})


def parsed(block: bytes, names: list[str], columns: list[str]) -> pa.Table:
    """``columns`` as text from a block of whole lines whose fields have ``names``; those the lines lack are NULL.

    Names are the same in any case. Lines with more fields than names are dropped, short ones are padded with NULL, an
    empty field is NULL. A line ends at its line end, also within a quote that is not closed.
    """
    spelled = {c.lower(): c for c in columns}
    names = [spelled.get(n.lower(), n) for n in names]
    data = block if block.isascii() else block.decode(ENCODING, "replace").encode()
    odd: list[str] = []
    if b'"' in data:
        lines = data.split(b"\n")
        open_ = [line.count(b'"') & 1 for line in lines]
        if any(open_):
            odd = [line.decode() for line, o in zip(lines, open_, strict=True) if o]
            data = b"\n".join(line for line, o in zip(lines, open_, strict=True) if not o)

    def uneven(row: arrow_csv.InvalidRow) -> str:
        if row.actual_columns < row.expected_columns:
            odd.append(row.text)
        return "skip"

    there = [c for c in columns if c in names]
    if data.strip() and there:
        table = arrow_csv.read_csv(
            pa.BufferReader(data),
            arrow_csv.ReadOptions(column_names=names, use_threads=False, block_size=len(data) + 1),
            arrow_csv.ParseOptions(delimiter=SEPARATOR, invalid_row_handler=uneven),
            arrow_csv.ConvertOptions(
                column_types={c: pa.string() for c in names}, include_columns=there, strings_can_be_null=True, null_values=[""],
                quoted_strings_can_be_null=False,
            ),
        )
        missing = {c: pa.nulls(table.num_rows, pa.string()) for c in columns if c not in names}
        table = pa.table({c: table.column(c) if c in names else missing[c] for c in columns})
    else:
        table = pa.table({c: pa.array([], pa.string()) for c in columns})
        odd += [] if there else [line for line in data.decode().split("\n") if line]
    return pa.concat_tables([table, _by_line(odd, names, columns)]) if odd else table


def tagged(table: pa.Table, **values: str | int | None) -> Iterator[pa.RecordBatch]:
    """The batches of a table with constant columns in front."""
    for batch in table.combine_chunks().to_batches(max_chunksize=1 << 16):
        kinds = {k: pa.int64() if k == "linhas" else pa.string() for k in values}
        fixed = [pa.nulls(batch.num_rows, kinds[k]) if v is None else pa.repeat(pa.scalar(v, kinds[k]), batch.num_rows) for k, v in values.items()]
        yield pa.RecordBatch.from_arrays([*fixed, *batch.columns], names=[*values, *batch.schema.names])


def _first_line(handle: pa.NativeFile) -> bytes:
    line = b""
    while part := handle.read(1 << 14):
        line += part
        if b"\n" in part:
            break
    return line[: line.find(b"\n") + 1] if b"\n" in line else line


def _range_chunks(handle: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin in a range: up to the end of the last one, and without the one that began before."""
    at, skipping = max(0, start - 1), start > 0
    handle.seek(at)
    while at < end or not skipping:
        chunk = handle.read(min(READ, end - at) if at < end else 1 << 14)
        if not chunk:
            return
        begin = at
        at += len(chunk)
        if skipping:
            first = chunk.find(b"\n") + 1
            if not first:
                continue
            chunk, begin, skipping = chunk[first:], begin + first, False
            if begin >= end:
                return
        # The last line is the one that holds the byte before the range's end.
        last = chunk.find(b"\n", max(0, end - 1 - begin)) + 1 if at >= end else 0
        if last:
            yield chunk[:last]
            return
        yield chunk


def _read_ranges(columns: list[str]):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opened(path) as handle:
                    header = _first_line(handle)
                    names = header_names(header)
                    for block in whole_lines(_range_chunks(handle, max(start, len(header)), end)):
                        yield from tagged(parsed(block, names, columns), metadata_arquivo_origem=path.rsplit("/", 1)[-1])

    return of


def read_ranges(spark: SparkSession, path: str | list[str], columns: list[str], range_bytes: int | None = None) -> DataFrame:
    """``columns`` and ``metadata_arquivo_origem`` of delimited windows-1252 files, each byte read once.

    Files are cut into ranges as large as the splits of Spark's own readers. A task reads the header of its file and the
    lines that begin in its range, and binds the fields by the names in the header: any number of headers, one plan, and
    no list of files on the driver.
    """
    files = listed(spark, path).filter("length > 0")
    if range_bytes is None:
        total = files.agg(F.sum("length")).first()[0] or 0
        largest = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        range_bytes = max(1, min(largest, max(1 << 22, -(-total // spark.sparkContext.defaultParallelism))))
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))).alias("start"))
    ranges = ranges.select("path", F.col("start").cast("long").alias("start"), F.least(F.col("start") + range_bytes, "length").alias("end"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["metadata_arquivo_origem", *columns]])
    count = max(1, ranges.count())
    return ranges.repartition(count).mapInArrow(_read_ranges(columns), schema).select(*columns, "metadata_arquivo_origem")
