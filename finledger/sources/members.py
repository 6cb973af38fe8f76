"""Archives read member by member: each member is planned from the archive's directory and read by itself.

A task looks at the end of an archive only, where its directory is; a member's rows come from its own bytes, inflated as
they are read, and are bound by the names in its first line. An archive of any size and with any number of members
is spread over the tasks, and none of it is ever one row.
"""

from __future__ import annotations

import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.session import materialise, quoted
from finledger.sources import extracts, ranges

BROKEN = "Arquivo corrompido ou não é um ZIP válido."
EMPTY = "Zip vazio."
_FAULTS = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError, ValueError)

DIRECTORY = T.StructType().add("path", T.StringType()).add("arquivo", T.StringType()).add("membro", T.StringType())
DIRECTORY = DIRECTORY.add("inicio", T.LongType()).add("comprimido", T.LongType()).add("metodo", T.LongType())
DIRECTORY = DIRECTORY.add("marcas", T.LongType()).add("soma", T.LongType()).add("mensagem", T.StringType())
PLAN = T.StructType([*DIRECTORY.fields, T.StructField("colunas", T.ArrayType(T.StringType()))])
EVENT = ["arquivo", "membro", "nivel", "mensagem", "linhas", "cabecalho"]
# What a row has in columns that its table does not know, by their names in lower case.
MORE = "_colunas_novas"
# What small members are brought together to.
BATCH_ROWS, BATCH_BYTES = 1 << 15, 1 << 23


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64()}
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kinds.get(f.dataType, pa.list_(pa.string()))) for c, f in zip(columns, schema.fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


class _File(io.RawIOBase):
    """A file as ``zipfile`` expects it: to seek before its beginning is an OSError."""

    def __init__(self, handle: pa.NativeFile):
        self.handle, self.size = handle, handle.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.handle.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self.handle.tell(), self.size)[whence]
        if place < 0:
            raise OSError("before the beginning")
        return self.handle.seek(place)

    def readinto(self, buffer) -> int:
        return self.handle.readinto(buffer)


def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            name, rows = path.rsplit("/", 1)[-1], []
            try:
                with ranges.opened(path) as handle:
                    members = [i for i in zipfile.ZipFile(io.BufferedReader(_File(handle))).infolist() if i.filename.lower().endswith(".csv")]
                for i in members:
                    rows.append((path, name, i.filename, i.header_offset, i.compress_size, i.compress_type, i.flag_bits, i.CRC, None))
                if not members:
                    rows.append((path, name, None, None, None, None, None, None, EMPTY))
            except _FAULTS:
                rows.append((path, name, None, None, None, None, None, None, BROKEN))
            for start in range(0, len(rows), 1 << 14):
                yield _batch(rows[start : start + (1 << 14)], DIRECTORY)


def inflated(handle: pa.NativeFile, start: int, size: int, method: int, flags: int, checksum: int, step: int = ranges.READ) -> Iterator[bytes]:
    """The bytes of a member, in parts of about ``step``. What is wrong with it shows at the latest at its end."""
    if flags & 1:
        raise NotImplementedError("Membro cifrado.")
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise NotImplementedError(f"Compressão desconhecida: {method}.")
    handle.seek(start)
    head = handle.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("Cabeçalho do membro ausente.")
    handle.seek(start + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    inflate = zlib.decompressobj(-15) if method else None
    found, left = 0, size
    while left:
        part = handle.read(min(step, left))
        if not part:
            raise EOFError("Membro incompleto.")
        left -= len(part)
        while part:
            data = inflate.decompress(part, 4 * ranges.READ) if inflate else part
            part = inflate.unconsumed_tail if inflate else b""
            found = zlib.crc32(data, found)
            if data:
                yield data
    if inflate:
        data = inflate.flush()
        found = zlib.crc32(data, found)
        if data:
            yield data
        if not inflate.eof:
            raise EOFError("Membro incompleto.")
    if found != checksum:
        raise zipfile.BadZipFile("Soma de verificação diferente.")


def _with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            path, place, names = row[0], row[3:8], None
            if row[2] is not None:
                line = b""
                try:
                    with ranges.opened(path) as handle:
                        for part in inflated(handle, *place, step=1 << 12):
                            line += part
                            if b"\n" in part:
                                break
                    names = ranges.header_names(line.split(b"\n", 1)[0])
                except _FAULTS:
                    names = None  # reading its rows will tell
            rows.append((*row, names))
        if rows:
            yield _batch(rows, PLAN)


def _dealt(rows: DataFrame, found: int, size: int = 0) -> DataFrame:
    """Rows dealt out evenly: one to a task, or so many that all cores have several tasks and none has too many bytes.

    Members of an archive stay with their neighbours, so a table laid out by archive gets a file or a few for each, not one
    from every task.
    """
    session = rows.sparkSession
    largest = int(session._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    parts = max(1, min(found, max(4 * session.sparkContext.defaultParallelism, -(-size // largest))))
    return rows.repartitionByRange(parts, *[c for c in ("path", "inicio") if c in rows.columns])


def planned(files: DataFrame) -> DataFrame:
    """A row for each delimited member of the archives (``path``), with its place; for an archive that can't be read or
    has none, a row with a message. Written, so the directories are read once."""
    return materialise(_dealt(files.select("path"), files.count()).mapInArrow(_directory, DIRECTORY), "directory")


def with_headers(plan: DataFrame) -> DataFrame:
    """The plan with the names in each member's header (``colunas``), by its first bytes alone."""
    return _dealt(plan, plan.count()).mapInArrow(_with_header, PLAN)


def _with_more(table: pa.Table, columns: list[str], more: list[str]) -> pa.Table:
    """``columns`` as they are, and the ``more`` ones as a map."""
    n, k = table.num_rows, len(more)
    kind = pa.map_(pa.string(), pa.string())
    if not k:
        return table.select(columns).append_column(MORE, pa.nulls(n, kind))
    cells = np.arange(n * k)
    flat = pa.concat_arrays([table.column(c).combine_chunks() for c in more]).take(pa.array(cells % k * n + cells // k))
    keys = pa.array([c.lower() for c in more]).take(pa.array(cells % k))
    maps = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), keys, flat)
    return table.select(columns).append_column(MORE, maps)


def _rows(columns: list[str]):
    known = {c.lower() for c in columns}

    def member(name: str, own: str, header: str, blocks: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        names = ranges.column_names(header)
        more = [n for n in names if n.lower() not in known]
        for block in blocks:
            table = _with_more(ranges.parsed(block, names, [*columns, *more]), columns, more)
            yield from ranges.tagged(table, arquivo=name, membro=own, nivel=None, mensagem=None, linhas=None, cabecalho=None)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, own, *place, message in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sent, level, header = 0, "INFO", None
                if own is None:
                    level = "WARNING" if message == EMPTY else "ERROR"
                else:
                    try:
                        with ranges.opened(path) as handle:
                            blocks = ranges.whole_lines(inflated(handle, *place))
                            line, _, first = next(blocks, b"").partition(b"\n")
                            header = ranges.header_text(line)
                            for rows in member(name, own, header, itertools.chain([first] if first else [], blocks)):
                                sent += rows.num_rows
                                yield rows
                    except _FAULTS as error:
                        level, message, sent, header = "ERROR", f"Membro corrompido: {error}", 0, None
                event = _with_more(pa.table({c: pa.nulls(1, pa.string()) for c in columns}), columns, [])
                yield from ranges.tagged(event, arquivo=name, membro=own, nivel=level, mensagem=message, linhas=sent, cabecalho=header)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Small members share a batch."""
        held, rows, size = [], 0, 0
        for batch in each(batches):
            held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
            if rows >= BATCH_ROWS or size >= BATCH_BYTES or len(held) >= 256:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows, size = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return of


def staged(plan: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of all planned members with ``columns`` bound by name and what else they have in a map, and after each
    member an event: INFO with the rows it gave, or what is wrong (``nivel``, ``mensagem``, ``linhas``; a row has no
    ``nivel``).

    Each member is read once, and large ones have a task of their own; a member's checksum is known at its end, so its
    rows count only if its event is INFO. Written, for ``rows_of`` and ``events_of``.
    """
    kinds = {"linhas": T.LongType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in [*EVENT, *columns]])
    schema = schema.add(MORE, T.MapType(T.StringType(), T.StringType()))
    size = plan.agg(F.count("*").alias("n"), F.coalesce(F.sum("comprimido"), F.lit(0)).alias("b")).first()
    return materialise(_dealt(plan, size["n"], size["b"]).mapInArrow(_rows(columns), schema), "staged")


def rows_of(staged: DataFrame, added: list[str] | None = None) -> DataFrame:
    """The rows of sound members, with ``metadata_arquivo_origem`` and ``metadata_membro``, and ``added`` columns."""
    bad = staged.filter("nivel = 'ERROR'").select("arquivo", "membro")
    rows = staged.filter("nivel IS NULL").join(bad, ["arquivo", "membro"], "left_anti")
    columns = [quoted(c) for c in staged.columns if c not in EVENT and c != MORE]
    more = [F.element_at(MORE, F.lit(c.lower())).alias(c) for c in added or []]
    return rows.select(F.col("arquivo").alias("metadata_arquivo_origem"), F.col("membro").alias("metadata_membro"), *columns, *more)


def events_of(staged: DataFrame) -> DataFrame:
    """(arquivo, membro, nivel, mensagem, LINHAS): one for each member, and for each archive without usable ones."""
    return staged.filter("nivel IS NOT NULL").select("arquivo", "membro", "nivel", "mensagem", F.col("linhas").alias("LINHAS"))


def headers_of(staged: DataFrame) -> DataFrame:
    """(arquivo, membro, colunas) of the sound members."""
    names = F.udf(ranges.column_names, "array<string>")
    # Members have few different headers.
    headers = staged.filter("nivel = 'INFO'").select("arquivo", "membro", "cabecalho")
    known = headers.select("cabecalho").distinct().select("cabecalho", names("cabecalho").alias("colunas"))
    return headers.join(known, "cabecalho").select("arquivo", "membro", "colunas")


def drift(headers: DataFrame, known: list[str], required: list[str]) -> DataFrame:
    """(arquivo, membro, COLUNA, SITUACAO): names (``colunas``) a member adds to the ``known`` columns (NOVA), and ``required`` ones
    that it lacks (AUSENTE). Names are the same in any case."""
    names = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    tag = lambda found, state: F.transform(found, lambda c: F.struct(c.alias("COLUNA"), F.lit(state).alias("SITUACAO")))
    lower, there = names([c.lower() for c in known]), F.transform("colunas", F.lower)
    new = F.filter("colunas", lambda c: ~F.array_contains(lower, F.lower(c)))
    lacking = F.filter(names(required), lambda c: ~F.array_contains(there, F.lower(c)))
    changes = F.concat(tag(new, "NOVA"), tag(lacking, "AUSENTE"))
    return headers.filter("colunas IS NOT NULL").select("arquivo", "membro", F.inline(changes))


def from_blocks(blocks: DataFrame, columns: list[str], added: list[str] | None = None) -> DataFrame:
    """The shape of ``staged`` from expanded blocks (``extracts.expand_archives``), for stores that only Spark reads."""
    rows = extracts.parse_members(blocks, [*columns, *(added or [])])
    kind = "map<string, string>"
    more = F.create_map(*[x for c in added or [] for x in (F.lit(c.lower()), F.col(quoted(c)))]).cast(kind)
    rows = rows.select(
        F.col("metadata_arquivo_origem").alias("arquivo"), F.col("metadata_membro").alias("membro"),
        *[F.lit(None).cast("string").alias(c) for c in ("nivel", "mensagem")], F.lit(None).cast("long").alias("linhas"),
        F.lit(None).cast("string").alias("cabecalho"), *map(quoted, columns), more.alias(MORE),
    )
    rows = materialise(rows, "rows")
    counted = rows.groupBy("arquivo", "membro").agg(F.count("*").alias("linhas"))
    events = blocks.select("arquivo", "membro", "nivel", "mensagem", "cabecalho").distinct().join(counted, ["arquivo", "membro"], "left")
    blank = [F.lit(None).cast("string").alias(c) for c in columns]
    counts = F.coalesce("linhas", F.lit(0)).cast("long").alias("linhas")
    return rows.unionByName(events.select(*EVENT[:4], counts, "cabecalho", *blank, F.lit(None).cast(kind).alias(MORE)))
