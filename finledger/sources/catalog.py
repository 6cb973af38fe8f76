"""Which files to expect, what tables they become, and which are still to be loaded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger import schema as S
from finledger.functions.literals import literal_frame
from finledger.sources import ranges


def datasets(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, S.DATASETS, "DATASET string, PREFIXO string, COMPACTADO boolean, ANUAL boolean")


def expected_files(years: DataFrame) -> DataFrame:
    """File names per dataset for the years of ``years`` (column ``ANO``); unyearly datasets have one file."""
    spark = years.sparkSession
    kinds = datasets(spark)
    extension = F.when(F.col("COMPACTADO"), ".zip").otherwise(".csv")
    # A year is paired with the handful of dataset kinds by exploding a literal array, not by a join.
    yearly = [row[0:3] for row in S.DATASETS if row[3]]
    kind = F.explode(
        F.array(*[F.struct(F.lit(n).alias("DATASET"), F.lit(p).alias("PREFIXO"), F.lit(z).alias("COMPACTADO")) for n, p, z in yearly])
    )
    per_year = years.select("ANO", kind.alias("k")).select(
        F.col("k.DATASET").alias("DATASET"),
        "ANO",
        F.concat("k.PREFIXO", F.lit("_"), F.col("ANO").cast("string"), F.when(F.col("k.COMPACTADO"), ".zip").otherwise(".csv"))
        .alias("ARQUIVO"),
    )
    single = kinds.filter(~F.col("ANUAL")).select(
        "DATASET", F.lit(None).cast("int").alias("ANO"), F.concat("PREFIXO", extension).alias("ARQUIVO")
    )
    return per_year.unionByName(single)


def table_name(file_name: Column | str, year: Column | str, prefix: Column | str) -> Column:
    """Target table of an extract: lower case, without extension and year, with the family prefix in front."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    year = F.col(year) if isinstance(year, str) else year
    family = F.split_part(F.col(prefix) if isinstance(prefix, str) else prefix, F.lit("_"), F.lit(1))
    clean = F.replace(F.lower(name), F.lit(".csv"), F.lit(""))
    clean = F.when(year > 0, F.replace(clean, F.concat(F.lit("_"), year.cast("string")), F.lit(""))).otherwise(clean)
    return F.when(F.startswith(clean, family), clean).otherwise(F.concat(family, F.lit("_"), clean))


def pending_files(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Expected files without a successful load in the log."""
    done = log.filter(
        (F.col("nivel_log") == "SUCCESS") & F.col("mensagem").like("Processamento do arquivo finalizado%")
    ).select(F.col("arquivo_origem").alias("ARQUIVO"))
    return expected.join(done.distinct(), "ARQUIVO", "left_anti")


def schema_drift(known: list[str], incoming: DataFrame) -> DataFrame:
    """Columns of an extract that its table does not know, and known ones it lacks, with the rows they fill."""
    new = [c for c in incoming.columns if c not in known]
    missing = [c for c in known if c not in incoming.columns]
    counted = incoming.agg(F.count("*").alias("LINHAS"), *[F.count(c).alias(c) for c in new])
    entries = [
        F.struct(F.lit(c).alias("COLUNA"), F.lit("NOVA").alias("SITUACAO"), F.col(c).alias("PREENCHIDAS")) for c in new
    ] + [
        F.struct(F.lit(c).alias("COLUNA"), F.lit("AUSENTE").alias("SITUACAO"), F.lit(0).cast("bigint").alias("PREENCHIDAS"))
        for c in missing
    ]
    if not entries:
        empty = "array<struct<COLUNA:string,SITUACAO:string,PREENCHIDAS:bigint>>"
        return counted.select(F.inline(F.array().cast(empty)))
    return counted.select(F.inline(F.array(*entries)))


def align_to(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append rows of a drifted extract: new columns are added, missing ones are NULL."""
    return known.unionByName(incoming, allowMissingColumns=True)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, paths, sizes = (c.to_pylist() for c in batch.columns)
        rows = []
        for path in paths:
            with ranges.opened(path) as handle:
                rows.append(parquet.ParquetFile(handle).metadata.num_rows)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip((names, paths, rows, sizes), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["TABELA", "ARQUIVO", "LINHAS", "BYTES"])


def parquet_files(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(TABELA, ARQUIVO, LINHAS, BYTES) of every file of the tables (name to path), from the files' footers: no data page
    is read. In a store that only Spark's readers reach the rows are counted."""
    by_footer, counted = None, None
    for name, path in tables.items():
        if ranges.reachable(spark, path):
            files = ranges.listed(spark, path, "*.parquet").select(F.lit(name).alias("TABELA"), "path", "length")
            by_footer = files if by_footer is None else by_footer.unionByName(files)
        else:
            rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("ARQUIVO"))
            rows = rows.agg(F.count("*").alias("LINHAS"), F.max("_metadata.file_size").alias("BYTES"))
            rows = rows.select(F.lit(name).alias("TABELA"), "ARQUIVO", "LINHAS", "BYTES")
            counted = rows if counted is None else counted.unionByName(rows)
    schema = "TABELA string, ARQUIVO string, LINHAS long, BYTES long"
    if by_footer is not None:
        dealt = by_footer.repartition(4 * spark.sparkContext.defaultParallelism)
        by_footer = dealt.mapInArrow(_footers, schema)
        return by_footer if counted is None else by_footer.unionByName(counted)
    return counted if counted is not None else spark.createDataFrame([], schema)


def profile(files: DataFrame, top: int | None = None) -> DataFrame:
    """Rows, files and bytes of every table, largest first, and their total (``TABELA`` is NULL, last); with ``top`` the
    first tables only, the total of all."""
    sums = [F.sum("LINHAS").alias("LINHAS"), F.count("*").alias("ARQUIVOS"), F.sum("BYTES").alias("BYTES")]
    tables = files.groupBy("TABELA").agg(*sums).orderBy(F.col("BYTES").desc(), "TABELA")
    tables = tables if top is None else tables.limit(top)
    total = files.agg(*sums).select(F.lit(None).cast("string").alias("TABELA"), "LINHAS", "ARQUIVOS", "BYTES")
    return tables.unionByName(total)
